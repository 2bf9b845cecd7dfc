"""Registered queries of the operators (``opN_<name>``) and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import byte_bpe, language_id, ngram_jaccard, order_minhash, packing
from kpiloom.llm.common import read
from kpiloom.llm.conversation_repair import damage, repair
from kpiloom.llm.importance_resampling import resample
from kpiloom.llm.jaccard_links import link_counts
from kpiloom.llm.license_scan import license_scan
from kpiloom.llm.nn_descent import near_vectors
from kpiloom.llm.prefix_trie import prefix_trie
from kpiloom.llm.quality_rules import quality_rules
from kpiloom.llm.surrogates import replace_entities
from kpiloom.llm.url_filter import DEFAULT_BLOCKS, UrlRule, rule_table, url_filter


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    """A public vocabulary, installed on the driver and every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_id.train(docs.where(~held_out))
    return language_id.predict(docs, model, carry=(F.col("doc_id"), held_out.alias("held_out"))).select(
        "doc_id", "held_out", "lang_pred", "score")


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints_of_edits(read(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.encode(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"),
                           public_tokenizers.PATTERN)


URL_RULES = (UrlRule("net/", "block"), UrlRule("example.net/en/", "allow"),
             UrlRule("example.com/de/", "block"), UrlRule("org/fr/", "allow"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(read(spark, sf_dir, "pages"), rule_table(spark, [*URL_RULES, *DEFAULT_BLOCKS]))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.near_duplicates(read(spark, sf_dir, "documents"))


def ngram_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 with the number of links of each document."""
    return link_counts(read(spark, sf_dir, "documents"))


def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


#: Key of the registered query; a deployment passes its own.
SURROGATE_KEY = "kpiloom-surrogates"


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(read(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read(spark, sf_dir, "documents"))


def word_ids(path: str) -> Callable[[str], bytes]:
    return lambda text: packing.tokenizer(path).ids(text)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(read(spark, sf_dir, "documents"), word_ids(tokenizer_file("word_bpe_49k.json")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))


def op13_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_order_minhash": op2_order_minhash,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_url_filter": op4_url_filter,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "ngram_jaccard_links": ngram_jaccard_links,
    "op7_importance_resampling": op7_importance_resampling,
    "op9_surrogates": op9_surrogates,
    "op10_license_scan": op10_license_scan,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op6_quality_rules": op6_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_nn_descent": op13_nn_descent,
}

#: crc32 of a text of ASCII characters, bit by bit.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''),
    lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"""

SQL: dict[str, str] = {
    "op11_prefix_trie": f"""
        WITH turns AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
                   [coalesce(role, ''), coalesce(text, '')] AS said
            FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (SELECT conv_id AS c, count(*) AS n, {_CRC32.format("conv_id::VARCHAR")} % 4 AS h FROM turns GROUP BY conv_id),
        rebuilt AS (
            SELECT c, pos AS rank, said FROM convs JOIN turns ON conv_id = c - c % 20 AND pos < h
            UNION ALL SELECT c, pos, said FROM convs JOIN turns ON conv_id = c AND pos >= h),
        paths AS (SELECT c, list(said ORDER BY rank) AS path FROM rebuilt GROUP BY c
                  UNION ALL SELECT c, [] FROM convs WHERE c NOT IN (SELECT c FROM rebuilt)),
        steps AS (SELECT c, len(path) AS len, d AS depth, path[1:d] AS node FROM paths, unnest(range(0, len(path) + 1)) AS r(d)),
        nodes AS (
            SELECT depth, node, min(c) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len = depth), '')) AS ends_sha256,
                   CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * len(list_filter(
                       regexp_split_to_array(node[-1][2], '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) END AS saved
            FROM steps GROUP BY depth, node),
        kids AS (SELECT depth - 1 AS depth, node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
        known AS (SELECT a.*, coalesce(k.n, 0) AS n_children FROM nodes a LEFT JOIN kids k ON a.depth = k.depth AND a.node = k.node)
        SELECT v.conv_id, v.depth::BIGINT AS depth, any_value(p.conv_id) AS parent_conv_id, any_value(v.n_convs) AS n_convs,
               any_value(v.n_children)::BIGINT AS n_children,
               count(DISTINCT [u.conv_id, u.depth]) FILTER (WHERE u.n_children = 0) AS n_leaves,
               sum(u.saved)::BIGINT AS saved_tokens, any_value(v.ends_sha256) AS ends_sha256
        FROM known v JOIN known u ON u.depth >= v.depth AND u.node[1:v.depth] = v.node
        LEFT JOIN known p ON p.depth = v.depth - 1 AND p.node = v.node[1:v.depth - 1]
        GROUP BY v.conv_id, v.depth""",
    "op4_url_filter": """
        WITH cut AS (
            SELECT page_id, coalesce(substr(url, nullif(strpos(url, '://'), 0) + 3), '') AS rest FROM pages),
        parts AS (
            SELECT page_id,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
        ruled AS (
            SELECT page_id, host, path,
                   CASE WHEN '.' || host LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
                        WHEN '.' || host LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
                        WHEN '.' || host LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
                        WHEN '.' || host LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule,
                   CASE WHEN host || path LIKE '%/wp-login.php%' THEN '*/wp-login.php'
                        WHEN '.' || host LIKE '%.cheap-pills.%' THEN 'cheap-pills.'
                        WHEN '.' || host LIKE '%.casino-win.%' THEN 'casino-win.'
                        WHEN '.' || host LIKE '%.spam-farm.%' THEN 'spam-farm.'
                        WHEN '.' || host LIKE '%.free-bets.%' THEN 'free-bets.'
                        WHEN '.' || host LIKE '%.ads-track.%' THEN 'ads-track.'
                        WHEN host || path LIKE '%/cgi-bin/%' THEN '*/cgi-bin/'
                        WHEN '.' || host LIKE '%.adult-x.%' THEN 'adult-x.' END AS blocked
            FROM parts)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                    WHEN blocked IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
               CASE WHEN rule IS NULL THEN blocked END AS method_rule
        FROM ruled""",
    "op13_nn_descent": """
        WITH RECURSIVE units AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
        links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM units a JOIN units b
                  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
        reached AS (SELECT vec_id AS x, vec_id AS y FROM units UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y),
        smallest AS (SELECT x, min(y) AS component_id FROM reached GROUP BY x),
        counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
        SELECT s.x AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, s.x = component_id AS kept
        FROM smallest s LEFT JOIN counted c ON c.x = s.x""",
    "op6_quality_rules": r"""
        WITH split AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
            FROM documents),
        positions AS (SELECT doc_id, len(words) AS n, words, unnest(range(1, len(words) - 6)) AS i FROM split WHERE len(words) > 8),
        windows AS (SELECT doc_id, n, i, count(*) OVER (PARTITION BY doc_id, words[i : i + 7]) AS times FROM positions),
        covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS word FROM windows WHERE times > 1),
        repeats AS (SELECT doc_id, count(*) AS n_repeat_words FROM covered GROUP BY doc_id),
        base AS (
            SELECT s.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
                   length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                   (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
                   coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
                   length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_bangs
            FROM split s LEFT JOIN repeats r ON s.doc_id = r.doc_id),
        bits AS (
            SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END
                       + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
                       + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
                       + CASE WHEN n_dup_lines >= 5 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
                       + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
                       + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END
                       + CASE WHEN 10 * n_bangs > 5 * n_words THEN 64 ELSE 0 END)::BIGINT AS fail_bits
            FROM base)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
               fail_bits = 0 AS kept, n_lines, n_bangs, fail_bits, fail_bits AS policy_bits
        FROM bits""",
}
