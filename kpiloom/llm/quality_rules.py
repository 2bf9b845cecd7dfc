"""Quality rules kept as a ledger of bits.

Every rule is evaluated once per document.  The ledger stores the
measurements and one integer whose bit ``k`` says that rule ``k`` failed.
A policy is a versioned set of rules, i.e. a mask over that integer; applying
another policy, or asking what each rule of a policy removes, reads only the
ledger and never the texts again.

DataFrame functions only; one pass over the table, no shuffle for the ledger.

Defined results: null and empty texts have no words and fail ``few_words``;
repeated rows each get their own ledger row; an empty table gives an empty
ledger; other columns of the input are carried where asked for and clash with
nothing, because the ledger's own columns are built in one ``select``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import WHITE, let, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``failed`` is a condition on the measurements (integers)."""

    name: str
    failed: Column


def default_rules() -> list[Rule]:
    """Position in this list = bit in the ledger: append only."""
    n = F.col("n_words")
    return [
        Rule("few_words", n < 20),
        Rule("repeated_words", 100 * F.col("n_repeat_words") > 30 * n),
        Rule("symbols", 10 * F.col("n_symbols") > n),
        Rule("duplicate_lines", (F.col("n_dup_lines") >= 5) & (100 * F.col("n_dup_lines") > 30 * F.col("n_lines"))),
        Rule("short_words", F.col("word_chars") < 2 * n),
        Rule("long_words", F.col("word_chars") > 15 * n),
        Rule("shouting", 10 * F.col("n_bangs") > 5 * n),
    ]


@dataclass(frozen=True)
class Policy:
    """A version of the decision: a document that fails any of ``rules`` goes."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: list[Rule]) -> int:
        names = [r.name for r in rules]
        return sum(1 << names.index(r) for r in self.rules)


#: Decisions over the same ledger; add a version, never change one.
BASE_POLICY = Policy("base-1", ("few_words", "repeated_words"))
DEFAULT_POLICY = Policy("web-1", ("few_words", "repeated_words", "symbols", "duplicate_lines", "short_words",
                                  "long_words", "shouting"))


def _count_chars(text: Column, chars: str) -> Column:
    """Occurrences of any of ``chars`` (the runs between them are cut out)."""
    quoted = "".join("\\" + c for c in chars)
    return F.length(F.regexp_replace(text, f"[^{quoted}]+", "")).cast("long")


def _repeat_words(words: Column, n: Column) -> Column:
    """Words covered by ``WINDOW``-word windows that occur at least twice.

    Windows are compared by a 64-bit hash.  Texts without a repeated window
    stop after one hash set.  Otherwise (hash, position) pairs are sorted, the
    positions whose neighbour has the same hash are kept, and each window adds
    the words up to the next kept one: linear but for the sort.
    """
    def hashes(ws: Column) -> Column:
        # windows of 2, 4 and 8 words, each from two neighbours of the one before
        joined = lambda a, k: F.zip_with(a, F.slice(a, F.lit(k + 1), n), lambda x, y: F.xxhash64(x, y))
        return let(F.transform(ws, lambda w: F.xxhash64(w)), lambda one: let(joined(one, 1), lambda two: let(
            joined(two, 2), lambda four: F.slice(joined(four, 4), F.lit(1), n - (WINDOW - 1)))))

    def covered(hs: Column) -> Column:
        pairs = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda ps, k, j: F.coalesce(F.get(ps, k)["h"] == F.get(ps, j)["h"], F.lit(False))
        starts = lambda ps: F.array_sort(F.transform(
            F.filter(F.transform(ps, lambda p, k: F.struct(p["i"].alias("i"), (same(ps, k, k - 1) | same(ps, k, k + 1)).alias("twice"))),
                     lambda s: s["twice"]), lambda s: s["i"]))
        widths = lambda ss: F.aggregate(
            ss, F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("last")),
            lambda a, s: F.struct((a["sum"] + F.least(F.lit(WINDOW), s - a["last"])).alias("sum"), s.alias("last")))["sum"]
        return let(pairs, lambda ps: let(starts(ps), widths))

    return F.when(n < WINDOW + 1, F.lit(0)).otherwise(
        let(hashes(words), lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(covered(hs)))
    ).cast("long")


def _measurements(text: Column) -> dict[str, Column]:
    """What needs no words array."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    both = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("u")))
    return {"n_symbols": _count_chars(text, SYMBOLS), "n_bangs": _count_chars(text, "!"), "lines": both}


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None,
           carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, measurements, ``fail_bits`` and ``carry``.

    ``carry`` columns travel as one struct ``row`` and cannot clash.
    """
    rules = rules or default_rules()
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       *([F.struct(*carry).alias("row")] if carry else []))
    kept = ["doc_id"] + (["row"] if carry else [])
    split = base.select(*kept, words_of(F.col("text")).alias("words"), *[c.alias(k) for k, c in _measurements(text).items()])
    size = F.size("words")
    measured = split.select(
        *kept, size.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols", "n_bangs",
        F.col("lines.n").alias("n_lines"), (F.col("lines.n") - F.col("lines.u")).alias("n_dup_lines"),
        _repeat_words(F.col("words"), size).alias("n_repeat_words"))
    bits = F.lit(0).cast("long")
    for k, r in enumerate(rules):
        bits = bits.bitwiseOR(F.when(r.failed, F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("fail_bits", bits)


def apply_policy(led: DataFrame, policy: Policy = DEFAULT_POLICY, rules: list[Rule] | None = None) -> DataFrame:
    """Adds ``policy_bits`` (failures the policy counts) and ``kept``."""
    mask = policy.mask(rules or default_rules())
    hit = F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long"))
    return led.withColumn("policy_bits", hit).withColumn("kept", hit == 0)


def ablations(led: DataFrame, policy: Policy = DEFAULT_POLICY, rules: list[Rule] | None = None) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone
    (dropping the rule would bring them back), and that the policy removes.

    One aggregation by failure pattern (at most 2^rules rows, pre-aggregated
    before the shuffle), then bitwise sums over the patterns.
    """
    rules = rules or default_rules()
    mask = policy.mask(rules)
    patterns = (led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits"))
                .agg(F.count(F.lit(1)).alias("n")))
    names = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << k).cast("long").alias("bit"))
                      for k, r in enumerate(rules) if mask >> k & 1])
    exploded = patterns.select("bits", "n", F.explode(names).alias("r"))
    fails = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (exploded.groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(fails & (F.bit_count("bits") == 1), F.col("n")).otherwise(0)).alias("n_failed_alone"),
                 F.sum(F.when(F.col("bits") != 0, F.col("n")).otherwise(0)).alias("n_removed_by_policy")))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Ledger plus the decisions of the base policy and of ``policy``."""
    led = ledger(docs, id_col, text_col)
    base = apply_policy(led, BASE_POLICY).withColumn("base_failed", F.col("policy_bits") != 0)
    return apply_policy(base, policy).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("kept")).alias("kept"),
        "n_lines", "n_bangs", "fail_bits", "policy_bits")
