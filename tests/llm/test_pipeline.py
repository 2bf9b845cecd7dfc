import re
from collections import Counter

import duckdb
import pytest
import regex

import __spark_entry__ as E
import corpus_pipeline as P
from check_oracle import rows_of
from kpiloom.llm.common import stored
from tests.conftest import SF01
from tests.llm.test_ngram_jaccard import brute as groups_of
from tests.llm.test_quality_rules import brute as measures_of

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in P.STAGES:
        docs = out[name] = stored(stage(spark, docs, SMALL), name)
    return out


def test_stages_return_the_columns_of_documents(stages):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "language_id", "near_duplicates", "personal_data", "best_fit_packing"]
    for name in list(stages)[:-1]:
        assert stages[name].columns == P.COLUMNS


def test_quality_stage(stages):
    def kept(text):
        n, chars, symbols, duplicates, repeats = measures_of(text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return not (n < 20 or 100 * repeats > 30 * n or 10 * symbols > n or duplicates >= 5 and 100 * duplicates > 30 * len(lines)
                    or chars < 2 * n or chars > 15 * n or 10 * text.count("!") > 5 * n)
    assert {r.doc_id for r in stages["quality_rules"].collect()} == {r.doc_id for r in stages["documents"].collect() if kept(r.text)}


def test_language_stage_keeps_documents_in_a_language(stages):
    before = {r.doc_id: r for r in stages["quality_rules"].collect()}
    after = {r.doc_id: r for r in stages["language_id"].collect()}
    assert len(after) >= 0.98 * len(before) and all(r == before[i] for i, r in after.items())


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    before = [(r.doc_id, r.text) for r in stages["language_id"].collect()]
    assert {r.doc_id for r in stages["near_duplicates"].collect()} == set(groups_of(before).values())


def test_personal_data_stage(stages):
    real = re.compile(r"[\w.]+@[\w.]+\w|\b\d+\.\d+\.\d+\.\d+\b|\+1 \(\d+\) [\d-]+|\b\d{13,19}\b|\b[0-9a-f]{40}\b")
    before = {r.doc_id: r for r in stages["near_duplicates"].collect()}
    after = {r.doc_id: r for r in stages["personal_data"].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r.n_chars == len(r.text)
        found = real.findall(before[i].text)
        assert not any(x in r.text for x in found)
        if not found and not regex.search(r"\d", before[i].text):
            assert r.text == before[i].text


def test_packing_stage_covers_every_document(stages):
    rows = stages["best_fit_packing"].collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in stages["personal_data"].collect()}
    used = Counter()
    for r in rows:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048


def test_stages_take_edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b c", None, "s", 5), (3, "a b c", None, "s", 5)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in P.STAGES:
            stage(spark, docs, SMALL).collect()


def test_run_is_registered_and_entry_has_all_queries():
    names = E.queries()
    assert names["pipeline"] is P.run
    assert {n.split("_")[0] for n in names if n[:2] == "op" and n[2:3].isdigit()} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", ["op4_url_filter", "op6_quality_rules"])
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    df = E.queries()[name](spark, SF01)
    result = con.execute(E.oracle_sql()[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in result.description], result.fetchall())
