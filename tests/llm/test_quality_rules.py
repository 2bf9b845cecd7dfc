import re
from collections import Counter

from kpiloom.llm.quality_rules import BASE_POLICY, DEFAULT_POLICY, Policy, ablations, apply_policy, ledger, quality_rules
from tests.llm.conftest import EDGE


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_measurements_match_brute_force(spark, table):
    texts = ["a b c d e f g h i " * 4, "same line\nsame line\n\nother\nsame line", "é ü中 x\u00a0y # * $% &|<>", "w" * 3,
             " ".join("abcdefgh") + " " + " ".join("abcdefgh"), " ".join("abcdefgh") + " z " + " ".join("abcdefgh")]
    rows = [*EDGE, *((100 + i, t) for i, t in enumerate(texts))]
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in quality_rules(table(rows)).collect())
    assert got == Counter((i, *brute(t)) for i, t in rows)


def test_base_failure_overrides(spark, table):
    rows = {r.doc_id: r for r in quality_rules(table([(1, "a " * 19), (2, " ".join(f"w{i}" for i in range(20))), (3, "z " * 40)])).collect()}
    assert rows[1].base_failed and not rows[1].kept
    assert not rows[2].base_failed and rows[2].kept
    assert rows[3].base_failed and not rows[3].kept


def test_policies_and_ablations_read_the_ledger(spark, table):
    clean = " ".join(f"word{i}" for i in range(30))
    symbols = " ".join(f"word{i}***" for i in range(30))
    led = ledger(table([(1, clean), (2, symbols), (3, "short"), (4, "##")]))
    assert {r.doc_id for r in apply_policy(led, DEFAULT_POLICY).where("kept").collect()} == {1}
    assert {r.doc_id for r in apply_policy(led, BASE_POLICY).where("kept").collect()} == {1, 2}
    assert {r.doc_id for r in apply_policy(led, Policy("none", ())).where("kept").collect()} == {1, 2, 3, 4}
    found = {r.rule: (r.n_failed, r.n_failed_alone, r.n_removed_by_policy) for r in ablations(led).collect()}
    assert found["few_words"] == (2, 1, 3)
    assert found["symbols"] == (2, 1, 3)
    assert found["shouting"] == (0, 0, 3)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert quality_rules(df).count() == 0
    odd = spark.createDataFrame([(1, "a b", 5, "x", True)], "doc_id long, text string, n_words int, words string, kept boolean")
    row = quality_rules(odd).first()
    assert row.n_words == 2 and row.kept is False
    carried = ledger(odd, carry=("doc_id", "n_words", "words")).first()
    assert carried.row.n_words == 5 and carried.n_words == 2


def test_no_python_in_the_plan(spark, table):
    plan = quality_rules(table(EDGE))._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
