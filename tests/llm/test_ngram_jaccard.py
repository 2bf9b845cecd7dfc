import itertools
import random

import numpy as np
import pytest

from kpiloom.llm.ngram_jaccard import JaccardConfig, components, filed, keep_one, may_link, near_duplicates, tokens_of
from tests.llm.conftest import EDGE

CONFIG = JaccardConfig()


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def corpus(seed, families=6, size=14, passage=40):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    shared = [word() for _ in range(passage)]
    rows, n = [], 0
    for _ in range(families):
        base = [word() for _ in range(rng.randint(12, 160))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = word()
            if rng.random() < 0.2:
                words = words[:len(words) // 2] + shared + words[len(words) // 2:]
            rows.append((n, " ".join(words)))
            n += 1
    rows += [(n + i, " ".join(shared + [word() for _ in range(rng.randint(0, 60))])) for i in range(30)]
    rows += [(n + 30 + i, rows[i][1].upper()) for i in range(5)]
    return rows


@pytest.mark.parametrize("seed, frequent", [(1, 24), (2, 2)])
def test_components_match_brute_force(table, seed, frequent):
    rows = corpus(seed)
    got = near_duplicates(table(rows).repartition(3), config=JaccardConfig(frequent=frequent)).collect()
    want = brute(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    texts = dict(rows)
    assert all(r.n_shingles == len(shingles(texts[r.doc_id])) for r in got)


def test_large_groups_are_compared_in_blocks(table, monkeypatch):
    monkeypatch.setattr("kpiloom.llm.ngram_jaccard.BLOCK", 4)
    rows = corpus(6)
    got = near_duplicates(table(rows), config=JaccardConfig(frequent=2), rounds=0).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows)


def test_similar_sets_share_a_key_for_any_frequent_class():
    rng = np.random.default_rng(5)
    for _ in range(400):
        n = int(rng.integers(2, 120))
        x = np.unique(rng.integers(-2**62, 2**62, n))
        drop = rng.random(len(x)) < rng.random() * 0.2
        y = np.unique(np.concatenate([x[~drop], rng.integers(-2**62, 2**62, int(rng.integers(0, n // 6 + 1)))]))
        same = len(np.intersect1d(x, y))
        if not len(y) or 100 * same < 80 * (len(x) + len(y) - same):
            continue
        share = rng.random()
        often = lambda t: (t.view(np.uint64) % np.uint64(1000)).astype(float) / 1000 < share
        assert len(np.intersect1d(filed(x, often(x), CONFIG), filed(y, often(y), CONFIG)))
        head = lambda t: (t[:2 * CONFIG.lacking(len(t)) + 2] >> 32).astype(np.int32)
        assert may_link(len(x), head(x), len(y), head(y), CONFIG)


def test_words_are_split_and_lowered_as_stated():
    assert (tokens_of("A b\tC\x0bd\x0ce f") == tokens_of("a B c D E f")).all()
    assert len(tokens_of("a b")) == 1 and len(tokens_of("É b")) == 1
    assert (tokens_of("É") != tokens_of("é")).all()
    assert len(tokens_of(None)) == len(tokens_of(" \n")) == 0


def test_edges(spark, table):
    rows = near_duplicates(table(EDGE)).collect()
    assert len(rows) == len(EDGE)
    assert {r.component_id for r in rows if r.doc_id in (4, 5)} == {4}
    assert all(r.component_id == r.doc_id and r.n_shingles == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert near_duplicates(table([])).count() == 0
    odd = spark.createDataFrame([(1, "a b c d e f", 3, "k"), (2, "a b c d e f", 4, "k")], "doc_id long, text string, node int, sig string")
    assert {r.component_id for r in near_duplicates(odd).collect()} == {1}
    kept = keep_one(odd)
    assert kept.columns == odd.columns and [r.node for r in kept.collect()] == [3]


def test_rows_that_share_an_id_are_one_document(table):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = {(r.doc_id, r.component_id) for r in near_duplicates(table([(5, a), (5, b), (3, a), (9, b), (8, "x y z")])).collect()}
    assert rows == {(5, 3), (3, 3), (9, 3), (8, 8)}


def test_keep_one_keeps_one_of_each_group(table):
    rows = corpus(4)
    want = brute(rows)
    kept = [r.doc_id for r in keep_one(table(rows + [(None, "x y"), (None, "x y")])).collect()]
    assert sorted(i for i in kept if i is not None) == sorted(set(want.values())) and kept.count(None) == 2


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400)], "a long, b long")
    assert {(r.node, r.component) for r in components(edges).collect()} == {(i, 0) for i in range(201)} | {(400, 400), (500, 400)}


def test_session_and_columns_stay_as_they_were(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(1, "a b c d e f", 7), (2, "a b c d e f", 8)], "doc_id long, text string, held_back int")
    assert [tuple(r) for r in keep_one(docs).select(*docs.columns).collect()] == [(1, "a b c d e f", 7)]
    assert spark.conf.get(name) == before
