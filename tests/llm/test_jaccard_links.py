import itertools
import random

import numpy as np
import pytest

from kpiloom.llm.jaccard_links import common_tokens, link_counts
from tests.llm.conftest import EDGE
from tests.llm.test_ngram_jaccard import brute, corpus, shingles


def brute_links(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    links = dict.fromkeys((i for i, _ in rows), 0)
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            links[i] += 1
            links[j] += 1
    return links


@pytest.mark.parametrize("tokens, columns", [(1 << 17, 1 << 12), (400, 64)])
def test_counts_match_brute_force(table, monkeypatch, tokens, columns):
    monkeypatch.setattr("kpiloom.llm.jaccard_links.TOKENS", tokens)
    monkeypatch.setattr("kpiloom.llm.jaccard_links.COLUMNS", columns)
    rows = corpus(9)
    got = link_counts(table(rows).repartition(3)).collect()
    assert {r.doc_id: r.n_links for r in got} == brute_links(rows)
    assert {r.doc_id: r.component_id for r in got} == brute(rows)
    assert len(got) == len(rows) and max(r.n_links for r in got) > 3


def test_common_tokens_match_sets():
    rng = random.Random(3)
    sets = [np.unique(np.array([rng.randrange(50) for _ in range(rng.randint(0, 30))], np.int64)) for _ in range(12)]
    got = common_tokens(sets[:5], sets[5:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:5]]


def test_edges(spark, table):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [*EDGE, (40, text), (41, text), (41, text), (None, text)]
    got = link_counts(table(rows)).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.n_links) for r in got if r.doc_id in (40, 41)) == [(40, 1), (41, 1), (41, 1)]
    assert all(r.n_links is None and r.component_id is None for r in got if r.doc_id is None)
    assert link_counts(table([])).count() == 0
    odd = spark.createDataFrame([(1, "a b", 5, 6)], "doc_id long, text string, n_links int, component_id int")
    assert link_counts(odd).first()["n_links"] == 0
