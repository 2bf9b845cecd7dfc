import dataclasses
import math

import numpy as np
import pytest

from kpiloom.llm import nn_descent as N

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, threshold=0.9):
    """(vec_id, links, smallest reachable id) per row."""
    unit = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        x = np.array(v, float) if ok else None
        unit.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if ok else None)
    near = [[j for j in range(len(rows)) if j != i and unit[i] is not None and unit[j] is not None
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        name = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), name, rows[i][0] == name))
    return sorted(out, key=repr)


def run(spark, rows, schema=SCHEMA, **more):
    df = spark.createDataFrame(rows, schema).repartition(3)
    out = N.near_vectors(df, config=dataclasses.replace(N.NearConfig(), **more))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, out.collect()), key=repr)


def clouds(sizes, dim=24, noise=0.04, seed=1):
    """Near copies around random centres, and vectors of their own."""
    rng, rows = np.random.default_rng(seed), []
    for size in sizes:
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        rows += [(centre + rng.normal(size=dim) * noise).tolist() for _ in range(size)]
    order = rng.permutation(len(rows))
    return [(int(k) * 3, rows[k]) for k in order]


def test_groups_and_singles(spark):
    rows = clouds([1] * 300 + [2] * 40 + [7] * 10 + [60])
    assert run(spark, rows, block=32) == brute(rows)


def test_group_larger_than_a_block_or_a_part(spark):
    rows = clouds([400] + [1] * 50 + [30], noise=0.03)
    assert run(spark, rows, block=32, part=20) == brute(rows)


def test_large_component_that_is_no_clique(spark):
    """An arc: each vector links with those near it on the arc only."""
    rows = [(k, [math.cos(k / 60), math.sin(k / 60), 0.0, 0.0]) for k in range(180)]
    assert run(spark, rows, block=32, part=16) == brute(rows)
    rows += clouds([90], dim=4, noise=0.15)
    assert run(spark, [(i, v) for i, (_, v) in enumerate(rows)], block=32, part=16) == brute([(i, v) for i, (_, v) in enumerate(rows)])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]), (8, [2.0, 4.0]),
            (8, [2.0, 4.0]), (None, [1.0, 2.0]), (9, [1.0, 2.0, 0.0]), (10, [-1.0, -2.0]), (11, [1e300, 2e300]), (12, [1e-300, 2e-300]),
            (None, [5.0, -9.0]), (13, [-0.0, 0.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, block=4) == brute(rows)


def test_empty_table_and_extra_columns(spark):
    assert run(spark, []) == []
    rows = [(1, [1.0, 0.0], 5, "x"), (2, [1.0, 0.1], 6, "y")]
    assert run(spark, rows, SCHEMA + ", component long, row string") == [(1, 1, 1, True), (2, 1, 1, False)]


def test_no_link_below_the_threshold(spark):
    a = math.acos(0.9)
    rows = [(0, [1.0, 0.0]), (1, [math.cos(a - 1e-9), math.sin(a - 1e-9)]), (2, [math.cos(a + 1e-9), -math.sin(a + 1e-9)])]
    assert run(spark, rows) == [(0, 1, 0, True), (1, 1, 0, False), (2, 0, 2, True)]


def test_audit_asks_for_more(spark, monkeypatch):
    """Few bits and tiny blocks find little at once; the audit goes on."""
    seen = []
    told = N.audited
    monkeypatch.setattr(N, "audited", lambda *a: seen.append(told(*a)) or seen[-1])
    rows = clouds([1] * 400 + [2] * 100, noise=0.07)
    run(spark, rows, block=4, trees=1, rounds=0, turns=3, recall=1.0)
    assert len(seen) > 1 and seen == sorted(seen)


@pytest.mark.parametrize("sf", ["sf0.1"])
def test_recall_on_real_vectors(spark, sf):
    from kpiloom.llm.queries import QUERIES

    path = f"/root/testdata/{sf}"
    x = spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    unit = np.array(x["embedding"].tolist(), float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    true = ((unit @ unit.T) >= 0.9).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in QUERIES["op13_nn_descent"](spark, path).collect()}
    assert len(got) == len(x) and all(got[v] <= t for v, t in zip(x["vec_id"], true))
    assert sum(got.values()) >= 0.99 * true.sum()
