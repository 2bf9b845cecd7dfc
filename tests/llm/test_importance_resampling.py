import math
import random

import numpy as np
import pytest

from kpiloom.llm.importance_resampling import ResamplingConfig, kth_largest, ngram_buckets, resample
from tests.llm.conftest import EDGE

CONFIG = ResamplingConfig(buckets=1 << 12)


def corpus():
    rng = random.Random(1)
    good = [f"good{i}" for i in range(40)]
    bad = [f"bad{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(good if i % 4 else bad) for _ in range(rng.randint(20, 60)))) for i in range(200)]
    labels = [(i, 1 if i % 4 else 0, 0) for i in range(0, 200, 2)]
    return rows, labels


def brute(rows, labels, config):
    raw, wanted = np.zeros(config.buckets), np.zeros(config.buckets)
    target = {i for i, q, t in labels if q == 1 and t == 0}
    for i, text in rows:
        c = np.bincount(ngram_buckets(text, config.buckets), minlength=config.buckets)
        raw += c
        wanted += c * (i in target)
    ratio = np.log((wanted + 1) / (wanted.sum() + config.buckets)) - np.log((raw + 1) / (raw.sum() + config.buckets))
    return {i: ratio[ngram_buckets(text, config.buckets)].sum() for i, text in rows}


def test_weights_match_brute_force_and_sample_follows_them(spark, table):
    rows, labels = corpus()
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = resample(table(rows).repartition(3), lab, config=CONFIG).collect()
    want = brute(rows, labels, CONFIG)
    assert all(math.isclose(r.log_weight, want[r.doc_id], abs_tol=1e-6) for r in out)
    share = sum(q for _, q, _ in labels) / len(labels)
    assert sum(r.kept for r in out) == round(share * len(rows))
    keys = sorted((r.gumbel_key for r in out), reverse=True)
    assert all(r.kept == (r.gumbel_key >= keys[round(share * len(rows)) - 1]) for r in out)
    wrong = [r.doc_id for r in out if r.kept and r.doc_id % 4 == 0]
    assert not wrong


@pytest.mark.parametrize("k", [0, 1, 17, 4999, 9000])
def test_kth_largest_is_exact(spark, k):
    rng = np.random.default_rng(k)
    values = np.concatenate([rng.normal(size=6000), np.full(3000, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert kth_largest(df, k) == (sorted(values, reverse=True)[k - 1] if k else None)


def test_gumbel_noise_has_the_right_mean(spark, table):
    rows = [(i, "same text here") for i in range(4000)]
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = resample(table(rows), lab, k=100, config=CONFIG).collect()
    assert {r.log_weight for r in out} == {0.0}
    assert abs(np.mean([r.gumbel_key for r in out]) - 0.5772) < 0.08
    assert sum(r.kept for r in out) == 100


def test_edges(spark, table):
    lab = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (7, 0, 1), (None, 1, None), (5, None, 0)], "doc_id long, quality int, toxic int")
    out = resample(table(EDGE), lab, k=100, config=CONFIG).collect()
    assert len(out) == len(EDGE)
    assert all(not r.kept and r.log_weight == 0 for r in out if r.doc_id in (1, 2, 3))
    assert all(r.kept for r in out if r.doc_id in (4, 5, 6, 7, None))
    assert resample(table([]), lab, config=CONFIG).count() == 0
    odd = spark.createDataFrame([(1, "a b", 1, 2.0)], "doc_id long, text string, quality int, mark double")
    assert resample(odd, lab, k=1, config=CONFIG).first().kept
