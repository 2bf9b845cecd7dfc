"""Data selection by importance resampling.

Two generative models over hashed word unigrams and bigrams, one of target
text and one of all raw text, give each document the logarithm of its
importance weight; adding Gumbel noise and taking the largest keys samples
without replacement in proportion to the weights.

The raw model counts every document.  The target model is fitted on a bounded
sample of rows labelled good (``ResamplingConfig.target_sample``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import Recent, stored

#: Words and runs of punctuation.
TOKEN = re.compile(r"\w+|[^\w\s]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)  # fixed: odd 64-bit constant


@dataclass(frozen=True)
class ResamplingConfig:
    buckets: int = 1 << 16
    #: Labelled rows that make the target model, at most.
    target_sample: int = 20_000
    #: Added to every bucket of both models.
    smoothing: float = 1.0
    seed: int = 1


@lru_cache(maxsize=1)
def _hashes() -> Recent:
    return Recent(xxhash.xxh3_64_intdigest, 300_000)


def ngram_buckets(text: str | None, buckets: int) -> np.ndarray:
    """Buckets of the unigrams and bigrams of a whole text, lower-cased."""
    words = TOKEN.findall(text.lower()) if text else []
    h = np.fromiter(map(_hashes().__getitem__, words), np.uint64, len(words))
    pairs = (h[:-1] * _ODD) ^ (h[1:] + (h[:-1] >> np.uint64(29)))
    pairs ^= pairs >> np.uint64(32)
    return (np.concatenate([h, pairs * _ODD >> np.uint64(20)]) % np.uint64(buckets)).astype(np.int64)


def _models(docs: DataFrame, target_ids: np.ndarray, config: ResamplingConfig) -> np.ndarray:
    """Counts per bucket of the raw and of the target text; one row per task
    and bucket before the shuffle, one per bucket to the driver."""
    sent = docs.sparkSession.sparkContext.broadcast(target_ids)

    def run(batches):
        counts = np.zeros((2, config.buckets), np.int64)
        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                at = ngram_buckets(text, config.buckets)
                c = np.bincount(at, minlength=config.buckets)
                counts[0] += c
                if doc is not None and (i := np.searchsorted(sent.value, doc)) < len(sent.value) and sent.value[i] == doc:
                    counts[1] += c
        at = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[0][at]), pa.array(counts[1][at])],
                                         ["bucket", "raw", "target"])

    out = np.zeros((2, config.buckets))
    sums = (docs.mapInArrow(run, "bucket int, raw long, target long").groupBy("bucket")
            .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    for r in sums.collect():
        out[:, r["bucket"]] = r["raw"], r["target"]
    return out


def kth_largest(values: DataFrame, k: int) -> float | None:
    """The k-th largest of a one-column table of doubles, exactly: histograms
    of ever smaller ranges, until the range holds few values."""
    name = values.columns[0]
    low, high, n = values.agg(F.min(name), F.max(name), F.count(name)).first()
    if k <= 0 or n == 0:
        return None
    if k >= n:
        return low
    above, inside = 0, n
    while inside > 4096 and low < high:
        width = (high - low) / 1024
        place = F.least(F.lit(1023), F.floor((F.col(name) - low) / width)) if width > 0 else F.lit(0)
        rows = (values.where(F.col(name).between(low, high)).groupBy(place.alias("bin"))
                .agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("low"), F.max(name).alias("high")).orderBy(F.desc("bin")).collect())
        for r in rows:
            if above + r["n"] >= k:
                same = (low, high) == (r["low"], r["high"])
                low, high, inside = r["low"], r["high"], r["n"]
                break
            above += r["n"]
        if same:
            break
    if low == high:
        return low
    inner = sorted((r[0] for r in values.where(F.col(name).between(low, high)).collect()), reverse=True)
    return inner[k - above - 1]


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, id_col: str = "doc_id", text_col: str = "text",
             target: str = "quality = 1 and toxic = 0", good: str = "quality = 1", config: ResamplingConfig | None = None) -> DataFrame:
    """Per row: ``doc_id, n_ngrams, log_weight, gumbel_key, kept``.

    ``kept`` marks the sample of ``k`` rows; without ``k`` it is the share of
    labelled rows that are ``good`` (counted over all labels) of the rows that
    have an n-gram.  ``target`` says which labelled rows are target text.  Null and empty texts have weight 0 and are never kept.
    Rows tied at the last key are all kept.  Without a target row the target
    is the raw text and all weights are 0.  Repeated rows stay repeated, with
    equal keys; an empty table gives an empty result; other columns are left
    out, so none can clash.
    """
    config = config or ResamplingConfig()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.expr(good), F.lit(False)).alias("good"),
                           F.coalesce(F.expr(target), F.lit(False)).alias("target"))
    chosen = (marked.where("target and doc_id is not null").select("doc_id").distinct()
              .orderBy(F.xxhash64("doc_id", F.lit(config.seed)), "doc_id").limit(config.target_sample).collect())
    raw, wanted = _models(rows, np.array(sorted(r["doc_id"] for r in chosen), np.int64), config)
    a = config.smoothing
    ratio = np.log((wanted + a) / (wanted.sum() + a * config.buckets)) - np.log((raw + a) / (raw.sum() + a * config.buckets))
    sent = docs.sparkSession.sparkContext.broadcast(ratio if wanted.sum() else np.zeros(config.buckets))

    def run(batches):
        for b in batches:
            n, weight, mark = [], [], []
            for text in b.column("text").to_pylist():
                at = ngram_buckets(text, config.buckets)
                n.append(len(at))
                weight.append(float(sent.value[at].sum()))
                mark.append(xxhash.xxh3_64_intdigest(text or "") >> 1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(weight, pa.float64()), pa.array(mark, pa.int64())],
                ["doc_id", "n_ngrams", "log_weight", "mark"])

    uniform = (F.pmod(F.xxhash64("doc_id", "mark", F.lit(config.seed)), F.lit(1 << 52)) + 0.5) / (1 << 52)
    keyed = rows.mapInArrow(run, "doc_id long, n_ngrams long, log_weight double, mark long").select(
        "doc_id", "n_ngrams", "log_weight",
        F.when(F.col("n_ngrams") > 0, F.col("log_weight") - F.log(-F.log(uniform))).alias("gumbel_key"))
    keyed = stored(keyed, "keys")
    if k is None:
        share = marked.agg(F.avg(F.col("good").cast("double"))).first()[0]
        k = round((share or 0.0) * keyed.where("n_ngrams > 0").count())
    last = kth_largest(keyed.where("n_ngrams > 0").select("gumbel_key"), k)
    return keyed.withColumn("kept", F.coalesce(F.col("gumbel_key") >= F.lit(last), F.lit(False)))
