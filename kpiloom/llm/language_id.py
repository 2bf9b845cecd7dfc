"""Language identification from character n-grams.

Sparse multinomial logistic regression on TF-IDF of hashed character n-grams,
trained with follow-the-regularised-leader (proximal, per coordinate) under an
elastic-net penalty, then calibrated by a temperature.

Corpus statistics (document frequencies) are counted over all learnable rows.
The model is fitted on a bounded sample of them (``LanguageConfig.sample``).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
#: Code points hashed at once: bounds the memory of a very long text.
BLOCK = 1 << 20
_MULTIPLY = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)  # fixed: odd 32-bit constants


@dataclass(frozen=True)
class LanguageConfig:
    buckets: int = 1 << 14
    orders: tuple[int, ...] = (1, 2, 3)
    #: Labelled texts the model is fitted on, at most, over all languages
    #: (a fifth of them is held back for the temperature).
    sample: int = 4000
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-4


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages, sparse in effect
    bias: np.ndarray
    temperature: float
    config: LanguageConfig


def ngram_counts(text: str, config: LanguageConfig) -> np.ndarray:
    """Counts of hashed n-grams of the whole text, lower-cased."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    shift = np.uint32(32 - config.buckets.bit_length() + 1)
    counts = np.zeros(config.buckets, np.int64)
    most = max(config.orders)
    for at in range(0, len(points), BLOCK):
        part = points[at:at + BLOCK + most - 1]
        for n in config.orders:
            here = min(BLOCK, len(part) - n + 1)
            if here <= 0:
                continue
            code = np.full(here, n * 0x165667B1 & 0xFFFFFFFF, np.uint32)
            for j in range(n):
                code = (code ^ part[j:j + here]) * _MULTIPLY[j]
                code ^= code >> np.uint32(15)
            counts += np.bincount((code * _MULTIPLY[3]) >> shift, minlength=config.buckets)
    return counts


def features(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of unit length: (buckets, values)."""
    at = np.flatnonzero(counts)
    return at, _unit(counts[at], idf[at])


def _unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


def packed(counts: np.ndarray) -> tuple[bytes, bytes]:
    """The buckets that a text has and their counts, in the narrowest integers
    that hold all buckets and the text's greatest count."""
    at = np.flatnonzero(counts)
    narrow = np.min_scalar_type(counts.max(initial=0))
    return at.astype(np.min_scalar_type(len(counts) - 1)).tobytes(), counts[at].astype(narrow).tobytes()


def unpacked(buckets, counts, config: LanguageConfig) -> tuple[np.ndarray, np.ndarray]:
    """What ``packed`` was given: (buckets, counts)."""
    at = np.frombuffer(buckets, np.min_scalar_type(config.buckets - 1))
    own = np.frombuffer(counts, f"u{len(counts) // len(at)}") if len(at) else at
    return at.astype(np.int64), own.astype(np.int64)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _document_frequencies(rows: DataFrame, config: LanguageConfig) -> tuple[int, np.ndarray]:
    """Rows, and per bucket the rows that have it: one row per task and bucket
    before the shuffle, one per bucket to the driver."""
    def run(batches):
        seen, n = np.zeros(config.buckets + 1, np.int64), 0
        for b in batches:
            for text in b.column("text").to_pylist():
                seen[:-1] += ngram_counts(text, config) > 0
                n += 1
        seen[-1] = n
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], ["bucket", "n"])

    total = np.zeros(config.buckets + 1, np.int64)
    for r in rows.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r["bucket"]] = r["n"]
    return int(total[-1]), total[:-1]


def _sample(rows: DataFrame, config: LanguageConfig) -> pa.Table | None:
    """At most ``config.sample`` distinct texts as n-gram counts: the same
    number of each language if there are enough (one at least), those of the
    lowest hashes.  Copies of a text count as one, so a text with many copies
    takes no place from others and no language is cut.

    The counts reach the driver packed and as Arrow, which it holds as they
    come; it puts the texts in order itself."""
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("text").alias("n")).collect()}
    if not sizes:
        return None
    each = max(1, config.sample // len(sizes))
    place = F.xxhash64("text", F.lit(17))
    # about twice as many as needed pass by their hash, then the first are taken
    share = F.create_map(*[F.lit(v) for lang, n in sizes.items()
                           for v in (lang, int(min(1.0, (2 * each + 32) / max(1, n)) * (1 << 30)))])
    chosen = rows.where(F.pmod(place, F.lit(1 << 30)) < F.element_at(share, F.col("lang"))).select("text", "lang").distinct()
    order = Window.partitionBy("lang").orderBy(F.pmod("place", F.lit(1 << 30)), "place", "text")
    first = (chosen.withColumn("place", place).withColumn("rank", F.row_number().over(order))
             .where(F.col("rank") <= each).drop("rank"))

    def run(batches):
        for b in batches:
            out = [packed(ngram_counts(text, config)) for text in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("lang"), b.column("place"), pa.array([o[0] for o in out], pa.binary()),
                 pa.array([o[1] for o in out], pa.binary())], ["lang", "place", "buckets", "counts"])

    found = first.select("lang", "place", "text").mapInArrow(run, "lang string, place long, buckets binary, counts binary").toArrow()
    return found.sort_by([(c, "ascending") for c in ("place", "lang", "buckets", "counts")])


def _train(fit: list[int], example, k: int, config: LanguageConfig) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal: per coordinate, z gathers gradients corrected for the
    weights they were taken at, n their squares; weights follow in closed form
    (soft threshold by ``l1``, shrinkage by ``l2``).  The last row is the bias.
    ``example(i)``: features and label of the example ``i``."""
    z, n = np.zeros((config.buckets + 1, k)), np.zeros((config.buckets + 1, k))

    def weights(z, n):
        return np.where(np.abs(z) <= config.l1, 0.0, -(z - np.sign(z) * config.l1) / ((config.beta + np.sqrt(n)) / config.alpha + config.l2))

    for epoch in range(config.epochs):
        for i in np.random.default_rng(epoch).permutation(len(fit)):
            at, x, label = example(fit[i])
            at, x = np.append(at, config.buckets), np.append(x, 1.0)
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            p = _softmax(x @ w)
            p[label] -= 1
            g = x[:, None] * p[None, :]
            n2 = ni + g * g
            z[at] = zi + g - (np.sqrt(n2) - np.sqrt(ni)) / config.alpha * w
            n[at] = n2
    w = weights(z, n)
    return w[:-1], w[-1]


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of the lowest log loss, by golden section on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t):
        return -np.log(np.maximum(_softmax(scores / np.exp(t))[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, config: LanguageConfig | None = None, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fit on the rows that have a language and a text with content.

    An empty table, or one without labels, gives a model without languages,
    which answers ``und`` to everything; one language gives it to all texts.
    """
    config = config or LanguageConfig()
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != ""))
    sample = _sample(rows, config)
    if sample is None or not sample.num_rows:
        return LanguageModel((), np.zeros(config.buckets), np.zeros((config.buckets, 0)), np.zeros(0), 1.0, config)
    n, df = _document_frequencies(rows, config)
    idf = np.log((1 + n) / (1 + df)) + 1
    labels = sample.column("lang").to_pylist()
    languages = tuple(sorted(set(labels)))
    labels = [languages.index(lang) for lang in labels]
    texts = [tuple(v.as_buffer() for v in pair) for pair in zip(sample.column("buckets"), sample.column("counts"), strict=True)]

    def example(i):
        # made anew each time: the features of the whole sample are several times its counts
        at, counts = unpacked(*texts[i], config)
        return at, _unit(counts, idf[at]), labels[i]

    # every fifth text of a language is held back, so none is held back as a whole
    fit, rest, seen = [], [], Counter()
    for i, label in enumerate(labels):
        seen[label] += 1
        (fit if seen[label] % 5 else rest).append(i)
    w, bias = _train(fit, example, len(languages), config)
    scores = np.array([x @ w[at] + bias for at, x, _ in map(example, rest)])
    return LanguageModel(languages, idf, w, bias, _temperature(scores, np.array([labels[i] for i in rest])), config)


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", carry: tuple[Column, ...] = ()) -> DataFrame:
    """``carry`` columns, then ``lang_pred`` and ``score`` (the calibrated
    probability of that language), for each row.

    Null and empty texts and texts without a letter are ``und`` with score 0.
    Equal probabilities go to the first language in alphabetic order.  Rows
    stay as they are, repeated or not; a carried column named ``lang_pred`` or
    ``score`` gives way to the prediction.  The model travels as a broadcast of
    fixed size (buckets x languages).
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        for b in batches:
            pred, score = [], []
            for text in b.column("text_to_judge").to_pylist():
                if not text or not m.languages or not has_letter(text):
                    pred.append(UNDETERMINED)
                    score.append(0.0)
                    continue
                at, x = features(ngram_counts(text, m.config), m.idf)
                p = _softmax((x @ m.weights[at] + m.bias) / m.temperature)
                best = int(p.argmax())
                pred.append(m.languages[best])
                score.append(float(p[best]))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             ["row", "lang_pred", "score"])

    rows = docs.select(F.struct(*carry).alias("row"), F.col(text_col).alias("text_to_judge"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    kept = [F.col(f"row.`{c}`") for c in rows.schema["row"].dataType.names if c not in ("lang_pred", "score")]
    return rows.mapInArrow(run, schema).select(*kept, "lang_pred", "score")
