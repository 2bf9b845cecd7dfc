"""Order MinHash fingerprints: sensitive to edit distance, not only to content.

The k-mers of a text are numbered by occurrence (the second "abcde" differs
from the first).  For each of ``m`` hash functions the ``l`` smallest numbered
k-mers are selected, put back into text order, and hashed as a tuple.  Two
texts agree in a component if the same k-mers were selected and they stand in
the same order; the share of equal components is the likeness.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # fixed: constants of splitmix64
#: k-mers hashed at once: bounds the memory of a very long text.
BLOCK = 1 << 14


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class OrderMinHash:
    """``m`` components of ``l`` k-mers of ``k`` code points each."""

    def __init__(self, k: int = 8, l: int = 2, m: int = 64, seed: int = 1):  # noqa: E741
        self.k, self.l, self.m = k, l, m
        draws = _mix(np.arange(1, m + k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        self.weights = draws[:k] | np.uint64(1)
        self.factors = (draws[k:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)

    def numbered(self, points: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each k-mer together with its occurrence number.
        A text shorter than k is one k-mer; an empty text has none."""
        n, k = len(points), self.k
        if n == 0:
            return np.zeros(0, np.uint64)
        if n < k:
            points = np.concatenate([points, np.full(k - n, 0xFFFFFFFF, np.uint32)])
            n = k
        wide = points.astype(np.uint64) + np.uint64(1)
        codes = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            codes += wide[j:n - k + 1 + j] * self.weights[j]
        codes = _mix(codes)
        # occurrence numbers: equal codes lie together in a stable order
        order = np.argsort(codes, kind="stable")
        ranked = codes[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        if len(first) < len(codes):
            number = np.arange(len(codes)) - np.repeat(first, np.diff(np.append(first, len(codes))))
            again = number > 0
            codes[order[again]] = _mix(ranked[again] + number[again].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return codes

    def sketch(self, codes: np.ndarray) -> np.ndarray:
        """``m`` 32-bit components; all ones for a text without k-mers."""
        n = len(codes)
        if n == 0:
            return np.full(self.m, 0xFFFFFFFF, np.uint32)
        short = (codes >> np.uint64(32)).astype(np.uint32)
        best = [np.zeros((self.m, 0), np.uint32), np.zeros((self.m, 0), np.int64)]
        rows = np.arange(self.m)
        for at in range(0, n, BLOCK):
            values = short[None, at:at + BLOCK] * self.factors[:, None]
            for _ in range(min(self.l, values.shape[1])):
                where = values.argmin(1)
                best[0] = np.column_stack([best[0], values[rows, where]])
                best[1] = np.column_stack([best[1], where + at])
                values[rows, where] = 0xFFFFFFFF
            if best[0].shape[1] > 8 * self.l:
                best = self._smallest(*best)
        _, positions = self._smallest(*best)
        positions.sort(1)
        out = np.full(self.m, 0x9E3779B9, np.uint64)
        for j in range(positions.shape[1]):
            out = _mix(out * np.uint64(3) + codes[positions[:, j]])
        return (out >> np.uint64(32)).astype(np.uint32)

    def _smallest(self, values: np.ndarray, positions: np.ndarray) -> list[np.ndarray]:
        order = np.lexsort((positions, values), axis=1)[:, :self.l]  # ties: the earlier k-mer
        return [np.take_along_axis(values, order, 1), np.take_along_axis(positions, order, 1)]

    def __call__(self, text: str) -> np.ndarray:
        return self.sketch(self.numbered(_points(text)))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def _written(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.tobytes()).decode()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", method: OrderMinHash | None = None) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of each row: one pass, no shuffle.
    Null and empty texts have the fingerprint of no k-mers."""
    method = method or OrderMinHash()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([_written(method(t)) for t in texts], pa.string())], ["doc_id", "n_chars", "fingerprint"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_chars long, fingerprint string")


_EDIT_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                "near_edited double, near_next double")
#: Ranges of ids, at most; what the driver keeps is one number for each.
MAX_RANGES = 8192


def _in_ranges(docs: DataFrame, id_col: str, text_col: str, rows_per_range: int) -> DataFrame:
    """``range, tail, key, doc_id, text`` in partitions sorted by range, tail
    (0: a row of the range, 1: the row after its last) and descending key."""
    lowest = -(1 << 63)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(lowest))
    ids = docs.select(key.alias("key"))
    n = ids.count()
    ranges = min(MAX_RANGES, -(-n // rows_per_range)) if n else 0
    cuts = np.zeros(0, np.int64)
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        cuts = np.array(sorted(set(ids.agg(F.percentile_approx("key", shares, 20 * ranges)).first()[0])), np.int64)
    count = len(cuts) + 1

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:  # range 0 has the largest ids
        return pd.Series((count - 1 - np.searchsorted(cuts, keys.to_numpy(), "left")).astype(np.int32))

    firsts = ids.groupBy(range_of("key").alias("range")).agg(F.max("key").alias("key")).orderBy("range").collect()
    before = {firsts[i]["key"]: firsts[i - 1]["range"] for i in range(len(firsts))}  # the first's: the last range

    @F.pandas_udf("array<int>")
    def ranges_of(keys: pd.Series) -> pd.Series:
        own = count - 1 - np.searchsorted(cuts, keys.to_numpy(), "left")
        return pd.Series([[int(r), before[k]] if k in before else [int(r)] for k, r in zip(keys.tolist(), own, strict=True)])

    rows = docs.select(key.alias("key"), F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (rows.select(F.posexplode(ranges_of("key")).alias("tail", "range"), "key", "doc_id", "text")
            .repartition(F.col("range")).sortWithinPartitions("range", "tail", F.desc("key"), F.desc("text")))


def fingerprints_of_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          method: OrderMinHash | None = None, rows_per_range: int = 500) -> DataFrame:
    """Each text, its edit, and how alike their fingerprints are.

    The next document is the one with the next smaller id (after the smallest:
    the largest); among repeated ids, the next in descending order of text.
    The edit replaces the last half of a text (rounded down) by as many code
    points from the start of the next document, or all it has.  A table of one
    row is its own next document; rows without an id come last; an empty table
    gives an empty result; null texts count as empty; other columns are left
    out, so none can clash.

    Texts move once: the ids alone fix ranges of about ``rows_per_range`` rows
    (more if there would be over ``MAX_RANGES``), and tasks stream through
    whole sorted ranges with one text in hand.  The first row of a range is
    also sent to the range before it, as the last row's next document.
    """
    method = method or OrderMinHash()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def edited_row(doc, text, sketch, next_text, next_sketch):
        half = len(text) // 2
        edited = text[:len(text) - half] + next_text[:half]
        edit = sketch if edited == text else method(edited)
        return (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), _written(sketch), _written(edit),
                likeness(sketch, edit), likeness(sketch, next_sketch))

    def run(batches):
        held, closed = None, None  # the row whose next one is to come; the range that has had its tail
        for b in batches:
            rows = []
            for at, tail, doc, text in zip(*(b.column(c).to_pylist() for c in ("range", "tail", "doc_id", "text")), strict=True):
                if tail and closed == at:
                    continue  # repeated first rows of the next range: one is enough
                sketch = held[2] if held and held[1] == text else method(text)
                if held:
                    rows.append(edited_row(*held, text, sketch))
                held, closed = (None, at) if tail else ((doc, text, sketch), closed)
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return (_in_ranges(docs, id_col, text_col, rows_per_range).select("range", "tail", "doc_id", "text")
            .mapInArrow(run, _EDIT_SCHEMA))
