"""Best-fit packing of token pieces into sequences of a fixed size.

Pattern packing: only the histogram of piece lengths decides how sequences are
filled.  All patterns of up to three pieces that fill a sequence exactly are
enumerated, non-negative least squares fits how often each is to be used, the
repeat counts are rounded within the histogram, and what is left over is
packed best-fit, longest first - again on the histogram, not piece by piece.

At scale nothing but counts moves: the histogram has at most ``size`` rows.
Each piece then finds its place by its rank among the pieces of its length,
from a table whose size depends on the number of patterns only.
"""

from __future__ import annotations

import bisect
import re
import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import Recent, small_batches, stored

MAX_WORDS = 250_000
#: Letters of Latin-1, in lower case.
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha() and c == c.lower())
#: Letters, then ASCII punctuation, both possibly none; an apostrophe may start
#: a suffix of its own, so it is left out.
PLAIN = re.compile(f"([{LETTERS}]*)([!-&(-/:-@[-`{{-~]*)")


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class WordTokenizer:
    """Token ids of whole texts by a tokenizer that never joins across white
    space: each word is tokenized once and then looked up.

    Upper case matters to no token, so texts of Latin-1 characters (where
    lower-casing and composition are the same in every library) are
    lower-cased first; this only shares more look-ups.  A new word of such
    letters and closing punctuation is two runs for the pre-tokenizer, so the
    merges are applied to each directly; any other word takes the whole way.

    With ``added``, texts that hold an added token's literal go through the
    tokenizer's own default as a whole, which keeps such tokens; without it
    the literal is text like any other.  Both are one tokenizer that is
    switched: a second one would hold the vocabulary twice.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.literals = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.merged = self.tokenizer.model.tokenize
        # how the pre-tokenizer writes the bytes of each letter
        self.written = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in LETTERS}
        self.words = Recent(self._word, MAX_WORDS)

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        plain = PLAIN.fullmatch(text)
        if plain is None:
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        letters, marks = plain.groups()
        if letters and marks:
            return self.words[letters.encode()] + self.words[marks.encode()]
        return _packed([t.id for t in self.merged(text.translate(self.written))])

    def _default(self, text: str) -> bytes:
        self.tokenizer.encode_special_tokens = False
        try:
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        finally:
            self.tokenizer.encode_special_tokens = True

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        lower = text.lower()
        if any(literal in lower for literal in self.literals):
            return self._default(text)
        try:
            text.encode("latin-1")
            text = lower
        except UnicodeEncodeError:
            pass
        # bytes.split() cuts at the six ASCII white-space characters
        return b"".join(map(self.words.__getitem__, text.encode().split()))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker."""
    return WordTokenizer(path, added=True)


def patterns_of_up_to_three(size: int, lengths: np.ndarray) -> np.ndarray:
    """Rows of three lengths (0: none), descending, that sum to ``size``, of
    lengths that occur."""
    there = np.zeros(size + 1, bool)
    there[lengths] = True
    there[0] = True
    out = []
    for first in lengths[lengths >= -(-size // 3)][::-1]:
        rest = size - int(first)
        second = np.arange(min(int(first), rest), (rest + 1) // 2 - 1, -1)
        third = rest - second
        ok = there[second] & there[third]
        out.append(np.column_stack([np.full(ok.sum(), first), second[ok], third[ok]]))
    return np.concatenate(out).astype(np.int64) if out else np.zeros((0, 3), np.int64)


def fit_repeats(counts: np.ndarray, patterns: np.ndarray, steps: int = 150) -> np.ndarray:
    """Non-negative least squares: repeats ``x >= 0`` that make the pieces used
    by the patterns match ``counts``; accelerated projected gradient."""
    size = len(counts) - 1
    if not len(patterns):
        return np.zeros(0)
    flat, target = patterns.ravel(), counts.astype(float)
    target[0] = 0

    def used(x):
        u = np.bincount(flat, np.repeat(x, 3), size + 1)
        u[0] = 0
        return u

    # the largest eigenvalue of A'A, by power iteration
    v = np.ones(len(patterns))
    for _ in range(12):
        v = used(v / np.linalg.norm(v))[patterns].sum(1)
    step = 1 / (1.1 * np.linalg.norm(v) + 1e-9)
    x = np.zeros(len(patterns))
    y, t = x, 1.0
    for _ in range(steps):
        nxt = np.maximum(0, y - step * (used(y) - target)[patterns].sum(1))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return x


def round_repeats(counts: np.ndarray, patterns: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whole repeats that use no length more often than it occurs.

    The fraction lost on one pattern is carried to the next of the same
    longest piece, so that many small repeats still add up."""
    left = counts.astype(np.int64).copy()
    left[0] = np.iinfo(np.int64).max // 4
    out = np.zeros(len(patterns), np.int64)
    if not len(patterns):
        return out
    total = np.cumsum(x)
    start = np.searchsorted(-patterns[:, 0], -patterns[:, 0])  # first pattern of the same longest piece
    before = np.where(start > 0, total[start - 1], 0.0)
    down = np.floor(total - before + 1e-9)
    want = np.diff(down, prepend=0.0)
    want[start == np.arange(len(patterns))] = down[start == np.arange(len(patterns))]
    for p in np.flatnonzero(want > 0):
        uses = defaultdict(int)
        for length in patterns[p]:
            if length:
                uses[int(length)] += 1
        n = min(int(want[p]), min(int(left[k]) // m for k, m in uses.items()))
        if n > 0:
            out[p] = n
            for k, m in uses.items():
                left[k] -= n * m
    return out


def best_fit(left: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: (lengths of a sequence, repeats).

    Sequences of the same content are one group; as many pieces of a length
    as fit go to the fullest groups first."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # space left -> groups
    spaces: list[int] = []

    def put(space: int, content: tuple[int, ...], n: int) -> None:
        if not groups[space]:
            bisect.insort(spaces, space)
        groups[space].append((content, n))

    for length in sorted(left, reverse=True):
        todo = left[length]
        while todo:
            at = bisect.bisect_left(spaces, length)
            if at == len(spaces):
                each = size // length
                full, rest = divmod(todo, each)
                if full:
                    put(size - each * length, (length,) * each, full)
                if rest:
                    put(size - rest * length, (length,) * rest, 1)
                break
            space = spaces[at]
            content, n = groups[space].pop()
            if not groups[space]:
                spaces.pop(at)
            each = space // length  # pieces of this length for one sequence of the group
            full = min(n, todo // each)
            if full:
                put(space - each * length, content + (length,) * each, full)
                todo -= full * each
                n -= full
            if n and todo and todo < each:
                put(space - todo * length, content + (length,) * todo, 1)
                todo, n = 0, n - 1
            if n:
                put(space, content, n)
    return [(content, n) for space in list(groups) for content, n in groups[space]]


def plan(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences for a histogram ``{length: pieces}``: (lengths, repeats)."""
    counts = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    pats = patterns_of_up_to_three(size, np.flatnonzero(counts))
    repeats = round_repeats(counts, pats, fit_repeats(counts, pats))
    out = [(tuple(int(v) for v in pats[p] if v), int(repeats[p])) for p in np.flatnonzero(repeats)]
    left = counts.copy()
    for content, n in out:
        for length in content:
            left[length] -= n
    rest = {int(k): int(left[k]) for k in np.flatnonzero(left) if k}
    # the simplest plan is kept if fitting did not pay (few pieces)
    packed = out + best_fit(rest, size)
    plain = best_fit({k: v for k, v in histogram.items() if v}, size)
    return min(packed, plain, key=lambda plan_: sum(n for _, n in plan_))


def place_table(sequences: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """Per length, runs of ranks: ``length, first_rank, sequence_id, offset``;
    rank ``first_rank + i`` goes to ``sequence_id + i``."""
    rank: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for content, n in sequences:
        offset = 0
        for length in content:
            rows.append((length, rank[length], base, offset))
            rank[length] += n
            offset += length
        base += n
    return pd.DataFrame(rows, columns=["length", "first_rank", "sequence_id", "offset"]).sort_values(
        ["length", "first_rank"], ignore_index=True)


def pieces(docs: DataFrame, ids_of: Callable[[str], bytes], size: int, end_id: int = 0,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces: a document's ids and ``end_id``, cut into runs of ``size``.

    ``task, rank_in_task``: the piece's rank among the pieces of its length in
    the task that made it."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = end_id.to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank_in_task"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def run(batches):
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), [0] * (size + 1)
        for b in batches:
            rows, source = [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                data = ids_of(text or "") + end
                for k in range(0, len(data), 4 * size):
                    part = data[k:k + 4 * size]
                    n = len(part) // 4
                    rows.append((k // (4 * size), k // 4, n, zlib.crc32(part), task, seen[n]))
                    source.append(i)
                    seen[n] += 1
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(source, pa.int32()))]
                + [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, rank_in_task long"
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)


def best_fit_pack(docs: DataFrame, ids_of: Callable[[str], bytes], size: int = 2048, end_id: int = 0,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null and empty texts are one piece of the end id alone; repeated rows are
    packed each; pieces of equal length take places in the order of their
    tasks; an empty table gives an empty result.

    The pieces (a few numbers each) are written to the shared folder once, so
    ranks cannot change if a task is run again; texts reach Python in small
    batches, so a task's memory does not follow their lengths.  To the driver go the
    histogram (at most ``size`` rows); back go the places (one row per slot of
    a pattern, a bound that does not depend on the number of documents).
    """
    spark = docs.sparkSession
    with small_batches(spark):
        cut = stored(pieces(docs, ids_of, size, end_id, id_col, text_col), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = place_table(plan(histogram, size))
    keys = (table["length"].to_numpy() << 40) + table["first_rank"].to_numpy()
    places = spark.sparkContext.broadcast((keys, table["first_rank"].to_numpy(), table["sequence_id"].to_numpy(),
                                           table["offset"].to_numpy()))
    # rows of one length here: one per task
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        keys, first, sequence, offset = places.value
        at = np.searchsorted(keys, (length.to_numpy() << 40) + rank.to_numpy(), "right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + rank.to_numpy() - first[at], "offset": offset[at]})

    ranked = cut.join(starts, ["length", "task"]).withColumn("place", place("length", F.col("first") + F.col("rank_in_task")))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")
