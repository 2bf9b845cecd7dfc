"""Near duplicates among embeddings by NN-descent.

**Start.** Random hyperplanes give every vector a code a tree; sorted by code,
vectors are compared with those next to them, in blocks of ``block`` that overlap
by half.  Ranges of (tree, code, row) are equal parts of the work, so a dense
group is many blocks and no task's burden.

**Descent.** Each vector goes to every vector in its list and is compared there
with all that came: a neighbour's neighbours.  Lists keep the ``neighbours``
nearest, and beyond those the links found: a saturated list (full of links) may
double with every round, so that a dense group does not shut its members in.

**Links.** Every block joins its linked vectors to the smallest, so components
need one edge a vector and no pairs.  Links are then counted within components:
small ones at once; a large one is a clique, without comparing, if all of it lies
within half the threshold's angle of its centre; else blocks of it are compared
with blocks, unless centres and radii tell that all or none of them link.

**Audit.** A sample of vectors is held against all rows; while the links found are
under ``recall`` of theirs, further trees and descent follow.

Cosines are of double precision.  Edge cases: a vector that is null, empty, zero
or holds a null or non-finite component links with nothing; vectors of different
lengths do not link; rows that repeat an id are vectors of their own (linked, if
equal); a row without an id takes part, and its component has the smallest id of
the others (null if there is none); extra columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import stored
from kpiloom.llm.ngram_jaccard import components


@dataclass(frozen=True)
class NearConfig:
    threshold: float = 0.9
    trees: int = 4              # at first, and in each further turn
    bits: int = 60              # of a code
    block: int = 256            # vectors compared at once, overlapping by half
    neighbours: int = 4         # of a list, beside its links
    rounds: int = 2             # of descent after each turn's trees
    turns: int = 6              # at most, if the audit asks for more
    audit: int = 256            # vectors held against all rows
    recall: float = 0.98        # of the audited vectors' links, asked for
    part: int = 512             # vectors of a part of a large component
    seed: int = 20


def _matrix(raw: list[bytes], dtype: str) -> np.ndarray:
    """Unit vectors in double precision (all of one length)."""
    x = np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _units(raw: bytes, n: int, dtype: str) -> np.ndarray:
    size = len(raw) // n
    return _matrix([raw[k:k + size] for k in range(0, len(raw), size)], dtype)


def _vectors(dtype: str):
    """``row, vec_id, embedding`` to ``row, vec_id, dim, raw``; dim 0: unusable."""
    def run(batches):
        for batch in batches:
            lists = batch.column("embedding")
            if isinstance(lists, pa.ChunkedArray):
                lists = lists.combine_chunks()
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            sizes = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
            dims, raw = np.zeros(len(sizes), np.int32), [None] * len(sizes)
            for size in np.unique(sizes[sizes > 0]):
                rows = np.flatnonzero(sizes == size)
                x = values[offsets[rows][:, None] + np.arange(size)]
                good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
                dims[rows[good]] = size
                for r, v in zip(rows[good], x[good].astype(dtype)):
                    raw[r] = v.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("vec_id"), pa.array(dims), pa.array(raw, pa.binary())], ["row", "vec_id", "dim", "raw"])

    return run


def _codes(config: NearConfig, dtype: str, trees: range):
    """Each vector once a tree, with its code."""
    def run(batches):
        planes = {}
        weights = np.left_shift(np.int64(1), np.arange(config.bits - 1, -1, -1, dtype=np.int64))
        for batch in batches:
            dims, raw = batch.column("dim").to_numpy(), batch.column("raw").to_pylist()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x = _matrix([raw[r] for r in rows], dtype)
                taken = batch.take(pa.array(rows))
                for tree in trees:
                    if (dim, tree) not in planes:
                        planes[dim, tree] = np.random.default_rng([config.seed, tree, int(dim)]).normal(size=(dim, config.bits))
                    code = ((x @ planes[dim, tree]) > 0) @ weights
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), tree, np.int64)), taken.column("dim"), pa.array(code), taken.column("row"), taken.column("raw")],
                        ["run", "dim", "code", "row", "raw"])

    return run


#: Runs of up to so many vectors are compared many at a time.
SMALL = 32

_NEAR = "row long, leader long, near array<struct<sim: double, id: long>>"


def _leaders(links: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """(row, smallest row of its component) of linked rows of a block."""
    some = np.flatnonzero(links.any(axis=1))
    if not len(some):
        return []
    a, own = links[np.ix_(some, some)], ids[some]
    label = own
    while True:
        lower = np.minimum(label, np.where(a, label, np.iinfo(np.int64).max).min(axis=1))
        if (lower == label).all():
            break
        label = lower
    return [(int(r), int(c)) for r, c in zip(own, label) if r != c]


class _Blocks:
    """Compares the vectors of a run with those around them, half a block at a
    time, and gives each its list when the half after it has been seen."""

    def __init__(self, config: NearConfig, dtype: str):
        self.config, self.dtype, self.most = config, dtype, 4 * config.neighbours
        self.before = None
        self.lists, self.edges = [], []

    def _nearest(self, sims: np.ndarray, ids: np.ndarray):
        most = min(self.most, sims.shape[1])
        if most < sims.shape[1]:
            at = np.argpartition(-sims, most - 1, axis=1)[:, :most]
            return np.take_along_axis(sims, at, axis=1), ids[at]
        return sims, np.broadcast_to(ids, sims.shape)

    def half(self, ids: np.ndarray, raw: list[bytes]) -> None:
        unit = _matrix(raw, self.dtype)
        old_ids, old_unit = (self.before[0], self.before[1]) if self.before else (ids[:0], unit[:0])
        all_ids, m = np.concatenate([old_ids, ids]), len(old_ids)
        sims = unit @ np.concatenate([old_unit, unit]).T
        sims[np.arange(len(ids)), m + np.arange(len(ids))] = -2
        hits = sims >= self.config.threshold
        if hits.any():
            links = np.zeros((len(all_ids), len(all_ids)), bool)
            links[m:] = hits
            self.edges += _leaders(links | links.T, all_ids)
        near = self._nearest(sims, all_ids)
        if self.before:
            s, i = self._nearest(sims[:, :m].T, ids)
            self._give(old_ids, np.hstack([self.before[2][0], s]), np.hstack([self.before[2][1], i]))
        self.before = (ids, unit, near)

    def many(self, ids: np.ndarray, raw: list[bytes]) -> None:
        """Whole runs of one small size at once: ``ids`` has a row a run."""
        g, n = ids.shape
        unit = _matrix(raw, self.dtype).reshape(g, n, -1)
        sims = unit @ unit.transpose(0, 2, 1)
        sims[:, np.arange(n), np.arange(n)] = -2
        hits = sims >= self.config.threshold
        for k in np.flatnonzero(hits.any(axis=(1, 2))):
            self.edges += _leaders(hits[k], ids[k])
        self._give(ids.ravel(), sims.reshape(g * n, n), np.broadcast_to(ids[:, None, :], (g, n, n)).reshape(g * n, n))

    def end(self) -> None:
        if self.before:
            self._give(self.before[0], *self.before[2])
        self.before = None

    def _give(self, ids, sims, near) -> None:
        order = np.argsort(-sims, axis=1, kind="stable")[:, :self.most]
        sims, near = np.take_along_axis(sims, order, axis=1), np.take_along_axis(near, order, axis=1)
        n = self.config.neighbours
        keep = n + np.minimum((sims >= self.config.threshold).sum(axis=1), self.most - n)
        keep = np.minimum(keep, (sims > -2).sum(axis=1))
        mask = np.arange(sims.shape[1]) < keep[:, None]
        self.lists.append((ids, keep, sims[mask], near[mask]))

    def batch(self) -> pa.RecordBatch | None:
        if not self.lists and not self.edges:
            return None
        ids = np.concatenate([x[0] for x in self.lists] or [np.zeros(0, np.int64)])
        sizes = np.concatenate([x[1] for x in self.lists] or [np.zeros(0, np.int64)])
        sims = np.round(np.concatenate([x[2] for x in self.lists] or [np.zeros(0)]), 9)
        near = np.concatenate([x[3] for x in self.lists] or [np.zeros(0, np.int64)])
        pairs = np.array(self.edges, np.int64).reshape(-1, 2)
        offsets = np.concatenate([[0], np.cumsum(sizes), np.full(len(pairs), sizes.sum())]).astype(np.int32)
        items = pa.StructArray.from_arrays([pa.array(sims), pa.array(near, pa.int64())], ["sim", "id"])
        leader = pa.array(np.concatenate([np.zeros(len(ids), np.int64), pairs[:, 1]]),
                          mask=np.arange(len(ids) + len(pairs)) < len(ids))
        self.lists, self.edges = [], []
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([ids, pairs[:, 0]])), leader, pa.ListArray.from_arrays(pa.array(offsets), items)], ["row", "leader", "near"])


def _compare(config: NearConfig, dtype: str):
    """Sorted runs ``run, dim, row, raw`` to lists and links' leaders."""
    def run(batches):
        half, blocks = config.block // 2, _Blocks(config, dtype)
        key, ids, raw = None, [], []

        def close(done: bool):
            if ids:
                blocks.half(np.array(ids, np.int64), raw)
            if done:
                blocks.end()

        for batch in batches:
            keys = np.stack([batch.column("run").to_numpy(), batch.column("dim").to_numpy().astype(np.int64)])
            rows, raws = batch.column("row").to_pylist(), batch.column("raw").to_pylist()
            starts = np.concatenate([[0], 1 + np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)), [len(rows)]]) if rows else [0]
            small: dict[int, list[int]] = {}
            for a, b in zip(starts[:-1], starts[1:]):
                if b - a <= SMALL and a > 0 and b < len(rows):       # a run that begins and ends here
                    small.setdefault(b - a, []).append(a)
                    continue
                if (now := tuple(keys[:, a])) != key:
                    close(True)
                    key, ids, raw = now, [], []
                while a < b:
                    take = min(b - a, half - len(ids))
                    ids += rows[a:a + take]
                    raw += raws[a:a + take]
                    a += take
                    if len(ids) == half:
                        close(False)
                        ids, raw = [], []
            for size, at in small.items():
                if size > 1:
                    take = (np.array(at)[:, None] + np.arange(size))
                    blocks.many(batch.column("row").to_numpy()[take], [raws[k] for k in take.ravel()])
            if (out := blocks.batch()) is not None:
                yield out
        close(True)
        if (out := blocks.batch()) is not None:
            yield out

    return run


def _started(base: DataFrame, config: NearConfig, dtype: str, trees: range) -> DataFrame:
    coded = base.select("row", "dim", "raw").mapInArrow(_codes(config, dtype, trees), "run long, dim int, code long, row long, raw binary")
    key = ["run", "dim", "code", "row"]
    return coded.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(_compare(config, dtype), _NEAR)


def _merged(lists: DataFrame, config: NearConfig, growth: int) -> DataFrame:
    """One list a row: the nearest, and up to ``growth`` times as many links."""
    near = F.sort_array(F.array_distinct(F.flatten(F.collect_list("near"))), asc=False)
    links = F.size(F.filter("near", lambda x: x.sim >= config.threshold))
    out = lists.groupBy("row").agg(near.alias("near"))
    return out.select("row", F.slice("near", 1, config.neighbours + F.least(links, F.lit(config.neighbours * growth))).alias("near"))


def _descended(lists: DataFrame, base: DataFrame, config: NearConfig, dtype: str) -> DataFrame:
    """Neighbours of neighbours: all that list a vector meet there, with it."""
    hubs = F.concat(F.array("row"), F.transform("near", lambda x: x.id))
    sent = lists.join(base.select("row", "dim", "raw"), "row").select(F.explode(hubs).alias("run"), "dim", "row", "raw")
    key = ["run", "dim", "row"]
    return sent.repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(_compare(config, dtype), _NEAR)


# ------------------------------------------------------------- links, counted
def _count_whole(config: NearConfig, dtype: str):
    """Links of each member of components that fit a block."""
    def run(batches):
        key, ids, raw = None, [], []

        def made():
            unit = _matrix(raw, dtype)
            n = ((unit @ unit.T) >= config.threshold)
            np.fill_diagonal(n, False)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n.sum(axis=1).astype(np.int64))], ["row", "n"])

        for batch in batches:
            for c, row, vector in zip(*[batch.column(x).to_pylist() for x in ("component", "row", "raw")], strict=True):
                if c != key and ids:
                    yield made()
                if c != key:
                    key, ids, raw = c, [], []
                ids.append(row)
                raw.append(vector)
        if ids:
            yield made()

    return run


def _angle(cosine):
    return np.arccos(np.clip(cosine, -1, 1))


def _summary(dtype: str):
    """A part of a large component: its rows and vectors as one, the sum of its
    unit vectors and the greatest angle to that sum."""
    def run(pdf):
        import pandas as pd

        unit = _matrix(list(pdf["raw"]), dtype)
        total = unit.sum(axis=0)
        size = np.sqrt((total * total).sum())
        radius = float(_angle(unit @ (total / size)).max()) if size > 0 else math.pi
        return pd.DataFrame({"component": [pdf["component"].iloc[0]], "slot": [pdf["slot"].iloc[0]], "n": [len(pdf)],
                             "total": [total.tolist()], "radius": [radius], "rows": [pdf["row"].tolist()], "raw": [b"".join(pdf["raw"])]})

    return run


def _unit_of(column) -> np.ndarray:
    x = np.array(column.tolist(), np.float64)
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def _certain(config: NearConfig):
    """Whether two balls of vectors link wholly (1), not at all (-1) or in part
    (0), by their centres and radii.  A margin keeps rounding on the safe side."""
    reach = math.acos(config.threshold)

    @F.pandas_udf("int")
    def told(a, r_a, b, r_b):
        import pandas as pd

        between = _angle((_unit_of(a) * _unit_of(b)).sum(axis=1))
        wide = r_a.to_numpy() + r_b.to_numpy()
        return pd.Series(np.where(between + wide <= reach - 1e-6, 1, np.where(between - wide > reach + 1e-6, -1, 0)).astype(np.int32))

    return told


def _count_parts(config: NearConfig, dtype: str):
    """Links between two parts, for the members of the first."""
    def run(batches):
        for batch in batches:
            for rows, raw, other, raw_other in zip(*[batch.column(c).to_pylist() for c in ("rows", "raw", "o_rows", "o_raw")], strict=True):
                a, b = _units(raw, len(rows), dtype), _units(raw_other, len(other), dtype)
                hits = ((a @ b.T) >= config.threshold).sum(axis=1) - np.isin(rows, other) * 1     # not itself
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(hits.astype(np.int64))], ["row", "n"])

    return run


def _count_large(members: DataFrame, config: NearConfig, dtype: str) -> DataFrame:
    slots = F.ceil(F.col("size") / config.part).cast("int")
    dealt = members.withColumn("slot", F.pmod(F.xxhash64("row"), slots).cast("int"))
    schema = "component long, slot int, n long, total array<double>, radius double, rows array<long>, raw binary"
    parts = stored(dealt.select("component", "slot", "row", "raw").groupBy("component", "slot").applyInPandas(_summary(dtype), schema), "near-parts")
    told = _certain(config)
    sums = parts.select("component", F.posexplode("total").alias("at", "x"), "n").groupBy("component", "at").agg(F.sum("x").alias("x"))
    centres = sums.groupBy("component").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda s: s.x).alias("centre"))
    # a part's distance from the centre and its radius bound the component's
    spread = parts.select("component", "n", "total", "radius").join(centres, "component")
    clique = spread.withColumn("far", F.col("radius") + _between(F.col("total"), F.col("centre")))
    cliques = clique.groupBy("component").agg(F.max("far").alias("far"), F.sum("n").alias("size")).withColumn(
        "whole", F.col("far") <= math.acos(config.threshold) / 2 - 1e-6)
    settled = parts.join(cliques.where("whole"), "component").select(F.explode("rows").alias("row"), (F.col("size") - 1).alias("n"))
    loose = parts.join(cliques.where("not whole").select("component"), "component", "left_semi")
    one = loose.select("component", "slot", F.col("n").alias("o_n"), "total", "radius")
    two = loose.select("component", F.col("slot").alias("o_slot"), F.col("n").alias("m"), F.col("total").alias("o_total"), F.col("radius").alias("o_radius"))
    pairs = stored(one.join(two, "component").select("component", "slot", "o_slot", "m", told("total", "radius", "o_total", "o_radius").alias("told")),
                   "near-part-pairs")
    sure = pairs.where("told = 1").groupBy("component", "slot").agg(F.sum(F.col("m") - (F.col("slot") == F.col("o_slot")).cast("long")).alias("n"))
    whole = loose.drop("n").join(sure, ["component", "slot"]).select(F.explode("rows").alias("row"), "n")
    vectors = loose.select("component", "slot", "rows", "raw")
    others = vectors.select("component", F.col("slot").alias("o_slot"), F.col("rows").alias("o_rows"), F.col("raw").alias("o_raw"))
    part = pairs.where("told = 0").select("component", "slot", "o_slot").join(vectors, ["component", "slot"]).join(others, ["component", "o_slot"])
    compared = part.select("rows", "raw", "o_rows", "o_raw").mapInArrow(_count_parts(config, dtype), "row long, n long")
    return settled.unionByName(whole).unionByName(compared).groupBy("row").agg(F.sum("n").alias("n"))


def _between(a, b):
    """Angle between two arrays."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / size)))).otherwise(math.pi)


def linked(base: DataFrame, edges: DataFrame, config: NearConfig, dtype: str) -> DataFrame:
    """``row, component, n`` of the rows that have links."""
    found = stored(components(edges.distinct()).select(F.col("node").alias("row"), "component"), "near-components")
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    members = stored(found.join(sizes, "component").join(base.select("row", "raw"), "row"), "near-members")
    small = members.where(F.col("size") <= config.part).select("component", "row", "raw").repartition("component").sortWithinPartitions("component")
    counts = small.mapInArrow(_count_whole(config, dtype), "row long, n long")
    if members.where(F.col("size") > config.part).limit(1).count():
        counts = counts.unionByName(_count_large(members.where(F.col("size") > config.part), config, dtype))
    return found.join(counts, "row")


def audited(base: DataFrame, config: NearConfig, dtype: str, links: DataFrame) -> float:
    """Share of the sampled vectors' links that were found."""
    sample = base.orderBy(F.xxhash64("row", F.lit(config.seed))).limit(config.audit).select("row", "dim", "raw").collect()
    if not sample:
        return 1.0
    asked = {}
    for dim in sorted({r.dim for r in sample}):
        rows = [r for r in sample if r.dim == dim]
        asked[dim] = ([r.row for r in rows], _matrix([bytes(r.raw) for r in rows], dtype))

    def count(batches):
        true = {row: 0 for rows, _ in asked.values() for row in rows}
        for batch in batches:
            dims, raw = batch.column("dim").to_numpy(), batch.column("raw").to_pylist()
            for dim in np.unique(dims):
                if dim in asked:
                    unit = _matrix([raw[k] for k in np.flatnonzero(dims == dim)], dtype)
                    for row, n in zip(asked[dim][0], ((asked[dim][1] @ unit.T) >= config.threshold).sum(axis=1)):
                        true[row] += int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(true), pa.int64()), pa.array(list(true.values()), pa.int64())], ["row", "true"])

    true = base.select("dim", "raw").mapInArrow(count, "row long, true long").groupBy("row").agg((F.sum("true") - 1).alias("true"))
    got = true.join(links.select("row", "n"), "row", "left").agg(F.sum("true"), F.sum(F.least("true", F.coalesce("n", F.lit(0))))).first()
    return 1.0 if not got[0] else got[1] / got[0]


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", config: NearConfig | None = None) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept`` (the ids under
    ``id_col``).  ``kept``: the vector has the smallest id of its component."""
    config = config or NearConfig()
    dtype = "float32" if vectors.schema[vector_col].dataType.elementType.simpleString() == "float" else "float64"
    picked = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
                            F.col(vector_col).cast(f"array<{'float' if dtype == 'float32' else 'double'}>").alias("embedding"))
    rows = stored(picked.mapInArrow(_vectors(dtype), "row long, vec_id long, dim int, raw binary"), "near-vectors")
    base = rows.where("dim > 0")
    lists = edges = links = None

    def taken(step: DataFrame) -> None:
        nonlocal lists, edges
        found = stored(step, "near-lists")
        new = found.where("leader is not null").select(F.col("row").alias("a"), F.col("leader").alias("b"))
        edges = new if edges is None else edges.unionByName(new)
        mine = found.where("leader is null").select("row", "near")
        lists = mine if lists is None else lists.unionByName(mine)

    for turn in range(config.turns):
        taken(_started(base, config, dtype, range(turn * config.trees, (turn + 1) * config.trees)))
        for k in range(config.rounds):
            lists = stored(_merged(lists, config, 2 ** (turn * config.rounds + k)), "near-merged")
            taken(_descended(lists, base, config, dtype))
        links = stored(linked(base, edges, config, dtype), "near-links")
        if audited(base, config, dtype, links) >= config.recall:
            break
    all_rows = rows.select("row", "vec_id").join(links, "row", "left").withColumn("component", F.coalesce("component", "row"))
    names = all_rows.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return all_rows.join(names, "component").select(
        F.col("vec_id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
