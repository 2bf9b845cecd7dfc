"""Prefix trie of conversations with subtree totals by time-forward processing.

A node is a distinct sequence of first turns; its members are the conversations
that begin with it.  Every conversation is, at the end of its path, the smallest
member of some run of nodes, so ``(conv_id, depth)`` with the smallest member
names a node, and a parent's name is always below its child's.

**Nodes.** Turns become two 64-bit digests at once; texts are not moved.  A
prefix is known by its depth and the exclusive-or of the digests of its turns
with their places, which running windows over bounded pieces of a conversation
give (a piece is what one partition or ``PIECE`` turns hold, so a conversation
with a third of all rows is many pieces).

**Totals.** Nodes are dealt by ranges of their name into shards and sorted there
in reverse level order.  A task walks its shard once; each node takes what its
children sent from a priority queue (which spills), adds its own, and sends the
sum to its parent's place in the queue.  Before that, the shards are tied
together: a node with children in other shards, a node where two such meet and a
shard's root form a smaller tree, which is solved in the same way, and its totals
are final for its nodes.  Each turn takes at least one crossing off every path.

Edge cases: null role or text is empty, a null turn comes first; rows of the same
turn come in the order of role, then digest; rows without a conv_id belong to no
conversation and are left out; an empty table has no root and gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import stored, words_of

#: Turns of a conversation that one window holds.
PIECE = 4096
#: Nodes of a shard; with over ``SHARDS`` shards they grow (a task streams them).
SHARD_NODES, SHARDS = 50_000, 20_000
#: Messages that a queue holds before it spills, bytes of ids hashed at a time.
QUEUE, CHUNK = 1 << 18, 1 << 20


# ------------------------------------------------------------------ rebuilding
def positions(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, d1, d2, words``: every turn with its place from 0, as
    digests.  Ranges of (conversation, turn) share the work evenly;
    what a conversation has in earlier ranges is added."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    light = conversations.where("conv_id is not null").select(
        "conv_id", "turn", role.alias("role"), F.xxhash64(role, text).alias("d1"), F.xxhash64(F.lit(1), role, text).alias("d2"),
        F.size(words_of(text)).cast("long").alias("words"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("turn").asc_nulls_first(), "role", "d1", "d2", "row"]
    ranged = light.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    rows = stored(ranged, "trie-turns")
    local = rows.withColumn("place", F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)) - 1)
    counts = rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.withColumn("first", F.sum("n").over(earlier)).where("first > 0").select("conv_id", "part", "first")
    return local.join(carried, ["conv_id", "part"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("first", F.lit(0))).alias("pos"), "d1", "d2", "words")


def shared_starts(turns: DataFrame, family: int = 20) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: the first ``h`` turns come from the conversation
    that opens the family.  Returns rows ``c, depth, d1, d2, words`` and the
    conversations ``c, last`` (their number of rebuilt turns)."""
    h = (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    heads = turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < 3)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "d1", "d2", "words"))).alias("head"))
    members = sizes.withColumns({"base": F.col("conv_id") - F.col("conv_id") % family, "h": h}).join(heads, "base", "left")
    members = members.withColumn("head", F.when(F.col("head").isNotNull(), F.slice("head", 1, F.col("h"))))
    members = members.withColumn("taken", F.coalesce(F.size("head"), F.lit(0)))
    members = stored(members.select("conv_id", "n", "h", "taken", "head"), "trie-members")
    copied = members.select(F.col("conv_id").alias("c"), F.explode("head").alias("t")).select(
        "c", (F.col("t.pos") + 1).alias("depth"), "t.d1", "t.d2", "t.words")
    fewer = members.where("taken < h").select("conv_id", "taken")
    own = turns.withColumn("h", h).where("pos >= h").join(fewer, "conv_id", "left").select(
        F.col("conv_id").alias("c"), (F.col("pos") - F.col("h") + F.coalesce("taken", "h") + 1).alias("depth"), "d1", "d2", "words")
    last = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return copied.unionByName(own), members.select(F.col("conv_id").alias("c"), last.alias("last"))


# ----------------------------------------------------------------------- nodes
def prefixes(rows: DataFrame) -> DataFrame:
    """Rows with their prefix ``n1, n2`` and the one before it, ``p1, p2``."""
    tagged = stored(rows.select(
        "c", "depth", F.xxhash64("depth", "d1", "d2").alias("t1"), F.xxhash64(F.lit(1), "depth", "d1", "d2").alias("t2"), "words",
        F.floor((F.col("depth") - 1) / PIECE).cast("long").alias("piece")), "trie-tags")
    upto = Window.partitionBy("c", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("c").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = tagged.groupBy("c", "piece").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))
    carried = pieces.select("c", "piece", F.bit_xor("x1").over(earlier).alias("b1"), F.bit_xor("x2").over(earlier).alias("b2"))
    out = tagged.withColumns({"x1": F.bit_xor("t1").over(upto), "x2": F.bit_xor("t2").over(upto)}).join(
        carried.where("piece > 0"), ["c", "piece"], "left")
    n = {i: F.col(f"x{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0))) for i in (1, 2)}
    return out.select("c", "depth", "words", n[1].alias("n1"), n[2].alias("n2"),
                      n[1].bitwiseXOR(F.col("t1")).alias("p1"), n[2].bitwiseXOR(F.col("t2")).alias("p2"))


NODE = ["depth", "n1", "n2"]


_ENDS = "depth long, n1 long, n2 long, first long, piece binary, ends_sha256 string"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.binary(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)],
                                      [f.split()[0] for f in _ENDS.split(", ")])


def _rows(batches, *names: str):
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names], strict=True)


def _ends_of_part(batches):
    """Digests of the nodes whose sorted ids all lie in this partition; the ids
    of its first and last node, and of long lists, come out as pieces of text."""
    node, ids, size, opens, out = None, [], 0, True, []

    def piece():
        return (*node, ids[0], b",".join(b"%d" % i for i in ids), None)

    for *at, c in _rows(batches, *NODE, "c"):
        if at != node or size >= CHUNK:
            if ids:
                alone = at != node and not opens
                out.append((*node, None, None, hashlib.sha256(piece()[4]).hexdigest()) if alone else piece())
            opens = node is None or at == node          # the first node, or the rest of a long list
            node, ids, size = at, [], 0
        ids.append(c)
        size += 8
        if len(out) >= 500:
            yield _batch(out)
            out = []
    if ids:
        out.append(piece())
    if out:
        yield _batch(out)


def _ends_of_pieces(batches):
    """Digests of nodes from their pieces in order, one piece held at a time."""
    node, digest, out = None, None, []
    for *at, piece in _rows(batches, *NODE, "piece"):
        if at != node:
            if node is not None:
                out.append((*node, None, None, digest.hexdigest()))
            node, digest = at, hashlib.sha256(piece)
        else:
            digest.update(b"," + piece)
        if len(out) >= 500:
            yield _batch(out)
            out = []
    if node is not None:
        out.append((*node, None, None, digest.hexdigest()))
    if out:
        yield _batch(out)


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids that end at each node."""
    ranged = ends.repartitionByRange(*NODE, "c").sortWithinPartitions(*NODE, "c")
    first = stored(ranged.mapInArrow(_ends_of_part, _ENDS), "trie-ends")
    parts = first.where("piece is not null").repartition(*NODE).sortWithinPartitions(*NODE, "first")
    rest = parts.mapInArrow(_ends_of_pieces, _ENDS)
    return first.where("piece is null").unionByName(rest).select(*NODE, "ends_sha256")


# ---------------------------------------------------------------------- totals
class SpillingQueue:
    """Smallest key first; beyond ``limit`` messages all go to a sorted run in
    the task's own scratch file, and runs are merged as they are read."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs = limit, [], []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        self.heap.sort()
        for at in range(0, len(self.heap), 4096):
            pickle.dump(self.heap[at:at + 4096], file)
        file.seek(0)
        self.heap = []
        self._next(self._read(file))

    def _next(self, run) -> None:
        item = next(run, None)
        if item is not None:
            heapq.heappush(self.runs, (item, id(run), run))

    @staticmethod
    def _read(file):
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def take(self, key: tuple) -> list[tuple]:
        """All messages for ``key`` (none is for a smaller one)."""
        out = []
        while self.heap and self.heap[0][:2] == key:
            out.append(heapq.heappop(self.heap))
        while self.runs and self.runs[0][0][:2] == key:
            item, _, run = heapq.heappop(self.runs)
            out.append(item)
            self._next(run)
        return out


_COLUMNS = ["shard", "conv_id", "depth", "parent_conv", "parent_depth", "inside", "leaves", "saved"]
_TREE = "conv_id long, depth long, parent_conv long, parent_depth long, leaves long, saved long"


def _sweep(tie: bool, limit: int):
    """One walk over shards in reverse level order.

    ``tie``: what the shards' tree needs (values and edges of its nodes).
    Otherwise: every node with its totals, final where ``known`` tells them."""
    fields = [f.split()[0] for f in _TREE.split(", ")]

    def tied(node, parent, inside, leaves, saved, mark, sent, out, queue):
        below = [(m[4], m[5]) for m in sent if m[4] is not None]
        leaves += sum(m[2] for m in sent)
        saved += sum(m[3] for m in sent)
        if mark or len(below) > 1 or below and parent is None:
            out += [(*b, *node, 0, 0) for b in below]
            out.append((*node, None, None, leaves, saved))
            leaves, saved, below = 0, 0, [node]
        if parent is not None:
            up = below[0] if below else (None, None)
            if inside:
                queue.push((-parent[1], parent[0], leaves, saved, *up))
            else:
                out.append((*parent, None, None, leaves, saved))
                if below:
                    out.append((*up, *parent, 0, 0))

    def run(batches):
        queue, shard, out = SpillingQueue(limit), None, []

        def made():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], fields)

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in (*_COLUMNS, *(["mark"] if tie else ["known_leaves", "known_saved"]))]
            for at, conv, depth, p_conv, p_depth, inside, leaves, saved, *more in zip(*columns, strict=True):
                if at != shard:
                    queue, shard = SpillingQueue(limit), at
                sent = queue.take((-depth, conv))
                parent = None if p_conv is None else (p_conv, p_depth)
                if tie:
                    tied((conv, depth), parent, inside, leaves, saved, more[0], sent, out, queue)
                else:
                    if more[0] is None:
                        leaves, saved = leaves + sum(m[2] for m in sent), saved + sum(m[3] for m in sent)
                    else:
                        leaves, saved = more
                    out.append((conv, depth, p_conv, p_depth, leaves, saved))
                    if inside:
                        queue.push((-p_depth, p_conv, leaves, saved, None, None))
            if len(out) >= 10_000:
                yield made()
                out = []
        if out:
            yield made()

    return run


def _in_levels(sharded: DataFrame) -> DataFrame:
    return sharded.repartition("shard").sortWithinPartitions("shard", F.col("depth").desc(), "conv_id")


def subtree_totals(tree: DataFrame, shard_nodes: int = SHARD_NODES, limit: int = QUEUE) -> DataFrame:
    """``conv_id, depth, leaves, saved`` summed over subtrees.

    ``tree`` is written already: ``conv_id, depth, parent_conv, parent_depth,
    leaves, saved``; a parent is less deep and not above its child by (conv_id,
    depth), and the root has none."""
    n = tree.count()
    shards = min(SHARDS, -(-n // shard_nodes))
    null = F.lit(None).cast("long")
    if shards <= 1:
        alone = tree.withColumns({"shard": F.lit(0), "inside": F.col("parent_conv").isNotNull(), "known_leaves": null, "known_saved": null})
        return _in_levels(alone).mapInArrow(_sweep(False, limit), _TREE).select("conv_id", "depth", "leaves", "saved")
    dealt = stored(tree.repartitionByRange(shards, "conv_id", "depth").withColumn("shard", F.spark_partition_id()), "trie-shards")
    low = dealt.groupBy("shard").agg(F.min(F.struct("conv_id", "depth")).alias("low"))
    parent: Column = F.struct(F.col("parent_conv").alias("conv_id"), F.col("parent_depth").alias("depth"))
    placed = dealt.join(low, "shard").withColumn("inside", F.col("parent_conv").isNotNull() & (parent >= F.col("low"))).drop("low")
    over = placed.where("parent_conv is not null and not inside")
    marks = over.select(F.col("parent_conv").alias("conv_id"), F.col("parent_depth").alias("depth")).distinct().withColumn("mark", F.lit(True))
    marked = placed.join(marks, ["conv_id", "depth"], "left").withColumn("mark", F.coalesce("mark", F.lit(False)))
    parts = _in_levels(marked).mapInArrow(_sweep(True, limit), _TREE)
    joined = parts.groupBy("conv_id", "depth").agg(
        F.max(F.when(F.col("parent_conv").isNotNull(), F.struct("parent_conv", "parent_depth"))).alias("up"),
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    ties = stored(joined.select("conv_id", "depth", "up.parent_conv", "up.parent_depth", "leaves", "saved"), "trie-ties")
    known = subtree_totals(ties, shard_nodes, limit).select(
        "conv_id", "depth", F.col("leaves").alias("known_leaves"), F.col("saved").alias("known_saved"))
    return _in_levels(placed.join(known, ["conv_id", "depth"], "left")).mapInArrow(_sweep(False, limit), _TREE).select(
        "conv_id", "depth", "leaves", "saved")


# ----------------------------------------------------------------- the operator
def nodes_of(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Nodes with members, children, parent and digest of ends, written."""
    steps = stored(prefixes(rows), "trie-prefixes")
    found = steps.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("conv_id"), F.max("words").alias("words"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = members.agg(F.count(F.lit(1)).alias("n_convs"), F.min("c").alias("conv_id")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("n1"), zero.alias("n2"), "n_convs", "conv_id", zero.alias("words"), null.alias("p1"), null.alias("p2"))
    nodes = stored(found.unionByName(root), "trie-nodes")
    top = nodes.where("depth = 0").select("conv_id").first()
    closing = steps.join(members.withColumnRenamed("last", "depth"), ["c", "depth"], "left_semi").select(*NODE, "c")
    turnless = members.where("last = 0").select(zero.alias("depth"), zero.alias("n1"), zero.alias("n2"), "c")
    ends = ends_digests(closing.unionByName(turnless))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    # the root may have most of the children: its name is a plain value
    deep = nodes.where("depth > 1").select((F.col("depth") - 1).alias("up"), "p1", "p2", *[c for c in nodes.columns if c not in ("p1", "p2")])
    above = nodes.where("depth > 0").select(F.col("depth").alias("up"), F.col("n1").alias("p1"), F.col("n2").alias("p2"),
                                            F.col("conv_id").alias("parent_conv_id"))
    named = deep.join(above, ["up", "p1", "p2"]).drop("up", "p1", "p2")
    first = nodes.where("depth <= 1").drop("p1", "p2").withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, F.lit(top[0] if top else None).cast("long")))
    none = hashlib.sha256(b"").hexdigest()
    out = named.unionByName(first).join(children, NODE, "left").join(ends, NODE, "left")
    return stored(out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "words",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")), "trie-tree")


def trie(rows: DataFrame, members: DataFrame, shard_nodes: int = SHARD_NODES, limit: int = QUEUE) -> DataFrame:
    """All nodes of conversations given as ``c, depth, d1, d2, words`` turns and
    ``c, last`` members, with totals of their subtrees."""
    nodes = nodes_of(rows, members)
    tree = nodes.select("conv_id", "depth", F.col("parent_conv_id").alias("parent_conv"),
                        F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).alias("parent_depth"),
                        (F.col("n_children") == 0).cast("long").alias("leaves"),
                        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    totals = subtree_totals(tree, shard_nodes, limit)
    return nodes.join(totals, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), "ends_sha256")


def prefix_trie(conversations: DataFrame, shard_nodes: int = SHARD_NODES, limit: int = QUEUE) -> DataFrame:
    """The trie of ``conversations`` rebuilt with their families' shared starts."""
    rows, members = shared_starts(positions(conversations))
    return trie(rows, members, shard_nodes, limit)
