"""Near duplicates: Jaccard join of word n-gram sets by token-combination
prefixes, and the components of its links.

A token is a hashed n-gram of words.  Two sets whose Jaccard similarity
reaches the threshold differ in few tokens, so they must meet in the first
tokens ("prefix") of any common order.  The order here: rare tokens before
frequent ones, each by hash.

* A set with enough rare tokens files single rare tokens: with ``u`` the
  tokens it may lack in a similar set, ``u + 1`` of them.
* Any other set files all its rare tokens and extends its prefix into the
  frequent class until ``u + d + 2`` tokens, where ``d`` bounds the tokens in
  which two similar sets differ.  If two sets share no rare token, they share
  at least ``d + 2`` frequent ones there, hence at least one pair of
  neighbours with no foreign token between: combinations of two neighbouring
  tokens are filed, as many as there are tokens.

Which tokens count as frequent changes only the amount of work: the result is
exact for any choice, and a fixed-size bitmap of token hashes says which do.

Candidates are verified on whole sets.  In each filed group all sets are first
held against a few central sets (stars, not all pairs); sets of one component
need no further comparison, and only what is left in different components of
a group is compared with each other, in large groups block by block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import Lent, small_batches, stored

_ODD = np.uint64(0x9E3779B97F4A7C15)  # fixed: odd 64-bit constant
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_PAGE = 1 << 15  # bits of one bitmap page (as Spark's bitmap functions have it)


@dataclass(frozen=True)
class JaccardConfig:
    words: int = 5
    percent: int = 80
    #: A token in the prefixes of more sets than this is frequent.
    frequent: int = 24
    #: Bits of a bitmap, at most; it has 256 for each row if that is fewer.
    bits: int = 1 << 27

    def bits_for(self, rows: int) -> int:
        return min(self.bits, max(1 << 20, 1 << (256 * rows).bit_length()))

    def lacking(self, n: int) -> int:
        """Tokens that a set of ``n`` may lack in a similar set, at most."""
        return n - -(-self.percent * n // 100)

    def differing(self, n: int) -> int:
        """Tokens in which a set of ``n`` and a similar one differ, at most."""
        return (100 - self.percent) * n // self.percent


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _hashes(words: list[bytes]) -> np.ndarray:
    # hashing a word anew is cheaper than finding it in a table of many
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def tokens_of(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of a text's words: runs of
    anything but ASCII white space, A-Z lower-cased.  A text with fewer words
    is one n-gram; one without words has none."""
    split = text.encode().lower().split() if text else []
    if not split:
        return np.zeros(0, np.int64)
    h = _hashes(split)
    width = min(words, len(split))
    m = len(h) - width + 1
    code = np.full(m, width, np.uint64)
    for j in range(width):
        code = _mixed(code * _ODD + h[j:m + j])
    return np.unique(code.view(np.int64))


#: Words hashed at once, about.
WORDS_AT_ONCE = 20_000


def token_sets(texts: list[str | None], words: int = 5) -> list[np.ndarray]:
    """``tokens_of`` each text, many texts at a time."""
    out: list[np.ndarray] = []
    at, sizes, parts = [], [], []

    def hashed():
        h = _hashes(parts)
        m = len(h) - words + 1
        code = np.full(m, words, np.uint64)
        for j in range(words):
            code = _mixed(code * _ODD + h[j:m + j])
        code, start = code.view(np.int64), 0
        for i, n in zip(at, sizes, strict=True):
            own = np.sort(code[start:start + n - words + 1])     # n-grams across two texts are left out
            new = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=new[1:])
            out[i] = own[new]
            start += n
        at.clear(), sizes.clear(), parts.clear()

    for i, text in enumerate(texts):
        split = text.encode().lower().split() if text else []
        if len(split) < words:
            out.append(tokens_of(text, words))
            continue
        out.append(None)
        at.append(i)
        sizes.append(len(split))
        parts.extend(split)
        if len(parts) >= WORDS_AT_ONCE:
            hashed()
    if parts:
        hashed()
    return out


def _positions(tokens: np.ndarray, bits: int, seed: int = 0) -> np.ndarray:
    mixed = _mixed((tokens.view(np.uint64) + np.uint64(seed)) * _ODD)
    return (mixed & np.uint64(bits - 1) if bits & (bits - 1) == 0 else mixed % np.uint64(bits)).astype(np.int64)


class Bitmap:
    """A fixed number of bits, set by the keys of a table (a Bloom filter with
    ``hashes`` bits for each).  It may say yes to others; callers stay right
    if it does, and only do more work."""

    def __init__(self, keys: DataFrame, bits: int, hashes: int = 1):
        self.bits, self.hashes = bits, hashes

        def pages_of(batches):
            # a task's own bits, at most ``bits``, and of them the pages that have any
            data = None
            for b in batches:
                k = b.column(0).drop_null().to_numpy(zero_copy_only=False)
                if data is None and len(k):
                    data = np.zeros((-(-bits // _PAGE), _PAGE // 8), np.uint8)
                for i in range(hashes if len(k) else 0):
                    at = _positions(k, bits, i)
                    np.bitwise_or.at(data.reshape(-1), at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
            used = np.flatnonzero(data.any(1)) if data is not None else []
            for at in range(0, len(used), 256):
                some = used[at:at + 256]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([data[p].tobytes() for p in some], pa.binary())],
                                                 ["page", "bits"])

        # Spark puts the pages together; at most `bits` bits come to the driver
        pages = (keys.select(keys.columns[0]).mapInArrow(pages_of, "page int, bits binary")
                 .groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits")))
        self.data = np.zeros(-(-bits // _PAGE) * (_PAGE // 8), np.uint8)
        for b in pages.toArrow().to_batches():
            for page, raw in zip(b.column("page").to_pylist(), b.column("bits"), strict=True):
                raw = np.frombuffer(raw.as_buffer(), np.uint8)
                self.data[page * (_PAGE // 8):page * (_PAGE // 8) + len(raw)] = raw

    def has(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.zeros(len(keys), bool), None        # most keys fail at the first bit
        for i in range(self.hashes):
            at = _positions(keys if left is None else keys[left], self.bits, i)
            hit = np.flatnonzero((self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
            left = hit if left is None else left[hit]
        out[left] = True
        return out


#: Rows handled at once in a task: bounds what a worker holds.
SLICE = 512


def _slices(batches):
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            yield b.slice(at, SLICE)


def _lists(tokens: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(t) for t in tokens]).astype(np.int32)
    values = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))


def _ids(batch, name: str) -> np.ndarray:
    return batch.column(name).fill_null(0).to_numpy(zero_copy_only=False)


def _classes(rows: DataFrame, config: JaccardConfig) -> DataFrame:
    """``doc_id, n, sig, first`` of every row: size, digest and first tokens by
    hash of its set, twice as many as it files if they are rare."""
    def run(batches):
        for b in _slices(batches):
            sets = token_sets(b.column("text").to_pylist(), config.words)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(t) for t in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(t.tobytes()) if len(t) else None for t in sets], pa.binary()),
                 _lists([t[:2 * config.lacking(len(t)) + 2] for t in sets])], ["doc_id", "n", "sig", "first"])

    return rows.mapInArrow(run, "doc_id long, n long, sig binary, first array<long>")


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of an array of lists, and where each list starts and ends."""
    ends = lists.offsets.to_numpy()
    return lists.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]], ends - ends[0]


def _over(classes: DataFrame, chosen: Bitmap, more: tuple[Bitmap, ...], config: JaccardConfig, pick, lent: Lent) -> DataFrame:
    """``pick(n, first, *has)`` of each class that ``chosen`` lets pass: tokens,
    or None if only the whole set can tell (``keys`` is null then).  ``has``:
    for each bitmap of ``more``, which of the first tokens it has."""
    sent = lent((chosen, more))

    def run(batches):
        allowed, given = sent.value
        for b in _slices(batches):
            ids, sizes = _ids(b, "doc_id"), _ids(b, "n")
            tokens, ends = _flat(b.column("first"))
            has = [bitmap.has(tokens) for bitmap in given]
            at, out = [], []
            for i in np.flatnonzero(allowed.has(ids) & (sizes > 0)):
                own = slice(ends[i], ends[i + 1])
                keys = pick(int(sizes[i]), tokens[own], *[h[own] for h in has])
                if keys is None or len(keys):
                    at.append(i)
                    out.append(None if keys is None else keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at], pa.int64()), pa.array(sizes[at], pa.int64()),
                 pa.array(out, pa.list_(pa.int64()))], ["node", "n", "keys"])

    return (classes.where("doc_id is not null").select("doc_id", "n", "first")
            .mapInArrow(run, "node long, n long, keys array<long>"))


def _whole(texts: DataFrame, wanted: Bitmap, config: JaccardConfig, lent: Lent, frequent: Bitmap | None = None) -> DataFrame:
    """``node, n, keys``: whole sets of the rows in ``wanted``, read from their
    texts again; with ``frequent``, what they are filed under."""
    sent = lent((wanted, frequent))

    def run(batches):
        allowed, often = sent.value
        for b in _slices(batches):
            ids = _ids(b, "doc_id")
            at, n, out = [], [], []
            wanted_ones = np.flatnonzero(allowed.has(ids))
            sets = token_sets([b.column("text")[i].as_py() for i in wanted_ones], config.words)
            for i, tokens in zip(wanted_ones, sets, strict=True):
                if len(tokens):
                    at.append(i)
                    n.append(len(tokens))
                    out.append(tokens if often is None else filed(tokens, often.has(tokens), config))
            yield pa.RecordBatch.from_arrays([pa.array(ids[at], pa.int64()), pa.array(n, pa.int64()), _lists(out)],
                                             ["node", "n", "keys"])

    return texts.mapInArrow(run, "node long, n long, keys array<long>")


def filed(tokens: np.ndarray, frequent: np.ndarray, config: JaccardConfig) -> np.ndarray:
    """What a set is filed under: rare tokens, or rare tokens and combinations
    of neighbouring frequent ones.  ``tokens`` are sorted, ``frequent`` says
    which of them belong to the frequent class."""
    n = len(tokens)
    u = config.lacking(n)
    rare = tokens[~frequent]
    if len(rare) > u:
        return rare[:u + 1]
    often = tokens[frequent][:u + config.differing(n) + 2 - len(rare)]
    pairs = _mixed(_mixed(often[:-1].view(np.uint64) * _ODD) + often[1:].view(np.uint64)).view(np.int64)
    return np.concatenate([rare, pairs])


def _often(tokens: DataFrame, more_than: int) -> DataFrame:
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > more_than)


def may_link(n_x: int, head_x: np.ndarray, n_y: int, head_y: np.ndarray, config: JaccardConfig) -> bool:
    """Whether two sets can reach the threshold, told from their first tokens
    by hash (the upper 32 bits, sorted): below the smaller of the two last
    values all tokens of both are known, so the overlap is at most the equal
    ones there and what either may have after it."""
    end = min(head_x[-1], head_y[-1])
    x, y = head_x[:np.searchsorted(head_x, end)], head_y[:np.searchsorted(head_y, end)]
    same = int(np.isin(x, y).sum())
    most = same + min(n_x - len(x), n_y - len(y))
    return 100 * most >= config.percent * (n_x + n_y - most)


def _possible(pairs: DataFrame, classes: DataFrame, wanted: Bitmap, config: JaccardConfig, lent: Lent) -> DataFrame:
    """Those of the distinct pairs ``a, b`` whose first tokens allow a link."""
    sent = lent(wanted)

    def heads(batches):
        for b in _slices(batches):
            ids, sizes = _ids(b, "doc_id"), _ids(b, "n")
            at = np.flatnonzero(sent.value.has(ids) & (sizes > 0))
            out = [(b.column("first")[i].values.to_numpy(zero_copy_only=False) >> 32).astype(np.int32) for i in at]
            yield pa.RecordBatch.from_arrays([pa.array(ids[at], pa.int64()), pa.array(sizes[at], pa.int64()),
                                              pa.array(out, pa.list_(pa.int32()))], ["node", "n", "head"])

    def run(batches):
        for b in _slices(batches):
            keep = [may_link(n, one.values.to_numpy(zero_copy_only=False), m, two.values.to_numpy(zero_copy_only=False), config)
                    for n, one, m, two in zip(b.column("n_a").to_pylist(), b.column("h_a"), b.column("n_b").to_pylist(),
                                              b.column("h_b"), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    known = (classes.where("doc_id is not null").select("doc_id", "n", "first")
             .mapInArrow(heads, "node long, n long, head array<int>"))
    left = known.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("head").alias("h_a"))
    right = known.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("head").alias("h_b"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long").distinct()


def _linked(pairs: DataFrame, classes: DataFrame, texts: DataFrame, config: JaccardConfig, bits: int, lent: Lent) -> DataFrame:
    """Those of the distinct pairs ``a, b`` that reach the threshold: what the
    first tokens leave is verified on whole sets."""
    pairs = stored(_possible(pairs, classes, Bitmap(_ends(pairs), bits, 3), config, lent), "possible")
    sets = stored(_whole(texts, Bitmap(_ends(pairs), bits, 3), config, lent).distinct(), "sets")
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("keys").alias("t_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("keys").alias("t_b"))
    common = F.size(F.array_intersect("t_a", "t_b"))
    return (pairs.join(left, "a").join(right, "b")
            .where(100 * common >= config.percent * (F.col("n_a") + F.col("n_b") - common)).select("a", "b").distinct())


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select("a").union(pairs.select("b")).distinct()


FEW_EDGES = 100_000


def _few_components(batches):
    """``node, component`` of a short edge list ``u, v`` that one task holds: each
    round the greatest of two linked roots falls to the smallest it meets."""
    parts = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches if b.num_rows]
    if not parts:
        return
    ends = [np.concatenate(side) for side in zip(*parts, strict=True)]
    nodes, at = np.unique(np.concatenate(ends), return_inverse=True)
    u, v = at[:len(ends[0])], at[len(ends[0]):]
    root = np.arange(len(nodes))
    while (differ := root[u] != root[v]).any():
        one, two = root[u[differ]], root[v[differ]]
        np.minimum.at(root, np.maximum(one, two), np.minimum(one, two))
        while (root[root] != root).any():
            root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(nodes[root], pa.int64())], ["node", "component"])


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for the nodes of an edge
    list ``a, b``: alternating large and small stars until nothing changes;
    logarithmic in the longest chain, and no neighbourhood is gathered.  A list
    of at most ``FEW_EDGES`` is settled in one task, which saves the turns' jobs."""
    def mark(e):
        r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("h")).first()
        return r["n"], r["h"]

    e = edges.select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
    e = stored(e.where("u <> v").distinct(), "edges")
    before = mark(e)
    if before[0] <= FEW_EDGES:
        return e.coalesce(1).mapInArrow(_few_components, "node long, component long")
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = mark(e)
        if now == before:
            break
        before = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component")))


def _unsettled(groups: DataFrame, found: DataFrame | None) -> DataFrame:
    """``key, node, n, rank, component`` of the groups that hold sets of
    different components; ``found``: the components so far."""
    if found is None:
        return groups.withColumn("component", F.col("node"))
    own = groups.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (own.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low <> high").select("key"))
    return own.join(mixed, "key", "left_semi")


def _pairs(near: DataFrame, config: JaccardConfig) -> DataFrame:
    """Pairs ``x, y`` whose sizes allow a link, each once."""
    fit = 100 * F.least("n_x", "n_y") >= config.percent * F.greatest("n_x", "n_y")
    return near.where(fit).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


#: Sets of a group that all others are held against in a turn, after the first.
CENTRES = 8


def _with_centres(groups: DataFrame, turn: int, config: JaccardConfig) -> DataFrame:
    """Each set with the centres of each of its groups: at first the one set
    that shares most, then ``CENTRES`` others by chance, the same in all groups
    that have them."""
    if turn == 0:
        order, slot = F.struct("rank", "node"), F.lit(0)
    else:
        chance = F.xxhash64("node", F.lit(turn))
        order, slot = F.struct(chance.alias("rank"), F.col("node")), F.pmod(chance, F.lit(CENTRES)).cast("int")
    centre = groups.groupBy("key", slot.alias("slot")).agg(F.max(F.struct(
        order.alias("order"), F.col("node").alias("y"), F.col("n").alias("n_y"), F.col("component").alias("c"))).alias("centre"))
    near = groups.join(centre.select("key", "centre.y", "centre.n_y", "centre.c"), "key").where("component <> c")
    return _pairs(near.select(F.col("node").alias("x"), F.col("n").alias("n_x"), "y", "n_y"), config)


def _within(groups: DataFrame, config: JaccardConfig) -> DataFrame:
    """Sets of different components of a group, pair by pair."""
    one = groups.select("key", F.col("node").alias("x"), F.col("n").alias("n_x"), F.col("component").alias("c_x"))
    two = groups.select("key", F.col("node").alias("y"), F.col("n").alias("n_y"), F.col("component").alias("c_y"))
    return _pairs(one.join(two, "key").where("x < y and c_x <> c_y"), config)


#: Unsettled groups of up to so many sets are compared pair by pair; in larger
#: ones, blocks of about so many sets are compared as wholes.
BLOCK = 64


def _block_links(percent: int):
    """Links between two blocks of sets (or within one), as ``a, b``."""
    def run(pdf):
        import pandas as pd

        low, high = pdf["low"].iloc[0], pdf["high"].iloc[0]
        left, right = pdf[pdf["slot"] == low], pdf[pdf["slot"] == high]
        nodes, sizes, parts = right["node"].to_numpy(), right["n"].to_numpy(), right["component"].to_numpy()
        tokens = np.concatenate(list(right["keys"]) or [np.zeros(0, np.int64)])
        owner = np.repeat(np.arange(len(right)), sizes)
        out = []
        for x, n, part, own in zip(left["node"], left["n"], left["component"], left["keys"], strict=True):
            common = np.bincount(owner[np.isin(tokens, own)], minlength=len(right))
            hit = (100 * common >= percent * (n + sizes - common)) & (parts != part)
            out += [(min(x, y), max(x, y)) for y in nodes[hit]]
        return pd.DataFrame(sorted(set(out)), columns=["a", "b"], dtype="int64")

    return run


def _in_blocks(groups: DataFrame, texts: DataFrame, config: JaccardConfig, bits: int, lent: Lent) -> DataFrame:
    """Links between sets of different components in large groups.

    Groups that overlap are one cluster (a family that shares a hundred keys
    is compared once, not once a key).  A cluster is dealt into slots of about
    ``BLOCK`` sets, each two slots meet in one bounded group, and only links
    come out."""
    first = groups.groupBy("key").agg(F.min("node").alias("first"))
    clusters = components(groups.join(first, "key").select(F.col("node").alias("a"), F.col("first").alias("b")))
    members = (groups.select("node", "component").distinct()
               .join(clusters.select("node", F.col("component").alias("cluster")), "node"))
    slots = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("slots"))
    placed = members.join(slots, "cluster").withColumn("slot", F.pmod(F.xxhash64("node"), F.col("slots")).cast("int"))
    sets = _whole(texts, Bitmap(members.select("node"), bits, 3), config, lent).distinct()
    rows = placed.join(sets, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    rows = rows.select("cluster", F.least("slot", "other").alias("low"), F.greatest("slot", "other").alias("high"),
                       "slot", "node", "n", "component", "keys")
    return rows.groupBy("cluster", "low", "high").applyInPandas(_block_links(config.percent), "a long, b long").distinct()


def _filed_groups(classes: DataFrame, first: DataFrame, texts: DataFrame, config: JaccardConfig, bits: int) -> DataFrame:
    """``key, node, n, rank`` of the keys that two or more sets are filed under."""
    spark = classes.sparkSession
    chosen = Bitmap(first.select("node"), bits)

    def filed_at_first(n, tokens):
        return tokens[:config.lacking(n) + 1]

    with Lent(spark) as lent:
        index = _over(classes, chosen, (), config, filed_at_first, lent).select(F.explode("keys").alias("token"))
        counts = stored(_often(index, 1), "counts")
    often = counts.where(F.col("df") > config.frequent).select("token")

    def moving_up(n, tokens, frequent):
        # frequent tokens leave the first ones; twice as many may take their places
        size = config.lacking(n) + 1
        end = size + 2 * int(frequent[:size].sum())
        return tokens[size:end][~frequent[size:end]]

    with Lent(spark) as lent:
        rising = _over(classes, chosen, (Bitmap(often, bits, 3),), config, moving_up, lent).select(F.explode("keys").alias("token"))
        often = stored(often.union(_often(rising, config.frequent).select("token")).distinct(), "often")

    def rare(n, tokens, frequent):
        size = config.lacking(n) + 1
        found = tokens[~frequent]
        return found[:size] if len(found) >= size else None

    def undecided(n, tokens, frequent):
        return None if rare(n, tokens, frequent) is None else tokens[:0]

    def later(n, tokens, frequent):
        # rare tokens that were not among the first ones counted
        size, found = config.lacking(n) + 1, rare(n, tokens, frequent)
        return tokens[:0] if found is None else found[found > tokens[size - 1]]

    # sets with few rare tokens at first reach beyond what was counted so far
    with Lent(spark) as lent:
        few = _over(classes, chosen, (Bitmap(often, bits, 3),), config, undecided, lent).select("node")
        beyond = _whole(texts, Bitmap(few, bits, 3), config, lent).select(F.explode("keys").alias("token"))
        frequent = Bitmap(often.union(_often(beyond, config.frequent).select("token")), bits, 3)
    with Lent(spark) as lent:
        few = _over(classes, chosen, (frequent,), config, undecided, lent).select("node")
        few = stored(_whole(texts, Bitmap(few, bits, 3), config, lent, frequent).distinct(), "few")

    def shared_ones(n, tokens, frequent, one, two):
        found = rare(n, tokens, frequent)
        if found is None:
            return tokens[:0]
        return found[(one | two)[~frequent][:len(found)]]

    with Lent(spark) as lent:
        more = _over(classes, chosen, (frequent,), config, later, lent).select(F.explode("keys").alias("key"))
        besides = Bitmap(more.union(few.select(F.explode("keys").alias("key"))).distinct(), bits, 3)
    with Lent(spark) as lent:
        shared = Bitmap(counts.select("token"), bits, 3)
        many = _over(classes, chosen, (frequent, shared, besides), config, shared_ones, lent)
        index = stored(many.union(few).select("node", "n", F.explode("keys").alias("key")).distinct(), "index")
    twice = index.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")
    groups = stored(index.join(twice, "key", "left_semi"), "groups")
    ranks = groups.groupBy("node").agg((F.count(F.lit(1)) / F.max("n")).alias("rank"))
    return stored(groups.join(ranks, "node"), "ranked")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: JaccardConfig | None = None,
                    rounds: int = 2) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id`` (the smallest id reachable
    by links, its own included).

    Equal sets are one class, compared through the row of its smallest id.
    Rows that share an id are one document and share a component.  Texts that
    are null, empty or without words have no set and link with nothing; rows
    without an id get a null component.  An empty table gives an empty result;
    other columns are left out, so none can clash.

    Texts are read for the classes, again where a set has too few rare tokens
    among its first ones, and again for the sets of candidate pairs; whole
    sets are neither moved nor stored otherwise.  Each turn's links are merged
    into the components so far, so no later plan reads earlier links.
    """
    config, spark = config or JaccardConfig(), docs.sparkSession
    with small_batches(spark):
        return _labelled(*_joined(_rows(docs, id_col, text_col), config, rounds)).drop("sig")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def _merged(edges: DataFrame, found: DataFrame | None) -> DataFrame:
    """Components of ``edges`` and of the components ``found`` so far."""
    if found is not None:
        edges = edges.union(found.where("node <> component"))
    return stored(components(edges), "components")


def _joined(rows: DataFrame, config: JaccardConfig, rounds: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``doc_id, n, sig, first`` of the rows, ``sig, node`` of the classes, and
    ``node, component`` of the nodes that link with any."""
    classes = stored(_classes(rows, config), "classes")
    bits = config.bits_for(classes.count())
    known = classes.where("doc_id is not null and n > 0").select("doc_id", "sig")
    first = stored(known.groupBy("sig").agg(F.min("doc_id").alias("node")), "first")
    texts = rows.where("doc_id is not null and text is not null")
    groups = _filed_groups(classes, first, texts, config, bits)

    joined = tested = None
    for turn in range(rounds + 1):
        left = stored(_unsettled(groups, joined), "unsettled")
        if left.isEmpty():
            break
        with Lent(rows.sparkSession) as lent:
            blocks = None
            if turn < rounds:
                pairs = _with_centres(left, turn, config)
            else:
                sizes = left.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
                large = stored(left.join(sizes.where(F.col("size") > BLOCK).select("key"), "key", "left_semi"), "large")
                pairs = _within(left.join(sizes.where(F.col("size") <= BLOCK).select("key"), "key", "left_semi"), config)
                if not large.isEmpty():
                    blocks = stored(_in_blocks(large, texts, config, bits, lent), "links")
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = stored(pairs, "pairs")
            links = stored(_linked(pairs, classes, texts, config, bits, lent), "links")
        joined = _merged(links if blocks is None else links.union(blocks), joined)
        tested = pairs if tested is None else tested.union(pairs)

    # documents whose rows have different sets tie those together
    member = known.distinct().join(first, "sig")
    several = member.groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    ties = stored(member.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("node").alias("b")), "ties")
    if joined is None or not ties.isEmpty():
        joined = _merged(ties, joined)
    return classes, first, joined


def _labelled(classes: DataFrame, first: DataFrame, joined: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, sig, component_id`` of the rows."""
    return (classes.select("doc_id", "n", "sig").join(first, "sig", "left").join(joined, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), "sig", F.when(
                F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: JaccardConfig | None = None) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one of
    the smallest id; of rows that share an id, the least row.  Rows without an
    id stay.  Columns of any other names are kept as they are.

    Most rows are kept without moving: a bitmap of the ids in question lets
    them pass, and only rows that it holds back are joined with the exact ids.
    """
    found = stored(near_duplicates(docs, id_col, text_col, config), "components").where("doc_id is not null")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    again = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    asked = stored(gone.union(again), "asked")
    bits = (config or JaccardConfig()).bits_for(max(1, asked.count()))
    sent = docs.sparkSession.sparkContext.broadcast(Bitmap(asked, bits, 3))

    @F.pandas_udf("boolean")
    def held_back(ids):
        import pandas as pd

        return pd.Series(sent.value.has(ids.to_numpy()))

    own = F.col(id_col).cast("long")
    mark = "held_back"
    while mark in docs.columns:
        mark += "_"
    marked = docs.withColumn(mark, own.isNotNull() & held_back(F.coalesce(own, F.lit(0))))
    free = marked.where(~F.col(mark)).drop(mark)
    held = marked.where(F.col(mark)).drop(mark)
    held = held.join(gone, held[id_col].cast("long") == gone["doc_id"], "left_anti")
    others = [c for c in docs.columns if c != id_col]
    least = held.groupBy(id_col).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in others])).alias("row"))
    return free.unionByName(least.select(id_col, *[F.col(f"row.`{c}`") for c in others]))
