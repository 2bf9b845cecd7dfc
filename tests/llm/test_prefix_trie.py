import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from kpiloom.llm import prefix_trie as T
from kpiloom.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(turns.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + own[h:])
    members, nodes = {}, {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    for node in sorted(members, key=len, reverse=True):
        kids = [k for k in members if len(k) == len(node) + 1 and k[:-1] == node]
        n_words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        ends = ",".join(str(c) for c in sorted(c for c in members[node] if len(paths[c]) == len(node)))
        nodes[node] = (min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(kids),
                       sum(nodes[k][5] for k in kids) or 1, sum(nodes[k][6] for k in kids) + (len(members[node]) - 1) * n_words,
                       hashlib.sha256(ends.encode()).hexdigest())
    return sorted(nodes.values(), key=repr)


def run(spark, rows, **more):
    out = T.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(3), **more)
    assert out.columns == COLUMNS
    return sorted(map(tuple, out.collect()), key=repr)


def many(seed=3, n=150):
    draw = random.Random(seed)
    return [(c, t, draw.choice(["user", "assistant"]), draw.choice(["a b", "c", "d e f"]))
            for c in range(-20, n) if c % 7 for t in range(draw.randrange(1, 9))]


def test_edges_equal_brute_force(spark):
    rows = [(20, None, None, None), (20, 0, "user", "hi there"), (21, 0, "user", "x"), (21, 0, "user", "x"), (22, 5, "user", ""),
            (None, 1, "user", "nobody"), (41, 0, "a", "b"), (42, 0, "a", "b"), (43, 0, "a", "b"), (-3, 0, "user", "neg\t\n ative")]
    assert run(spark, rows) == brute(rows)


def test_one_shard(spark):
    assert run(spark, many()) == brute(many())


def test_many_shards_and_a_full_queue(spark, monkeypatch):
    monkeypatch.setattr(T, "PIECE", 2)
    assert run(spark, many(4), shard_nodes=7, limit=2) == brute(many(4))


def test_a_hot_conversation_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(T, "PIECE", 16)
    monkeypatch.setattr(T, "CHUNK", 64)
    rows = [(7, t, "user", f"t {t}") for t in range(300)] + [(c, t, "user", f"same {t}") for c in range(100, 400) for t in range(2)]
    assert run(spark, rows, shard_nodes=40) == brute(rows)


def test_empty_table_and_extra_columns(spark):
    assert run(spark, []) == []
    more = spark.createDataFrame([(1, 0, "user", "a b", 5, 6)], SCHEMA + ", depth long, n1 long")
    assert sorted(map(tuple, T.prefix_trie(more).collect()), key=repr) == brute([(1, 0, "user", "a b")])


def test_queue_spills_and_keeps_order():
    queue, draw, left = T.SpillingQueue(5), random.Random(1), []
    for k in range(200):
        item = (draw.randrange(20), draw.randrange(3), k, 0, None, None)
        left.append(item)
        queue.push(item)
    for key in sorted({i[:2] for i in left}):
        assert sorted(queue.take(key)) == sorted(i for i in left if i[:2] == key)


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_real_conversations(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op11_prefix_trie"](spark, path).collect()), key=repr) == brute(rows)


def test_ids_of_a_node_over_partitions(spark):
    ends = spark.range(5000).select(F.lit(2).cast("long").alias("depth"), F.when(F.col("id") < 4000, 1).otherwise(2).cast("long").alias("n1"),
                                    F.lit(0).cast("long").alias("n2"), F.col("id").alias("c"))
    got = {r.n1: r.ends_sha256 for r in T.ends_digests(ends).collect()}
    assert got == {1: hashlib.sha256(",".join(map(str, range(4000))).encode()).hexdigest(),
                   2: hashlib.sha256(",".join(map(str, range(4000, 5000))).encode()).hexdigest()}
