import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm import conversation_repair as R
from tests.conftest import SF01

SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    """Rows of one conversation after damage, in order (brute force)."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if role is None else role), (" " if text is None else text)
        kind = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        chars = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append(1 if not chars else 2 if (role, text) in seen else 3 if chars[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def best_edits(rows, faults):
    """Every word of edits up to a cost that is known to do, cheapest first."""
    n, found = len(rows), None
    for limit in itertools.count(0, 1):
        words = []

        def go(i, state, cost, word):
            if cost > limit:
                return
            if i == n and re.fullmatch("(s?(ua)+)?", state):
                words.append((cost, word, state))
            if not re.fullmatch("s?(ua)*u?", state):
                return
            for r in "ua":
                go(i, state + r, cost + 3, word + "I")
            if i < n:
                role, fault = rows[i][1], faults[i]
                go(i + 1, state, cost + 4, word + "D")
                if fault not in (1, 2):
                    more = 3 if fault == 3 else 0
                    for r in "ua":
                        go(i + 1, state + r, cost + 3 + more, word + "R")
                    if role[:1] in tuple("sua"):
                        go(i + 1, state + role[:1], cost + more, word + "K")
        go(0, "", 0, "")
        if words:
            found = min(words)[:2]
            return found


def brute(conv, rows):
    rows = damaged(rows)
    faults = faults_of(rows)
    cost, audit = best_edits(rows, faults)
    lines = [f"{r}:{t}" for r, t in R.replay(audit, [(r, t) for _, r, t in rows])]
    turns = [t for t, _, _ in rows if t is not None]
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def results(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return {r.conv_id: tuple(r) for r in R.repair(R.damage(df), **more).collect()}


def by_conversation(rows):
    out = {}
    for r in rows:
        if r[0] is not None:
            out.setdefault(r[0], []).append(r)
    return out


def test_search_equals_every_edit():
    draw = random.Random(5)
    for _ in range(250):
        rows = [(k, draw.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]),
                 draw.choice(["yes.", "no", "", "ok!", f"t{k}."])) for k in range(draw.randrange(6))]
        faults = faults_of(rows)
        assert R.cheapest("".join(R.code(r[1], f) for r, f in zip(rows, faults))) == best_edits(rows, faults), rows


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("ABCDEFGHMNOP"), max_size=40))
def test_bounds_are_reached_and_words_replay(codes):
    codes = "".join(codes)
    cost, word = R.cheapest(codes)
    assert cost == R.bounds(codes)[0]
    names = {"s": "system", "u": "user", "a": "assistant", " ": "tool"}
    read = [R._read(c) for c in codes]
    out = list(R.replay(word, [(names[r], "") for r, _ in read]))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out))
    taken = [w for w in word if w != "I"]
    assert len(taken) == len(codes) and all(w == "D" for w, (_, f) in zip(taken, read) if f == 1)
    price = sum({"K": 0, "R": 3, "D": 4}[w] + (3 if f == 3 and w != "D" else 0) for w, (_, f) in zip(taken, read))
    assert price + 3 * word.count("I") == cost


def test_edge_cases_equal_brute_force(spark):
    rows = [(1, None, None, None), (1, 3, "user", "Hi."), (1, 3, "user", "Hi."), (1, 9, "assistant", "Bye"),
            (2, 0, "system", "S."), (3, 0, "tool", "T?"), (3, 1, "", "x."), (None, 0, "user", "nobody's."),
            *[(100 + c, t, ["system", "user", "assistant"][(c * t) % 3], f"text {t % 4}" + "." * (c % 2)) for c in range(60) for t in range(5)]]
    got = results(spark, rows)
    want = {c: brute(c, rs) for c, rs in by_conversation(rows).items()}
    assert got == want


def test_a_long_search_stays_linear():
    import time
    for codes in ("CD" * 100_000, "OP" * 50_000 + "BGK" * 30_000):
        begun = time.perf_counter()
        cost, word = R.cheapest(codes)
        assert cost == R.bounds(codes)[0] and time.perf_counter() - begun < 20


def test_all_rows_dropped_gives_zeros(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert results(spark, [(conv, 0, "user", "x.")]) == {conv: (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_empty_table_and_extra_columns(spark):
    assert R.repair(R.damage(spark.createDataFrame([], SCHEMA))).count() == 0
    more = spark.createDataFrame([(5, 1, "user", "a.", "x", True)], SCHEMA + ", copy string, gone boolean")
    assert [tuple(r) for r in R.repair(R.damage(more)).collect()] == [brute(5, [(5, 1, "user", "a.")])]


def test_long_conversation_uses_its_scratch_file(spark):
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"row {t}. " * 20) for t in range(3000)]
    (row,) = results(spark, rows, held=1000).values()
    (whole,) = results(spark, rows).values()
    assert row == whole and row[6] > 0
    rows_ = damaged(rows)
    lines = [f"{r}:{t}" for r, t in R.replay(row[7], [(r, t) for _, r, t in rows_])]
    assert row[8] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))


@pytest.mark.parametrize("path", [SF01])
def test_real_conversations_equal_brute_force(spark, path):
    from kpiloom.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r) for r in QUERIES["op12_conversation_repair"](spark, path).collect()}
    assert got == {c: brute(c, rs) for c, rs in by_conversation(rows).items()}
