"""Repair of the turn structure of conversations by depth-first branch-and-bound.

A conversation is in order if the initials of its roles read ``(s?(ua)+)?``: an
optional system turn, then user and assistant in turn.  Edits walk along its
rows: Keep a row (K, cost 0), Rerole it to user or assistant (R, 3), Delete it
(D, 4), Insert an empty user or assistant turn (I, 3).  A blank or repeated row
has to go; a truncated one costs 3 more where it stays.  ``cheapest`` finds the
edits of least cost, and among those the ASCII-least word of their initials.

Rows are dealt by conversation and sorted there by Spark (which spills); tasks
walk the sorted rows.  Of a conversation a task keeps one code a row while it
reads; the rows themselves wait in a buffer that goes to the task's own scratch
file beyond ``HELD`` bytes.  One conversation is one sequence (its digest runs
over all its text in order), so it is walked by one task whatever its length.

Edge cases: null role, text or turn read as one space (a null turn sorts first
and counts in no gap); rows of the same turn come in the order of role, then
text; an empty role has no legal initial; rows without a conv_id belong to no
conversation and are left out; a conversation without rows after damage gives
zeros and empty words; extra columns are not read; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from array import array

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import Recent

#: Word characters: all but space and U+0009 to U+000D.
_WORD = r"[^\x20\x09-\x0D]"
RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, repaired_sha256 string")
#: Bytes of a conversation's rows that a task holds before it uses its scratch file.
HELD = 8 << 20

#: Roles so far read ... 0: nothing, 1: "s", 2: "..u", 3: "..a".
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_WANTS = {0: 2, 1: 2, 2: 3, 3: 2}            # a user or assistant put in
_ENDS = (0, 3)
_FAR = 1 << 60


def damage(rows: DataFrame) -> DataFrame:
    """``conversations`` with a planted fault by crc32 of ``conv_id:turn``, as
    ``conv_id, turn, role, text, copy, gone``; a dropped row stays as a mark
    (``gone``) without text, so that its conversation is still known."""
    blank = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key) % 20
    text = F.coalesce("text", blank)
    hurt = (F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text))
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("conv_id is not null").select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        hurt.alias("text"), F.explode(times).alias("copy"), (kind == 0).alias("gone"))


def faults(rows: DataFrame) -> DataFrame:
    """Rows with their first fault: 1 blank, 2 duplicate, 3 truncated, 0 none.

    One exchange, by conversation: the order in which equal rows are found and
    the order of the turns are both sorts within it."""
    from pyspark.sql import Window

    order = [F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    alike = Window.partitionBy("conv_id", "gone", "role", F.xxhash64("text"), F.xxhash64(F.lit(1), "text")).orderBy(*order)
    last = F.regexp_extract("text", _WORD + r"[\x20\x09-\x0D]*\z", 0)
    fault = (F.when(~F.col("text").rlike(_WORD), 1).when(F.col("earlier") > 1, 2)
             .when(~F.substring(last, 1, 1).isin(".", "!", "?"), 3).otherwise(0))
    return (rows.repartition("conv_id").withColumn("earlier", F.row_number().over(alike))
            .withColumn("fault", fault.cast("int")))


def code(role: str, fault: int) -> str:
    """A row as one letter: what the search has to know of it."""
    initial = "sua".find(role[:1]) if role else -1
    return chr(ord("A") + 4 * (fault if fault != 2 else 1) + (initial + 1))


def _read(letter: str) -> tuple[str, int]:
    n = ord(letter) - ord("A")
    return " sua"[n % 4], n // 4


def bounds(codes: str) -> array:
    """Least cost of what is left, for every row and state (at ``4 * row +
    state``), from the end: the suffix lower bounds of the search."""
    ahead = [0 if s in _ENDS else _FAR for s in range(4)]
    out = array("q", bytes(32 * (len(codes) + 1)))
    for i in range(len(codes), -1, -1):
        if i < len(codes):
            role, fault = _read(codes[i])
            here = []
            for s in range(4):
                best = 4 + ahead[s]
                if fault != 1:
                    extra = 3 if fault == 3 else 0
                    best = min(best, 3 + extra + ahead[_WANTS[s]])
                    if (s, role) in _NEXT:
                        best = min(best, extra + ahead[_NEXT[s, role]])
                here.append(best)
        else:
            here = ahead
        for _ in range(3):                              # inserted turns, any number
            here = [min(here[s], 3 + here[_WANTS[s]]) for s in range(4)]
        out[4 * i:4 * i + 4] = array("q", here)
        ahead = here
    return out


def _word(step) -> str:
    letters = []
    while step is not None:
        letters.append(step[1])
        step = step[0]
    return "".join(reversed(letters))


def _greater(chain, best: str, places: dict[int, int]) -> bool:
    """Whether the edits of ``chain`` come after the incumbent's; where they
    leave its path, one letter tells."""
    at = places.get(id(chain[0]))
    if at is not None and at < len(best):
        return chain[1] > best[at]
    word = _word(chain)
    return word > best[:len(word)]


def cheapest(codes: str) -> tuple[int, str]:
    """Least cost and, among the edits of that cost, the ASCII-least word.

    An explicit stack holds open prefixes (row, state, cost, edits as a chain).
    A prefix goes if its cost and suffix bound exceed the incumbent's, if they
    equal it with a greater word, or if the table of its (row, state) holds a
    prefix no worse in (cost, word): two prefixes there can be completed in the
    same ways, and of equal cost neither begins the other.  When the stack is
    empty the incumbent is optimal."""
    bound, n = bounds(codes), len(codes)
    best_cost, best_word = _FAR, ""
    places: dict[int, int] = {id(None): 0}      # prefixes of the incumbent and their lengths
    table: dict[tuple[int, int], tuple[int, object]] = {}
    stack: list[tuple[int, int, int, object]] = [(0, 0, 0, None)]
    kept: object = None
    while stack:
        i, s, cost, chain = stack.pop()
        total = cost + bound[4 * i + s]
        if total > best_cost or total == best_cost and chain is not None and _greater(chain, best_word, places):
            continue
        held = table.get((i, s))
        if held is not None and (held[0] < cost or held[0] == cost and held[1] is not chain and _word(held[1]) <= _word(chain)):
            continue
        table[i, s] = (cost, chain)
        if i == n and s in _ENDS:
            word = _word(chain)
            if (cost, word) < (best_cost, best_word):
                best_cost, best_word = cost, word
                places, step = {id(None): 0}, chain
                for k in range(len(word), 0, -1):
                    places[id(step)], step = k, step[0]
                kept = chain                            # its steps live, so their ids stay theirs
        ways = [(cost + 3, "I", i, _WANTS[s])]
        if i < n:
            role, fault = _read(codes[i])
            ways.append((cost + 4, "D", i + 1, s))
            if fault != 1:
                extra = 3 if fault == 3 else 0
                ways.append((cost + 3 + extra, "R", i + 1, _WANTS[s]))
                if (s, role) in _NEXT:
                    ways.append((cost + extra, "K", i + 1, _NEXT[s, role]))
        # most promising last: it is taken up next
        for c, letter, j, t in sorted(ways, key=lambda w: (w[0] + bound[4 * w[2] + w[3]], w[1]), reverse=True):
            if c + bound[4 * j + t] <= best_cost:
                stack.append((j, t, c, (chain, letter)))
    del kept
    return best_cost, best_word


def replay(audit: str, rows):
    """Repaired ``role, text`` from the edits and the rows in order."""
    state = 0
    rows = iter(rows)
    for letter in audit:
        if letter == "I":
            state = _WANTS[state]
            yield "user" if state == 2 else "assistant", ""
            continue
        role, text = next(rows)
        if letter == "K":
            state = _NEXT[state, role[:1]]
            yield role, text
        elif letter == "R":
            state = _WANTS[state]
            yield "user" if state == 2 else "assistant", text


class _Rows:
    """The rows of one conversation, in memory or in the task's scratch file."""

    def __init__(self, held: int):
        self.file = tempfile.SpooledTemporaryFile(max_size=held)

    def add(self, role: str, text: str) -> None:
        r, t = role.encode(), text.encode("utf-8", "surrogatepass")
        self.file.write(struct.pack("<qq", len(r), len(t)) + r + t)

    def __iter__(self):
        self.file.seek(0)
        while head := self.file.read(16):
            r, t = struct.unpack("<qq", head)
            yield self.file.read(r).decode(), self.file.read(t).decode("utf-8", "surrogatepass")


def _legal(a: str, b: str) -> bool:
    return a[:1] + b[:1] in ("su", "ua", "au")


class _Conversation:
    def __init__(self, conv_id: int, held: int):
        self.conv_id, self.rows = conv_id, _Rows(held)
        self.codes: list[str] = []
        self.counts = [0, 0, 0, 0]
        self.illegal, self.distinct = 0, 0
        self.low = self.high = self.before = None

    def add(self, turn, role, text, fault) -> None:
        if turn is not None:                            # turns come in order
            self.low = turn if self.low is None else self.low
            self.distinct += turn != self.high
            self.high = turn
        self.illegal += self.before is not None and not _legal(self.before, role)
        self.before = role
        self.counts[fault] += 1
        self.codes.append(code(role, fault))
        self.rows.add(role, text)

    def result(self, solve) -> tuple:
        cost, audit = solve["".join(self.codes)]
        digest = hashlib.sha256()
        for k, (role, text) in enumerate(replay(audit, self.rows)):
            digest.update(("\n" * (k > 0) + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.rows.file.close()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv_id, gaps, *self.counts[1:], self.illegal, cost, audit, digest.hexdigest())


def _walk(held: int):
    def run(batches):
        solve = Recent(cheapest, 20_000)
        types = [pa.int64()] * 7 + [pa.string()] * 2
        names = [c.split()[0] for c in RESULT.split(", ")]

        def out(done):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types, strict=True)], names)

        now, done = None, []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "fault", "gone")]
            for conv_id, turn, role, text, fault, gone in zip(*columns, strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.result(solve))
                    now = _Conversation(conv_id, held)
                    if len(done) >= 1000:
                        yield out(done)
                        done = []
                if not gone:
                    now.add(turn, role, text, fault)
        if now is not None:
            done.append(now.result(solve))
        if done:
            yield out(done)

    return run


def repair(rows: DataFrame, held: int = HELD) -> DataFrame:
    """One row per conversation of ``conv_id, turn, role, text`` rows (``copy``
    and ``gone`` as ``damage`` gives them): its faults, the cost and word of the
    cheapest edits, and the digest of the repaired ``role:text`` lines."""
    marked = faults(rows).select("conv_id", "turn", "role", "text", "fault", "gone", "copy")
    ordered = marked.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "copy")
    return ordered.mapInArrow(_walk(held), RESULT)


def as_rows(conversations: DataFrame) -> DataFrame:
    """Undamaged conversations in the form that ``repair`` takes."""
    blank: Column = F.lit(" ")
    return conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        F.lit(0).alias("copy"), F.lit(False).alias("gone"))
