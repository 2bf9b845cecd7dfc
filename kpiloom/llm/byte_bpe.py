"""Byte-level BPE by a lazily determinised transducer, and streaming decode.

Encoding.  A sequence of tokens is the BPE result of its bytes exactly if each
token is its own BPE result and each two neighbours are the BPE result of
their joined bytes ("fit").  That makes encoding a finite-state matter: a
non-deterministic transducer guesses the next token among those that fit the
one before, and walks the vocabulary's byte trie through it.  A prefix of the
input has one BPE result, so at most one guess per start position survives,
and a state holds at most as many guesses as the longest token has bytes.
``Transducer`` determinises this on the fly: a state is the set of surviving
guesses with the tokens each still owes; the longest common prefix of what
they owe is emitted, so every token leaves after a bounded lookahead.  States
and arcs are made when an input first needs them.

Decoding.  ``Utf8Stream`` is an incremental UTF-8 state machine: bytes of a
character that is not complete yet stay in the machine until the next feed.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kpiloom.llm.common import Recent

#: Bounds of the per-worker memory: beyond them states start anew and words not met of late are forgotten.
MAX_STATES, MAX_WORDS, MAX_PARTS, MAX_FITS = 200_000, 100_000, 400_000, 1_000_000
_NONE: tuple[int, ...] = ()


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Transducer:
    """Encodes one piece (a match of the splitting pattern) at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: data for data, rank in ranks.items()}
        # byte trie: node -> {byte: node}, and the token that ends at a node
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for data, rank in ranks.items():
            node = 0
            for b in data:
                nxt = self.children[node].get(b)
                if nxt is None:
                    nxt = len(self.children)
                    self.children[node][b] = nxt
                    self.children.append({})
                    self.ends.append(-1)
                node = nxt
            self.ends[node] = rank
        self.fits: dict[tuple[int, int], bool] = {}
        self.made: dict[int, tuple[list[bytes], list[bytes]] | None] = {}
        self._reset()

    def _reset(self) -> None:
        # a state: ((last token, trie node, tokens owed), ...); number 0 is the start
        start = ((-1, 0, _NONE),)
        self.number = {start: 0}
        self.states = [start]
        self.arcs: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]

    def merged(self, data: bytes, down_to: int = 1) -> list[bytes]:
        """BPE by its definition: join the neighbours of lowest rank, the
        leftmost first.  Used on single tokens, to learn how they are made."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > down_to:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 31), i) for i in range(len(parts) - 1))
            if rank == 1 << 31:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def edges(self, token: int) -> tuple[list[bytes], list[bytes]] | None:
        """How the first and the last part of a token grow, from a byte to the
        token; None if BPE does not make this token from its own bytes, or
        joins a part before parts of lower rank (then it has no such order)."""
        if token not in self.made:
            data, rank = self.token[token], token
            if len(data) == 1:
                self.made[token] = ([data], [data])
            else:
                known = None
                parts = self.merged(data, 2)
                if len(parts) == 2:
                    left, right = (self.ranks[x] for x in parts)
                    one, two = self.edges(left), self.edges(right)
                    if one and two and all(x < rank for x, p in ((left, parts[0]), (right, parts[1])) if len(p) > 1):
                        known = (one[0] + [data], two[1] + [data])
                self.made[token] = known
        return self.made[token]

    def fit(self, last: int, token: int) -> bool:
        """Whether ``last`` and ``token`` stay apart when their bytes are joined.

        Joins happen by rank, so the parts at the seam grow in that order; the
        two do not fit if the parts at the seam could be joined at any time
        before each has grown further (at equal ranks the leftmost goes first).
        """
        key = (last, token)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= MAX_FITS:
                self.fits.clear()
            one, two, ranks, end = self.edges(last)[1], self.edges(token)[0], self.ranks, 1 << 31
            i = j = 0
            while True:
                a = ranks[one[i + 1]] if i + 1 < len(one) else end
                b = ranks[two[j + 1]] if j + 1 < len(two) else end
                seam = ranks.get(one[i] + two[j], end)
                if seam < end and seam < a and seam <= b:
                    known = False
                    break
                if a == b == end:
                    known = True
                    break
                if a <= b:
                    i += 1
                else:
                    j += 1
            self.fits[key] = known
        return known

    def _arc(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        guesses = []
        for last, node, owed in self.states[state]:
            nxt = self.children[node].get(byte)
            if nxt is None:
                continue
            if self.children[nxt]:
                guesses.append((last, nxt, owed))
            token = self.ends[nxt]
            if token >= 0 and self.edges(token) and (last < 0 or self.fit(last, token)):
                guesses.append((token, 0, owed + (token,)))
        common = guesses[0][2] if guesses else _NONE
        for _, _, owed in guesses[1:]:
            k = 0
            while k < len(common) and k < len(owed) and common[k] == owed[k]:
                k += 1
            common = common[:k]
        target = tuple((last, node, owed[len(common):]) for last, node, owed in guesses)
        number = self.number.get(target)
        if number is None:
            number = len(self.states)
            self.number[target] = number
            self.states.append(target)
            self.arcs.append({})
        arc = (number, common)
        self.arcs[state][byte] = arc
        return arc

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(self.states) > MAX_STATES:
            self._reset()
        out: list[int] = []
        state, arcs = 0, self.arcs
        for byte in data:
            arc = arcs[state].get(byte)
            if arc is None:
                arc = self._arc(state, byte)
            state, emitted = arc
            if emitted:
                out.extend(emitted)
        for _, node, owed in self.states[state]:
            if node == 0:
                out.extend(owed)
                return out
        raise ValueError("the vocabulary does not cover every byte")


class Encoder:
    """Whole texts: split into pieces by ``pattern``, each piece encoded.

    Between two characters that are not white space, one space or one newline
    always ends a piece (the pattern ties a space to what follows and leaves a
    lone newline alone), so a text without white-space runs is cut there and
    each part is looked up among the parts met before; other texts go through
    the pattern as a whole.
    """

    _RUN = re.compile(r"\s\s|^\s|\s\Z|\0")

    def __init__(self, path: str, pattern: str):
        self.transducer = Transducer(load_ranks(path))
        # in the tokenizer's pattern \s is the White_Space property
        self.split = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
                                   .replace(r"\S", r"\P{White_Space}"))
        self.pieces = Recent(self._piece, MAX_WORDS)
        self.parts = Recent(self._part, MAX_PARTS)
        self.data = [b""] * (max(self.transducer.ranks.values()) + 1)
        for data, rank in self.transducer.ranks.items():
            self.data[rank] = data

    def _piece(self, piece: str) -> bytes:
        ids = self.transducer.encode_piece(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def _part(self, part: str) -> bytes:
        found = self.split.findall(part)
        if len(found) == 1:                             # the part itself is looked up, that is enough
            return self._piece(found[0])
        return b"".join(map(self.pieces.__getitem__, found))

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self._RUN.search(text):
            return self._part(text)
        return b"".join(map(self.parts.__getitem__, text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")))

    def decode(self, ids: Iterable[int], block: int = 8192) -> Iterator[str]:
        """Text of a stream of ids, as far as its characters are complete."""
        machine, waiting = Utf8Stream(), []
        for i in ids:
            waiting.append(self.data[i])
            if len(waiting) == block:
                yield machine.feed(b"".join(waiting))
                waiting = []
        yield machine.feed(b"".join(waiting))
        yield machine.close()


class Utf8Stream:
    """Incremental UTF-8: keeps the bytes of an unfinished character."""

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def _missing(lead: int) -> int:
        """State after a lead byte: continuation bytes still to come."""
        return 0 if lead < 0xC2 or lead > 0xF4 else 1 if lead < 0xE0 else 2 if lead < 0xF0 else 3

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b & 0xC0 != 0x80:  # the last byte that starts a character
                if self._missing(b) >= back:
                    cut -= back
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held.decode("utf-8", "replace"), b""
        return rest


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False, round_trip: bool = True) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``,
    the little-endian ids as binary, if asked for).

    One pass without a shuffle.  ``path`` must be readable by every executor.
    Null and empty texts have no tokens; repeated rows stay repeated; other
    columns are ignored; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + (["ids"] if with_ids else [])
    types, width = [pa.int64(), pa.string(), pa.string(), pa.binary()], len(names) - 1

    def run(batches):
        enc = encoder(path, pattern)
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                ids = enc.encode(text or "")
                decoded = hashlib.sha256()
                if round_trip:
                    for part in enc.decode(memoryview(ids).cast("I") if ids else ()):
                        decoded.update(part.encode())
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), decoded.hexdigest() if round_trip else None, ids))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")] + [pa.array(c, t) for c, t in zip(columns[:width], types, strict=False)], names)

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary" if with_ids else "")
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)
