import hashlib

import numpy as np
import pytest

from kpiloom.llm.order_minhash import OrderMinHash, fingerprints, fingerprints_of_edits, likeness
from tests.llm.conftest import EDGE

WORDS = [f"w{i * 7919 % 1000}" for i in range(300)]
TEXT = " ".join(WORDS)


def brute(method, text):
    """Sketch by its definition, from the same hash of numbered k-mers."""
    codes = method.numbered(np.frombuffer(text.encode("utf-32-le"), np.uint32))
    short = (codes >> np.uint64(32)).astype(np.uint32)
    rows = []
    for f in method.factors:
        values = short * f
        rows.append(sorted(sorted(range(len(codes)), key=lambda i: (values[i], i))[:method.l]))
    return rows


def test_selects_the_smallest_and_keeps_text_order(monkeypatch):
    method = OrderMinHash(k=4, l=3, m=8)
    whole = method(TEXT)
    monkeypatch.setattr("kpiloom.llm.order_minhash.BLOCK", 50)
    assert (method(TEXT) == whole).all()                       # blocks change nothing
    codes = method.numbered(np.frombuffer(TEXT.encode("utf-32-le"), np.uint32))
    out = []
    for row in brute(method, TEXT):
        from kpiloom.llm.order_minhash import _mix
        h = np.full(1, 0x9E3779B9, np.uint64)
        for i in row:
            h = _mix(h * np.uint64(3) + codes[i])
        out.append(int(h[0] >> np.uint64(32)))
    assert out == whole.tolist()


def test_occurrences_are_numbered():
    method = OrderMinHash(k=3)
    codes = method.numbered(np.frombuffer("abcabcabc".encode("utf-32-le"), np.uint32))
    assert len(set(codes.tolist())) == len(codes) == 7


def test_sensitive_to_order_and_edits():
    method = OrderMinHash()
    half = " ".join(WORDS[150:] + WORDS[:150])
    assert likeness(method(TEXT), method(TEXT)) == 1
    assert likeness(method(TEXT), method(TEXT[:-20] + "x" * 20)) > 0.7
    near, far = likeness(method(TEXT), method(half)), likeness(method(TEXT), method("other " * 200))
    assert far < near < 0.75                                     # same content, other order
    assert method("").tolist() == OrderMinHash()("").tolist()


@pytest.mark.parametrize("rows_per_range", [1, 2, 500])
def test_edits_follow_the_next_document(spark, table, rows_per_range):
    rows = [(i, f"{i} " * (i % 7 * 10) + TEXT[:i * 3]) for i in range(1, 40)] + [(50, None), (51, ""), (52, "é中😀xy")]
    got = {r.doc_id: r for r in fingerprints_of_edits(table(rows), rows_per_range=rows_per_range).collect()}
    ordered = sorted(rows, reverse=True, key=lambda r: r[0])
    assert len(got) == len(rows)
    method = OrderMinHash()
    for (doc, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == likeness(method(text), method(edited))
        assert r.near_next == likeness(method(text), method(after))
    plain = {r.doc_id: r.fingerprint for r in fingerprints(table(rows)).collect()}
    assert plain == {k: r.fingerprint for k, r in got.items()}


def test_repeated_rows_one_row_and_empty_table(table):
    out = fingerprints_of_edits(table(EDGE), rows_per_range=2).collect()
    assert len(out) == len(EDGE)
    one = fingerprints_of_edits(table([(7, "only one here")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprints_of_edits(table([])).count() == 0
