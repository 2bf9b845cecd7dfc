import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from kpiloom.llm.byte_bpe import Encoder, Transducer, Utf8Stream, encode
from tests.llm.conftest import EDGE

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.transducer.ranks, special_tokens={})


def ids(encoder, text):
    return memoryview(encoder.encode(text)).cast("I").tolist() if text else []


def test_same_ids_as_the_library_and_round_trip(encoder, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab  \n\t\x1c\x85\xa0é'sll.12Ж中😀\u200b\r źñ\0") for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["".join(rng.choice("theandionrstlg") for _ in range(rng.randint(1, 200))) for _ in range(500)]
    texts += ["a" * 3000 + "!" * 2000 + " " * 1000 + "b", "<|endoftext|>", "don't we'LL I'm"]
    for text in texts:
        got = ids(encoder, text)
        assert got == library.encode_ordinary(text), text
        assert "".join(encoder.decode(got, block=3)) == text


def test_other_vocabulary():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    enc = Encoder(path, public_tokenizers.PATTERN)
    lib = tiktoken.Encoding("m", pat_str=public_tokenizers.PATTERN, mergeable_ranks=enc.transducer.ranks, special_tokens={})
    for text in ("Größe und Maß, élève où çà; niño mañana 中文字符 Привет мир", "x" * 77):
        assert ids(enc, text) == lib.encode_ordinary(text)


def test_states_start_anew_within_bounds(encoder, library, monkeypatch):
    monkeypatch.setattr("kpiloom.llm.byte_bpe.MAX_STATES", 5)
    small = Transducer(encoder.transducer.ranks)
    for word in (" unbelievably", " extraordinarily", " thhehaer", " stnatble"):
        assert small.encode_piece(word.encode()) == library.encode_ordinary(word)


def test_utf8_stream_holds_unfinished_characters():
    data = "aé中😀z".encode()
    for step in (1, 2, 3, 5):
        machine = Utf8Stream()
        parts = [machine.feed(data[i:i + step]) for i in range(0, len(data), step)]
        assert "".join(parts) + machine.close() == "aé中😀z"
    assert Utf8Stream().feed(b"\xff\xc3") == "\ufffd"


def test_query_shape_on_edges(spark, table):
    out = encode(table(EDGE), PATH, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = out.collect()
    assert len(rows) == len(EDGE)
    for r in rows:
        texts = [t for i, t in EDGE if i == r.doc_id]
        assert r.decoded_sha256 == hashlib.sha256((texts[0] or "").encode()).hexdigest()
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert encode(table([]), PATH, public_tokenizers.PATTERN).count() == 0
