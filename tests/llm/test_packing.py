import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from kpiloom.llm import packing
from kpiloom.llm.common import BATCH, stored
from kpiloom.llm.packing import WordTokenizer, best_fit, best_fit_pack, fit_repeats, patterns_of_up_to_three, plan, tokenizer
from tests.llm.conftest import EDGE

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_word_ids_equal_whole_text_ids():
    words, whole = WordTokenizer(PATH), Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    rng = random.Random(2)
    alphabet = "ab  \n\t\x1c\x85\xa0é'sll.12Ж中😀\u200b\rİΣς źñ"
    for text in ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["ABC <|endoftext|> d", "É\u0301 e\u0301"]:
        assert memoryview(words.ids(text)).cast("I").tolist() == whole.encode(text, add_special_tokens=False).ids if text else True


def test_patterns_fill_a_sequence_exactly():
    pats = patterns_of_up_to_three(12, np.array([2, 3, 4, 6, 9, 12]))
    assert {tuple(p) for p in pats.tolist()} == {(12, 0, 0), (9, 3, 0), (6, 6, 0), (6, 4, 2), (6, 3, 3), (4, 4, 4)}


def test_fitted_repeats_are_non_negative_and_close():
    pats = patterns_of_up_to_three(12, np.array([3, 9, 6]))
    counts = np.zeros(13, np.int64)
    counts[[3, 9, 6]] = 100, 100, 50
    x = fit_repeats(counts, pats, 400)
    assert (x >= 0).all()
    used = np.bincount(pats.ravel(), np.repeat(x, 3), 13)
    assert abs(used[9] - 100) < 2 and abs(used[6] - 50) < 2


def test_plan_uses_every_piece_and_is_near_the_bound():
    rng = random.Random(3)
    for n in (1, 7, 300, 20000):
        histogram = Counter(min(2048, max(1, int(rng.lognormvariate(6.5, 0.9)))) for _ in range(n))
        sequences = plan(dict(histogram), 2048)
        used = Counter()
        for content, times in sequences:
            assert sum(content) <= 2048
            for length in content:
                used[length] += times
        assert used == histogram
        bound = max(-(-sum(k * v for k, v in histogram.items()) // 2048), sum(v for k, v in histogram.items() if k > 1024))
        total = sum(times for _, times in sequences)
        assert total <= bound * 1.02 + 1
        assert total <= sum(times for _, times in best_fit(dict(histogram), 2048))


def test_pieces_and_places(spark, table):
    def ids(text):
        return tokenizer(PATH).ids(text)

    rows = [*EDGE, *((10 + i, "hello world " * (i * 37 % 900)) for i in range(60))]
    out = best_fit_pack(table(rows).repartition(3), ids, 2048).collect()
    whole = Tokenizer.from_file(PATH)
    want = Counter()
    for doc, text in rows:
        seq = whole.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(seq), 2048):
            part = seq[k:k + 2048]
            want[doc, k // 2048, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert best_fit_pack(table([]), ids).count() == 0


def test_added_tokens_are_kept_as_by_the_library():
    words, whole = tokenizer(PATH), Tokenizer.from_file(PATH)
    for text in ["abc <|endoftext|> d", "<|startoftext|>A b<|endoftext|>", "ABC <|ENDOFTEXT|> d", "Ж <|endoftext|>é x", "a <|endof text|>", "plain É"]:
        assert memoryview(words.ids(text)).cast("I").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert 49407 in memoryview(words.ids("abc <|endoftext|> d")).cast("I").tolist()


def test_one_tokenizer_serves_both_ways():
    words, whole = tokenizer(PATH), Tokenizer.from_file(PATH)
    assert [k for k, v in vars(words).items() if isinstance(v, Tokenizer)] == ["tokenizer"]
    plain = WordTokenizer(PATH)
    for text in ["a <|endoftext|> b", "c <|endoftext|>", "Жd"]:
        kept = memoryview(words.ids(text)).cast("I").tolist()
        assert kept == whole.encode(text, add_special_tokens=False).ids
        assert words.tokenizer.encode_special_tokens
        assert (kept == memoryview(plain.ids(text)).cast("I").tolist()) == ("|" not in text)


def test_texts_reach_python_in_small_batches(spark, table, monkeypatch):
    own = {name: spark.conf.get(name) for name in BATCH}
    seen = []

    def recorded(df, tag):
        seen.append((tag, {name: spark.conf.get(name) for name in BATCH}))
        return stored(df, tag)

    monkeypatch.setattr(packing, "stored", recorded)
    docs = table([(i, "word " * 100_000) for i in range(12)]).coalesce(1)  # 6 MB in one task
    out = best_fit_pack(docs, lambda text: bytes(4 * len(text.split()))).collect()
    assert sum(r.length for r in out) == 12 * 100_001
    assert seen == [("pieces", BATCH)]
    assert {name: spark.conf.get(name) for name in BATCH} == own != BATCH
