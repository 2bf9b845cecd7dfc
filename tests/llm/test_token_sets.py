import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm.ngram_jaccard import Bitmap, token_sets, tokens_of
from tests.llm.test_ngram_jaccard import corpus


def test_token_sets_are_those_of_each_text():
    texts = [t for _, t in corpus(3)] + [None, "", " \t", "one", "a b c d", "a b c d e", "A b\nC d e " * 40, "é ß " * 9]
    for got, text in zip(token_sets(texts * 3), texts * 3, strict=True):
        assert got.tolist() == tokens_of(text).tolist()


@pytest.mark.parametrize("bits, hashes", [(1 << 20, 3), (1 << 20, 1), (100_000, 2)])
def test_a_bitmap_has_its_keys_without_a_row_a_bit(spark, bits, hashes):
    keys = spark.range(-500, 500, 7, numPartitions=3).select((F.col("id") * 1_000_003).alias("k"))
    bitmap = Bitmap(keys, bits, hashes)
    own = np.array([r["k"] for r in keys.collect()])
    assert bitmap.has(own).all() and not bitmap.has(own[:0]).any()
    assert np.unpackbits(bitmap.data).sum() <= hashes * len(own)
    assert bitmap.has(np.arange(10**12, 10**12 + 2000)).sum() < 60
