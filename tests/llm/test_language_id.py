import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from kpiloom.llm.language_id import LanguageConfig, _softmax, _temperature, _train, features, ngram_counts, packed, predict, train, unpacked
from tests.conftest import SF01


def test_counts_cover_the_whole_text_in_blocks(monkeypatch):
    config, text = LanguageConfig(), "abc déf 中文 " * 500
    whole = ngram_counts(text, config)
    assert whole.sum() == sum(len(text) - n + 1 for n in config.orders)
    monkeypatch.setattr("kpiloom.llm.language_id.BLOCK", 100)
    assert (ngram_counts(text, config) == whole).all()
    assert ngram_counts("", config).sum() == 0 and ngram_counts("A", config).sum() == 1


def test_features_have_unit_length():
    at, x = features(ngram_counts("hello", LanguageConfig()), np.ones(1 << 14))
    assert abs((x * x).sum() - 1) < 1e-9 and len(at) == len(x)


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    scores = rng.normal(size=(2000, 3))
    labels = np.array([rng.choice(3, p=p) for p in _softmax(scores / 2)])
    assert 1.6 < _temperature(scores, labels) < 2.5
    assert _temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_elastic_net_makes_weights_sparse(spark, table):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog of", "en"), ("der hund und die katze", "de")] * 30)]
    docs = table(rows, "doc_id long, text string, lang string")
    model = train(docs, LanguageConfig(l1=0.05))
    assert (model.weights == 0).mean() > 0.99
    out = {r.doc_id: r.lang_pred for r in predict(docs, model, carry=(F.col("doc_id"),)).collect()}
    assert all(out[i] == lang for i, _, lang in rows)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = train(docs.where(~held), LanguageConfig(sample=400))
    rows = predict(docs.where(held), model, carry=(F.col("doc_id"), F.col("lang"))).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark, table):
    schema = "doc_id long, text string, lang string, lang_pred int, row string"
    docs = table([(1, "hello there", "en", 1, "x"), (2, None, "en", 1, "x"), (3, "", None, 1, "x"), (4, "123 !?", "en", 1, "x"),
                  (1, "hello there", "en", 1, "x")], schema)
    model = train(docs)
    rows = predict(docs.drop("lang_pred"), model, carry=(F.col("doc_id"), F.col("row").alias("kept_row"))).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in rows) == [(1, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "und")]
    assert {r.score for r in rows if r.lang_pred == "und"} == {0.0}
    none = train(docs.limit(0))
    assert {r.lang_pred for r in predict(docs, none, carry=(F.col("doc_id"),)).collect()} == {"und"}
    assert predict(docs.limit(0), model, carry=(F.col("doc_id"),)).count() == 0


def test_copies_take_no_language_out_of_the_sample(table):
    rows = [(i, "the same text again and again", "en") for i in range(3000)]
    rows += [(3000 + i, f"der hund und die katze {i}", "de") for i in range(400)]
    rows += [(4000 + i, f"el perro y el gato {i}", "es") for i in range(3)]
    docs = table(rows, "doc_id long, text string, lang string")
    model = train(docs, LanguageConfig(sample=30))
    assert model.languages == ("de", "en", "es")
    found = {r.lang: r.lang_pred for r in predict(docs, model, carry=(F.col("lang"),)).distinct().collect()}
    assert found == {"de": "de", "en": "en", "es": "es"}


def test_carried_columns_of_the_same_names_give_way(table):
    docs = table([(1, "hello there", "en", "x")], "doc_id long, text string, lang string, score string")
    out = predict(docs, train(docs), carry=(F.col("doc_id"), F.col("score")))
    assert out.columns == ["doc_id", "lang_pred", "score"] and out.first()["score"] == 1.0


def test_counts_are_packed_and_come_back():
    for text in ("a", "hello hello", "b" * 300, "c" * 70_000, "abc déf 中文 " * 500):
        config = LanguageConfig()
        counts = ngram_counts(text, config)
        buckets, own = packed(counts)
        at, found = unpacked(buckets, own, config)
        assert (at == np.flatnonzero(counts)).all() and (found == counts[at]).all() and found.dtype == np.int64
        assert len(buckets) == 2 * len(at)
    assert [len(x) for x in unpacked(*packed(np.zeros(1 << 14, np.int64)), LanguageConfig())] == [0, 0]


def wide_texts(n, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, "".join(map(chr, rng.integers(0x4E00, 0x9FFF, 8000))), "zh" if i % 2 else "ja") for i in range(n)]
    return rows, "doc_id long, text string, lang string"


def test_the_driver_holds_no_features_of_the_whole_sample(table):
    docs = table(*wide_texts(200)).cache()
    docs.count()
    tracemalloc.start()
    model = train(docs)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.languages == ("ja", "zh")
    assert most < 20e6        # 200 texts of some 12,000 buckets: 32 bytes a bucket were 80 MB


def test_model_is_the_one_of_all_features(table):
    rows, schema = wide_texts(40)
    rows += [(1000 + i, f"der hund und die katze {i % 30}", "de") for i in range(60)]
    docs, config = table(rows, schema), LanguageConfig()
    model = train(docs, config)
    rows = [r for r in docs.select("text", "lang").distinct().select("*", F.xxhash64("text", F.lit(17)).alias("place")).collect()]
    rows.sort(key=lambda r: (r.place, r.lang))
    n = docs.count()
    df = sum((ngram_counts(r.text, config) > 0).astype(int) for r in docs.collect())
    idf = np.log((1 + n) / (1 + df)) + 1
    fit, rest, seen = [], [], {}
    for r in rows:
        seen[r.lang] = seen.get(r.lang, 0) + 1
        (fit if seen[r.lang] % 5 else rest).append((*features(ngram_counts(r.text, config), idf), model.languages.index(r.lang)))
    w, bias = _train(list(range(len(fit))), fit.__getitem__, 3, config)
    assert (model.idf == idf).all() and (model.weights == w).all() and (model.bias == bias).all()
    assert model.temperature == _temperature(np.array([x @ w[at] + bias for at, x, _ in rest]), np.array([e[2] for e in rest]))
