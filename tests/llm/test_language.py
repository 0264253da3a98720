import zlib

import numpy as np

from trendmill.llm import language


def test_families_join_alike_languages():
    rng = np.random.default_rng(1)
    romance, germanic = rng.normal(size=(2, 50)) * 3
    rows, names = [], []
    for name, family in (("es", romance), ("fr", romance), ("de", germanic), ("en", germanic)):
        own = family + rng.normal(size=50)
        rows += list(own + rng.normal(size=(20, 50)) * 0.1)
        names += [name] * 20
    found = language.families_of(np.array(rows, np.float32), np.array(names, object))
    assert sorted(found) == [["de", "en"], ["es", "fr"]]


def test_features_are_of_length_one_and_ignore_other_characters():
    one = language.features(language.letters("Hello, World!!"))
    assert np.isclose(np.linalg.norm(one), 1)
    assert (one == language.features(language.letters("hello *** world 123"))).all()
    assert np.isfinite(language.features(language.letters(""))).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(docs, language.train(docs))
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.train(docs)
    rows = language.identify(odd, model).collect()
    assert len(rows) == odd.count()
    assert all(r["lang_pred"] == "und" for r in rows if r["doc_id"] in (2, 3, 6))
    assert all(r["lang_pred"] != "und" for r in rows if r["doc_id"] in (1, 5))
    assert language.train(none) is None
    assert {r["lang_pred"] for r in language.identify(odd, None).collect()} == {"und"}
    assert language.identify(none, model).count() == 0
    assert language.train(docs.where("lang = 'en'")).families == [["en"]]
