import numpy as np
from pyspark.sql import functions as F


from txrisk.llm.common import id_remainder, prepare
from txrisk.llm.language_id import GRAM_BITS, KernelModel, fit_languages, gram_set, identify


def test_held_out_accuracy(spark):
    docs = prepare(spark).read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_languages(docs, id_remainder("doc_id", 4) != 2, per_language=64, landmarks_per_language=16)
    rows = identify(docs, model).where(id_remainder("doc_id", 4) == 2).select("lang", "lang_pred", "score").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_sample_is_bounded_and_leaves_held_out_rows_alone(spark, sf_docs):
    from txrisk.llm.language_id import training_sample

    prepare(spark)
    drawn = training_sample(sf_docs, id_remainder("doc_id", 4) != 2, 8)
    assert drawn.groupBy("lang").count().where("count > 8").count() == 0
    assert drawn.where(id_remainder("doc_id", 4) == 2).count() == 0


def test_gram_set_by_definition():
    seen = np.zeros(1 << GRAM_BITS, dtype=bool)
    a, b = gram_set("Ab  cd, 12 ab", seen), gram_set("ab cd ab", seen)
    assert (a == b).all() and not seen.any()
    grams = {f" ab cd ab "[i : i + n] for n in (1, 2, 3) for i in range(11 - n)}
    assert len(a) == len(grams)
    assert len(gram_set("123 .", seen)) == 0


def test_a_long_text_in_slices(monkeypatch):
    from txrisk.llm import language_id

    seen = np.zeros(1 << GRAM_BITS, dtype=bool)
    text = "some words of a text that goes on " * 50
    whole = gram_set(text, seen)
    monkeypatch.setattr(language_id, "SLICE", 7)
    assert (gram_set(text, seen) == whole).all()


def test_kernel_by_definition():
    sets = [np.array(x, dtype=np.int32) for x in ([1, 2, 3], [2, 3, 4, 5], [9], [])]
    model = KernelModel(["a"], sets[:2], np.ones((2, 1)))
    expected = [[1, 2 / 12**0.5], [2 / 12**0.5, 1], [0, 0], [0, 0]]
    assert np.allclose(model.kernel(sets), expected, atol=1e-6)


def test_odd_documents(spark, odd_docs, no_docs):
    prepare(spark)
    model = fit_languages(odd_docs, id_remainder("doc_id", 4) != 2)
    rows = identify(odd_docs, model, "_x_").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r._x_lang_pred == "und") == (not letters)
        assert r._x_lang_pred in {"und", *model.languages}
    assert identify(no_docs, model, "_x_").count() == 0
    nothing = fit_languages(no_docs, id_remainder("doc_id", 4) != 2)
    assert {r._x_lang_pred for r in identify(odd_docs, nothing, "_x_").collect()} == {"und"}


def test_repeated_ids_do_not_outgrow_the_sample(spark):
    from txrisk.llm.language_id import training_sample

    rows = [(7, f"text {i}", lang) for i in range(300) for lang in ("en", "fr")] + [(i, "a b", "en") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = [tuple(r) for r in training_sample(df, F.lit(True), 4).collect()]
    assert len([r for r in drawn if r[1] == "en"]) == 4 and len([r for r in drawn if r[1] == "fr"]) == 1
    again = training_sample(df.repartition(3).orderBy("text"), F.lit(True), 4).collect()
    assert sorted(drawn) == sorted(map(tuple, again))
