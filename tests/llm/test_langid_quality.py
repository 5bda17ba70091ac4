"""Language ID and quality scores: held-out accuracy and edge cases."""

import numpy as np
from pyspark.sql import functions as F

from sheaf.llm import langid, quality, queries

SF = "/root/testdata/sf0.01"


def test_unseen_words_back_off_to_shorter_grams():
    known = {0: {"the": (0.0, -9.0)}, 5: {}, 4: {}, 3: {"_ab": (-9.0, -1.0)}, 2: {}, 1: {"a": (-1.0, -9.0)}}
    tables = {n: ({g: k for k, g in enumerate(t)}, np.array(list(t.values())).reshape(-1, 2)) for n, t in known.items()}
    m = langid.Model(["en", "fr"], tables)
    assert m.predict("The the!")[0] == "en"
    assert m.predict("abx")[0] == "fr"          # 3-gram before 1-gram
    assert m.predict("zax")[0] == "en"
    assert m.predict("qqq") == ("en", 0.5)      # nothing known: a tie goes to the smaller
    assert m.predict("12 $$ 3.4") == m.predict(None) == m.predict("") == ("und", 0.0)


def test_language_held_out_accuracy(spark):
    got = queries.QUERIES["op2_language_id"](spark, SF).toPandas()
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    held = got.merge(lang, on="doc_id").query("held_out")
    assert len(got) == len(lang) and len(held) > 100 and (held.lang_pred == held.lang).mean() > 0.99
    assert got.score.between(0, 1).all()


def test_language_nulls_clashes_and_empty(spark):
    rows = [(1, "der und die", "de"), (3, "the of and", "en"), (4, "the " * 30000, "en"), (5, None, "en"), (None, "der", None), (6, "123", None), (6, "123", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"score": F.lit("x"), "kept": F.lit(0), "gram": F.lit(1)})
    model = langid.fit(docs)
    got = {(r[0], r[1]): r[2] for r in langid.identify(docs, model, docs.columns).select("kept.doc_id", "kept.text", "lang_pred").collect()}
    assert got[(6, "123")] == got[(5, None)] == "und" and got[(None, "der")] in model.languages
    none = langid.fit(docs.limit(0))
    assert none.languages == [] and {r["lang_pred"] for r in langid.identify(docs, none, ["doc_id"]).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model, ["doc_id"]).count() == 0


def test_quality_ranks_held_out_labels(spark):
    got = queries.QUERIES["op6_quality_classifier"](spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    held = got.merge(labels, on="doc_id").query("held_out")
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert len(got) == 1000 and (good[:, None] > bad[None, :]).mean() > 0.95
    assert (held.predicted == held.quality).mean() > 0.95 and got.score.between(0, 1).all()


def test_quality_density_is_gaussian():
    rng = np.random.default_rng(0)
    size = len(quality.FEATURES)
    mean, spread = rng.normal(size=size), np.cov(rng.normal(size=(size, 60)))
    inverse = np.linalg.inv(np.linalg.cholesky(spread))
    m = quality.Discriminant([mean, mean + 1], [inverse, inverse], [0.0, 0.0])
    x = rng.normal(size=(5, size))
    far = lambda c: np.einsum("ij,jk,ik->i", x - c, np.linalg.inv(spread), x - c)
    assert np.allclose(m.score(x), 1 / (1 + np.exp(np.clip(0.5 * (far(mean + 1) - far(mean)), -60, 60))))


def test_quality_nulls_labels_and_empty(spark):
    rows = [(1, "good text here"), (1, "good text here"), (2, None), (None, ""), (3, "$$$ " * 20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"x": F.lit(1), "label": F.lit(2), "own": F.lit("o")})
    kinds = "doc_id long, quality int"
    none = quality.score_quality(docs, spark.createDataFrame([], kinds), docs.columns)
    assert {r["score"] for r in none.collect()} == {0.5} and none.count() == 5
    labels = spark.createDataFrame([(3, 0), (3, 1), (1, 1), (2, None), (None, 1), (5, 7)], kinds)
    assert {r["score"] for r in quality.score_quality(docs, labels, ["doc_id"]).collect()} == {1.0}
    assert quality.score_quality(docs.limit(0), labels, ["doc_id"]).count() == 0


def test_numerals_are_no_letters():
    assert langid.words_of("½ ² ① Ⅷ 7_8 x²y ʰa ªb") == ["x", "y", "ʰa", "ªb"]
    assert langid.Model(["en"], {0: ({}, np.zeros((0, 1))), **{n: ({}, np.zeros((0, 1))) for n in langid.ORDERS}}).predict("½ ² ①") == ("und", 0.0)


def test_entries_are_pruned_by_their_share_only(spark):
    docs = spark.createDataFrame([(k, f"word{'abcdefgh'[k % 8]} the", "en") for k in range(64)], "doc_id long, text string, lang string")
    assert set(langid.fit(docs).tables[0][0]) == {"the", *(f"word{c}" for c in "abcdefgh")}
    assert set(langid.fit(docs, share=3).tables[0][0]) == {"the"}


def test_labels_between_the_classes_are_skipped(spark):
    docs = spark.createDataFrame([(k, "good words here. " * (k + 1) if k % 2 else "b@d $$$ " * (k + 1)) for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, float(k % 2)) for k in range(60)], "doc_id long, quality double")
    odd = labels.unionByName(spark.createDataFrame([(k, 0.7) for k in range(1, 60, 2)], "doc_id long, quality double"))
    scores = lambda of: sorted((r[0], round(r["score"], 9)) for r in quality.score_quality(docs, of, ["doc_id"]).select("kept.doc_id", "score").collect())
    assert scores(labels) == scores(odd)
    mixed = odd.filter("quality <> 1")                       # of the class 1 only labels of 0.7 are left: one class
    assert {s for _, s in scores(mixed)} == {0.0}
