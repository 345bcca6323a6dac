"""Language network and additive model: held-out accuracy, folds, and odd texts."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tractscope.llm import folds, language_id, quality_gam

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def net(documents):
    return language_id.train(documents)


@pytest.fixture(scope="module")
def model(spark, documents):
    return quality_gam.train(documents, spark.read.parquet(f"{SF}/labels.parquet"))


def test_folds(spark):
    ids = [0, 1, -5, 123456, None]
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    for row in frame.withColumn("out", folds.held_out(F.col("doc_id"))).collect():
        text = "" if row.doc_id is None else str(row.doc_id)
        assert row.out == (zlib.crc32(text.encode()) % 4 == 2)


def test_language_of_held_out_documents(documents, net):
    found = language_id.identify(documents, net, keep=("doc_id", "lang")).where(
        folds.held_out(F.col("doc_id"))
    )
    rows = found.collect()
    assert len(rows) > 150
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98


def test_labels_of_held_out_documents_change_nothing(documents, net):
    wrong = documents.withColumn(
        "lang", F.when(folds.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))
    )
    again = language_id.train(wrong)
    assert again.languages == net.languages
    assert all(np.array_equal(getattr(again, n), getattr(net, n)) for n in ("embed", "kernel", "out"))


def test_language_of_odd_texts(spark, net):
    rows = [(None,), ("",), ("123 !? \n",), ("the",), ("the and of " * 40_000,), ("日本",), ("x",)]
    frame = spark.createDataFrame(rows, "text string").withColumn("score", F.lit("clash"))
    found = language_id.identify(frame, net, keep=()).collect()
    assert [r.lang_pred == "und" for r in found] == [True] * 3 + [False] * 4
    assert found[4].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in found)
    assert [r.lang_pred for r in language_id.identify(frame.limit(4), None, keep=()).collect()] == ["und"] * 4


def test_windows_cover_whole_texts():
    texts = [bytes(range(65, 91)) * n for n in (0, 1, 9, 10, 11, 60)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    windows, text, size = language_id.windows_of(data, offsets)
    for i, t in enumerate(texts):
        joined = b""
        for w, n in zip(windows[text == i], size[text == i], strict=True):
            piece = bytes(w[:n].astype(np.uint8))
            overlap = min(language_id.WINDOW - language_id.STRIDE, len(joined))
            assert not joined or joined.endswith(piece[:overlap])
            joined += piece[overlap:]
            assert (w[n:] == language_id.PAD).all()
        assert joined == t


def test_a_text_scores_alike_alone_and_in_a_batch(net):
    texts = ["the and of it " * n for n in (1, 30, 2_000, 5)] + ["être dans les " * 100, ""]
    whole = language_id.predict_batch(net, pa.array(texts))
    for i, t in enumerate(texts):
        alone = language_id.predict_batch(net, pa.array([t]))
        assert alone[0][0] == whole[0][i] and alone[1][0] == pytest.approx(whole[1][i], abs=1e-5)


def test_nothing_to_learn_from(spark, documents):
    assert language_id.train(documents.limit(0)) is None
    assert language_id.train(documents.withColumn("lang", F.lit(None).cast("string"))) is None
    one = language_id.train(documents.limit(30).withColumn("lang", F.lit("en")))
    assert one.languages == ["en"]


def test_sample_is_bounded_and_stable(documents):
    chosen = folds.sample_ids(documents, "doc_id", "lang", 20, 1)
    counts = {r.lang: r["count"] for r in chosen.groupBy("lang").count().collect()}
    assert set(counts.values()) == {20}
    again = folds.sample_ids(documents.union(documents).repartition(5), "doc_id", "lang", 20, 1)
    assert sorted(chosen.collect()) == sorted(again.collect())


def test_sample_is_shared_by_many_labels(spark):
    rows = spark.range(40_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 60).cast("string")).alias("lang"),
    )
    counts = dict(folds.sample_ids(rows, "doc_id", "lang", 500, 1, 1000).groupBy("lang").count().collect())
    assert len(counts) == 21 and set(counts.values()) == {1000 // 21}
    with pytest.raises(ValueError, match="more than 20 labels"):
        folds.sample_ids(rows, "doc_id", "lang", 500, 1, 20)
    # The least hashes of each label, as if all were ranked.
    chosen = folds.sample_ids(rows, "doc_id", "lang", 30, 5)
    spots = rows.select("lang", "doc_id", folds.seeded_hash(F.col("doc_id"), 5).alias("spot"))
    wanted = {}
    for lang, doc_id, spot in spots.collect():
        wanted.setdefault(lang, []).append((spot, doc_id))
    wanted = {(doc_id, lang) for lang, found in wanted.items() for _, doc_id in sorted(found)[:30]}
    assert {tuple(row) for row in chosen.collect()} == wanted


def test_quality_of_held_out_documents(spark, documents, model):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = quality_gam.classify(documents, model).join(labels, "doc_id")
    rows = found.where(folds.held_out(F.col("doc_id"))).collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_quality_of_odd_texts(spark, model):
    rows = [(None,), ("",), ("a",), ("word " * 100_000,), ("\n\n",)] * 2
    frame = spark.createDataFrame(rows, "text string").withColumn("features", F.lit("clash"))
    scores = [r.score for r in quality_gam.classify(frame, model, keep=()).collect()]
    assert len(scores) == 10 and all(0 <= s <= 1 for s in scores)
    assert scores[0] == scores[1]


def test_additive_model_learns_an_interaction():
    r = np.random.default_rng(1)
    x = np.zeros((4000, len(quality_gam.FEATURES)))
    x[:, :3] = r.uniform(0, 1, (4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == (y[3000:] == 1)).mean() > 0.9


def test_additive_score_is_the_sum_of_its_tables():
    r = np.random.default_rng(2)
    x = r.normal(size=(500, len(quality_gam.FEATURES)))
    model = quality_gam.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float))
    for row in x[:20]:
        total = model.bias
        for value, edges, table in zip(row, model.edges, model.tables, strict=True):
            total += table[sum(value >= e for e in edges)]
        for a, b, ea, eb, table in model.pairs:
            total += table[sum(row[a] >= e for e in ea), sum(row[b] >= e for e in eb)]
        assert model.score(row[None])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_labels_of_one_kind_or_none(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    none = quality_gam.train(documents, labels.limit(0))
    assert none.score(np.zeros((1, len(quality_gam.FEATURES))))[0] == 0.5
    ones = quality_gam.train(documents, labels.withColumn("quality", F.lit(1)))
    assert ones.score(np.zeros((1, len(quality_gam.FEATURES))))[0] > 0.9
