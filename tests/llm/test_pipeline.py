"""Every stage of the pipeline against plain Python, and the registered SQL."""

import hashlib

import pytest
import sentencepiece
from brute import jaccard, measures, mix as plain_mix
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline as pipeline
from compare import compare, connect
from tractscope.llm import language_id, piece_encode, quality_rules
from tractscope.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    assert compare(result, connect(SF_DIR), ORACLE[name]) is None


def test_ten_queries_and_the_pipeline_are_registered():
    names = entry_module.queries()
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 11))
    assert names["pipeline"] is pipeline.run


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def odd(spark, documents):
    """Documents with nulls, empty and repeated rows."""
    extra = [(None, None, None, None, None), (10**6, "", "en", None, 0), (10**6 + 1, "12 34", "en", "s", 5)]
    frame = spark.createDataFrame(extra, documents.schema)
    return documents.limit(60).union(documents.limit(3)).union(frame)


def test_language_stage(spark, documents):
    docs = odd(spark, documents)
    net = language_id.train(docs)
    found = language_id.identify(docs, net, keep=tuple(docs.columns)).collect()
    wanted = [tuple(r)[:5] for r in found if r.lang_pred != "und" and r.score >= 0.4]
    assert rows(pipeline.known_language(spark, docs, SF_DIR)) == sorted(wanted, key=repr)
    assert len(wanted) == 63


def test_language_stage_with_many_close_languages(spark, documents):
    """No language of six stands out, in all of one kind of text."""
    english = documents.where("lang = 'en'").limit(120)
    docs = english.withColumn("lang", F.concat(F.lit("en-"), (F.col("doc_id") % 6).cast("string")))
    net = language_id.train(docs)
    found = language_id.identify(docs, net, keep=("doc_id",))
    assert found.where((F.col("score") < 0.4) & (F.col("lang_pred") != "und")).count() > 0
    letters = docs.where(F.col("text").rlike(r"\p{L}"))
    assert rows(pipeline.known_language(spark, docs, SF_DIR)) == rows(letters)


def test_language_stage_fills_and_corrects(spark, documents):
    """What the network says decides the language of documents without one, or a wrong one."""
    clean = documents.where(F.length("text") > 400).limit(120)
    docs = clean.withColumn(
        "lang",
        F.when(F.col("doc_id") % 5 == 0, F.lit(None).cast("string"))
        .when(F.col("doc_id") % 23 == 1, F.when(F.col("lang") == "en", "fr").otherwise("en"))
        .otherwise(F.col("lang")),
    )
    true = {r.doc_id: r.lang for r in clean.collect()}
    given = {r.doc_id: r.lang for r in docs.collect()}
    found = {r.doc_id: r.lang for r in pipeline.known_language(spark, docs, SF_DIR).collect()}
    assert found.keys() == true.keys()
    filled = [i for i in true if given[i] is None]
    assert len(filled) > 15 and sum(found[i] == true[i] for i in filled) > 0.95 * len(filled)
    assert all(found[i] == true[i] for i in true if given[i] == true[i])
    wrong = [i for i in true if given[i] not in (None, true[i])]
    assert any(found[i] == true[i] for i in wrong)
    # Other labels to learn from give other languages.
    wrong = docs.withColumn("lang", F.when(F.col("lang").isNotNull(), "zz"))
    assert {r.lang for r in pipeline.known_language(spark, wrong, SF_DIR).collect()} == {"zz"}


def test_language_stage_with_wanted_languages(spark, documents):
    docs = documents.limit(150)
    net = language_id.train(docs)
    said = {r.doc_id: r.lang_pred for r in language_id.identify(docs, net, keep=("doc_id",)).collect()}
    found = pipeline.known_language(spark, docs, SF_DIR, frozenset(["de", "fr"])).collect()
    assert {r.doc_id for r in found} == {i for i, lang in said.items() if lang in ("de", "fr")}
    assert 0 < len(found) < len(said)


def test_language_stage_without_labels(spark, documents):
    docs = documents.limit(30).withColumn("lang", F.lit(None).cast("string"))
    assert language_id.train(docs) is None
    assert rows(pipeline.known_language(spark, docs, SF_DIR)) == rows(docs)


def test_rule_stage(spark, documents):
    docs = odd(spark, documents)

    def passes(text):
        m = measures(text)
        return not any(eval(r.fails.replace(" OR ", " or "), {}, m) for r in quality_rules.RULES)

    wanted = [tuple(r) for r in docs.collect() if passes(r.text)]
    assert rows(pipeline.good_quality(spark, docs, SF_DIR)) == sorted(wanted, key=repr)


def test_near_duplicate_stage(spark, documents):
    docs = odd(spark, documents)
    all_rows = sorted(docs.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    groups = jaccard([r.text for r in all_rows])
    wanted = [tuple(r) for i, r in enumerate(all_rows) if groups[i][1] == i]
    assert rows(pipeline.one_of_each_group(spark, docs, SF_DIR)) == sorted(wanted, key=repr)


def test_mix_stage(spark, documents):
    docs = odd(spark, documents)
    found = docs.collect()
    plain = plain_mix(
        [(r.doc_id, r.source, measures(r.text)["n_words"]) for r in found], pipeline.MIX_SEED
    )
    wanted = sorted(
        (i, source) for i, source, _, _, repeats in plain for _ in range(repeats) if i is not None
    )
    got = pipeline.mixed_sources(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.source) for r in got.collect() if r.doc_id is not None) == wanted


def test_piece_stage(spark, documents):
    docs = odd(spark, documents)
    library = sentencepiece.SentencePieceProcessor(model_file=piece_encode.default_model())
    wanted = []
    for r in docs.collect():
        ids = library.encode(r.text or "")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        wanted.append((r.doc_id, r.lang, r.source, len(ids), *sha))
    assert rows(pipeline.pieces(spark, docs, SF_DIR)) == sorted(wanted, key=repr)


def test_whole_pipeline(spark, documents):
    result = pipeline.run(spark, SF_DIR)
    kept = result.select("doc_id").distinct()
    assert 0 < kept.count() < documents.count()
    assert kept.join(documents, "doc_id", "left_anti").count() == 0


def test_stages_of_an_empty_table(spark, documents):
    docs = documents.limit(0)
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0, name


def test_stages_keep_the_columns(spark, documents):
    docs = documents.limit(20).withColumn("n", F.lit(1)).withColumn("row", F.lit(2))
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
