"""Words, windows and lines as arrays, and the rule ledger, against plain Python."""

import random

import pyarrow as pa
import pytest
from brute import measures
from pyspark.sql import functions as F

from tractscope.llm import quality_rules, words

ODD = [
    None, "", " ", "\n\n", "a", " a ", "one two three four five one two three four five",
    "a b c d e f\na b c d e f\n\na b c d e f", "x\r\nx\r\nx", "ÄÖ ÄÖ\x0bÄÖ\x0cÄÖ\x1cé",
    "# * $ % & | < >", "HELLO!! WORLD!!", "\ta\t\nb\n", "same\nsame \nsame", "日本 語\u3000文",
]


def texts(count=300, seed=4):
    r = random.Random(seed)
    vocabulary = ["the", "a", "is", "Ünd", "#", "x!", "\n", "\n\n", " ", "", "日本", "\t", "A"]
    made = [" ".join(r.choices(vocabulary, k=r.randint(0, 60))) for _ in range(count)]
    return ODD + made + ["long " * 50_000 + "end", "w" * 300_000]


def test_measures_equal_plain_python():
    column = pa.array(texts())
    powers = words.Powers()
    found = {name: [] for name in quality_rules.MEASURES}
    for at, s in words.text_slices(column, powers):
        assert at == len(found["n_words"])
        for name, values in quality_rules.measure_slice(s).items():
            found[name] += values.tolist()
    rows = [dict(zip(found, row, strict=True)) for row in zip(*found.values(), strict=True)]
    assert rows == [measures(text) for text in texts()]


def test_slices_of_a_sliced_column():
    column = pa.array(["skipped words", "a b", None, "c"])[1:]
    counts = [s.n_words.tolist() for _, s in words.text_slices(column, words.Powers())]
    assert sum(counts, []) == [2, 0, 1]


def frame(spark, made):
    return spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")


def test_ledger(spark):
    made = texts(40)
    rows = quality_rules.ledger(frame(spark, made)).collect()
    assert len(rows) == len(made)
    for row in rows:
        m = measures(made[row.doc_id])
        assert {name: row[name] for name in quality_rules.MEASURES} == m
        bits = 0
        for rule in quality_rules.RULES:
            fails = rule.fails.replace(" OR ", " or ")
            bits |= bool(eval(fails, {}, m)) << rule.bit
        assert row.failed_rules == bits


def test_policies_and_ablation(spark):
    made = texts(60)
    rows = quality_rules.ledger(frame(spark, made)).cache()
    bits = [row.failed_rules for row in rows.collect()]
    mask = quality_rules.policy_mask("web-1")
    kept = rows.where(quality_rules.passes("web-1")).count()
    assert kept == sum(b & mask == 0 for b in bits)
    found = {row.rule: row for row in quality_rules.ablation(rows, "web-1").collect()}
    for rule in quality_rules.RULES:
        bit = 1 << rule.bit
        row = found.get(rule.name)
        assert row is None or row.failed == sum(b & bit != 0 for b in bits)
        assert row is None or row.failed_alone == sum(b & mask == bit for b in bits)
        assert row is None or row.kept_without == sum(b & mask & ~bit == 0 for b in bits)
    assert len(found) == len(quality_rules.RULES)
    rows.unpersist()


def test_bits_are_unique():
    bits = [rule.bit for rule in quality_rules.RULES]
    assert len(set(bits)) == len(bits)


def test_kept_documents_keep_their_columns(spark):
    clean = "this is a clean line of ordinary prose with enough words in it"
    schema = "failed_rules string, n_words int, text string, doc_id long"
    docs = spark.createDataFrame([("a", 1, clean, 1), (None, None, None, None), ("b", 2, "# #", 2)], schema)
    assert [tuple(r) for r in quality_rules.keep_documents(docs).collect()] == [("a", 1, clean, 1)]
    assert quality_rules.keep_documents(docs.limit(0)).collect() == []


@pytest.mark.parametrize("empty", [True, False])
def test_empty_and_repeated(spark, empty):
    docs = frame(spark, ["a b c"] * 3).withColumn("doc_id", F.lit(None).cast("long"))
    rows = quality_rules.ledger(docs.limit(0) if empty else docs).collect()
    assert [r.n_words for r in rows] == ([] if empty else [3, 3, 3])


def test_a_kept_text_is_sent_once_and_comes_back(spark):
    rows = [(1, "a b c", 5), (2, None, None), (3, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n int")
    source, place = words.kept_and_text(docs, ("text", "n"), "text")
    assert (source.columns, place) == (["text", "n"], 0)
    source, place = words.kept_and_text(docs, ("doc_id",), "n")
    assert (source.dtypes[place][1], place) == ("string", 1)
    kept = quality_rules.measure(docs, "text", ("text", "doc_id")).collect()
    assert {(r.doc_id, r.text, r.n_words) for r in kept} == {(1, "a b c", 3), (2, None, 0), (3, "", 0)}
    alone = quality_rules.measure(docs, "n", ("doc_id",)).collect()
    assert {(r.doc_id, r.n_words) for r in alone} == {(1, 1), (2, 0), (3, 1)}
