"""Class language model: exact sums against plain Python, exchange against recounting."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import LOWER, WORD
from pyspark.sql import functions as F

from tractscope.llm import class_lm as lm

SCHEMA = "doc_id long, text string"
END = None


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), END]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def made(count, seed=6):
    """Words of two kinds that follow each other in turn, and odd texts."""
    r = random.Random(seed)
    nouns = [f"n{i}" for i in range(40)] + ["Ünd", "日本"]
    verbs = [f"V{i}" for i in range(40)]
    rows = [(None, None), (None, "a b"), (3, ""), (4, " \n\t "), (5, "x" * 9000), (6, "only\x0bonce\x1c")]
    for i in range(count):
        pairs = [r.choice(nouns) + " " + r.choice(verbs) for _ in range(r.randrange(12))]
        rows.append((i, " ".join(pairs + [f"rare{i}"] * (i % 3 == 0))))
    return rows + rows[:9]


def base_scores(rows):
    counts = Counter(t for i, text in rows if not held_out(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        own = tokens(text)
        score = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        known = sum(counts[t] > 0 for t in own)
        out.append((i, held_out(i), len(own), known, n, round(score, 6)))
    return out


def plain(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("sent", [200_000, 30, 0])
def test_base_scores(spark, monkeypatch, sent):
    """Counts sent to the tasks or joined give the same sums."""
    monkeypatch.setattr(lm, "MOST_SENT", sent)
    monkeypatch.setattr(lm, "ROUNDS", 2)
    rows = made(300)
    found = lm.document_scores(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert plain(base_scores(rows)) == plain([(*r[:5], round(r.base_score, 6)) for r in found])


def test_score_is_that_of_the_classes(spark, monkeypatch):
    """The model's classes, with everything else counted again in plain Python."""
    monkeypatch.setattr(lm, "MOST_SENT", 50)
    monkeypatch.setattr(lm, "ROUNDS", 3)
    rows = made(300)
    docs = spark.createDataFrame(rows, SCHEMA)
    training = docs.where(~F.col("doc_id").isin([i for i, _ in rows if held_out(i)]) | F.col("doc_id").isNull())
    kept = [text for i, text in rows if not held_out(i)]
    counts = lm.count_words(training.select("text"))
    model = lm.train(training.select("text"), counts)
    own = pa.array(model.sent[: model.n_own], pa.large_string())
    n_classes = len(model.log_next)

    def class_of(token):
        if token is END:
            return n_classes - 2
        return int(model.unit_class[lm._units(pa.array([token]), own)[0]])

    count = Counter(t for text in kept for t in tokens(text))
    sizes = Counter()
    for t, c in count.items():
        sizes[class_of(t)] += c + 1
    pairs = np.zeros((n_classes, n_classes))
    for text in kept:
        before = n_classes - 1
        for t in tokens(text):
            pairs[before, class_of(t)] += 1
            before = class_of(t)
    share = (pairs.sum(0) + 1) / (pairs.sum() + n_classes - 1)
    follow = (pairs + lm.SHARE * share) / (pairs.sum(1, keepdims=True) + lm.SHARE)
    follow[:, -1] = 0
    follow /= follow.sum(1, keepdims=True)

    def score(text):
        total, before = 0.0, n_classes - 1
        for t in tokens(text):
            own_class = class_of(t)
            total += math.log10(follow[before, own_class])
            if t is not END:
                total += math.log10((count[t] + 1) / (sizes[own_class] + 1))
            before = own_class
        return total

    found = lm.score(docs, counts, model, keep=("doc_id", "text")).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.score == pytest.approx(score(row.text), abs=1e-6)


def test_probabilities_sum_to_one(spark):
    """Over all known words, one unknown word of each class, and the end."""
    docs = spark.createDataFrame([(t,) for _, t in made(100)], "text string")
    counts = lm.count_words(docs)
    model = lm.train(docs, counts)
    assert np.allclose((10.0**model.log_next).sum(1), 1)
    own = pa.array(model.sent[: model.n_own], pa.large_string())
    sums = np.zeros(len(model.log_next))
    for row in counts.words.collect():
        at = model.unit_class[lm._units(pa.array([row.word]), own)[0]]
        sums[at] += (row.c + 1) / 10 ** model.log_sizes[at]
    sums += 10.0**-model.log_sizes
    assert np.allclose(sums, 1)


def test_best_class_equals_recounting():
    r = np.random.default_rng(2)
    n_units, n_classes = 30, 7
    bigrams = r.integers(0, 4, (n_units, n_units)) * r.integers(0, 2, (n_units, n_units))
    classes = r.integers(0, n_classes - 2, n_units)
    classes[-2:] = n_classes - 2, n_classes - 1

    def pairs(of):
        out = np.zeros((n_classes, n_classes))
        np.add.at(out, (of[:, None].repeat(n_units, 1), of[None, :].repeat(n_units, 0)), bigrams)
        return out

    for unit in range(n_units - 2):
        after = np.bincount(classes, bigrams[unit], n_classes)
        before = np.bincount(classes, bigrams[:, unit], n_classes)
        to, gain = lm.best_class(pairs(classes), classes[unit], after, before, bigrams[unit, unit])
        values = []
        for c in range(n_classes - 2):
            moved = classes.copy()
            moved[unit] = c
            values.append(lm.likelihood(pairs(moved)))
        assert values[to] == pytest.approx(max(values))
        assert gain == pytest.approx(max(values) - values[classes[unit]])


def test_exchange_finds_the_two_kinds(spark):
    rows = made(1500)
    docs = spark.createDataFrame([(t,) for _, t in rows], "text string")
    counts = lm.count_words(docs)
    model = lm.train(docs, counts)
    classes = dict(zip(model.sent, model.unit_class.tolist(), strict=False))
    nouns = {classes[w] for w in classes if w.startswith("n") and w[1:].isdigit()}
    verbs = {classes[w] for w in classes if w.startswith("v") and w[1:].isdigit()}
    assert nouns and verbs and not nouns & verbs


def test_held_out_texts_are_likelier_than_by_single_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = lm.document_scores(docs).where("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")
    ).first()
    assert found.s / found.n > found.b / found.n + 0.1


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "")], [(1, "a a")], [(8, "q")]])
def test_little_or_nothing(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("word", "row_no", "kept_0", "n_known", "c", "score", "lang"):
        docs = docs.withColumn(name, F.lit("x"))
    found = lm.document_scores(docs).collect()
    assert plain(base_scores(rows)) == plain([(*r[:5], round(r.base_score, 6)) for r in found])
    assert all(math.isfinite(r.score) and r.score <= 0 for r in found)


def test_nothing_to_learn_from(spark):
    only = [i for i in range(100) if held_out(i)][:3]
    rows = [(i, "a b") for i in only]
    found = lm.document_scores(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found] == [(3, 0, 0, 0.0)] * 3
    assert all(math.isfinite(r.score) for r in found)
