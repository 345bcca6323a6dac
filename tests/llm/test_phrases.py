"""Phrases and their scores against counting in plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tractscope.llm import phrase_mining as pm, words as text_words

SCHEMA = "doc_id long, lang string, text string"
LOWER = {c: c + 32 for c in range(65, 91)}


def pieces(text):
    split = re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER))
    return [re.findall("[^ \t]+", piece) for piece in split]


def counts(rows):
    f = defaultdict(Counter)
    for _, lang, text in rows:
        for w in pieces(text):
            for m in range(1, 6):
                f[lang or "und"].update(tuple(w[k : k + m]) for k in range(len(w) - m + 1))
    return f


def inside(short, long):
    return any(long[k : k + len(short)] == short for k in range(len(long) - len(short) + 1))


def mined(rows, least, most):
    out = []
    for lang, f in counts(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        kept = []
        for p, a in found.items():
            if any(len(q) > len(p) and c >= a and inside(p, q) for q, c in found.items()):
                continue
            cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return out


def made(count, seed=3):
    r = random.Random(seed)
    vocabulary = ["the", "The", "new", "york", "ünd", "a.", "b,", "日本", "!", "x\n", "\t", "", "z\x0bq"]
    rows = [(None, None, None), (1, "de", ""), (1, "de", " ,. \r\n"), (2, "und", "the new york")]
    for i in range(count):
        text = " ".join(r.choices(vocabulary, k=r.randint(0, 60)))
        rows.append((r.choice([None, i]), r.choice([None, "en", "en", "de", "und"]), text))
    rows.append((9, "en", "new york times " * 5000))
    return rows + rows[:20]


@pytest.mark.parametrize("least, most", [(3, 2000), (40, 7)])
def test_equal_to_counting(spark, least, most):
    rows = made(400)
    found = pm.mine(spark.createDataFrame(rows, SCHEMA).repartition(3), least, most)
    assert sorted(map(tuple, found.collect())) == sorted(mined(rows, least, most))


def test_merged_in_small_parts(spark, monkeypatch):
    """Slices of a few texts and merges after a few rows change nothing."""
    rows = made(150, 8)
    monkeypatch.setattr(pm, "SLICE_BYTES", 200)
    monkeypatch.setattr(pm, "MERGE_ROWS", 50)
    found = pm.mine(spark.createDataFrame(rows, SCHEMA), 3, 100)
    assert sorted(map(tuple, found.collect())) == sorted(mined(rows, 3, 100))


def test_full_bit_tables_change_no_count(spark, monkeypatch):
    """With one bit for hundreds of hashes everything is let through, and counts stay."""
    rows = made(150, 9)
    monkeypatch.setattr(pm, "LEAST_BITS", 3)
    monkeypatch.setattr(pm, "MOST_BITS", 3)
    found = pm.mine(spark.createDataFrame(rows, SCHEMA), 3, 100)
    assert sorted(map(tuple, found.collect())) == sorted(mined(rows, 3, 100))


@pytest.mark.parametrize("bits", [0, 3])
def test_equal_fingerprints_of_different_phrases(spark, monkeypatch, bits):
    """Fingerprints of the same size collide; the phrases are still told apart."""
    rows = made(150, 10)
    whole = pm._both

    def poor(hashes, size, at, powers):
        found, second = whole(hashes, size, at, powers)
        return found >> np.uint64(64 - bits) if bits else found * np.uint64(0), second

    monkeypatch.setattr(pm, "_both", poor)
    monkeypatch.setattr(pm, "frequent_bits", lambda hashes: (3, b"\xff" * 4096))
    found = pm.mine(spark.createDataFrame(rows, SCHEMA), 3, 100)
    assert sorted(map(tuple, found.collect())) == sorted(mined(rows, 3, 100))


def test_pointers_by_shuffle(spark, monkeypatch):
    rows = made(150, 11)
    monkeypatch.setattr(pm, "BROADCAST_POINTERS", 0)
    found = pm.mine(spark.createDataFrame(rows, SCHEMA), 3, 100)
    assert sorted(map(tuple, found.collect())) == sorted(mined(rows, 3, 100))


def test_pointers_name_a_document(spark):
    rows = [(4, "en", "a b c"), (3, "en", "x, a b"), (None, "en", "a b"), (2, "de", "a b")]
    phrases, _ = pm.frequent_phrases(spark.createDataFrame(rows, SCHEMA), 3)
    found = phrases.where("n_words = 2").select("lang", "phrase", "f", "doc_key").collect()
    assert [tuple(r)[:3] for r in found] == [("en", "a b", 3)] and found[0].doc_key <= 3


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "en", "alone")]])
def test_nothing_to_find(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("phrase", "f", "rank", "word", "place", "fingerprint"):
        docs = docs.withColumn(name, F.lit("x"))
    assert pm.mine(docs, 1, 10).collect() == []


def test_fingerprints_depend_on_words_only():
    data, offsets = text_words.text_bytes(pa.array(["New  york\ttimes", "x the new York times y"]))
    w = pm.PieceWords(data, offsets, 0, 2, text_words.Powers())
    found = pm.fingerprints(w.hash, 3, text_words.Powers())
    assert found[0] == found[5] and len(set(found.tolist())) == len(found) - 1
    assert w.text.tolist() == [0] * 3 + [1] * 6
