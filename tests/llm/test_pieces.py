"""Piece encoding against the library."""

import hashlib
import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from tractscope.llm import piece_encode

ODD = [
    None, "", " ", "  ", "   ", "a", " a", "a ", "a  b", "  a  b  ", "▁", "▁▁a▁ ", "a\nb\n", "\n", "\x00",
    "<s></s><unk><0x0A>", "日本語 テキスト", "\u00a0x\u3000", "é" * 50, "🙂 ok", "x" * 20_000, "ab " * 5_000,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_encode.default_model())


def texts():
    r = random.Random(3)
    parts = ["the ", "a", " ", "▁", "ñ", "\n", "  ", "ing", "<s>", "字", "\t", "ü ", "1"]
    return ODD + ["".join(r.choices(parts, k=r.randint(0, 30))) for _ in range(400)]


def frame(spark, made=None):
    rows = [(i, text, "clash") for i, text in enumerate(made or texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def test_encode_and_decode(spark, library):
    encoded = piece_encode.encode(frame(spark)).cache()
    made = texts()
    for row in encoded.collect():
        assert row.ids == library.encode(made[row.doc_id] or "")
    for row in piece_encode.decode(encoded).collect():
        assert row.text == library.decode(library.encode(made[row.doc_id] or ""))
    encoded.unpersist()


def test_round_trip(spark, library, monkeypatch):
    monkeypatch.setattr(piece_encode, "TABLE_BYTES", 2_000)  # the table starts anew often
    monkeypatch.setattr(piece_encode, "GROUP_CHARS", 100)
    made = texts()
    found = piece_encode.round_trip(frame(spark).repartition(3)).collect()
    assert len(found) == len(made)
    for row in found:
        ids = library.encode(made[row.doc_id] or "")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        assert [row.n_tokens, row.ids_sha256, row.decoded_sha256] == [len(ids), *sha]


def test_empty_table_and_null_ids(spark):
    assert piece_encode.round_trip(frame(spark).limit(0)).collect() == []
    docs = frame(spark, ["a b"] * 2).withColumn("doc_id", F.lit(None).cast("long"))
    assert [r.n_tokens for r in piece_encode.round_trip(docs).collect()] == [2, 2]


def test_pieces_that_cross_white_space_are_refused(monkeypatch, spark):
    monkeypatch.setattr(piece_encode, "words_are_independent", lambda proto: False)
    with pytest.raises(ValueError):
        piece_encode.encode(frame(spark))


def test_white_space_is_a_border_of_the_given_model():
    from pathlib import Path

    assert piece_encode.words_are_independent(Path(piece_encode.default_model()).read_bytes())
