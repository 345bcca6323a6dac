"""The query functions that have no SQL, run by name over whole tables."""

import hashlib
import zlib
from collections import Counter

import pytest
import sentencepiece
from brute import words
from test_class_lm import base_scores
from test_pages import fitting, split

import __spark_entry__ as entry_module
from tractscope.llm import piece_encode
from tractscope.llm.queries import ORACLE, QUERIES, URL_RULES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return {
        name: spark.read.parquet(f"{SF_DIR}/{name}.parquet").collect()
        for name in ("documents", "pages", "labels")
    }


def found(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


def is_held_out(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds == 2


def test_all_thirteen_are_registered():
    names = entry_module.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert {"op11_merkle_manifest", "op12_phrase_collocations"} <= set(ORACLE)


def test_op1(spark, tables):
    urls = {r.page_id: r.url for r in tables["pages"]}
    rows = found(spark, "op1_url_filter")
    assert sorted(r.page_id for r in rows) == sorted(urls)
    for r in rows:
        assert (r.host, r.path) == split(urls[r.page_id])
        assert r.rule == fitting(r.host, r.path)
        assert r.verdict == (URL_RULES[r.rule] if r.rule else "block" if r.score >= 0.5 else "allow")


def test_op3(spark, tables):
    rows = {r.page_id: r for r in found(spark, "op3_html_extract")}
    assert rows.keys() == {r.page_id for r in tables["pages"]}
    for page in tables["pages"]:
        row = rows[page.page_id]
        assert row.url == page.url and row.n_chars == len(row.text)
        assert "<script" not in row.text and "\n\n" not in row.text and row.text == row.text.strip()


def test_op5(spark, tables):
    """Shares, slots and digests counted by hand; the order is a permutation of the rows."""
    texts = {r.doc_id: r.text or "" for r in tables["documents"]}
    rows = found(spark, "op5_feistel_shards")
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "rows")
        assert r.grown_shard is None
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    assert all({r.slot for r in rows if r.shard == s} == set(range(n)) for s, n in counts.items())
    assert sorted(r.row_number for r in rows) == list(range(len(rows)))
    neighbours = sum(a.shard == b.shard for a, b in zip(rows, rows[1:], strict=False))
    assert neighbours < len(rows) / 2


def test_op6(spark, tables):
    langs = {r.doc_id: r for r in tables["documents"]}
    rows = found(spark, "op6_language_id")
    assert sorted(r.doc_id for r in rows) == sorted(langs)
    assert all(r.held_out == is_held_out(r.doc_id, 4) and 0 <= r.score <= 1 for r in rows)
    judged = [r for r in rows if r.held_out and any(c.isalpha() for c in langs[r.doc_id].text or "")]
    assert sum(r.lang_pred == langs[r.doc_id].lang for r in judged) > 0.95 * len(judged)


def test_op7(spark, tables):
    quality = {r.doc_id: r.quality for r in tables["labels"]}
    rows = found(spark, "op7_quality_gam")
    assert len(rows) == len(tables["documents"])
    assert all(r.held_out == is_held_out(r.doc_id, 4) for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    judged = [r for r in rows if r.held_out and r.doc_id in quality]
    assert sum(r.predicted == quality[r.doc_id] for r in judged) >= 0.9 * len(judged)


def test_op9(spark, tables):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_encode.default_model())
    wanted = set()
    for doc in tables["documents"]:
        ids = library.encode(doc.text or "")
        shas = [hashlib.sha256(t.encode()).hexdigest() for t in (",".join(map(str, ids)), library.decode(ids))]
        wanted.add((doc.doc_id, len(ids), *shas))
    rows = found(spark, "op9_piece_round_trip")
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == wanted


def test_op13(spark, tables):
    rows = found(spark, "op13_class_lm")
    plain = base_scores([(r.doc_id, r.text) for r in tables["documents"]])
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in rows]
    assert sorted(got) == sorted(p[:5] for p in plain)
    base = {p[0]: p[5] for p in plain}
    assert all(r.base_score == pytest.approx(base[r.doc_id], abs=1e-5) for r in rows)
    assert all(r.score < 0 and r.n_tokens == 1 + len(words(text)) for r, text in (
        (r, {d.doc_id: d.text for d in tables["documents"]}[r.doc_id]) for r in rows[:20]
    ))
