"""Phrase collocations by Rabin-Karp fingerprints of n-grams.

Texts fall into pieces at punctuation and line ends, pieces into words. Prefix polynomials
over the words' hashes give the fingerprint of every n-gram by one subtraction and one
product. Fingerprints are counted by a shuffle, each with a pointer to a document that holds
it. Only of those found often enough is the text looked up, by a join of the pointers with
the documents, and checked: the words there must give the fingerprint again.

A second polynomial gives every n-gram 32 bits more. Two phrases that share a fingerprint
differ in these, are counted apart, and each gets the text at its own pointer. Phrases of one
language that share all 96 bits would be counted as one.

A phrase is found at least as often as the phrases around it, so an n-gram is sent to the
shuffle only if the words, and for more than two words the pairs, that it consists of may be
frequent. What is frequent is a table of bits by hash, at most ``MOST_BITS``: hashes that
share their bits let more through, and change no count.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tractscope.llm.words import (
    BASE, BASE_INVERSE, BYTE_VALUES, LOWER_VALUES, Powers, mixed, slices, text_bytes, tidy,
)
from tractscope.session import write_once

MOST_WORDS = 5
UNKNOWN = "und"
# Bytes of text worked on at once, and rows after which a task's counts are merged; both
# bound memory and change no result.
SLICE_BYTES = 1 << 20
MERGE_ROWS = 3 << 19
# Bits of a table of frequent hashes: so many for each, at most 2^28 (32 MB) in all, and how
# many of them a hash sets.
BITS_EACH, LEAST_BITS, MOST_BITS, PROBES = 24, 15, 28, 3
# Up to so many frequent phrases, the pointers (about 20 bytes each) go to the documents;
# beyond, both are shuffled.
BROADCAST_POINTERS = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09]] = True
_END = np.zeros(256, bool)
_END[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class PieceWords:
    """Words of a slice of texts, A-Z lower-cased.

    ``piece`` numbers the pieces (equal for words of one piece only), ``text`` the texts;
    ``hash`` is of the word alone.
    """

    def __init__(self, data, offsets, at, to, powers):
        start, end = offsets[at:to] - offsets[at], offsets[at + 1 : to + 1] - offsets[at]
        self.bytes = data[offsets[at] : offsets[to]]
        n = len(self.bytes)
        up, down = powers.upto(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(LOWER_VALUES[self.bytes] * up[:n], out=sums[1:])
        ends = _END[self.bytes]
        self.inside = ~(_SPACE[self.bytes] | ends)
        edge = np.zeros(n + 1, bool)
        edge[start] = edge[end] = True
        inside = np.r_[False, self.inside, False]
        self.begin = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
        self.end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
        self.hash = mixed((sums[self.end] - sums[self.begin]) * down[self.begin])
        first = np.searchsorted(self.begin, np.r_[start, n])
        self.text = np.repeat(np.arange(to - at), np.diff(first))
        self.piece = np.cumsum(ends)[self.begin] + self.text if n else self.text

    def words(self) -> pa.DictionaryArray:
        """The words themselves; equal indices are equal words."""
        offsets = np.r_[0, np.cumsum(self.end - self.begin)].astype(np.int64)
        letters = _LOWER[self.bytes[self.inside]]
        words = pa.LargeStringArray.from_buffers(
            len(self.begin), pa.py_buffer(offsets), pa.py_buffer(letters)
        )
        return words.dictionary_encode()


def fingerprints(word_hash, size, powers):
    """Fingerprint of the ``size`` words from each word on, by prefix polynomials."""
    n = len(word_hash)
    up, down = powers.upto(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(word_hash * up[:n], out=sums[1:])
    return mixed((sums[size:] - sums[: n - size + 1]) * down[: n - size + 1], 1) + np.uint64(size)


def text_hash(text: str) -> np.uint64:
    """Hash of a short text by itself."""
    h = 0
    for byte in reversed(text.encode()):
        h = (h * BASE + int(BYTE_VALUES[byte])) % (1 << 64)
    return mixed(np.array([h], np.uint64), 2)[0]


class Bits:
    """A table of bits: whether a hash may be among those put in."""

    def __init__(self, exponent, data: bytes):
        self.exponent, self.data = exponent, np.frombuffer(data, np.uint8)

    def holds(self, hashes):
        out = np.ones(len(hashes), bool)
        mask = np.uint64((1 << self.exponent) - 1)
        for shift in _shifts(self.exponent):
            at = (hashes >> np.uint64(shift)) & mask
            byte = self.data[(at >> np.uint64(3)).astype(np.int64)]
            out &= (byte >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def _shifts(exponent):
    """Where the parts of a hash begin that name its bits."""
    return [(64 - exponent) * i // (PROBES - 1) for i in range(PROBES)]


def frequent_bits(hashes: DataFrame) -> tuple[int, bytes]:
    """Exponent and bytes of the table of the hashes (column ``fingerprint``, long).

    The bits are set by an aggregation in Spark. What comes to the driver is the table, whose
    size is bounded whatever the number of hashes.
    """
    count = hashes.count()
    exponent = math.ceil(math.log2(max(1, count * BITS_EACH)))
    exponent = min(max(exponent, LEAST_BITS), MOST_BITS)
    mask = F.lit((1 << exponent) - 1).cast("long")
    parts = [F.shiftrightunsigned("fingerprint", s).bitwiseAND(mask) + 1 for s in _shifts(exponent)]
    at = hashes.select(F.explode(F.array(*parts)).alias("at"))
    found = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")
    )
    table = bytearray(max(1 << exponent, 1 << 15) // 8)
    for row in found.collect():
        begin = (row.bucket - 1) * 4096
        table[begin : begin + 4096] = row.bits
    return exponent, bytes(table)


def _merged(tables, keys, merges):
    """Rows with equal keys as one; ``merges`` (column, how) of the others."""
    table = pa.concat_tables(tables)
    out = table.group_by(keys).aggregate(merges)
    names = {f"{c}_{how}": c for c, how in merges}
    out = out.rename_columns([names.get(c, c) for c in out.column_names])
    return out.select(table.column_names)


def _map_slices(docs, schema, rows_of, keys, merges):
    """``rows_of(words, batch, powers)`` over all slices of the documents, merged by ``keys``
    in each task. ``batch`` holds the columns of the slice's documents, the text last."""

    def run(batches):
        powers, held, size = Powers(), [], 0
        for batch in batches:
            data, offsets = text_bytes(batch.columns[-1])
            for at, to in slices(offsets, SLICE_BYTES):
                words = PieceWords(data, offsets, at, to, powers)
                for table in rows_of(words, batch.slice(at, to - at), powers):
                    held.append(table)
                    size += len(table)
                if size > MERGE_ROWS:
                    held = [_merged(held, keys, merges)]
                    size = len(held[0])
                    if size > MERGE_ROWS * 3 // 4:
                        yield from held[0].to_batches()
                        held, size = [], 0
        if held:
            yield from _merged(held, keys, merges).to_batches()

    return docs.mapInArrow(tidy(run), schema)


def _langs(batch):
    return batch.column("lang").cast(pa.string()).fill_null(UNKNOWN)


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, f) over (doc_key, lang, text)."""

    def rows_of(words, batch, powers):
        encoded, lang_code = words.words(), _langs(batch).dictionary_encode()
        n_langs = max(len(lang_code.dictionary), 1)
        lang = lang_code.indices.to_numpy(zero_copy_only=False)[words.text]
        keys = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * n_langs + lang
        keys, f = np.unique(keys, return_counts=True)
        yield pa.table(
            {
                "lang": lang_code.dictionary.take(pa.array(keys % n_langs)),
                "word": encoded.dictionary.take(pa.array(keys // n_langs)).cast(pa.string()),
                "f": pa.array(f, pa.int64()),
            }
        )

    schema, keys = "lang string, word string, f long", ["lang", "word"]
    partial = _map_slices(docs, schema, rows_of, keys, [("f", "sum")])
    return partial.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _lang_hashes(words, langs):
    """Hash of the language of every word."""
    code = langs.dictionary_encode()
    found = np.array([text_hash(lang) for lang in code.dictionary.to_pylist()], np.uint64)
    return found[code.indices.to_numpy(zero_copy_only=False)][words.text]


def _word_keys(word_hash, lang_hash):
    return mixed(word_hash + lang_hash, 3)


def word_hashes(words: DataFrame) -> DataFrame:
    """``fingerprint`` of rows (lang, word), as tasks compute it from texts."""

    def run(batches):
        powers = Powers()
        for batch in batches:
            langs, texts = batch.columns
            data, offsets = text_bytes(texts)
            for at, to in slices(offsets, SLICE_BYTES):
                found = PieceWords(data, offsets, at, to, powers)
                keys = _word_keys(found.hash, _lang_hashes(found, langs[at:to]))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["fingerprint"])

    return words.select("lang", "word").mapInArrow(run, "fingerprint long")


def _both(hashes, size, at, powers):
    """Fingerprints and second polynomials of the n-grams whose first words are ``at``."""
    second = fingerprints(mixed(hashes, 2), size, powers)[at] >> np.uint64(32)
    return fingerprints(hashes, size, powers)[at], second.astype(np.uint32).view(np.int32)


def _hopeful(words, lang_hash, word_bits, pair_bits, powers):
    """(size, first words) of the n-grams that may be frequent.

    Without ``pair_bits`` these are pairs of frequent words; with them, longer n-grams of
    frequent pairs.
    """
    sound = word_bits.holds(_word_keys(words.hash, lang_hash))
    run = pair = (words.piece[:-1] == words.piece[1:]) & sound[:-1] & sound[1:]
    at = np.flatnonzero(pair)
    if pair_bits is None or not len(at):
        yield 2, at
        return
    pair[at] = pair_bits.holds(fingerprints(words.hash + lang_hash, 2, powers)[at])
    for size in range(3, MOST_WORDS + 1):
        run = run[:-1] & pair[size - 2 :]
        yield size, np.flatnonzero(run)


def count_fingerprints(docs: DataFrame, word_table, pair_table=None) -> DataFrame:
    """(fingerprint, second, f, doc_key): count of each n-gram that may be frequent, by
    language, and a document that holds it; of (doc_key, lang, text)."""
    tables = docs.sparkSession.sparkContext.broadcast((word_table, pair_table))

    def rows_of(words, batch, powers):
        word_bits, pair_bits = (t and Bits(*t) for t in tables.value)
        lang_hash = _lang_hashes(words, _langs(batch))
        for size, at in _hopeful(words, lang_hash, word_bits, pair_bits, powers):
            if not len(at):
                continue
            found, second = _both(words.hash + lang_hash, size, at, powers)
            yield pa.table(
                {
                    "fingerprint": pa.array(found.view(np.int64)),
                    "second": pa.array(second),
                    "f": pa.array(np.ones(len(at), np.int64)),
                    "doc_key": batch.column("doc_key").take(pa.array(words.text[at])),
                }
            ).combine_chunks()

    schema = "fingerprint long, second int, f long, doc_key long"
    keys = ["fingerprint", "second"]
    partial = _map_slices(docs, schema, rows_of, keys, [("f", "sum"), ("doc_key", "min")])
    return partial.groupBy(*keys).agg(F.sum("f").alias("f"), F.min("doc_key").alias("doc_key"))


def materialise(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(lang, phrase, n_words, f, doc_key) of rows (fingerprint, second, f, doc_key).

    The words of the documents pointed to must give both numbers again. A document is asked
    for no more phrases than it holds, so no row of the join is without bound.
    """
    asked = found.groupBy("doc_key").agg(F.collect_list("fingerprint").alias("asked"))
    if found.count() <= BROADCAST_POINTERS:
        asked = F.broadcast(asked)
    pointed = docs.join(asked, "doc_key").select("asked", "lang", "text")

    def rows_of(words, batch, powers):
        wanted = np.unique(batch.column("asked").flatten().to_numpy(zero_copy_only=False))
        wanted = np.sort(wanted.view(np.uint64))
        langs = _langs(batch)
        hashes = words.hash + _lang_hashes(words, langs)
        encoded = words.words()
        code = encoded.indices.to_numpy(zero_copy_only=False)
        for size in range(2, MOST_WORDS + 1):
            at = np.flatnonzero(words.piece[: 1 - size] == words.piece[size - 1 :])
            if not len(at):
                return
            numbers, second = _both(hashes, size, at, powers)
            place = np.searchsorted(wanted, numbers).clip(max=len(wanted) - 1)
            keep = np.flatnonzero(wanted[place] == numbers)
            if not len(keep):
                continue
            at = at[keep]
            parts = [encoded.dictionary.take(pa.array(code[at + k])) for k in range(size)]
            phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
            yield pa.table(
                {
                    "fingerprint": pa.array(numbers[keep].view(np.int64)),
                    "second": pa.array(second[keep]),
                    "lang": langs.take(pa.array(words.text[at])),
                    "phrase": phrase.cast(pa.string()),
                    "n_words": pa.array(np.full(len(at), size), pa.int64()),
                }
            )

    keys = ["fingerprint", "second"]
    schema = "fingerprint long, second int, lang string, phrase string, n_words long"
    rest = ["lang", "phrase", "n_words"]
    merges = [(c, "min") for c in rest]
    texts = _map_slices(pointed, schema, rows_of, keys, merges)
    texts = texts.groupBy(*keys).agg(*[F.min(c).alias(c) for c in rest])
    return found.join(texts, keys).select(*rest, "f", "doc_key")


def frequent_phrases(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to 5 words found ``least`` times or more, and the words of each language.

    The first table is (lang, phrase, n_words, f, doc_key), the second (lang, n). ``doc_key``
    points to a document: its id, or a hash of the text where that is null; words have none.
    Null texts are empty, a null language is ``und``; repeated rows and ids count as often as
    they occur. Tables that are read again are written, so a lost executor costs only its own
    tasks.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    plain = docs.select(key.alias("doc_key"), F.col("lang").cast("string"), F.col("text").cast("string"))
    words = write_once(count_words(plain), "phrase-words")
    often = words.where(F.col("f") >= least)
    word_table = frequent_bits(word_hashes(often))

    def counted(label, *tables):
        found = count_fingerprints(plain, *tables).where(F.col("f") >= least)
        return write_once(found, label)

    pairs = counted("phrase-pairs", word_table)
    longer = counted("phrase-longer", word_table, frequent_bits(pairs))
    phrases = materialise(plain, pairs.union(longer))
    single = often.select(
        "lang",
        F.col("word").alias("phrase"),
        F.lit(1).cast("long").alias("n_words"),
        "f",
        F.lit(None).cast("long").alias("doc_key"),
    )
    phrases = write_once(phrases.unionByName(single), "phrases")
    return phrases, words.groupBy("lang").agg(F.sum("f").alias("n"))


def collocations(phrases: DataFrame, sizes: DataFrame) -> DataFrame:
    """Candidates with the score of their weakest cut: (lang, phrase, a, k, l, r, n, score).

    Products are decimals of 38 digits; a quotient is floored. A candidate goes if a longer
    one holds its words and is found as often. A phrase inside a longer one is found at least
    as often as those between them, so one word more on either side decides.
    """
    counts = phrases.select("lang", "phrase", "f")
    words = F.split("phrase", " ")
    candidates = phrases.where(F.col("n_words") > 1).select(
        "lang", "phrase", F.col("f").alias("a"), "n_words", words.alias("words")
    )
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_words") - 1)))
    k = F.col("k").cast("int")
    cut = cut.withColumns(
        {
            "first": F.array_join(F.slice("words", F.lit(1), k), " "),
            "rest": F.array_join(F.slice("words", k + 1, F.lit(MOST_WORDS)), " "),
        }
    )
    first = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    whole = "decimal(20,0)"
    cut = cut.join(first, ["lang", "first"]).join(rest, ["lang", "rest"])
    cut = cut.join(F.broadcast(sizes) if _few(sizes) else sizes, "lang")
    scored = cut.withColumn(
        "score",
        F.expr(
            f"(cast(a as {whole}) * cast(n * 1000 as {whole})) "
            f"div (cast(l as {whole}) * cast(r as {whole}))"
        ),
    )
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    inner = F.explode(
        F.array(
            F.array_join(F.slice("words", F.lit(1), F.size("words") - 1), " "),
            F.array_join(F.slice("words", F.lit(2), F.size("words") - 1), " "),
        )
    )
    held = candidates.where(F.col("n_words") > 2).select("lang", inner.alias("phrase"), "a")
    held = held.distinct()
    return weakest.join(held, ["lang", "phrase", "a"], "left_anti").select(
        "lang", "phrase", "a", "cut.k", "cut.l", "cut.r", "n", "cut.score"
    )


def _few(sizes):
    return sizes.limit(10_001).count() <= 10_000


def best(scored: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each language by score, count, then phrase, with their rank.

    Every task first keeps its own first ``most``; so do sixteen parts of a language, which
    one task then ranks.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(16))
    parts = Window.partitionBy("lang", "part").orderBy(*order)
    cut = scored.withColumn("part", part).withColumn("rank", F.row_number().over(parts))
    cut = cut.where(F.col("rank") <= most).drop("part", "rank")
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= most)


def mine(docs: DataFrame, least: int = 100, most: int = 2000) -> DataFrame:
    """Each language's best collocations: (lang, rank, phrase, a, l, r, n, score)."""
    phrases, sizes = frequent_phrases(docs, least)
    return best(collocations(phrases, sizes), most).select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"
    )
