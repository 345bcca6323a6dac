"""Class-based bigram language model: exchange clustering of words, smoothed scores of texts.

Every word has a class, a text is a walk over classes, and the probability of a token is that
of its class after the class before, times that of the word within its class.

Words are clustered in units: a word found often enough is a unit of its own, other words
share one by the bytes they end with. So every word, known or not, has a class without a
table of all words. The number of units, and with it what a task holds, is bounded; counts
are taken over all training texts. A unit's neighbours are one row of a written table, at most
twice as many numbers as there are units, and an exchange round is a pass over these rows.

Scoring needs the count of every word. Those of the most frequent words, a bounded table,
go to the tasks; the others are looked up by a join of (document, word) pairs with the counts.
"""

import math
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tractscope.llm.words import Powers, Slice, mixed, slices, text_bytes, tidy
from tractscope.session import write_once

# Units that words may be of their own, and units of endings. Classes that units move between.
MOST_UNITS, ENDINGS, CLASSES = 6_000, 1_024, 128
# Words whose counts go to the tasks (about 40 bytes each); the rest is joined.
MOST_SENT = 100_000
ROUNDS = 14
# Weight of a class's overall share among the classes that follow another.
SHARE = 2.0
SLICE_BYTES = 1 << 19
MERGE_ROWS = 3 << 18
SCORES = "n_tokens long, n_known long, base_score double, score double"


@dataclass
class Counts:
    """``words`` (word, c) of all training tokens but the end, which ``texts`` counts;
    ``tokens`` and ``distinct`` include it."""

    words: DataFrame
    texts: int
    tokens: int
    distinct: int


@dataclass
class Model:
    """What tasks need. ``sent`` are words in order of their counts ``sent_counts``; the first
    ``n_own`` are units. ``unit_class`` holds a class for each unit, ``log_next`` the log10
    probability of a class after another, ``log_sizes`` log10 of what a class's words share.
    The last two classes are the end of a text and its begin."""

    sent: list
    sent_counts: np.ndarray
    n_own: int
    unit_class: np.ndarray
    log_next: np.ndarray
    log_sizes: np.ndarray
    log_all: float
    log_end: float


class Words(Slice):
    """Words of a slice of texts, A-Z lower-cased."""

    def strings(self) -> pa.DictionaryArray:
        lower = np.where((self.bytes >= 65) & (self.bytes <= 90), self.bytes | 32, self.bytes)
        offsets = np.r_[0, np.cumsum(self.word_end - self.word_begin)].astype(np.int64)
        words = pa.LargeStringArray.from_buffers(
            len(self.word_begin), pa.py_buffer(offsets), pa.py_buffer(lower[self.inside])
        )
        return words.dictionary_encode()


def _slices(texts, powers):
    data, offsets = text_bytes(texts)
    for at, to in slices(offsets, SLICE_BYTES):
        yield at, Words(data, offsets, at, to, powers, lower=True)


def _summed(tables, keys, value):
    # One thread: each further one would hold a table of groups of its own.
    found = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([(value, "sum")])
    return found.rename_columns([*keys, value])


def _map_counts(texts, schema, rows_of, keys, value):
    """``rows_of(slice)`` over all texts, summed by ``keys`` in each task."""

    def run(batches):
        powers, held, size = Powers(), [], 0
        for batch in batches:
            for _, words in _slices(batch.columns[0], powers):
                table = rows_of(words)
                held.append(table)
                size += len(table)
                if size > MERGE_ROWS:
                    held = [_summed(held, keys, value)]
                    size = len(held[0])
                    if size > MERGE_ROWS // 2:
                        yield from held[0].to_batches()
                        held, size = [], 0
        if held:
            yield from _summed(held, keys, value).to_batches()

    return texts.mapInArrow(tidy(run), schema)


def count_words(texts: DataFrame) -> Counts:
    """Counts of all words of a column ``text``."""

    def rows_of(words):
        encoded = words.strings()
        c = np.bincount(encoded.indices.to_numpy(zero_copy_only=False), minlength=len(encoded.dictionary))
        return pa.table({"word": encoded.dictionary.cast(pa.string()), "c": pa.array(c, pa.int64())})

    partial = _map_counts(texts, "word string, c long", rows_of, ["word"], "c")
    words = write_once(partial.groupBy("word").agg(F.sum("c").alias("c")), "lm-words")
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n = texts.count()
    return Counts(words, n, total + n, distinct + (n > 0))


def frequent(words: DataFrame, most: int) -> list[tuple[str, int]]:
    """At most ``most`` words, by falling count: all of at least some count.

    The count is found from the numbers of words in bands of counts, a few hundred rows, so
    nothing is sorted and no task holds more than its share.
    """
    band = F.floor(F.log2("c") * 8)
    bands = words.groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect()
    bound, room = None, most
    for band_no, n in sorted(((b.band, b.n) for b in bands), reverse=True):
        if n > room:
            break
        bound, room = band_no, room - n
    if bound is None:
        return []
    found = words.where(band >= bound).collect()
    return sorted(((r.word, r.c) for r in found), key=lambda r: (-r[1], r[0]))


def _ending(words: pa.Array, n_own) -> np.ndarray:
    """Unit of each word by its last three bytes."""
    data, offsets = text_bytes(words)
    out = np.zeros(len(words), np.uint64)
    for back in range(1, 4):
        at = offsets[1:] - back
        sound = at >= offsets[:-1]
        out[sound] += data[at[sound]].astype(np.uint64) << np.uint64(8 * back - 8)
    out = out * np.uint64(0x9E3779B97F4A7C15)
    return (out >> np.uint64(40)).astype(np.int64) % ENDINGS + n_own


def _units(words: pa.Array, own: pa.Array) -> np.ndarray:
    """Unit of each word: its place among ``own``, else that of its ending."""
    found = pc.index_in(words.cast(pa.large_string()), value_set=own).fill_null(-1)
    found = found.to_numpy(zero_copy_only=False).astype(np.int64)
    rest = np.flatnonzero(found < 0)
    if len(rest):
        found[rest] = _ending(words.take(pa.array(rest)), len(own))
    return found


def _walk(words, unit, end, begin):
    """Units of the texts of a slice in a row, each text between ``begin`` and ``end``."""
    n_texts = len(words.n_words)
    out = np.full(len(unit) + 2 * n_texts, end, np.int64)
    starts = words.first_word[:-1] + 2 * np.arange(n_texts)
    out[starts] = begin
    out[np.arange(len(unit)) + 2 * words.word_text + 1] = unit
    return out


def count_pairs(texts: DataFrame, own: list[str]) -> DataFrame:
    """(before, after, n): how often a unit comes after another.

    Units are numbered: frequent words, endings, end of text, begin of text.
    """
    n_units = len(own) + ENDINGS + 2
    shared = texts.sparkSession.sparkContext.broadcast(own)

    def rows_of(words):
        own_words = pa.array(shared.value, pa.large_string())
        encoded = words.strings()
        unit = _units(encoded.dictionary, own_words)[encoded.indices.to_numpy(zero_copy_only=False)]
        walk = _walk(words, unit, n_units - 2, n_units - 1)
        key = walk[:-1] * n_units + walk[1:]
        key, n = np.unique(key[walk[:-1] != n_units - 2], return_counts=True)
        return pa.table({"pair": pa.array(key), "n": pa.array(n, pa.int64())})

    partial = _map_counts(texts, "pair long, n long", rows_of, ["pair"], "n")
    return partial.groupBy("pair").agg(F.sum("n").alias("n")).select(
        F.floor(F.col("pair") / n_units).cast("int").alias("before"),
        (F.col("pair") % n_units).cast("int").alias("after"),
        "n",
    )


def neighbours(pairs: DataFrame, n_units: int) -> DataFrame:
    """(unit, other, n): one row for each unit, its followers, and its predecessors with
    ``n_units`` added."""
    sides = pairs.select(F.col("before").alias("unit"), F.col("after").alias("other"), "n").union(
        pairs.select("after", (F.col("before") + n_units).alias("other"), "n")
    )
    rows = sides.groupBy("unit").agg(F.collect_list(F.struct("other", "n")).alias("near"))
    return rows.select("unit", F.col("near.other").alias("other"), F.col("near.n").alias("n"))


def _xlogx(x):
    return x * np.log(np.maximum(x, 1))


def _each_unit(batch, unit_class):
    """(unit, counts of the classes that follow it, and of those before it, own pairs)."""
    n_units, n_classes = len(unit_class), int(unit_class.max()) + 1
    classes = np.r_[unit_class, unit_class + n_classes]
    units, others, counts = batch.columns
    at = others.offsets.to_numpy()
    flat, n = others.values.to_numpy(), counts.values.to_numpy()
    for i, unit in enumerate(units.to_numpy()):
        other, own = flat[at[i] : at[i + 1]], n[at[i] : at[i + 1]]
        near = np.bincount(classes[other], own, 2 * n_classes)
        itself = own[other == unit].sum()
        yield unit, near[:n_classes], near[n_classes:], itself


def class_pairs(near: DataFrame, unit_class: np.ndarray) -> np.ndarray:
    """How often a class follows another, from the written rows of the units."""
    n_classes = int(unit_class.max()) + 1
    shared = near.sparkSession.sparkContext.broadcast(unit_class)

    def run(batches):
        found = np.zeros((n_classes, n_classes))
        for batch in batches:
            for unit, after, _, _ in _each_unit(batch, shared.value):
                found[shared.value[unit]] += after
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(found.ravel()[at].astype(np.int64))], ["pair", "n"]
        )

    rows = near.mapInArrow(tidy(run), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    out = np.zeros(n_classes * n_classes)
    for row in rows.collect():
        out[row.pair] = row.n
    return out.reshape(n_classes, n_classes)


def likelihood(pairs: np.ndarray) -> float:
    """Log likelihood of the classes, less what does not depend on them."""
    return float(
        _xlogx(pairs).sum() - _xlogx(pairs.sum(0)).sum() - _xlogx(pairs.sum(1)).sum()
    )


def best_class(pairs, own, after, before, itself):
    """The class in which a unit raises the likelihood most, and by how much.

    ``pairs`` are the counts of class pairs, with the unit in class ``own``; ``after`` and
    ``before`` the unit's counts by class, ``itself`` of the unit after itself. The last two
    classes (end and begin of texts) take no other unit.
    """
    open_ = len(pairs) - 2
    rest = pairs.copy()
    rest[own] -= after
    rest[:, own] -= before
    rest[own, own] += itself
    # The unit's own pairs, without those with itself, as seen from another class.
    right, left = after.copy(), before.copy()
    right[own] -= itself
    left[own] -= itself
    now = _xlogx(rest)
    row = (_xlogx(rest + right[None, :]) - now).sum(1)
    column = (_xlogx(rest + left[:, None]) - now).sum(0)
    both = np.diagonal(rest)
    corner = (
        _xlogx(both + right + left + itself)
        - _xlogx(both + right) - _xlogx(both + left) + _xlogx(both)
    )
    # Wherever the unit goes, others still precede and follow it.
    sums, columns = rest.sum(1) + left, rest.sum(0) + right
    cost = (
        _xlogx(sums + right.sum() + itself) - _xlogx(sums)
        + _xlogx(columns + left.sum() + itself) - _xlogx(columns)
    )
    gain = (row + column + corner - cost)[:open_]
    found = int(gain.argmax())
    return found, float(gain[found] - gain[own])


def exchange(near: DataFrame, n_units: int, rounds: int = ROUNDS, classes: int = CLASSES):
    """Class of each unit by exchange; the last two units keep classes of their own.

    Every round some of the units, drawn anew, move to the class that is best for each given
    the others. As they move at once, a round can lower the likelihood; then the best classes
    so far are taken up again and half as many units move.
    """
    numbers = np.arange(n_units, dtype=np.uint64)
    unit_class = np.arange(n_units) % classes
    unit_class[-2:] = classes, classes + 1
    context = near.sparkSession.sparkContext
    best, parts = (-math.inf, None, None), 2
    for turn in range(rounds + 1):
        pairs = class_pairs(near, unit_class)
        found = likelihood(pairs)
        if found > best[0]:
            best = (found, unit_class, pairs)
        else:
            _, unit_class, pairs = best
            parts *= 2
        if turn == rounds:
            break
        moving = mixed(numbers * np.uint64(2) + np.uint64(2 * n_units * turn + 1)) % np.uint64(parts) == 0
        moving[-2:] = False
        shared = context.broadcast((unit_class, pairs, moving))

        def run(batches, shared=shared):
            unit_class, pairs, moving = shared.value
            for batch in batches:
                moved = [
                    (unit, best_class(pairs, unit_class[unit], after, before, itself))
                    for unit, after, before, itself in _each_unit(batch, unit_class)
                    if moving[unit]
                ]
                moved = [(unit, to) for unit, (to, gain) in moved if gain > 1e-6]
                units, to = zip(*moved, strict=True) if moved else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(units, pa.int32()), pa.array(to, pa.int32())], ["unit", "to"]
                )

        unit_class = unit_class.copy()
        for row in near.mapInArrow(tidy(run), "unit int, to int").collect():
            unit_class[row.unit] = row.to
    return best[1]


def train(texts: DataFrame, counts: Counts) -> Model:
    """Model of a column ``text``, whose words have been counted.

    What comes to the driver is bounded by the parameters: ``MOST_SENT`` words, a class for
    each unit, and the pairs of classes. Without a single text every token is equally likely.
    """
    sent = frequent(counts.words, MOST_SENT)
    own = [word for word, _ in sent[:MOST_UNITS]]
    n_units = len(own) + ENDINGS + 2
    near = neighbours(write_once(count_pairs(texts, own), "lm-pairs"), n_units)
    near = write_once(near, "lm-neighbours")
    classes = min(CLASSES, max(2, int(math.sqrt(len(own) + 1))))
    unit_class = exchange(near, n_units, classes=classes)
    sizes = class_sizes(counts.words, own, unit_class)
    pairs = class_pairs(near, unit_class)
    share = (pairs.sum(0) + 1) / (pairs.sum() + len(pairs) - 1)
    follow = (pairs + SHARE * share) / (pairs.sum(1, keepdims=True) + SHARE)
    # Nothing is followed by the begin of a text.
    follow[:, -1] = 0
    follow /= follow.sum(1, keepdims=True)
    with np.errstate(divide="ignore"):
        log_next = np.log10(follow)
    return Model(
        [word for word, _ in sent],
        np.array([c for _, c in sent], np.int64),
        len(own),
        unit_class,
        log_next,
        np.log10(sizes),
        math.log10(counts.tokens + counts.distinct + 1),
        math.log10(counts.texts + 1),
    )


def class_sizes(words: DataFrame, own: list[str], unit_class) -> np.ndarray:
    """For each class, the tokens and words in it, and one more for words not known."""
    shared = words.sparkSession.sparkContext.broadcast((own, unit_class))

    def run(batches):
        own, unit_class = shared.value
        own = pa.array(own, pa.large_string())
        found = np.zeros(int(unit_class.max()) + 1, np.int64)
        for batch in batches:
            classes = unit_class[_units(batch.columns[0], own)]
            np.add.at(found, classes, batch.columns[1].to_numpy() + 1)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["class", "n"])

    rows = words.mapInArrow(tidy(run), "class long, n long").groupBy("class").agg(F.sum("n").alias("n"))
    out = np.ones(int(unit_class.max()) + 1)
    for row in rows.collect():
        out[row["class"]] += row.n
    return out


def score(docs: DataFrame, counts: Counts, model: Model, keep=("doc_id",)) -> DataFrame:
    """``keep`` columns, n_tokens, n_known, base_score and score of every whole text.

    ``score`` is the log10 probability of the text and its end by the class model, with one
    unknown word more in each class; ``base_score`` that of single tokens, with one unknown
    word in all. Both are sums of log10(count + 1), which needs the counts, and of terms that
    need the classes only. Tasks add up all they know and give the other words as rows, which
    are counted by a join; the sums go back by the number of the row.
    """
    names = [f"kept_{i}" for i in range(len(keep))]
    rows = docs.select(
        *[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)],
        F.monotonically_increasing_id().alias("row_no"),
        F.col("text").cast("string").alias("text"),
    )
    kept = rows.drop("text").schema
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches):
        model, powers = SimpleNamespace(**shared.value), Powers()
        sent = pa.array(model.sent, pa.large_string())
        own = sent[: model.n_own]
        known_logs = np.r_[np.log10(model.sent_counts + 1.0), 0.0]
        end_class, begin_class = len(model.log_next) - 2, len(model.log_next) - 1
        for batch in batches:
            for at, words in _slices(batch.columns[-1], powers):
                n_texts = len(words.n_words)
                encoded = words.strings()
                of = encoded.indices.to_numpy(zero_copy_only=False)
                found = pc.index_in(encoded.dictionary, value_set=sent).fill_null(-1)
                found = found.to_numpy(zero_copy_only=False)
                classes = model.unit_class[_units(encoded.dictionary, own)].astype(np.int64)
                walk = _walk(words, classes[of], end_class, begin_class)
                steps = model.log_next[walk[:-1], walk[1:]]
                inside = walk[:-1] != end_class
                starts = np.cumsum(walk == begin_class) - 1
                text_of = starts[:-1][inside]
                moves = np.bincount(text_of, steps[inside], n_texts)
                place = found[of]
                logs = np.bincount(words.word_text, known_logs[place], n_texts)
                shares = np.bincount(words.word_text, model.log_sizes[classes][of], n_texts)
                known = np.bincount(words.word_text, place >= 0, n_texts).astype(np.int64)
                n_tokens = words.n_words + 1
                end_known = model.log_end > 0
                # The end is always its class's only word.
                base = logs + model.log_end - n_tokens * model.log_all
                full = logs - shares + moves
                first = [c.slice(at, n_texts) for c in batch.columns[:-1]]
                nothing = pa.nulls(n_texts, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        *first,
                        pa.array(n_tokens, pa.int64()),
                        pa.array(known + end_known, pa.int64()),
                        pa.array(base),
                        pa.array(full),
                        nothing,
                        pa.array(np.zeros(n_texts, np.int64)),
                    ],
                    names=schema_names,
                )
                other = np.flatnonzero(place < 0)
                if not len(other):
                    continue
                size = max(len(encoded.dictionary), 1)
                key, times = np.unique(
                    words.word_text[other] * size + of[other], return_counts=True
                )
                text, word = pa.array(key // size), pa.array(key % size)
                zeros = pa.array(np.zeros(len(key)))
                number = batch.columns[-2].slice(at, n_texts).take(text)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.nulls(len(key), c.type) for c in first[:-1]],
                        number,
                        pa.array(np.zeros(len(key), np.int64)),
                        pa.array(np.zeros(len(key), np.int64)),
                        zeros,
                        zeros,
                        encoded.dictionary.take(word).cast(pa.string()),
                        pa.array(times, pa.int64()),
                    ],
                    names=schema_names,
                )

    schema = ", ".join(
        [f"{f.name} {f.dataType.simpleString()}" for f in kept.fields]
        + [SCORES, "word string", "times long"]
    )
    schema_names = [*names, "row_no", "n_tokens", "n_known", "base_score", "score", "word", "times"]
    parts = write_once(rows.mapInArrow(tidy(run), schema), "lm-parts")
    texts = parts.where(F.col("word").isNull()).drop("word", "times")
    asked = parts.where(F.col("word").isNotNull()).select("row_no", "word", "times")
    late = asked.join(counts.words, "word").groupBy("row_no").agg(
        F.sum("times").alias("more_known"),
        F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"),
    )
    more = F.coalesce("more", F.lit(0.0))
    return texts.join(late, "row_no", "left").select(
        *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)],
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )


FOLDS, HELD_OUT = 7, 2


def document_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, the counts and both scores of every document.

    Learnt from the documents whose crc32 of the id (as text) leaves another remainder by 7
    than 2; a null id counts as an empty text. Null and empty texts are their end alone.
    Repeated rows are learnt from and scored as often as they occur. Without a document to
    learn from, N is 0 and all counts are. Other columns play no part.
    """
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    held = F.crc32(F.encode(text, "UTF-8")) % FOLDS == HELD_OUT
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    training = plain.where(~held).select("text")
    counts = count_words(training)
    scored = score(plain, counts, train(training, counts))
    return scored.select(
        "doc_id",
        held.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
