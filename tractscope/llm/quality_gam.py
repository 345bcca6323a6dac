"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text falls into a bin. Boosting goes round the features in turn and adds a
shallow tree over the bins of one feature at a time to that feature's table; then it goes
round the strongest pairs of features likewise. What is left are tables: a text's score is
the sum of the entries of its bins.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from tractscope.llm.folds import held_out
from tractscope.llm.quality_rules import measure_slice
from tractscope.llm.tables import seeded_hash
from tractscope.llm.words import Powers, mixed, text_slices, tidy

# The training sample: labelled documents, chosen by a seeded hash.
MAX_LABELLED = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS, RATE = 200, 60, 6, 0.1
LEAVES, LEAST_ROWS, RIDGE = 3, 5, 1.0
THRESHOLD = 0.7

FEATURES = [
    "log_words", "word_length", "symbols_a_word", "bars_a_word", "exclaims_a_word",
    "capital_share", "digit_share", "other_marks_a_word", "non_ascii_share",
    "repeated_words", "repeated_lines", "distinct_words", "doubled_words",
    "sentence_ends_a_word", "log_words_a_line", "letterless_words",
]


def _table(characters):
    flags = np.zeros(256, bool)
    flags[list(characters)] = True
    return flags


_DIGITS = _table(range(48, 58))
_ENDS = _table(b".?")
_LETTERS = _table([*range(65, 91), *range(97, 123), *range(128, 256)])
_OTHER = _table(b"\"'()-_=+[]{}\\;:/~`@^")


def slice_features(s):
    """(texts, features) of a slice of texts; all 0 for a text without words but for logs."""
    m = {name: values.astype(float) for name, values in measure_slice(s).items()}
    count, words = len(s.start), np.maximum(m["n_words"], 1)
    chars = np.maximum(m["word_chars"], 1)
    # Distinct words, and words equal to the one before.
    keys = mixed(s.word_hash + s.word_text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 3)
    first = np.unique(keys, return_index=True)[1]
    distinct = np.bincount(s.word_text[first], minlength=count)
    doubled = np.flatnonzero(keys[1:] == keys[:-1]) + 1
    doubled = np.bincount(s.word_text[doubled], minlength=count)
    letters = np.r_[0, np.cumsum(_LETTERS[s.bytes])]
    letterless = letters[s.word_end] == letters[s.word_begin]
    letterless = np.bincount(s.word_text[letterless], minlength=count)
    columns = [
        np.log1p(m["n_words"]),
        m["word_chars"] / words,
        m["n_symbols"] / words,
        s.totals(s.bytes == 0x7C) / words,
        m["n_exclaims"] / words,
        m["n_upper"] / np.maximum(m["n_upper"] + m["n_lower"], 1),
        s.totals(_DIGITS[s.bytes]) / chars,
        s.totals(_OTHER[s.bytes]) / words,
        s.totals((s.bytes & 0xC0) == 0xC0) / chars,
        m["n_repeat_words"] / words,
        m["n_dup_lines"] / np.maximum(m["n_lines"], 1),
        distinct / words,
        doubled / words,
        s.totals(_ENDS[s.bytes]) / words,
        np.log1p(m["n_words"] / np.maximum(m["n_lines"], 1)),
        letterless / words,
    ]
    return np.stack(columns, axis=1)


def text_features(texts: pa.Array, powers: Powers):
    out = np.zeros((len(texts), len(FEATURES)))
    for at, s in text_slices(texts, powers):
        rows = slice_features(s)
        out[at : at + len(rows)] = rows
    return out


# --- the model --------------------------------------------------------------------


@dataclass
class AdditiveModel:
    """``edges`` cut each feature into bins; ``tables`` hold each bin's points; ``pairs`` are
    (feature, feature, edges, edges, table of points)."""

    bias: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple]

    def score(self, x):
        total = np.full(len(x), self.bias)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, j], "right")]
        for a, b, edges_a, edges_b, table in self.pairs:
            total += table[
                np.searchsorted(edges_a, x[:, a], "right"), np.searchsorted(edges_b, x[:, b], "right")
            ]
        return _sigmoid(total)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _cuts(values, bins):
    """Edges between bins of about equal numbers of rows; equal values share a bin."""
    points = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="nearest"))
    return points[points > values.min()]


def _gain(g, h):
    return g * g / (h + RIDGE)


def _tree(g, h, n):
    """Points of each bin by a tree of at most LEAVES runs of bins."""
    bounds = [0, len(g)]
    sums = [np.r_[0, np.cumsum(v)] for v in (g, h, n)]

    def total(i, j):
        return [s[j] - s[i] for s in sums]

    for _ in range(LEAVES - 1):
        best, cut = 1e-9, None
        for i, j in zip(bounds, bounds[1:], strict=False):
            if j - i < 2:
                continue
            at = np.arange(i + 1, j)
            gl, hl, nl = (s[at] - s[i] for s in sums)
            gt, ht, nt = total(i, j)
            gains = _gain(gl, hl) + _gain(gt - gl, ht - hl) - _gain(gt, ht)
            gains[(nl < LEAST_ROWS) | (nt - nl < LEAST_ROWS)] = 0
            k = int(gains.argmax())
            if gains[k] > best:
                best, cut = gains[k], int(at[k])
        if cut is None:
            break
        bounds = sorted([*bounds, cut])
    points = np.zeros(len(g))
    for i, j in zip(bounds, bounds[1:], strict=False):
        gs, hs, _ = total(i, j)
        points[i:j] = gs / (hs + RIDGE)
    return points


def _quadrants(g, h):
    """Best cut of a grid of bins into four: (gain, row cut, column cut, points of each)."""
    rows, columns = g.shape
    if rows < 2 or columns < 2:
        return 0.0, 0, 0, np.zeros((2, 2))
    corner = [np.cumsum(np.cumsum(v, axis=0), axis=1) for v in (g, h)]
    parts = []
    for c in corner:
        a = c[:-1, :-1]
        parts.append((a, c[:-1, -1:] - a, c[-1:, :-1] - a, c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + a))
    gains = sum(_gain(x, y) for x, y in zip(*parts, strict=True)) - _gain(g.sum(), h.sum())
    i, j = np.unravel_index(gains.argmax(), gains.shape)
    points = [x[i, j] / (y[i, j] + RIDGE) for x, y in zip(*parts, strict=True)]
    return float(gains[i, j]), i + 1, j + 1, np.array(points).reshape(2, 2)


def fit(x, y) -> AdditiveModel:
    """Model of label 1 from features ``x`` and labels ``y``.

    Without rows every score is 0.5; with labels of one kind it is near that kind.
    """
    features = x.shape[1]
    if len(y) == 0:
        return AdditiveModel(0.0, [np.zeros(0)] * features, [np.zeros(1)] * features, [])
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    bias = float(np.log(share / (1 - share)))
    edges = [_cuts(x[:, j], BINS) for j in range(features)]
    bins = [np.searchsorted(edges[j], x[:, j], "right") for j in range(features)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    counts = [np.bincount(bins[j], minlength=len(tables[j])) for j in range(features)]
    total = np.full(len(y), bias)
    used = [j for j in range(features) if len(tables[j]) > 1] if 0 < y.sum() < len(y) else []
    for _ in range(ROUNDS):
        for j in used:
            p = _sigmoid(total)
            g = np.bincount(bins[j], y - p, minlength=len(tables[j]))
            h = np.bincount(bins[j], p * (1 - p), minlength=len(tables[j]))
            points = RATE * _tree(g, h, counts[j])
            tables[j] += points
            total += points[bins[j]]
    # The pairs whose four quadrants explain most of what is left.
    coarse_edges = [_cuts(x[:, j], PAIR_BINS) for j in range(features)]
    coarse = [np.searchsorted(coarse_edges[j], x[:, j], "right") for j in range(features)]
    shapes = [len(e) + 1 for e in coarse_edges]

    def grids(a, b):
        p = _sigmoid(total)
        cell, size = coarse[a] * shapes[b] + coarse[b], shapes[a] * shapes[b]
        return cell, *(
            np.bincount(cell, v, minlength=size).reshape(shapes[a], shapes[b])
            for v in (y - p, p * (1 - p))
        )

    ranked = sorted(
        ((-_quadrants(*grids(a, b)[1:])[0], a, b) for a in used for b in used if a < b)
    )
    chosen = [(a, b, np.zeros((shapes[a], shapes[b]))) for gain, a, b in ranked[:PAIRS] if gain < 0]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in chosen:
            cell, g, h = grids(a, b)
            gain, i, j, points = _quadrants(g, h)
            if gain <= 0:
                continue
            step = np.zeros(table.shape)
            step[:i, :j], step[:i, j:] = points[0]
            step[i:, :j], step[i:, j:] = points[1]
            table += RATE * step
            total += RATE * step.ravel()[cell]
    pairs = [(a, b, coarse_edges[a], coarse_edges[b], table) for a, b, table in chosen]
    return AdditiveModel(bias, edges, tables, pairs)


# --- on tables --------------------------------------------------------------------


def featurized(docs: DataFrame, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` columns and ``features``, an array, of every whole text."""
    field = StructField("features", ArrayType(DoubleType()))
    schema = StructType([*docs.select(*keep).schema.fields, field])

    def run(batches):
        powers = Powers()

        def featured(batch):
            values = text_features(batch.columns[-1], powers)
            offsets = np.arange(0, values.size + 1, len(FEATURES), dtype=np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=schema.names)

        return map(featured, batches)

    source = docs.select(*keep, F.col(text_col).cast("string").alias("text_to_measure"))
    return source.mapInArrow(tidy(run), schema)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labelled: int = MAX_LABELLED,
    seed: int = 3,
) -> AdditiveModel:
    """Model from at most ``max_labelled`` labelled documents, none of them held out.

    They are chosen by a seeded hash of the id among all rows of ``labels`` with an id and a
    label; an id labelled twice takes its smaller label. Only the chosen texts are measured,
    and only their features come to the driver.
    """
    labelled = labels.where(
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col))
    )
    chosen = (
        labelled.groupBy(id_col)
        .agg(F.min(F.col(label_col).cast("int")).alias("label_to_learn"))
        .orderBy(seeded_hash(F.col(id_col), seed), id_col)
        .limit(max_labelled)
    )
    texts = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col)
    rows = (
        featurized(texts, text_col, (id_col, "label_to_learn"))
        .groupBy(id_col)
        .agg(F.min(F.struct("features", "label_to_learn")).alias("row"))
        .collect()
    )
    rows.sort(key=lambda r: r[id_col])
    x = np.array([r.row.features for r in rows]).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r.row.label_to_learn for r in rows], float))


def classify(
    docs: DataFrame,
    model: AdditiveModel,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``keep`` columns, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Null and empty texts are scored by their features, which are 0. The model (some 10 kB)
    travels with the function.
    """
    added = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    schema = StructType([*docs.select(*keep).schema.fields, *added])

    def run(batches):
        powers = Powers()

        def scored(batch):
            scores = model.score(text_features(batch.columns[-1], powers))
            predicted = (scores >= threshold).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores), pa.array(predicted)], names=schema.names
            )

        return map(scored, batches)

    source = docs.select(*keep, F.col(text_col).cast("string").alias("text_to_score"))
    return source.mapInArrow(tidy(run), schema)
