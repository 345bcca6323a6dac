"""Language identification by a convolutional network over bytes, in numpy.

Bytes are embedded, filters of several widths slide over windows of fixed length, each
filter's largest response in a window is kept, and a linear layer with softmax gives each
language's probability. A text's windows cover all of it; their log-probabilities are
averaged by the bytes they hold.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tractscope.llm.folds import held_out, sample_ids
from tractscope.llm.tables import seeded_hash
from tractscope.llm.words import kept_and_text, text_bytes, tidy

WINDOW, WIDTHS, FILTERS, EMBED = 256, (2, 3, 4), 24, 8
WIDEST = max(WIDTHS)
STRIDE = WINDOW - WIDEST + 1
PAD = 256
BATCH_WINDOWS = 128
# The training sample: documents of each language, of all, and characters of a document.
PER_LANGUAGE, MAX_SAMPLE, PIECE_CHARS = 500, 20_000, 2000
PIECES, EPOCHS, STEP, RATE = 3, 16, 32, 3e-3
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class ByteNet:
    """``embed`` (257, EMBED); ``kernel`` (WIDEST * EMBED, filters), zero beyond a filter's
    width; ``bias``; ``out`` (filters, languages); ``out_bias``; ``languages``."""

    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    languages: list[str]

    def patches(self, windows):
        """(windows, positions, WIDEST * EMBED) inputs of the filters."""
        padded = np.full((len(windows), WINDOW + WIDEST - 1), PAD, np.int64)
        padded[:, :WINDOW] = windows
        x = self.embed[padded]
        view = sliding_window_view(x, WIDEST, axis=1)[:, :WINDOW]
        return np.ascontiguousarray(view.swapaxes(2, 3)).reshape(len(windows), WINDOW, -1)

    def pooled(self, windows):
        x = self.patches(windows)
        responses = x.reshape(-1, x.shape[2]) @ self.kernel
        return x, responses.reshape(len(windows), WINDOW, -1)

    def log_probabilities(self, windows):
        """Log-probability of each language for each window."""
        hidden = np.maximum(self.pooled(windows)[1].max(axis=1) + self.bias, 0)
        logits = hidden @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def windows_of(data, offsets):
    """(window bytes, text of each window, bytes in it) of texts given by offsets.

    Windows overlap by the widest filter less one, so no group of bytes is missed. Texts
    without bytes have no window.
    """
    lengths = np.diff(offsets)
    counts = np.where(lengths > 0, 1 + -(-np.maximum(lengths - WINDOW, 0) // STRIDE), 0)
    text = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = offsets[:-1][text] + nth * STRIDE
    size = np.minimum(offsets[1:][text] - begin, WINDOW)
    at = begin[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < size[:, None]
    found = data[np.minimum(at, max(len(data) - 1, 0))].astype(np.int16)
    windows = np.where(inside, found, np.int16(PAD))
    return windows, text, size


def fit(texts: list[bytes], labels: list[str], seed: int = 1) -> ByteNet:
    """Train on labelled texts by Adam.

    Each text gives windows at random places and of random length, so that short texts are
    learnt as well; each epoch draws anew. Every language is drawn as often.
    """
    random = np.random.default_rng(seed)
    languages = sorted(set(labels))
    index = {language: i for i, language in enumerate(languages)}
    filters = FILTERS * len(WIDTHS)
    mask = np.zeros((WIDEST, EMBED, filters), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[:width, :, i * FILTERS : (i + 1) * FILTERS] = 1
    mask = mask.reshape(-1, filters)
    net = ByteNet(
        random.normal(0, 0.5, (257, EMBED)).astype(np.float32),
        (random.normal(0, 0.25, mask.shape) * mask).astype(np.float32),
        np.zeros(filters, np.float32),
        random.normal(0, 0.1, (filters, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
        languages,
    )
    net.embed[PAD] = 0
    places = [[i for i, label in enumerate(labels) if label == lang] for lang in languages]
    per_epoch = max(len(texts) * PIECES // STEP, 20)
    moments = {}
    step = 0
    for _ in range(EPOCHS if len(languages) > 1 else 0):
        for _ in range(per_epoch):
            y = random.integers(0, len(languages), STEP)
            rows = np.full((STEP, WINDOW), PAD, np.int64)
            for r, language in enumerate(y):
                text = texts[places[language][random.integers(len(places[language]))]]
                size = int(min(len(text), WINDOW * random.uniform(0.1, 1.0) if r % 2 else WINDOW))
                begin = random.integers(0, len(text) - size + 1)
                rows[r, :size] = np.frombuffer(text[begin : begin + size], np.uint8)
            step += 1
            _adam(net, mask, rows, y, moments, step)
    return net


def _adam(net, mask, rows, y, moments, step):
    n = len(rows)
    x, responses = net.pooled(rows)
    top = responses.argmax(axis=1)
    before = np.take_along_axis(responses, top[:, None], axis=1)[:, 0] + net.bias
    hidden = np.maximum(before, 0)
    logits = hidden @ net.out + net.out_bias
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(n), y] -= 1
    p /= n
    slopes = {"out": hidden.T @ p, "out_bias": p.sum(axis=0)}
    back = (p @ net.out.T) * (before > 0)
    slopes["bias"] = back.sum(axis=0)
    # Only the place of each filter's largest response carries a slope.
    picked = x[np.arange(n)[:, None], top]
    slopes["kernel"] = np.einsum("nfk,nf->kf", picked, back) * mask
    to_input = np.einsum("kf,nf->nfk", net.kernel, back).reshape(n, -1, WIDEST, EMBED)
    padded = np.full((n, WINDOW + WIDEST - 1), PAD, np.int64)
    padded[:, :WINDOW] = rows
    used = padded[np.arange(n)[:, None, None], top[:, :, None] + np.arange(WIDEST)]
    embed = np.zeros_like(net.embed)
    np.add.at(embed, used.reshape(-1), to_input.reshape(-1, EMBED))
    embed[PAD] = 0
    slopes["embed"] = embed
    for name, slope in slopes.items():
        m, v = moments.get(name, (0.0, 0.0))
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        moments[name] = m, v
        change = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        setattr(net, name, (getattr(net, name) - change).astype(np.float32))


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
    seed: int = 1,
) -> ByteNet | None:
    """Model from at most ``per_language`` documents of each language, none of them held out.

    Of each the driver gets a piece of at most ``PIECE_CHARS`` characters from a seeded place.
    All languages together have at most ``MAX_SAMPLE`` pieces, shared evenly; more languages
    than that raise an error. None if no document can be learnt from (empty table, no label,
    no text).
    """
    open_rows = docs.where(~held_out(F.col(id_col)) & (F.octet_length(text_col) > 0))
    chosen = sample_ids(
        docs.where(~held_out(F.col(id_col))), id_col, lang_col, per_language, seed, MAX_SAMPLE
    )
    spare = F.greatest(F.length(text_col) - PIECE_CHARS, F.lit(0)).cast("long") + 1
    begin = (seeded_hash(F.col(id_col), seed + 1) % spare + 1).cast("int")
    piece = F.substring(F.col(text_col), begin, F.lit(PIECE_CHARS))
    # A repeated row counts once.
    rows = (
        open_rows.join(F.broadcast(chosen), [id_col, lang_col], "left_semi")
        .groupBy(id_col, lang_col)
        .agg(F.min(piece).alias("piece"))
        .collect()
    )
    rows.sort(key=lambda r: (r[lang_col], r[id_col]))
    if not rows:
        return None
    return fit([r.piece.encode() for r in rows], [r[lang_col] for r in rows], seed)


def predict_batch(net: ByteNet, texts: pa.Array):
    """(language, score) lists of a column of texts."""
    data, offsets = text_bytes(texts)
    count = len(texts)
    sums, sizes = np.zeros((count, len(net.languages))), np.zeros(count)
    step = BATCH_WINDOWS * WINDOW
    at = 0
    while at < count:
        # As many texts as fill a batch, or one longer text, cut into batches of windows.
        to = int(np.searchsorted(offsets, offsets[at] + step, "right")) - 1
        to = min(max(to, at + 1), count)
        for part in _parts(offsets[at : to + 1], step):
            windows, text, size = windows_of(data, part)
            for low in range(0, len(windows), BATCH_WINDOWS):
                some = slice(low, low + BATCH_WINDOWS)
                logs = net.log_probabilities(windows[some])
                owner = at + text[some]
                np.add.at(sums, owner, logs * size[some][:, None])
                np.add.at(sizes, owner, size[some])
        at = to
    mean = sums / np.maximum(sizes, 1)[:, None]
    shares = np.exp(mean - mean.max(axis=1, keepdims=True))
    shares /= shares.sum(axis=1, keepdims=True)
    best = shares.argmax(axis=1)
    languages, scores = [], []
    for i in range(count):
        text = texts[i].as_py()
        if text is None or not _LETTER.search(text):
            languages.append(UNKNOWN)
            scores.append(0.0)
        else:
            languages.append(net.languages[best[i]])
            scores.append(float(shares[i, best[i]]))
    return languages, scores


def _parts(offsets, step):
    """Offsets of several texts as they are; those of one long text cut at strides."""
    if len(offsets) > 2 or offsets[-1] - offsets[0] <= step:
        yield offsets
        return
    begin, end = int(offsets[0]), int(offsets[-1])
    strides = BATCH_WINDOWS * STRIDE
    while True:
        stop = min(begin + strides + WINDOW - STRIDE, end)
        yield np.array([begin, stop])
        if stop == end:
            return
        begin += strides


def identify(
    docs: DataFrame, net: ByteNet | None, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` (0 to 1) of every whole text.

    ``und`` with score 0 for null texts, texts without a letter, and without a model. The
    network (some 20 kB) travels with the function.
    """
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    schema = StructType([*docs.select(*keep).schema.fields, *added])
    source, place = kept_and_text(docs, keep, text_col)

    def identified(batch):
        texts = batch.column(place)
        if net is None:
            found = [UNKNOWN] * len(texts), [0.0] * len(texts)
        else:
            found = predict_batch(net, texts)
        columns = [pa.array(found[0], pa.string()), pa.array(found[1], pa.float64())]
        kept = batch.columns[: len(keep)]
        return pa.RecordBatch.from_arrays([*kept, *columns], names=schema.names)

    def run(batches):
        return map(identified, batches)

    return source.mapInArrow(tidy(run), schema)
