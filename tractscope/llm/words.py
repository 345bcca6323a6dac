"""Words, lines and word windows of many texts at once, as arrays of 64-bit hashes.

Words are ``[^\\x20\\x09-\\x0D]+``. All bytes of a character beyond ASCII are 128 or more, so
words can be found byte by byte. Work goes in slices of about a quarter of a megabyte of text
(a longer text is a slice of its own), which bounds memory whatever the size of an Arrow
batch.

Hashes are sums of a byte's random value times a power of a base, taken from running sums,
and then mixed; equal byte strings have equal hashes, and different ones of one text or of
two compared texts share one with a chance of about 1 in 2^64 for each pair.
"""

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SLICE_BYTES = 1 << 18
WINDOW = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def tidy(run):
    """``run`` over batches, giving freed memory back to the system when a task ends.

    Workers are used again by later tasks, and would hold the largest task's memory.
    """

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


def kept_and_text(docs: DataFrame, keep, text_col: str) -> tuple[DataFrame, int]:
    """``keep`` columns and the text as a string, for Arrow batches, and the text's place.

    A text that is kept is not sent a second time.
    """
    keep = tuple(keep)
    if text_col in keep and dict(docs.dtypes).get(text_col) == "string":
        return docs.select(*keep), keep.index(text_col)
    text = F.col(text_col).cast("string").alias("text_of_task")
    return docs.select(*keep, text), len(keep)


def _constants(count, seed):
    return np.random.default_rng(seed).integers(1, 1 << 63, count, dtype=np.uint64) | np.uint64(1)


BYTE_VALUES = _constants(256, 11)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]
BASE = int(_constants(1, 12)[0]) & ~7 | 5
BASE_INVERSE = pow(BASE, -1, 1 << 64)
PLACE_VALUES = _constants(WINDOW, 13)
MIXERS = _constants(4, 14)


def mixed(h, with_=0):
    """Spread the bits of 64-bit numbers, whose low bits are the weak ones."""
    h = (h ^ (h >> np.uint64(32))) * MIXERS[with_]
    return h ^ (h >> np.uint64(29))


class Powers:
    """Powers of the base and its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n):
        if n > len(self.up):
            size = max(n, 2 * len(self.up), SLICE_BYTES)
            self.up, self.down = (
                np.cumprod(np.r_[np.uint64(1), np.full(size - 1, np.uint64(base))])
                for base in (BASE, BASE_INVERSE)
            )
        return self.up, self.down


def text_bytes(texts: pa.Array):
    """Bytes and offsets of a string column; null texts are empty."""
    texts = texts.cast(pa.large_string()).fill_null("") if texts.null_count else texts.cast(
        pa.large_string()
    )
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return bytes_, offsets


def slices(offsets, size=SLICE_BYTES):
    """Ranges of texts of about ``size`` bytes each."""
    at, count = 0, len(offsets) - 1
    while at < count:
        to = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        to = min(max(to, at + 1), count)
        yield at, to
        at = to


class Slice:
    """Words of a slice of texts.

    ``word_text`` is the text of each word (from 0 in the slice), ``word_hash`` its hash,
    ``first_word`` the index of each text's first word, with the number of words at the end.
    """

    def __init__(self, data, offsets, at, to, powers, lower=False):
        self.start = offsets[at:to] - offsets[at]
        self.end = offsets[at + 1 : to + 1] - offsets[at]
        self.bytes = data[offsets[at] : offsets[to]]
        n = len(self.bytes)
        up, down = powers.upto(n + 1)
        self._down = down
        values = (LOWER_VALUES if lower else BYTE_VALUES)[self.bytes]
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * up[:n], out=self._sums[1:])
        self.inside = ~_SPACE[self.bytes]
        # A word begins where a text begins or a space lies before, and ends likewise.
        edge = np.zeros(n + 1, bool)
        edge[self.start] = edge[self.end] = True
        inside = np.r_[False, self.inside, False]
        begins = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
        ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
        self.word_hash = self.hashes(begins, ends)
        self.word_begin, self.word_end = begins, ends
        self.first_word = np.searchsorted(begins, np.r_[self.start, n])
        self.n_words = np.diff(self.first_word)
        self.word_text = np.repeat(np.arange(to - at), self.n_words)

    def hashes(self, begins, ends):
        """Hashes of byte ranges."""
        return mixed((self._sums[ends] - self._sums[begins]) * self._down[begins])

    def totals(self, flags):
        """Number of marked bytes in each text."""
        sums = np.r_[0, np.cumsum(flags)]
        return sums[self.end] - sums[self.start]

    def windows(self):
        """Start word and hash of every window of five words inside one text."""
        n = len(self.word_hash)
        if n < WINDOW:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.zeros(n - WINDOW + 1, np.uint64)
        for k in range(WINDOW):
            h += self.word_hash[k : n - WINDOW + 1 + k] * PLACE_VALUES[k]
        at = np.flatnonzero(self.word_text[: n - WINDOW + 1] == self.word_text[WINDOW - 1 :])
        return at, mixed(h[at], 1)


def text_slices(texts: pa.Array, powers: Powers, lower=False):
    """(index of the first text, Slice) over a column."""
    data, offsets = text_bytes(texts)
    for at, to in slices(offsets):
        yield at, Slice(data, offsets, at, to, powers, lower)
