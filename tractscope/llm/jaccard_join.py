"""N-gram Jaccard join by grouped prefixes.

A text's set holds its distinct word shingles. Two sets can only reach the threshold if they
share a shingle among the first few of each, in any order common to all; rare shingles come
first, so that few sets meet. Texts with equal sets are one class. Classes with the same
prefix and size are one group, and candidates are pairs of groups; only then are groups
expanded into their classes and these verified by their whole sets.

The result is each text's component under the links. To find it, not every pair inside a
component has to be verified. The first round verifies, for every shared shingle, each set
against one centre, and each class of a group against the group's first. The second round
verifies every candidate pair whose two sides are still in different components, so no link
between components is missed.

In the second round the smaller set of a pair is found by its first shingles only, about a
seventh of it: what it shares with a set no smaller must begin there. So texts that share
less than that with each other (pages of one template below the threshold) do not meet at
all. A shingle that very many groups share is dealt out by size as well, to the sizes that
its place in each set leaves possible. Groups of the component that holds most of a
shingle's groups do not meet each other there.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from tractscope.llm.components import connected_components
from tractscope.llm.tables import join_small
from tractscope.llm.words import Powers, Slice, mixed, slices, text_bytes, tidy
from tractscope.session import write_once

PERCENT = 75
# Shingles are counted in buckets to put frequent ones last: one bucket for BUCKET_BYTES of
# text, 2^21 to 2^25 of them (a byte each, broadcast). More tell more shingles apart; any
# number gives the same links.
BUCKET_BITS, MOST_BUCKET_BITS, BUCKET_BYTES, CHUNK_BITS = 21, 25, 512, 10
# Bits of the broadcast filters: 2^26 (8 MB), from 2^25 prefix shingles on two for each of them
# up to 2^30 (128 MB); and 2^25 (4 MB). A full filter lets more through, no less.
SHARED_BITS, MOST_SHARED_BITS, CHOSEN_BITS = 26, 30, 25
# A shingle that begins the search of more groups than HOT is dealt out by their sizes, too,
# in steps of a thirty-second of a natural logarithm, and in parts of SPLIT groups.
HOT, SIZE_STEPS, SPLIT = 256, 32, 1 << 14
# Prefix shingles of one part when shared ones are looked for, and of one task's buffer; and
# rows looked at together. They bound memory only.
PART_TOKENS, BUFFER_TOKENS, ROWS = 1 << 20, 1 << 18, 500


def need(total):
    """Least overlap of two sets with ``total`` shingles together: 100 i >= PERCENT (total - i)."""
    return -(-PERCENT * total // (100 + PERCENT))


def prefix_length(n):
    """Shingles to look at in a set of n: more than n less any overlap that could suffice."""
    return n - -(-PERCENT * n // 100) + 1


# --- sets -------------------------------------------------------------------------


def shingle_sets(s: Slice):
    """(text, shingle) of a slice of texts, distinct and sorted."""
    at, h = s.windows()
    owner = s.word_text[at]
    # Fewer than five words: the whole sequence is one shingle.
    short = np.flatnonzero((s.n_words > 0) & (s.n_words < 5))
    if len(short):
        first = s.first_word[short]
        whole = s.n_words[short].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for k in range(4):
            inside = s.n_words[short] > k
            word = s.word_hash[np.minimum(first + k, len(s.word_hash) - 1)]
            whole = np.where(inside, mixed(whole * np.uint64(3) + word, 2), whole)
        owner, h = np.r_[owner, short], np.r_[h, whole]
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], h[new]


def _sums(values, bounds):
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _fingerprints(values, bounds):
    """16 bytes for each run of values, the same for the same set."""
    pairs = np.stack([_sums(mixed(values, k), bounds) for k in (2, 3)], axis=1)
    return [pair.tobytes() for pair in pairs]


def _by_text(batch_texts, powers):
    """(index of the first text, number of texts, owner, shingle) for each slice."""
    data, offsets = text_bytes(batch_texts)
    for at, to in slices(offsets):
        s = Slice(data, offsets, at, to, powers, lower=True)
        yield at, to - at, *shingle_sets(s)


def _packed(h) -> bytes:
    """The upper 48 bits of each hash, six bytes each; enough to tell shingles apart."""
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _unpacked(data) -> np.ndarray:
    """Hashes with the lower 16 bits gone."""
    six = np.frombuffer(data, np.uint8).reshape(-1, 6)
    h = np.zeros((len(six), 8), np.uint8)
    h[:, 2:] = six
    return h.view(np.uint64).ravel()


# --- passes over the texts -----------------------------------------------------------


def _bits_for(wanted, least, most):
    """Bits that number ``wanted`` places, within bounds."""
    return min(max(int(wanted).bit_length(), least), max(least, most))


def bucket_ranks(texts: DataFrame) -> np.ndarray:
    """How frequent the shingles of each bucket are, in eighths of a doubling (0 to 255).

    Each task sends its counts in chunks, which are added up chunk by chunk as they come in.
    """
    size_of_all = texts.agg(F.sum(F.octet_length(texts.columns[0]))).first()[0] or 0
    bits = _bits_for(size_of_all // BUCKET_BYTES, BUCKET_BITS, MOST_BUCKET_BITS)
    schema = StructType(
        [
            StructField("chunk", IntegerType()),
            StructField("width", IntegerType()),
            StructField("counts", BinaryType()),
        ]
    )
    size = 1 << (bits - CHUNK_BITS)

    def packed(chunks):
        """Counts of chunks in the fewest bytes that hold them."""
        rows = []
        for chunk, counts in chunks:
            width = next(w for w in (1, 2, 4, 8) if counts.max() < 1 << (8 * w - 1))
            rows.append((chunk, width, counts.astype(f"i{width}").tobytes()))
        columns = zip(*rows, strict=True)
        kinds = (pa.int32(), pa.int32(), pa.binary())
        arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema.names)

    def count(batches):
        powers, counts = Powers(), np.zeros(1 << bits, np.uint32)
        found, waiting = [], 0

        def flush():
            if found:
                counts[:] += np.bincount(np.concatenate(found), minlength=len(counts)).astype(
                    np.uint32
                )
                found.clear()

        for batch in batches:
            for _, _, _, h in _by_text(batch.column(0), powers):
                found.append((h >> np.uint64(64 - bits)).astype(np.int32))
                waiting += len(h)
                if waiting >= BUFFER_TOKENS:
                    flush()
                    waiting = 0
            del batch
        flush()
        yield packed(enumerate(counts.reshape(-1, size)))

    def add(batches):
        sums = {}
        for batch in batches:
            for chunk, width, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(part, f"i{width}").astype(np.int64)
                sums[chunk] = sums[chunk] + part if chunk in sums else part
        if sums:
            ranks = {k: np.minimum(8 * np.log2(v + 1.0), 255).astype(np.uint8) for k, v in sums.items()}
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(ranks), pa.int32()),
                    pa.array([r.tobytes() for r in ranks.values()], pa.binary()),
                ],
                names=["chunk", "ranks"],
            )

    ranks = np.zeros((1 << CHUNK_BITS, size), np.uint8)
    sent = texts.mapInArrow(tidy(count), schema).repartition("chunk")
    for row in sent.mapInArrow(tidy(add), "chunk int, ranks binary").collect():
        ranks[row.chunk] = np.frombuffer(row.ranks, np.uint8)
    return ranks.ravel()


def _prefixes(texts: DataFrame, id_type, shared) -> DataFrame:
    """One row for each text: its set's size and fingerprint, its prefix and the prefix's.

    ``shared`` is the broadcast of the buckets' ranks.
    """
    schema = StructType(
        [
            StructField("id", id_type),
            StructField("n", LongType()),
            StructField("set_key", BinaryType()),
            StructField("prefix_key", BinaryType()),
            StructField("prefix", BinaryType()),
        ]
    )
    def run(batches):
        powers, ranks = Powers(), shared.value
        drop = np.uint64(64 - (len(ranks).bit_length() - 1))
        for batch in batches:
            sizes, keys, prefix_keys, prefixes = [], [], [], []
            for _, texts_here, owner, h in _by_text(batch.column(1), powers):
                n = np.bincount(owner, minlength=texts_here)
                bounds = np.r_[0, np.cumsum(n)]
                keys += _fingerprints(h, bounds)
                frequency = ranks[(h >> drop).astype(np.int64)]
                ordered = h[np.lexsort((h, frequency, owner))]
                taken = np.where(n > 0, prefix_length(n), 0)
                place = np.arange(len(h)) - np.repeat(bounds[:-1], n)
                first = ordered[place < np.repeat(taken, n)]
                ends = np.r_[0, np.cumsum(taken)]
                prefix_keys += _fingerprints(first, ends)
                packed = memoryview(_packed(first))
                prefixes += [
                    bytes(packed[6 * i : 6 * j]) for i, j in zip(ends, ends[1:], strict=False)
                ]
                sizes.append(n)
            columns = [
                pa.array(np.concatenate(sizes) if sizes else [], pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array(prefix_keys, pa.binary()),
                pa.array(prefixes, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return texts.mapInArrow(tidy(run), schema)


def _sets_of(texts: DataFrame, shared) -> DataFrame:
    """(set_key, shingles) of the texts whose ``id_hash`` passes the broadcast filter
    ``shared``; a set that a task meets again, it leaves out."""
    schema = StructType(
        [
            StructField("set_key", BinaryType()),
            StructField("shingles", BinaryType()),
        ]
    )

    def run(batches):
        powers, seen = Powers(), set()
        for batch in batches:
            hashes = np.asarray(batch.column(0), np.int64).view(np.uint64)
            some = batch.column(1).filter(pa.array(_passes(shared.value, hashes)))
            for _, texts_here, owner, h in _by_text(some, powers):
                bounds = np.searchsorted(owner, np.arange(texts_here + 1))
                keys = _fingerprints(h, bounds)
                full = []
                for i in np.flatnonzero(np.diff(bounds)):
                    if keys[i] not in seen:
                        seen.add(keys[i])
                        full.append(i)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[i] for i in full], pa.binary()),
                        pa.array([_packed(h[bounds[i] : bounds[i + 1]]) for i in full], pa.binary()),
                    ],
                    names=schema.names,
                )

    return texts.mapInArrow(tidy(run), schema)


# --- filters of bits, by the upper bits of 64-bit hashes --------------------------------


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - (len(bits).bit_length() - 1 + 3))
    byte = bits[(at >> np.uint64(3)).astype(np.int64)]
    return (byte >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _bit_slice(hashes, part, parts, bits):
    """Bytes of a filter's part with the bits of ``hashes`` set."""
    at = hashes >> np.uint64(64 - bits)
    marks = np.zeros((1 << bits) // parts, np.uint8)
    marks[(at - np.uint64(part * len(marks))).astype(np.int64)] = 1
    return np.packbits(marks, bitorder="little").tobytes()


_SLICE = StructType([StructField("part", LongType()), StructField("bits", BinaryType())])


def _gathered(parts_of_filter: DataFrame, bits: int, parts: int) -> np.ndarray:
    """The whole filter on the driver: its size is fixed by ``bits``."""
    whole = np.zeros((parts, (1 << (bits - 3)) // parts), np.uint8)
    for row in parts_of_filter.collect():
        whole[row.part] = np.frombuffer(row.bits, np.uint8)
    return whole.ravel()


def _hash_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """Filter that all values of a column of 64-bit hashes pass."""
    parts = 64
    part = F.shiftrightunsigned("h", 64 - 6).cast("long")
    dealt = hashes.toDF("h").distinct().withColumn("part", part)
    dealt = dealt.repartition("part")

    def run(batches):
        found = {}
        for batch in batches:
            hashes = np.asarray(batch.column(0), np.int64).view(np.uint64)
            numbers = np.asarray(batch.column(1), np.int64)
            for number in np.unique(numbers):
                if number not in found:
                    found[number] = np.zeros((1 << (bits - 3)) // parts, np.uint8)
                new = _bit_slice(hashes[numbers == number], int(number), parts, bits)
                found[number] |= np.frombuffer(new, np.uint8)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(x) for x in found], pa.int64()),
                pa.array([x.tobytes() for x in found.values()], pa.binary()),
            ],
            names=_SLICE.names,
        )

    return _gathered(dealt.mapInArrow(tidy(run), _SLICE), bits, parts)


def _shared_filter(prefixes: DataFrame, tokens: int) -> np.ndarray:
    """Filter that every shingle found in the prefixes of two texts or more passes.

    Tasks send their prefix shingles packed, sorted and without repetition, to parts by the
    upper bits; those that a task has met twice are marked, so however many texts share a
    shingle, a part gets it once from each buffer of a task.
    """
    bits = _bits_for(2 * tokens, SHARED_BITS, MOST_SHARED_BITS)
    parts = 1
    while parts * PART_TOKENS < tokens and parts < 1 << (bits - 3):
        parts *= 2
    schema = StructType(
        [
            StructField("part", LongType()),
            StructField("once", BinaryType()),
            StructField("twice", BinaryType()),
        ]
    )
    # A part gets the 32 bits that follow its own.
    own_bits = parts.bit_length() - 1

    def send(buffer):
        h, counts = np.unique(_unpacked(b"".join(buffer)), return_counts=True)
        again = counts > 1
        cuts = np.arange(1, parts, dtype=np.uint64) << np.uint64(64 - own_bits) if own_bits else []
        pieces = []
        for some in (h[~again], h[again]):
            bounds = np.r_[0, np.searchsorted(some, cuts), len(some)]
            small = (some >> np.uint64(32 - own_bits)).astype(np.uint32)
            pieces.append([small[i:j] for i, j in zip(bounds, bounds[1:], strict=False)])
        used = [i for i in range(parts) if len(pieces[0][i]) or len(pieces[1][i])]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int64()),
                *(pa.array([p[i].tobytes() for i in used], pa.binary()) for p in pieces),
            ],
            names=schema.names,
        )

    def deal(batches):
        buffer, size = [], 0
        for batch in batches:
            for prefix in batch.column(0):
                buffer.append(prefix.as_py())
                size += len(buffer[-1]) // 6
                if size >= BUFFER_TOKENS:
                    yield send(buffer)
                    buffer, size = [], 0
        if size:
            yield send(buffer)

    def find(batches):
        part, once, twice = None, [], []

        def result():
            h = np.sort(np.concatenate(once))
            again = np.unique(np.concatenate([*twice, h[1:][h[1:] == h[:-1]]]))
            again = again.astype(np.uint64) << np.uint64(32 - own_bits)
            if own_bits:
                again |= np.uint64(part) << np.uint64(64 - own_bits)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int64()),
                    pa.array([_bit_slice(again, part, parts, bits)], pa.binary()),
                ],
                names=_SLICE.names,
            )

        for batch in batches:
            for number, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number != part:
                    if part is not None:
                        yield result()
                    part, once, twice = number, [], []
                # A shingle marked by one task is sent as met once, too, for the others.
                twice.append(np.frombuffer(b, np.uint32))
                once += [np.frombuffer(a, np.uint32), twice[-1]]
        if part is not None:
            yield result()

    dealt = prefixes.mapInArrow(tidy(deal), schema).repartition("part").sortWithinPartitions("part")
    return _gathered(dealt.mapInArrow(tidy(find), _SLICE), bits, parts)


def _postings(rows: DataFrame, shared) -> DataFrame:
    """(row, n, tokens, places): the prefix shingles of each row that pass the broadcast filter
    ``shared``."""
    schema = "row long, n long, tokens array<long>, places array<int>"

    def run(batches):
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            prefixes = batch.column(2).to_pylist()
            offsets = np.r_[0, np.cumsum([len(prefix) // 6 for prefix in prefixes])]
            h = _unpacked(b"".join(prefixes))
            kept = np.flatnonzero(_passes(shared.value, h))
            owner = np.searchsorted(offsets, kept, "right") - 1
            place = (kept - offsets[owner]).astype(np.int32)
            starts = np.searchsorted(owner, np.arange(len(prefixes) + 1)).astype(np.int32)
            numbers = (h[kept] >> np.uint64(16)).astype(np.int64)
            tokens = pa.ListArray.from_arrays(pa.array(starts), pa.array(numbers))
            places = pa.ListArray.from_arrays(pa.array(starts), pa.array(place))
            full = pa.array(np.diff(starts) > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), tokens, places],
                names=["row", "n", "tokens", "places"],
            ).filter(full)

    return rows.select("row", "n", "prefix").mapInArrow(tidy(run), schema)


# --- verification -------------------------------------------------------------------


def _least_overlap(na, nb):
    return F.ceil((na + nb) * F.lit(PERCENT) / F.lit(100 + PERCENT) - F.lit(1e-6))


def _possible(na, nb, place_a, place_b):
    """Whether two sets whose first common shingle is at these places can reach the threshold:
    by their sizes, and by all that lies behind it."""
    smaller, larger = F.least(na, nb), F.greatest(na, nb)
    behind = F.least(na - place_a, nb - place_b)
    return (smaller * 100 >= larger * PERCENT) & (behind >= _least_overlap(na, nb))


def _enough(na, nb, common):
    """Whether two sets with ``common`` shingles in both prefixes can reach the threshold.

    Of the prefix that ends first in the order of shingles, everything shared up to its end
    is in both prefixes; what is left of that set is all that can still be shared.
    """
    behind = F.ceil(F.greatest(na, nb) * F.lit(PERCENT) / F.lit(100) - F.lit(1e-6)) - 1
    in_size = F.least(na, nb) * 100 >= F.greatest(na, nb) * PERCENT
    return in_size & (common + behind >= _least_overlap(na, nb))


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the (a, b) pairs of classes whose whole sets reach the threshold, written.

    Sets are made again from the texts, for the texts of these classes only.
    """
    pairs = write_once(pairs, "jaccard-pairs")
    if pairs.isEmpty():
        return pairs
    nodes = pairs.select("a").union(pairs.select("b")).toDF("class").distinct()
    chosen = write_once(
        classes.join(nodes, "class", "left_semi").select("class", "set_key", "first_hash"),
        "jaccard-chosen",
    )
    context = texts.sparkSession.sparkContext
    passing = context.broadcast(_hash_filter(chosen.select("first_hash"), CHOSEN_BITS))
    sets = _sets_of(texts.select("id_hash", "text"), passing)
    # Texts that only passed by chance go. Rows that repeat an id may leave a class's set
    # once for each task, which repeats links and no more.
    sets = join_small(sets, chosen.select("class", "set_key"), "set_key")
    sets = sets.select("class", "shingles")
    # Both joins deal the same sets out by class, which Spark does once.
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")

    def run(batches):
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = _unpacked(x.as_buffer()), _unpacked(y.as_buffer())
                common = _overlap(x, y)
                linked.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    links = both.select("a", "b", "set_a", "set_b").mapInArrow(tidy(run), "a long, b long")
    links = write_once(links, "jaccard-links")
    passing.destroy()
    return links


def _overlap(x, y):
    """Number of common values of two sorted arrays of distinct values."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = len(y) - 1
    return int((y[at] == x).sum())


# --- the join -------------------------------------------------------------------------


def _size_step(n):
    """Number of a size's step; a larger size never has a smaller one."""
    return F.floor(F.log(n.cast("double")) * SIZE_STEPS).cast("int")


def _candidates(postings: DataFrame, spans: DataFrame) -> DataFrame:
    """(group_a, group_b): pairs of groups of different kin that could reach the threshold.

    ``postings`` has (group, n, token, place) of all shingles that groups share, ``spans``
    (group, kin). The set of ``a`` is the smaller, or as large with a smaller group number.
    """
    # Whether a set could find one no smaller by this shingle, as the first common one: what
    # lies behind it must be enough for two sets of its own size.
    left = F.col("n") - F.col("place")
    begins_search = left * (100 + PERCENT) >= F.col("n") * (2 * PERCENT)
    postings = postings.join(spans, "group").withColumn("finds", begins_search)
    postings = write_once(postings, "jaccard-kin")
    # Only shingles in groups of two kins or more matter, and there the groups of the most
    # frequent kin need not meet each other.
    kins = postings.groupBy("token", "kin").agg(
        F.count("*").alias("groups"), F.count_if("finds").alias("finders")
    )
    tokens = (
        kins.groupBy("token")
        .agg(
            F.count("*").alias("kins"),
            F.max_by("kin", F.struct("groups", "kin")).alias("major"),
            F.sum("finders").alias("finders"),
        )
        .where(F.col("kins") > 1)
        .drop("kins")
    )
    in_order = Window.partitionBy("group").orderBy("place")
    met_by = (
        postings.join(tokens, "token")
        .withColumn("before", F.lag("token").over(in_order))
        .withColumn("major", F.col("kin") == F.col("major"))
    )
    met_by = write_once(met_by, "jaccard-open")

    # The larger set looks among the sizes that the place of the shingle in it leaves possible.
    searched = met_by.where(F.col("finders") > 0)
    hot = F.col("finders") > HOT
    own_step = F.when(hot, _size_step(F.col("n"))).otherwise(0)
    least = F.ceil(F.col("n") * PERCENT / 100 - F.lit(1e-6))
    most = F.floor(left * (100 + PERCENT) / PERCENT + F.lit(1e-6)) - F.col("n")
    most = F.greatest(least, F.least(F.col("n"), most))
    steps = F.when(hot, F.sequence(_size_step(least), _size_step(most))).otherwise(
        F.array(F.lit(0))
    )
    parts = F.ceil(F.col("finders") / SPLIT)
    kept = ("group", "n", "place", "before", "kin")
    # Finders of the major kin meet the others only, finders of another kin meet all.
    meets = F.when(F.col("major"), F.array(F.lit(False))).otherwise(
        F.array(F.lit(False), F.lit(True))
    )
    finders = searched.where("finds").select(
        "token",
        own_step.alias("step"),
        F.pmod(F.xxhash64("group"), parts).alias("part"),
        F.explode(meets).alias("major"),
        *(F.col(name).alias(f"{name}_a") for name in kept),
    )
    found = searched.select(
        "token",
        "major",
        F.explode(steps).alias("step"),
        parts.alias("parts"),
        *(F.col(name).alias(f"{name}_b") for name in kept),
    ).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    # Two sets meet only where a run of shingles that follow each other in both begins, as
    # it does at their first common one.
    begins = ~F.col("before_a").eqNullSafe(F.col("before_b")) | F.col("before_a").isNull()
    smaller = (F.col("n_a") < F.col("n_b")) | (
        (F.col("n_a") == F.col("n_b")) & (F.col("group_a") < F.col("group_b"))
    )
    sides = (F.col(f"{name}_{side}") for name in ("n", "place") for side in ("a", "b"))
    met = (
        finders.join(found.drop("parts"), ["token", "step", "part", "major"])
        .where((F.col("kin_a") != F.col("kin_b")) & smaller & begins & _possible(*sides))
        .select("group_a", "group_b")
        .distinct()
    )
    lists = met_by.groupBy("group").agg(
        F.collect_list("token").alias("tokens"), F.first("n").alias("n")
    )
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return (
        met.join(lists.toDF("group_a", "tokens_a", "na"), "group_a")
        .join(lists.toDF("group_b", "tokens_b", "nb"), "group_b")
        .where(_enough(F.col("na"), F.col("nb"), common))
        .select("group_a", "group_b")
    )


def link_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, n_shingles, component_id) of every document.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a set holds the distinct runs of
    five words, or the whole sequence of fewer. Two documents link if their sets' overlap is
    at least 75 % of their union; component_id is the smallest id reachable by links.

    Null and empty texts and texts without words have n_shingles 0 and link with nothing. A
    null id is never the smallest of a component with other ids. Repeated rows are copies.
    Other columns are not looked at. An empty table gives an empty result.
    """
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(id_col)).alias("id_hash"),
        F.col(text_col).cast("string").alias("text"),
    )
    context = docs.sparkSession.sparkContext
    ranks = context.broadcast(bucket_ranks(texts.select("text")))
    rows = _prefixes(texts.select("id", "text"), texts.schema["id"].dataType, ranks)
    rows = write_once(rows.withColumn("row", F.monotonically_increasing_id()), "jaccard-rows")
    ranks.destroy()
    full = rows.where(F.col("n") > 0)

    # Classes of equal sets, and groups of classes with equal prefixes and sizes.
    classes = full.groupBy("set_key", "prefix_key", "n").agg(
        F.min("id").alias("first_id"), F.min("row").alias("row")
    )
    classes = classes.withColumn("class", F.monotonically_increasing_id())
    classes = write_once(classes, "jaccard-classes")
    first = classes.groupBy("prefix_key", "n").agg(F.min("class").alias("group"))
    classes = classes.join(first, ["prefix_key", "n"]).withColumn(
        "first_hash", F.xxhash64("first_id")
    )
    classes = write_once(classes.drop("prefix_key"), "jaccard-groups")

    # Prefix shingles that at least two groups share.
    tokens = full.agg(F.sum(F.octet_length("prefix") / 6)).first()[0] or 0
    shared = context.broadcast(_shared_filter(full.select("prefix"), int(tokens)))
    leaders = classes.where(F.col("class") == F.col("group")).select("row", "group")
    postings = _postings(full, shared).join(leaders, "row")
    postings = postings.select(
        "group",
        "n",
        F.size("tokens").alias("weight"),
        F.explode(F.arrays_zip("tokens", "places")).alias("t"),
    )
    token, place = F.col("t.tokens").alias("token"), F.col("t.places").alias("place")
    postings = postings.select("group", "n", "weight", token, place)
    postings = write_once(postings, "jaccard-postings")
    shared.destroy()
    # A shingle's centre is the set most of whose prefix is shared: of texts changed from a
    # common source, the one changed least. Sets with as much are ordered by a hash.
    by_hash = F.pmod(F.xxhash64("group"), F.lit(1 << 20))
    most_shared = F.col("weight").cast("long") * (1 << 20) + by_hash
    centres = (
        postings.groupBy("token")
        .agg(F.count("*").alias("sets"), F.max_by("group", most_shared).alias("centre"))
        .where(F.col("sets") > 1)
        .drop("sets")
    )
    postings = write_once(postings.drop("weight").join(centres, "token"), "jaccard-shared")

    # First round: every set against one centre of its shingles, the one it shares most with.
    # Only the shingles that have this centre are counted, so half of what is needed will do.
    counted = (
        postings.where(F.col("group") != F.col("centre"))
        .groupBy(F.col("group").alias("a"), F.col("centre").alias("b"))
        .agg(F.count("*").alias("common"), F.first("n").alias("na"))
    )
    centre_sizes = classes.select(F.col("class").alias("b"), F.col("n").alias("nb"))
    stars = (
        counted.join(centre_sizes, "b")
        .where(_enough(F.col("na"), F.col("nb"), F.col("common") * 2))
        .groupBy("a")
        .agg(F.max_by("b", F.struct("common", -F.col("b"))).alias("b"))
    )
    members = classes.where(F.col("class") != F.col("group"))
    members = members.select(F.col("class").alias("a"), F.col("group").alias("b"))
    links = _verified(stars.union(members), classes, texts)
    roots = connected_components(links)

    # Second round: candidates that are still in different components.
    placed = classes.join(roots.withColumnRenamed("node", "class"), "class", "left")
    placed = placed.select(
        "class", "group", "n", F.coalesce("root", "class").alias("root")
    )
    placed = write_once(placed, "jaccard-placed")
    # A group's kin is the component of all its classes, or its own where they have several.
    one_root = F.min("root") == F.max("root")
    spans = placed.groupBy("group").agg(
        F.when(one_root, F.min("root")).otherwise(-1 - F.col("group")).alias("kin")
    )
    across = _candidates(postings.drop("centre"), spans)
    # Only now are the groups of a pair expanded into their classes.
    for side in ("a", "b"):
        classes_of = placed.select(
            F.col("group").alias(f"group_{side}"),
            F.col("class").alias(side),
            F.col("root").alias(f"root_{side}"),
        )
        across = across.join(classes_of, f"group_{side}")
    across = across.where(F.col("root_a") != F.col("root_b")).select("a", "b")
    # Classes of one group that share no other group's shingle meet here.
    inside = placed.join(spans.where(F.col("kin") < 0), "group")
    left, right = (
        inside.select("group", "n", F.col("class").alias(side), F.col("root").alias(f"root_{side}"))
        for side in ("a", "b")
    )
    inner = left.join(right, ["group", "n"]).where(F.col("root_a") < F.col("root_b"))
    more = _verified(across.union(inner.select("a", "b")), classes, texts)
    if not more.isEmpty():
        roots = connected_components(links.union(more))

    named = classes.join(roots.withColumnRenamed("node", "class"), "class", "left")
    named = named.select("set_key", "first_id", F.coalesce("root", "class").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_key = write_once(
        named.join(smallest, "root").select("set_key", "component_id"), "jaccard-components"
    )
    linked = full.select("id", "n", "set_key").join(by_key, "set_key")
    empty = rows.where(F.col("n") == 0)
    return linked.select("id", "n", "component_id").union(
        empty.select("id", "n", F.col("id"))
    ).toDF(id_col, "n_shingles", "component_id")
