"""SentencePiece encoding and decoding by a table of distinct marked words.

The tokenizer writes white space as a marker, and puts one before the text. If no piece of
its vocabulary holds a marker behind another character, no merge can cross from a word to
the marker of the next. A text then falls into marked words (a run of markers and the
characters up to the next marker) whose ids do not depend on each other. Each distinct
marked word is segmented once by the library and looked up for each of its places; the ids
of a text are those of its marked words in order, and likewise the decoded text.
"""

import hashlib
from pathlib import Path

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tractscope.llm.words import tidy

MARK = "▁"
# Size of the table at which a task starts it anew, and characters looked up at once; both
# bound memory and change no result.
TABLE_BYTES = 24 << 20
GROUP_CHARS = 1 << 19


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load(model: bytes):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def words_are_independent(model: bytes) -> bool:
    """Whether marked words can be segmented alone: no piece crosses a marker, the text is
    not rewritten, and a marker is put before it."""
    processor = load(model)
    spec = processor.serialized_model_proto()
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(spec)
    crossing = any(
        a != MARK and b == MARK
        for piece in proto.pieces
        if piece.type in (1, 4)
        for a, b in zip(piece.piece, piece.piece[1:], strict=False)
    )
    norm = proto.normalizer_spec
    plain = not norm.precompiled_charsmap and not norm.remove_extra_whitespaces
    return plain and norm.add_dummy_prefix and norm.escape_whitespaces and not crossing


class PieceTable:
    """Marked words already segmented: ids as text, and decoded texts that differ from the
    word."""

    def __init__(self, model: bytes, limit=None):
        self.processor = load(model)
        self.mark_id = self.processor.piece_to_id(MARK)
        self.limit = TABLE_BYTES if limit is None else limit
        self.ids, self.decoded, self.bytes = {}, {}, 0

    def learn(self, words: list[str]) -> None:
        """Segment marked words, each given without its first marker, in one library call.

        The library puts that marker back. It gives no ids to an empty text, so a lone
        marker is its own piece. Decoding drops one marker at the front, as of a text.
        """
        found = self.processor.encode(words, num_threads=1)
        found = [ids or [self.mark_id] for ids in found]
        decoded = self.processor.decode(found, num_threads=1)
        for word, ids, text in zip(words, found, decoded, strict=True):
            self.ids[word] = ",".join(map(str, ids))
            if text != word:
                self.decoded[word] = text
            self.bytes += 200 + 6 * len(word)

    def joined(self, texts: list[str]) -> list[tuple[str, str]]:
        """For each text, its ids as text, joined by commas, and its decoded text."""
        split = [marked_words(text) for text in texts]
        distinct = set().union(*split)
        if self.bytes > self.limit:
            self.ids, self.decoded, self.bytes = {}, {}, 0
        self.learn([word for word in distinct if word not in self.ids])
        ids_of, decoded = self.ids.__getitem__, self.decoded
        # Each marked word but the first gets the space back that decoding dropped.
        return [
            (
                ",".join(map(ids_of, words)),
                " ".join([decoded.get(word, word) for word in words] if decoded else words),
            )
            for words in split
        ]


def marked_words(text: str) -> list[str]:
    """A text's marked words, each without its first marker."""
    if not text:
        return []
    words = text.replace(MARK, " ").split(" ")
    return merged(words) if "" in words else words


def merged(words: list[str]) -> list[str]:
    """Runs of markers joined to the word behind them (or a run of their own at the end)."""
    out, markers = [], 0
    for word in words[:-1]:
        if word:
            out.append(" " * markers + word)
            markers = 0
        else:
            markers += 1
    out.append(" " * markers + words[-1])
    return out


def _map_texts(docs, text_col, keep, model, fields, row_of):
    kept = docs.select(*keep)
    schema = StructType([*kept.schema.fields, *fields])
    path = model or default_model()
    proto = Path(path).read_bytes()
    if not words_are_independent(proto):
        raise ValueError(f"pieces of {path} can cross white space")
    shared = docs.sparkSession.sparkContext.broadcast(proto)

    def run(batches):
        table = PieceTable(shared.value)

        def encoded(batch):
            rows = []
            for texts in groups(batch.columns[-1]):
                rows += map(row_of, table.joined(texts))
            columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
            values = [
                pa.array(list(column), _arrow_type(field))
                for column, field in zip(columns, fields, strict=True)
            ]
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], *values], names=schema.names)

        return map(encoded, batches)

    source = docs.select(*keep, F.col(text_col).cast("string").alias("text_to_encode"))
    return source.mapInArrow(tidy(run), schema)


def groups(texts: pa.Array):
    """The texts in lists of about GROUP_CHARS characters; null is empty."""
    group, size = [], 0
    for text in texts:
        group.append(text.as_py() or "")
        size += len(group[-1])
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _arrow_type(field):
    kinds = {LongType(): pa.int64(), StringType(): pa.string()}
    return kinds.get(field.dataType, pa.list_(pa.int32()))


def encode(
    docs: DataFrame, text_col="text", keep=("doc_id",), model: str | None = None
) -> DataFrame:
    """``keep`` columns and ``ids``, the ids of every whole text, without begin or end ids.

    Null and empty texts have no ids. The model file is read on the driver and sent to the
    tasks (half a megabyte). Each task holds its own table, emptied when it reaches
    ``TABLE_BYTES``; a task that is lost is simply run again.
    """
    fields = [StructField("ids", ArrayType(IntegerType(), False))]

    def row_of(found):
        return ([int(i) for i in found[0].split(",")] if found[0] else [],)

    return _map_texts(docs, text_col, keep, model, fields, row_of)


def decode(
    encoded: DataFrame, ids_col="ids", keep=("doc_id",), model: str | None = None
) -> DataFrame:
    """``keep`` columns and ``text``, what the library decodes from each row's ids.

    Null and no ids give an empty text.
    """
    schema = StructType([*encoded.select(*keep).schema.fields, StructField("text", StringType())])
    proto = Path(model or default_model()).read_bytes()
    shared = encoded.sparkSession.sparkContext.broadcast(proto)

    def run(batches):
        processor = load(shared.value)
        for batch in batches:
            texts = [processor.decode(ids.as_py() or []) for ids in batch.columns[-1]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names
            )

    return encoded.select(*keep, F.col(ids_col).alias("ids_to_decode")).mapInArrow(tidy(run), schema)


def round_trip(
    docs: DataFrame, text_col="text", keep=("doc_id",), model: str | None = None
) -> DataFrame:
    """``keep``, ``n_tokens``, and SHA-256 of the ids (joined by commas) and of the decoded text.

    Ids and decoded text are put together from the same table of marked words and are not
    stored.
    """
    fields = [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]

    def row_of(found):
        ids, text = found
        return (
            ids.count(",") + 1 if ids else 0,
            hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        )

    return _map_texts(docs, text_col, keep, model, fields, row_of)
