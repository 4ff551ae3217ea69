"""Byte-level BPE through a sentencepiece model serialised from the rank vocabulary.

Nothing is trained. Each byte string of the vocabulary becomes a piece of one character
per byte, scored by its negative rank: sentencepiece merges the pair whose piece scores
highest, leftmost first, which is the rule "lowest rank first" of rank tokenizers. The
normaliser is the identity without dummy prefix, blank removal or blank escape. A piece's
id is its rank; the unknown piece that the format demands takes the first id after the
ranks and is never produced, as all 256 bytes are pieces.

Texts are split by the tokenizer's pattern and every match is encoded separately. The
work is per row, so partitions are those of the scan, nothing is shuffled, and a worker
holds one model and a bounded table of pre-tokens it has met.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from carelake.llm.common import table

VOCABULARY = "byte_bpe_50k.tiktoken"
REMEMBERED = 400_000  # pre-tokens a worker keeps; the table is emptied beyond


def byte_alphabet() -> str:
    """256 characters: a printable Latin-1 byte is itself, the rest follow from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in shown else spare))
        spare += byte not in shown
    return "".join(letters)


ALPHABET = byte_alphabet()


def read_ranks(path: str) -> list[bytes]:
    """Byte strings by rank, from lines of base64 and rank."""
    with open(path, "rb") as lines:
        pairs = sorted((int(rank), base64.b64decode(piece)) for piece, rank in map(bytes.split, lines))
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must run from 0 without gaps")
    return [piece for _, piece in pairs]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def serialise(pieces: list[bytes]) -> bytes:
    """The sentencepiece ModelProto of a byte-level rank vocabulary."""

    def piece(text: str, score: float, kind: int) -> bytes:
        body = _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind)
        return _block(1, body)

    normal, unknown, bpe = 1, 2, 2
    vocabulary = b"".join(
        piece(p.decode("latin-1").translate(ALPHABET), -float(rank), normal) for rank, p in enumerate(pieces)
    ) + piece("<unk>", 0.0, unknown)
    none = -1
    trainer = (
        _number(3, bpe) + _number(4, len(pieces) + 1) + _number(40, len(pieces))
        + _number(41, none) + _number(42, none) + _number(43, none)
    )
    normaliser = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return vocabulary + _block(2, trainer) + _block(3, normaliser)


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.met: dict[str, bytes] = {}
        inverse = {letter: byte for byte, letter in enumerate(ALPHABET)}
        n = self.model.get_piece_size() - 1  # without the unknown piece
        self.bytes_of = [bytes(inverse[c] for c in self.model.id_to_piece(i)) for i in range(n)]
        self.whole = {p: i for i, p in enumerate(self.bytes_of)}

    def learn(self, tokens: set[str]) -> None:
        if len(self.met) > REMEMBERED:
            self.met.clear()
        fresh = [t for t in tokens if t not in self.met]
        raw = [t.encode() for t in fresh]
        ids = self.model.encode([r.decode("latin-1").translate(ALPHABET) for r in raw], num_threads=1) if raw else []
        for token, r, found in zip(fresh, raw, ids):
            direct = self.whole.get(r)  # a pre-token that is a vocabulary entry is that entry
            found = found if direct is None else [direct]
            self.met[token] = struct.pack(f"<{len(found)}I", *found)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        tokens = self.split(text or "")
        self.learn(set(tokens))
        return b"".join(map(self.met.__getitem__, tokens))

    def decode(self, ids: bytes | None) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids or b"").cast("I")))


def _column(frame: DataFrame, codec, arguments, name: str, source: str, work) -> DataFrame:
    kept = [f for f in frame.schema if f.name != name]
    schema, kept = StructType([*kept, StructField(name, BinaryType())]), [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(*arguments())
        for batch in batches:
            values = [work(coder, v.as_py()) for v in batch.column(source)]
            rest = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(values, pa.binary())], [*kept, name])

    return frame.mapInArrow(run, schema)


class ByteBpe:
    """encode and decode add a binary column to a frame; ids are little-endian uint32.

    A null or empty text has no ids, null or empty ids give no bytes. Rows keep their
    other columns; a column of the new one's name is replaced. Decoding an encoding gives
    the text's UTF-8 bytes for every text. Only 50 thousand pieces (about 1 MB) travel to
    the workers, whatever the corpus.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        model = spark.sparkContext.broadcast(serialise(read_ranks(path)))
        self.arguments = lambda: (model.value, pattern)

    def encode(self, frame: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
        return _column(frame, Codec, self.arguments, ids, text, Codec.encode)

    def decode(self, frame: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
        return _column(frame, Codec, self.arguments, decoded, ids, Codec.decode)


def standard(spark: SparkSession) -> ByteBpe:
    import public_tokenizers

    return ByteBpe(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document; a null text counts as empty."""
    bpe = standard(spark)
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return digests(bpe.decode(ids))
