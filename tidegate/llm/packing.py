"""Best-two-fit packing of tokenised documents into sequences of CAPACITY tokens.

A bin is filled greedily with the longest pieces that fit; then its smallest piece gives way to the
two unpacked pieces that fill the widened gap best, if they fill it better. Pieces of one length
are interchangeable, so the bins follow from the number of pieces of each length: at most CAPACITY
numbers reach the driver, whatever the size of the corpus, and a bin is repeated as often as the
lengths last. Each piece then finds its bin by its rank among the pieces of its length. Ranks are
counted in salted parts, so a length that a third of all pieces have is no hot key.

Tokenising is most of the work; its results are kept as a small table that is read twice.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.common import emitted, rows, saved

CAPACITY = 2048
END_ID = 0
#: Characters that every version of the tokenizer's cutting rule takes for the same kind. Texts with
#: others are encoded by the tokenizer itself.
_PLAIN = re.compile(
    "[\t\n\r -~\xa1-\u024f\u0400-\u04ff\u2010-\u2027\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]*"
)

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
PIECES_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes stand
    for themselves, the others for the letters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Texts to little-endian 32-bit ids.

    The ids are those of the tokenizer file. Its vocabulary lists the pieces in the order of their
    merges, so the same ids come from a byte-pair encoder over that order, four times as fast.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.special = sorted(special)
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        self.fast = tiktoken.Encoding(
            "vocabulary",
            # the cutting rule of byte-level vocabularies, a fixed value
            pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
            mergeable_ranks={
                bytes(byte_of[letter] for letter in piece): number
                for piece, number in self.tokenizer.get_vocab().items()
                if piece not in special
            },
            special_tokens={},
        )

    def ids(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text) or any(special in text for special in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, bytes]]:
    """start and ids of each piece: whole pieces at the end, the rest first."""
    n = len(ids) // 4
    first = n if n <= capacity else n % capacity or capacity
    yield 0, ids[: 4 * first]
    for start in range(first, n, capacity):
        yield start, ids[4 * start : 4 * (start + capacity)]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32."""
    end = np.array([END_ID], "<u4").tobytes()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encode = encoder(tokenizer_path).ids
        for doc_id, text in rows(batches, "doc_id", "text"):
            ids = encode(text or "") + end
            for piece, (start, part) in enumerate(cut(ids, capacity)):
                yield doc_id, piece, start, len(part) // 4, zlib.crc32(part)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from emitted(PIECES, found(batches))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(task, PIECES_SQL)


def fill(left: np.ndarray, capacity: int) -> dict[int, int]:
    """One bin as {length: uses}, from ``left`` pieces of each length."""
    sizes = np.flatnonzero(left)
    uses: dict[int, int] = {}
    gap = capacity
    at = len(sizes) - 1
    while at >= 0 and gap:
        at = min(at, int(np.searchsorted(sizes, gap, "right")) - 1)
        if at < 0:
            break
        size = int(sizes[at])
        uses[size] = min(int(left[size]), gap // size)
        gap -= size * uses[size]
        at -= 1
    least = min(uses)
    rest = left[sizes].copy()
    rest[np.searchsorted(sizes, list(uses))] -= list(uses.values())
    sizes, rest = sizes[rest > 0], rest[rest > 0]
    if gap and len(sizes):
        room = gap + least
        other = np.searchsorted(sizes, room - sizes, "right") - 1
        other -= (other >= 0) & (sizes[other] == sizes) & (rest[other] < 2)
        both = np.where(other >= 0, sizes + sizes[other], 0)
        best = int(both.argmax())
        if both[best] > least:
            uses[least] -= 1
            for size in (int(sizes[best]), int(sizes[other[best]])):
                uses[size] = uses.get(size, 0) + 1
    return {size: n for size, n in uses.items() if n}


class Layout:
    """Which sequence and offset the r-th piece of each length gets."""

    def __init__(self, counts: dict[int, int], capacity: int):
        left = np.zeros(capacity + 1, np.int64)
        left[list(counts)] = list(counts.values())
        rank = np.zeros(capacity + 1, np.int64)
        slots = []
        self.sequences = 0
        while left.any():
            uses = fill(left, capacity)
            times = min(int(left[size]) // n for size, n in uses.items())
            offset = 0
            for size, n in uses.items():
                for _ in range(n):
                    slots.append((size, int(rank[size]), self.sequences, offset))
                    rank[size] += times
                    offset += size
                left[size] -= n * times
            self.sequences += times
        slots.sort()
        table = np.array(slots, np.int64).reshape(-1, 4)
        self.key = (table[:, 0] << 48) + table[:, 1]
        self.rank, self.sequence, self.offset = table[:, 1], table[:, 2], table[:, 3]

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = np.searchsorted(self.key, (length << 48) + rank, "right") - 1
        return self.sequence[slot] + rank - self.rank[slot], self.offset[slot]


def pack(
    spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row for each piece.

    Every row of ``docs`` is packed, repeated rows and NULL ids too. NULL and empty texts are just
    the end id. Only documents longer than a sequence are cut. No rows give no rows.
    """
    cut_up = saved(spark, pieces(docs, tokenizer_path, capacity), "pieces")
    # at most `capacity` rows
    counts = {row["length"]: row["n"] for row in cut_up.groupBy("length").agg(F.count("*").alias("n")).collect()}
    layout = spark.sparkContext.broadcast(Layout(counts, capacity))
    # about as many parts of a length as pieces in a part
    parts = spark.createDataFrame(
        [(size, int(np.ceil(n**0.5))) for size, n in counts.items()], "length long, parts int"
    )
    salted = cut_up.join(F.broadcast(parts), "length").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("parts"))
    )
    sizes = salted.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part")
    offsets = sizes.select(
        "length", "part", (F.sum("n").over(before) - F.col("n")).alias("before")
    )
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("r", F.row_number().over(within) - 1)
        .join(offsets, ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("r"))
        .select(*PIECES.names, "rank")
    )
    schema = PIECES.append(pa.field("sequence_id", pa.int64())).append(pa.field("offset", pa.int64()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            sequence, offset = layout.value.place(length, rank)
            columns = [batch.column(n) for n in PIECES.names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)], schema=schema
            )

    return ranked.mapInArrow(task, PIECES_SQL + ", sequence_id long, offset long")
