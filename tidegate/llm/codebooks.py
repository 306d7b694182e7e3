"""Vector codes: each of 16 parts of a vector is named by the nearest entry of that part's codebook.

Vectors are kept as integers in chunks. Within a chunk every part position has its own order, along
a Hilbert curve, cut into flat blocks of neighbours that store the box around their parts (least
and greatest components) and the sum of them. A round compares 64 entries with boxes instead of
vectors: an entry whose least distance to a box is beyond another's greatest distance can be
nearest to nothing in it. A block with one entry left is counted by its stored sum; in the others
the few entries left are compared exactly, in integers.

Everything a round needs is in its chunk, so no vector is shuffled: a round is a pass over the
chunks that brings back a count and sums for each entry, whatever the number of vectors. Chunks are
cut by rows, so copies of one vector are no hot key; copies lie in the same blocks, whose boxes are
points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import emitted, saved
from tidegate.llm.vectors import usable
from tidegate.session import scratch_path

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Vectors in a block, and bytes of single precision in a chunk.
BLOCK = 32
CHUNK_BYTES = 4 << 20
#: Chunks a reader decodes at once.
CHUNKS_PER_ROW_GROUP = 4
#: The greatest magnitude of a single-precision number; components beyond it take no part.
GREATEST = float(np.finfo(np.float32).max)
_LOW_BITS = 60

CHUNK_SQL = (
    "vec_ids {id}, labels {label}, kind string, parts binary, places binary, "
    "least binary, greatest binary, sums binary"
)
TOTALS = pa.schema(
    [("part", pa.int32()), ("entry", pa.int32()), ("at", pa.int32()), ("n", pa.int64()),
     ("high", pa.decimal128(38, 0)), ("low", pa.decimal128(38, 0))]
)
TOTALS_SQL = "part int, entry int, at int, n long, high decimal(38,0), low decimal(38,0)"


def hilbert(points: np.ndarray) -> np.ndarray:
    """Place of each point on a Hilbert curve through the box around all of them.

    As many bits a dimension as fit 62, eight at most; dimensions beyond 62 are left out. This is an
    order only: nothing but the tightness of blocks depends on it.
    """
    points = points[:, :62].astype(float)
    n, width = points.shape
    bits = max(1, min(8, 62 // max(width, 1)))
    low, high = points.min(0), points.max(0)
    span = np.where(high > low, high - low, 1.0)
    x = np.minimum((points - low) / span * 2**bits, 2**bits - 1).astype(np.uint64).T.copy()
    # axes to the curve's transposed index: undo the excess work of each bit, then Gray-encode
    for bit in range(bits - 1, 0, -1):
        q = np.uint64(1 << bit)
        low_bits = q - np.uint64(1)
        for i in range(width):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, np.uint64(0), (x[0] ^ x[i]) & low_bits)
            x[0] ^= np.where(set_, low_bits, swap)
            x[i] ^= swap
    for i in range(1, width):
        x[i] ^= x[i - 1]
    flip = np.zeros(n, np.uint64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[width - 1] >> np.uint64(bit)) & np.uint64(1), np.uint64((1 << bit) - 1), np.uint64(0))
    x ^= flip
    place = np.zeros(n, np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(width):
            place = (place << np.uint64(1)) | ((x[i] >> np.uint64(bit)) & np.uint64(1))
    return place


def kind_of(values: np.ndarray) -> str:
    """The smallest form that holds the integers of a chunk; doubles where they pass 32 bits."""
    most = float(np.abs(values).max(initial=0))
    return "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"


def exact(values: np.ndarray, small: bool) -> np.ndarray:
    """As 64-bit integers, or as Python's where squares of differences would pass them."""
    if small:
        return values.astype(np.int64)
    return np.array([int(v) for v in values.ravel()], object).reshape(values.shape)


def is_small(width: int, *values: np.ndarray) -> bool:
    """Whether squared distances of vectors with ``width`` components fit 63 bits."""
    most = max(float(abs(v).max()) if v.size else 0.0 for v in values)
    return width * (2 * most + 1) ** 2 < 2.0**62


class Chunk:
    """Vectors with, for each part position, their order, blocks, boxes and sums."""

    def __init__(self, kind: str, parts: bytes, places: bytes, least: bytes, greatest: bytes, sums: bytes):
        self.places = np.frombuffer(places, "<i4").reshape(PARTS, -1)
        n = self.places.shape[1]
        self.parts = np.frombuffer(parts, kind).reshape(PARTS, n, -1)
        blocks = -(-n // BLOCK)
        self.least, self.greatest = (
            np.frombuffer(side, kind).reshape(PARTS, blocks, -1) for side in (least, greatest)
        )
        self.sums = np.frombuffer(sums, "<i8").reshape(PARTS, blocks, -1) if sums else None

    @staticmethod
    def pack(values: np.ndarray) -> tuple:
        """kind, parts, places, least, greatest, sums of integer-valued rows."""
        n, width = values.shape
        kind = kind_of(values)
        cut = values.reshape(n, PARTS, width // PARTS).transpose(1, 0, 2)
        places = np.stack([np.argsort(hilbert(part), kind="stable") for part in cut])
        ordered = np.take_along_axis(cut, places[:, :, None], 1).astype(kind)
        starts = np.arange(0, n, BLOCK)
        least = np.minimum.reduceat(ordered, starts, 1)
        greatest = np.maximum.reduceat(ordered, starts, 1)
        sums = b""
        if kind != "<f8":
            sums = np.add.reduceat(ordered.astype("<i8"), starts, 1).tobytes()
        return kind, ordered.tobytes(), places.astype("<i4").tobytes(), least.tobytes(), greatest.tobytes(), sums

    def shortlists(self, books: np.ndarray) -> Iterator[tuple]:
        """part, block, its rows, the entries that can be nearest to some of them, all entries, and
        whether 64-bit integers do."""
        n = self.parts.shape[1]
        small = is_small(self.parts.shape[2] * PARTS, self.parts, books)
        for part, entries in enumerate(books):
            entries = exact(entries, small)
            least, greatest = exact(self.least[part], small), exact(self.greatest[part], small)
            nearest, farthest = box_distances(least, greatest, entries)
            listed = nearest <= farthest.min(1)[:, None]
            for block, chosen in enumerate(listed):
                where = slice(block * BLOCK, min(n, (block + 1) * BLOCK))
                yield part, block, where, np.flatnonzero(chosen), entries, small

    def totals(self, books: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> None:
        """Add the number and the sum of parts nearest to each entry."""
        for part, block, where, chosen, entries, small in self.shortlists(books):
            if len(chosen) == 1 and self.sums is not None:
                counts[part, chosen[0]] += where.stop - where.start
                sums[part, chosen[0]] += self.sums[part, block].astype(object)
                continue
            values = exact(self.parts[part, where], small)
            entry = chosen[distances(values, entries[chosen]).argmin(1)]
            for found in np.unique(entry):
                mine = entry == found
                counts[part, found] += int(mine.sum())
                sums[part, found] += values[mine].sum(0).astype(object)

    def codes(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entry of each part and the summed squared distance, by vector."""
        n = self.places.shape[1]
        code = np.zeros((n, PARTS), np.uint8)
        error = np.zeros(n, np.int64 if is_small(self.parts.shape[2] * PARTS, self.parts, books) else object)
        for part, _, where, chosen, entries, small in self.shortlists(books):
            values = exact(self.parts[part, where], small)
            found = distances(values, entries[chosen])
            best = found.argmin(1)
            rows = self.places[part, where]
            code[rows, part] = chosen[best]
            error[rows] += found[np.arange(len(best)), best]
        return code, error


def box_distances(least: np.ndarray, greatest: np.ndarray, entries: np.ndarray):
    """Squared distances of entries to the nearest and the farthest point of each box."""
    below = least[:, None] - entries[None]
    above = entries[None] - greatest[:, None]
    outside = np.maximum(np.maximum(below, above), 0)
    reach = np.maximum(abs(below), abs(above))
    return (outside * outside).sum(2), (reach * reach).sum(2)


def distances(values: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of each value to each entry, exactly."""
    gap = values[:, None] - entries[None]
    return (gap * gap).sum(2)


def common_width(vectors: DataFrame) -> int:
    """The commonest number of components, the greater of equally common ones; 0 without rows."""
    sizes = vectors.groupBy(F.size("embedding").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.orderBy(F.desc("n"), F.desc("width")).first()
    return found["width"] if found else 0


def integers(values: np.ndarray, width: int) -> np.ndarray:
    """floor(256 x) as integer-valued doubles, padded with zeros to whole parts."""
    scaled = np.floor(values.reshape(-1, width).astype(float) * SCALE)
    return np.pad(scaled, ((0, 0), (0, -width % PARTS)))


def chunks(kept: DataFrame, width: int) -> DataFrame:
    """The vectors in chunks of bounded size; see ``CHUNK_SQL``."""
    types = {f.name: f.dataType.simpleString() for f in kept.schema}
    schema = CHUNK_SQL.format(id=f"array<{types['vec_id']}>", label=f"array<{types['label']}>")
    limit = max(BLOCK, CHUNK_BYTES // (4 * width))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            ids, labels, vectors = (table.column(n).combine_chunks() for n in ("vec_id", "label", "embedding"))
            values = integers(vectors.flatten().to_numpy(), width)
            whole = pa.array([0, len(ids)], pa.int32())
            columns = [pa.ListArray.from_arrays(whole, column) for column in (ids, labels)]
            columns += [pa.array([value]) for value in Chunk.pack(values)]
            return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in CHUNK_SQL.split(", ")])

        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, limit - size)
                held.append(part)
                size += part.num_rows
                start += part.num_rows
                if size == limit:
                    yield packed()
                    held, size = [], 0
        if size:
            yield packed()

    return kept.mapInArrow(task, schema)


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    names = ("kind", "parts", "places", "least", "greatest", "sums")
    for batch in batches:
        for at in range(batch.num_rows):
            yield Chunk(*(batch.column(name)[at].as_py() for name in names))


def _next_books(stored: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: floor of the mean, unused entries as they were."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(books.shape[:2], np.int64)
        sums = np.zeros(books.shape, object)
        for chunk in _chunk_rows(batches):
            chunk.totals(books, counts, sums)

        def rows() -> Iterator[tuple]:
            for part, entry in np.argwhere(counts):
                for at, total in enumerate(sums[part, entry]):
                    high, low = int(total) >> _LOW_BITS, int(total) & ((1 << _LOW_BITS) - 1)
                    yield part, entry, at, counts[part, entry], high, low

        yield from emitted(TOTALS, rows())

    columns = ("kind", "parts", "places", "least", "greatest", "sums")
    partial = stored.select(*columns).mapInArrow(task, TOTALS_SQL)
    total = partial.groupBy("part", "entry", "at").agg(*(F.sum(n).alias(n) for n in ("n", "high", "low")))
    moved = books.copy()
    for row in total.collect():  # at most one for each component of the codebooks
        mean = ((int(row["high"]) << _LOW_BITS) + int(row["low"])) // row["n"]
        moved[row["part"], row["entry"], row["at"]] = mean
    return moved


def _codes(stored: DataFrame, books: np.ndarray, kinds: dict[str, str]) -> DataFrame:
    """vec_id, label, code, error."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, chunk in enumerate(_chunk_rows(iter([batch]))):
                code, error = chunk.codes(books)
                text = [bytes(row).hex() for row in code]
                fits = [int(e) if e < 1 << 63 else None for e in error]
                owners = [batch.column(n)[at].values for n in ("vec_ids", "labels")]
                yield pa.RecordBatch.from_arrays(
                    [*owners, pa.array(text, pa.string()), pa.array(fits, pa.int64())],
                    names=["vec_id", "label", "code", "error"],
                )

    return stored.mapInArrow(task, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()


def _in_single_range(column: str) -> Column:
    return usable(column) & F.coalesce(F.forall(column, lambda x: F.abs(x) <= F.lit(GREATEST)), F.lit(False))


def compress(spark: SparkSession, vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: a row for each vector that takes part.

    Vectors that are NULL or empty or hold NULL, non-finite or larger than single-precision components
    are dropped, and so are vectors that have not the commonest number of components. A number of components that
    16 does not divide is filled up with zeros. The codebooks start as the parts of the vectors with
    the least ids; of equal ids the lesser vector comes first, NULL ids come last; fewer vectors give
    smaller codebooks. Repeated rows are coded alike and each counts. Errors are exact; an error or a
    label's sum beyond 64 bits is NULL. Labels are compared as they are, whatever their type, NULLs
    together. Other columns are left out. No rows give no rows.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's number has two hex digits")
    kept = vectors.select("vec_id", "label", "embedding").filter(_in_single_range("embedding"))
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    width = common_width(kept)
    result = f"vec_id {kinds['vec_id']}, code string, error long, label_error long, codebooks_sha256 string"
    if not width:
        return spark.createDataFrame([], result)
    kept = kept.filter(F.size("embedding") == width)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    starts = exact(integers(np.array([row["embedding"] for row in first], float), width), False)
    books = starts.reshape(len(first), PARTS, -1).transpose(1, 0, 2).copy()

    path = scratch_path(spark, "chunks")
    packed = chunks(kept, width)
    # a row is some megabytes: a reader must not take thousands of them into one batch
    packed.write.option("parquet.block.row.count.limit", CHUNKS_PER_ROW_GROUP).parquet(path)
    stored = spark.read.schema(packed.schema).parquet(path)
    for _ in range(rounds):
        books = _next_books(stored, books)
    coded = saved(spark, _codes(stored, books, kinds), "codes")

    total = F.sum(F.col("error").cast("decimal(38,0)"))
    complete = F.count("error") == F.count(F.lit(1))
    by_label = coded.groupBy(F.col("label").alias("of")).agg(
        F.when(complete, total.try_cast("long")).alias("label_error")
    )
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256")
    )
