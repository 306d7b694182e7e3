"""Substring deduplication: Rabin-Karp hashes of every window of WINDOW words.

A word goes if a window over it also starts in a document with a smaller doc_id, so all a window's
hash needs is its least doc_id. Four steps keep that to one shuffle of hashes:

* A task hashes whole documents by the million words. Of windows that repeat within the task only
  those of the least document are sent on; the others are known to go. So a window that a third of
  all documents share is sent once a task, not once a document.
* Each window is keyed by the least hash of the 8-word runs in it. Equal windows have equal keys,
  and neighbouring windows mostly share theirs, so a row holds a run of some twenty windows: eight
  bytes each and one key.
* A phrase of many texts would gather all windows around it under one key. So windows are counted by
  key first, and those of keys with more than KEY_WINDOWS go on one by one, keyed by their own hash.
* Each key's windows meet, sorted, in one task, which answers with intervals of words. Overlapping
  intervals of a document merge into maximal ones when the text is cut.

The hash of a window is 64 bits of a polynomial in random 64-bit word hashes; n different windows
collide with probability n * n / 2 ** 65 in all (0.0003 for 100 million).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import emitted, rows, saved

WINDOW = 50
KEY_WORDS = 8
#: Words a task hashes together, and windows it compares together, to the end of a document or key.
UNIT_WORDS = 600_000
UNIT_WINDOWS = 600_000
#: Windows of a key that may meet in one task as runs.
KEY_WINDOWS = 100_000
#: An odd multiplier, so that its powers can be undone modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
LAST_ID = np.iinfo(np.int64).max

RUNS = pa.schema(
    [
        ("key", pa.int64()),
        ("doc_id", pa.int64()),
        ("tag", pa.int64()),
        ("start", pa.int32()),
        ("stop", pa.int32()),
        ("hashes", pa.binary()),
    ]
)
SPANS = pa.schema(
    [("doc_id", pa.int64()), ("tag", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())]
)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Rolling:
    """Powers of BASE and of its inverse, kept between units."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def hashes(self, words: np.ndarray, width: int) -> np.ndarray:
        """The hash of words[i : i + width] for every i."""
        n = len(words)
        if n < width:
            return np.zeros(0, np.uint64)
        if len(self.up) < n:
            step = np.full(n, BASE, np.uint64)
            back = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
            step[0] = back[0] = 1
            self.up, self.down = np.cumprod(step), np.cumprod(back)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * self.up[:n])))
        return mixed_bits((total[width:] - total[:-width]) * self.down[: n - width + 1])


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i : i + width]) for every i, from running minima of blocks in both directions."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    full = -(-len(x) // width) * width
    padded = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def runs_of(flags: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of each run of set flags; a run also ends before a position in ``breaks``."""
    starts = flags.copy()
    starts[1:] &= ~flags[:-1] | breaks[1:]
    ends = flags.copy()
    ends[:-1] &= ~flags[1:] | breaks[1:]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def first_of(values: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each position, the least rank among positions of an equal value."""
    order = np.lexsort((rank, values))
    ordered = values[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    least = np.empty(len(values), rank.dtype)
    least[order] = rank[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return least


def hashed_runs(unit: list[tuple], rolling: Rolling) -> Iterator[tuple]:
    """Runs to send on and, without hashes, spans already known to go."""
    unit.sort(key=lambda doc: LAST_ID if doc[0] is None else doc[0])
    lengths = np.array([len(doc[2]) for doc in unit])
    words = np.concatenate([doc[2] for doc in unit])
    doc = np.repeat(np.arange(len(unit)), lengths)
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    value = rolling.hashes(words, WINDOW)
    if not len(value):
        return
    n = len(value)
    at = np.flatnonzero(doc[:n] == doc[WINDOW - 1 :])  # windows that stay in a document
    if not len(at):
        return
    key = window_min(rolling.hashes(words, KEY_WORDS), WINDOW - KEY_WORDS + 1)[at].view(np.int64)
    value, doc, place = value[at], doc[at], at - first[at]
    ids = np.array([LAST_ID if d[0] is None else d[0] for d in unit], np.int64)[doc]
    goes = first_of(value, ids) < ids
    other = np.concatenate(([True], doc[1:] != doc[:-1]))
    for a, b in zip(*runs_of(goes, other)):
        doc_id, tag, _ = unit[doc[a]]
        # any key will do, but not one for all rows of a passage
        yield int(key[a]) ^ tag, doc_id, tag, int(place[a]), int(place[b - 1]) + WINDOW, None
    other[1:] |= key[1:] != key[:-1]
    raw = value.tobytes()
    for a, b in zip(*runs_of(~goes, other)):
        doc_id, tag, _ = unit[doc[a]]
        yield int(key[a]), doc_id, tag, int(place[a]), int(place[b - 1]) + WINDOW, raw[8 * a : 8 * b]


def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rolling, digest = Rolling(), xxhash.xxh3_64_intdigest

    def found() -> Iterator[tuple]:
        unit, n = [], 0
        for doc_id, tag, text in rows(batches, "doc_id", "tag", "text"):
            words = (text or "").encode().split()
            if len(words) < WINDOW:
                continue
            unit.append((doc_id, tag, np.fromiter(map(digest, words), np.uint64, len(words))))
            n += len(words)
            if n >= UNIT_WORDS:
                yield from hashed_runs(unit, rolling)
                unit, n = [], 0
        if unit:
            yield from hashed_runs(unit, rolling)

    yield from emitted(RUNS, found())


def count_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, n: windows to be sent on under a key."""
    for batch in send(batches):
        sizes = pc.divide(pc.binary_length(batch.column("hashes")), 8).cast(pa.int64())
        found = pa.RecordBatch.from_arrays([batch.column("key"), sizes], names=["key", "n"])
        yield found.filter(pc.is_valid(sizes))


def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a hot key become runs of one window, keyed by its hash."""

    def found() -> Iterator[tuple]:
        for *run, hot in rows(batches, *RUNS.names, "hot"):
            key, doc_id, tag, start, stop, hashes = run
            if not hot or hashes is None:
                yield tuple(run)
                continue
            for i, value in enumerate(np.frombuffer(hashes, np.int64).tolist()):
                yield value, doc_id, tag, start + i, start + i + WINDOW, hashes[8 * i : 8 * i + 8]

    yield from emitted(RUNS, found())


def compare(unit: list[tuple]) -> Iterator[tuple]:
    value = np.frombuffer(b"".join(run[3] for run in unit), np.uint64)
    sizes = np.array([len(run[3]) // 8 for run in unit])
    ids = np.array([LAST_ID if run[0] is None else run[0] for run in unit], np.int64)
    ids = np.repeat(ids, sizes)
    of = np.repeat(np.arange(len(unit)), sizes)
    first = np.cumsum(sizes) - sizes
    breaks = np.concatenate(([True], of[1:] != of[:-1]))
    for a, b in zip(*runs_of(first_of(value, ids) < ids, breaks)):
        doc_id, tag, start, _ = unit[of[a]]
        at = start + int(a - first[of[a]])
        yield doc_id, tag, at, at + int(b - a) - 1 + WINDOW


def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; a unit ends with a whole key."""

    def found() -> Iterator[tuple]:
        unit, n, last = [], 0, None
        for key, doc_id, tag, start, stop, hashes in rows(batches, *RUNS.names):
            if hashes is None:
                yield doc_id, tag, start, stop
                continue
            if n >= UNIT_WINDOWS and key != last:
                yield from compare(unit)
                unit, n = [], 0
            unit.append((doc_id, tag, start, hashes))
            n += len(hashes) // 8
            last = key
        if unit:
            yield from compare(unit)

    yield from emitted(SPANS, found())


def text_tag() -> Column:
    """Tells rows of one doc_id but different texts apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")), F.col("doc_id"))


def keyed_runs(docs: DataFrame) -> DataFrame:
    """Runs of windows by key, of which no key has many more than KEY_WINDOWS different ones."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_tag().alias("tag"), "text")
    schema = "key long, doc_id long, tag long, start int, stop int, hashes binary"
    counts = texts.mapInArrow(count_keys, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    hot = counts.filter(F.col("n") > KEY_WINDOWS).select("key", F.lit(True).alias("hot"))
    hot = saved(docs.sparkSession, hot, "hot-keys")
    runs = texts.mapInArrow(send, schema)
    if hot.isEmpty():
        return runs
    return runs.join(hot, "key", "left").mapInArrow(spread, schema)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, tag, spans: word intervals to remove, for each document that has any."""
    runs = keyed_runs(docs)
    dealt = runs.repartition("key").sortWithinPartitions("key")
    spans = dealt.mapInArrow(answer, "doc_id long, tag long, start int, stop int")
    return spans.groupBy("doc_id", "tag").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")
    )


def cut(text: str | None, spans: list[dict] | None) -> tuple[int, list[bytes]]:
    """Number of words, and the words that stay."""
    words = (text or "").encode().split()
    if not spans:
        return len(words), words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, [s["start"] for s in spans], 1)
    np.add.at(change, [s["stop"] for s in spans], -1)
    stays = np.cumsum(change[:-1]) == 0
    return len(words), [word for word, kept in zip(words, stays) if kept]


def _joined(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` in one struct, and the spans of the row."""
    spans = repeated_spans(docs).alias("s")
    side = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_tag().alias("tag"),
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
    ).alias("d")
    same = (F.col("d.tag") == F.col("s.tag")) & F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))
    return side.join(spans, same, "left").select("row", "s.spans")


def deduplicated(
    docs: DataFrame, schema: str, arrow: pa.Schema, result: Callable[[dict, int, list[bytes]], tuple]
) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (
            result(row, *cut(row["text"], spans)) for row, spans in rows(batches, "row", "spans")
        )
        yield from emitted(arrow, found, 500)

    return _joined(docs).mapInArrow(task, schema)


def remove_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row.

    NULL and empty texts have no words; shorter texts than a window lose nothing. A NULL doc_id
    counts as larger than any other. Rows of one doc_id never remove words of each other; repeated
    rows get equal results. Other columns are not read. No rows give no rows.
    """
    arrow = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("n_removed", pa.int64()),
            ("kept_sha256", pa.string()),
        ]
    )

    def result(row: dict, n: int, kept: list[bytes]) -> tuple:
        digest = hashlib.sha256(b" ".join(kept)).hexdigest()
        return row["doc_id"], n, n - len(kept), digest

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return deduplicated(docs.select("doc_id", "text"), schema, arrow, result)


def without_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents without their repeated words. Texts that lose nothing stay as they are, others
    become their kept words joined by spaces, possibly none; n_chars, where present, follows."""
    joined = _joined(docs)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                n, kept = cut(text, spans) if spans else (0, [])
                texts.append(text if n == len(kept) else b" ".join(kept).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string())], names=["row", "kept"]
            )

    row_type = joined.schema["row"].dataType.simpleString()
    done = joined.select("row", "row.text", "spans").mapInArrow(task, f"row {row_type}, kept string")
    columns = {name: F.col(f"row.`{name}`") for name in docs.columns}
    columns["text"] = F.col("kept")
    if "n_chars" in columns:
        changed = ~F.col("row.text").eqNullSafe(F.col("kept"))
        length = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(changed, length).otherwise(columns["n_chars"])
    return done.select(*(column.alias(name) for name, column in columns.items()))
