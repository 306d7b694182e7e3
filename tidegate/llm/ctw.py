"""Language-model scoring by context-tree weighting.

A text is coded token by token: its words, each closed by a space, then one end. A byte is eight
binary decisions. Its contexts are the 0 to DEPTH bytes before it, reaching back over the token's
start to the last LOOK_BACK bytes of the token before; at each of them a node for every decision
holds a Krichevsky-Trofimov estimator of the training counts. Contexts of up to TOP bytes are kept
if they occur, longer ones from LEAST occurrences on, so the model grows with the text. Along the
path from the empty context to the longest one kept, the estimates are mixed with the context-tree
weights: a node stops with the posterior of one half its own code length against the code lengths
of its extensions. So a token's probability is a function of its key, the word and the bytes
before it, and everything is counted and coded once per distinct key.

Steps:
1. Tasks cut their documents into batches. A batch sends each of its distinct keys once, with its
   number of training occurrences, to the word's shard, in sorted packs, and keeps the keys' places.
2. A shard adds the counts up and notes where each batch's keys are among its own.
3. A shard cuts its keys into codes, a byte with the DEPTH bytes before it, and sends each distinct
   one to the bucket of the last TOP + 1 bytes before it. All longer contexts end in these bytes,
   so a bucket has whole subtrees; it weights them and passes sums on to the nodes of TOP bytes.
   These, at most 2 ** (8 * TOP + 8) however large the corpus, are weighted in one task and broadcast.
4. With them a bucket mixes down its subtrees and answers each shard with the probability of its
   codes; a shard sums them up to keys and answers its batches; a batch sums over its documents.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import ASCII_LOWER, fold, rows, saved, text_bytes

DEPTH = 6
LOOK_BACK = 2
BEFORE = LOOK_BACK + 1  # and the space between
#: Contexts up to this length are broadcast, and how often a longer one has to occur.
TOP, LEAST = 2, 2
#: Bytes of text in a batch and, before they are merged, in a shard's and a bucket's share.
BATCH_BYTES = 6 << 20
SHARD_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
#: Tasks that buckets are dealt to at most; a task works on one bucket at a time.
BUCKET_TASKS = 20_000
#: Keys cut into codes together, and nodes a task holds before it adds them up.
PART = 100_000
HELD_NODES = 2_000_000

LOG_HALF = float(np.log(0.5))
LOG2_10 = float(np.log2(10))


def keys_of(text: str | None) -> list[bytes]:
    """A key for each token: the word, empty for the end, after the BEFORE bytes before it."""
    words = (text or "").encode().translate(ASCII_LOWER).split()
    line = b"\0" * LOOK_BACK + b" " + b" ".join(words) + b" " * bool(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) + LOOK_BACK
    starts = np.append(0, ends + 1 - BEFORE)
    return [line[a:b] for a, b in zip(starts.tolist(), np.append(ends, len(line)).tolist())]


def key_codes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every byte to code: the DEPTH bytes before it and itself as one number, newest lowest;
    and where each key's bytes start. What lies before a key is zero; a space closes it."""
    pad = b"\0" * (DEPTH - BEFORE)
    x = np.frombuffer(pad + (b" " + pad).join(keys) + b" ", np.uint8)
    code = x.astype(np.int64)
    for back in range(1, DEPTH + 1):
        code[back:] |= x[:-back].astype(np.int64) << (8 * back)
    sizes = np.fromiter(map(len, keys), np.int64, len(keys)) + 1 - BEFORE
    starts = np.cumsum(sizes) - sizes
    keep = np.ones(len(x), bool)
    first = starts + DEPTH * np.arange(len(keys))
    keep[(first[:, None] + np.arange(DEPTH)).ravel()] = False
    return code[keep], starts


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of the counts under the sequential (n + 1/2) / (total + 1) estimator."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 8, brought down by the recurrence."""
    low = np.log(x * (x + 1)) + np.log((x + 2) * (x + 3)) + np.log((x + 4) * (x + 5)) + np.log((x + 6) * (x + 7))
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - low


def firsts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)


def merged(keys: np.ndarray, *sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, and the sums of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = firsts(keys)
    return (keys[first], *(np.add.reduceat(s[order], first) if len(first) else s[:0] for s in sums))


def shortened(context: np.ndarray, depth: int) -> np.ndarray:
    return context & ((1 << (8 * depth)) - 1)


def parents(key: np.ndarray, depth: int) -> np.ndarray:
    """The same decision in the context cut to ``depth`` bytes."""
    return (shortened(key >> 8, depth) << 8) | (key & 255)


def found(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each value in an ascending table, or -1."""
    if not len(table):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return np.where(table[at] == wanted, at, -1)


@dataclass
class Nodes:
    """Decisions of the contexts of one length, ascending, and their training counts."""

    key: np.ndarray  # context, then a one and the bits of the byte decided before
    zero: np.ndarray
    one: np.ndarray


@dataclass
class Level:
    """Nodes of one length whose mixture is known down from the empty context."""

    key: np.ndarray
    stop: np.ndarray  # chance of a one if the context's extensions are not kept
    done: np.ndarray  # chance of a one from shorter contexts and this one, by their share
    left: np.ndarray  # what share goes to the extensions


def nodes_of(code: np.ndarray, count: np.ndarray) -> Nodes:
    """code: context and byte as one number, ascending and distinct."""
    byte, context = code & 255, code >> 8
    parts = []
    for k in range(8):
        key = (context << 8) | (1 << k) | (byte >> (8 - k))  # ascending as the codes are
        first = firsts(key)
        if len(first):
            ones = np.where((byte >> (7 - k)) & 1, count, 0)
            parts.append((key[first], np.add.reduceat(count, first), np.add.reduceat(ones, first)))
    if not parts:
        return Nodes(code[:0], np.zeros(0), np.zeros(0))
    key, total, one = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key, kind="stable")
    total, one = total[order].astype(float), one[order].astype(float)
    return Nodes(key[order], total - one, one)


def deep_nodes(code: np.ndarray, count: np.ndarray) -> list[Nodes]:
    """Of contexts longer than TOP bytes that occur LEAST times, shortest first."""
    out = []
    for depth in range(TOP + 1, DEPTH + 1):
        gram, n = merged(shortened(code, depth + 1), count)
        first = firsts(gram >> 8)
        sizes = np.diff(np.append(first, len(gram)))
        often = np.repeat(np.add.reduceat(n, first) >= LEAST, sizes) if len(first) else np.zeros(0, bool)
        out.append(nodes_of(gram[often], n[often]))
    return out


def weighed(levels: list[Nodes], depth: int, below: tuple | None = None) -> tuple[list[tuple], tuple | None]:
    """From the longest contexts up: each level's shares that stop and counts that no kept extension
    holds, and the sums for the nodes above. ``levels`` start at ``depth``; ``below`` are such sums.
    What no kept extension holds is coded as one more child."""
    out = []
    for d, at in zip(range(depth + len(levels) - 1, depth - 1, -1), reversed(levels)):
        own = log_kt(at.zero, at.one)
        children, zero, one = np.zeros(len(at.key)), at.zero.copy(), at.one.copy()
        if below is not None:
            key, sums, below_zero, below_one = below
            place = np.searchsorted(at.key, key)
            children[place] = sums
            zero[place] -= below_zero
            one[place] -= below_one
        log_w = np.logaddexp(LOG_HALF + own, LOG_HALF + children + log_kt(zero, one))
        out.append((np.exp(LOG_HALF + own - log_w), zero, one))
        below = merged(parents(at.key, d - 1), log_w, at.zero, at.one) if d else None
    return out[::-1], below


def mixed(levels: list[Nodes], weights: list[tuple], depth: int, above: Level | None = None) -> list[Level]:
    """From the shortest contexts down."""
    out = []
    for d, (at, (stay, zero, one)) in enumerate(zip(levels, weights), depth):
        done, left = np.zeros(len(at.key)), np.ones(len(at.key))
        if above is not None:
            place = np.searchsorted(above.key, parents(at.key, d - 1))
            done, left = above.done[place], above.left[place]
        own = (at.one + 0.5) / (at.zero + at.one + 1)
        rest = np.where(zero + one > 0, (one + 0.5) / (zero + one + 1), own)
        stop = done + left * (stay * own + (1 - stay) * rest)
        out.append(above := Level(at.key, stop, done + left * stay * own, left * (1 - stay)))
    return out


def top_levels(key: np.ndarray, zero: np.ndarray, one: np.ndarray, below: tuple | None) -> list[Level]:
    """Mixtures of 0 to TOP bytes from the nodes of TOP bytes, ascending, and their extensions' sums."""
    levels = [Nodes(key, zero, one)]
    for depth in range(TOP - 1, -1, -1):
        levels.append(Nodes(*merged(parents(levels[-1].key, depth), levels[-1].zero, levels[-1].one)))
    levels.reverse()
    return mixed(levels, weighed(levels, 0, below)[0], 0)


def log10_codes(code: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 probability of each code's byte. A decision is taken by the longest context that is
    kept and has met it."""
    byte, p = code & 255, np.zeros(len(code))
    for k in range(8):
        node, one = (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1
        chance, ask = np.full(len(code), 0.5), np.arange(len(code))
        for depth in range(len(levels) - 1, -1, -1):
            at = found(levels[depth].key, (shortened(code[ask] >> 8, depth) << 8) | node[ask])
            hit = at >= 0
            chance[ask[hit]] = levels[depth].stop[at[hit]]
            ask = ask[~hit]
        p += np.log10(np.where(one, chance, 1 - chance))
    return p


def encoded(keys: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Distinct keys, ascending, and each key's place among them."""
    held = pa.array(keys, pa.large_binary()).dictionary_encode()
    order = pc.sort_indices(held.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    return held.dictionary.take(order), place[held.indices.to_numpy()]


def distinct_codes(keys: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes by bucket and then ascending, their buckets, the place of each code of the keys
    among them, and where each key's codes start."""
    parts = [key_codes(keys[at : at + PART]) for at in range(0, len(keys), PART)]
    sizes = np.cumsum([0, *(len(code) for code, _ in parts)])
    starts = np.concatenate([np.zeros(0, np.int64), *(s + n for (_, s), n in zip(parts, sizes))])
    held = pa.array(np.concatenate([np.zeros(0, np.int64), *(code for code, _ in parts)])).dictionary_encode()
    listed = held.dictionary.to_numpy()
    bucket = bucket_of(listed, buckets)
    order = np.lexsort((listed, bucket))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return listed[order], bucket[order], place[held.indices.to_numpy()], starts


def bucket_of(code: np.ndarray, buckets: int) -> np.ndarray:
    """By the last TOP + 1 bytes of the context."""
    mixed_up = shortened(code >> 8, TOP + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed_up >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _shard_of(keys: list[bytes], shards: int) -> np.ndarray:
    """By the word alone, so that all keys of a word meet."""
    return np.fromiter((zlib.crc32(key[BEFORE:]) % shards for key in keys), np.int64, len(keys))


def packed(values: np.ndarray | list[bytes], ascending: bool = False) -> bytes:
    """Numbers or lines, compressed: most of what is written and shuffled is such packs."""
    if isinstance(values, list):
        return zstandard.compress(b"\n".join(values), 1)
    return zstandard.compress((np.diff(values, prepend=values.dtype.type(0)) if ascending else values).tobytes(), 1)


def lines(pack: bytes) -> list[bytes]:
    return zstandard.decompress(pack).split(b"\n")


def numbers(pack: bytes, kind: str = "<i8", ascending: bool = False) -> np.ndarray:
    values = np.frombuffer(zstandard.decompress(pack), kind)
    return np.cumsum(values, dtype=kind) if ascending else values


def _cuts(of: np.ndarray) -> list[tuple[int, int]]:
    """First and end of each run of equal values."""
    first = firsts(of).tolist()
    return list(zip(first, [*first[1:], len(of)]))


_SENT = pa.schema(
    [
        ("batch", pa.int64()),
        ("shard", pa.int64()),
        ("words", pa.binary()),
        ("counts", pa.binary()),
        ("doc_id", pa.int64()),
        ("train", pa.bool_()),
        ("coded", pa.int64()),
        ("at", pa.binary()),
    ]
)


def _send(texts: DataFrame, shards: int) -> DataFrame:
    """Two kinds of rows: a batch's keys for a shard, and a document with the places of its keys."""

    def cut(batch: int, docs: list[tuple]) -> Iterator[pa.RecordBatch]:
        keys = [keys_of(text) for _, _, text in docs]
        sizes = [len(k) for k in keys]
        listed, at = encoded([key for doc in keys for key in doc])
        listed = listed.to_pylist()
        of = _shard_of(listed, shards)
        order = np.argsort(of, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        at = place[at]
        trained = np.repeat([bool(train) for _, train, _ in docs], sizes)
        counts = np.bincount(at[trained], minlength=len(listed)).astype("<i8")
        none = [None] * 4
        found_ = [
            (batch, int(of[order[a]]), packed([listed[i] for i in order[a:b].tolist()]), packed(counts[a:b]), *none)
            for a, b in _cuts(of[order])
        ]
        ends = np.cumsum(sizes)
        for (doc_id, train, _), own, end in zip(docs, keys, ends.tolist()):
            # the bytes coded: each token's and the one that closes it
            coded = sum(map(len, own)) + len(own) * (1 - BEFORE)
            places = packed(at[end - len(own) : end].astype("<i4"))
            found_.append((batch, None, None, None, doc_id, bool(train), coded, places))
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, field.type) for values, field in zip(zip(*found_), _SENT)], schema=_SENT
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch, docs, size = TaskContext.get().partitionId() << 32, [], 0
        for doc in rows(batches, "doc_id", "train", "text"):
            docs.append(doc)
            size += len(doc[2] or "")
            if size >= BATCH_BYTES:
                yield from cut(batch, docs)
                batch, docs, size = batch + 1, [], 0
        if docs:
            yield from cut(batch, docs)

    schema = "batch long, shard long, words binary, counts binary, doc_id long, train boolean, coded long, at binary"
    return texts.mapInArrow(task, schema)


def _learn(packs: DataFrame) -> DataFrame:
    """A row for each shard with its keys, their counts and their words' counts; and for each batch
    that sent it keys, their places."""

    def add(t: pa.Table) -> pa.Table:
        asked = [lines(words) for words in t.column("words").to_pylist()]
        keys, at = encoded([key for keys in asked for key in keys])
        keys = keys.to_pylist()
        n = np.zeros(len(keys), "<i8")
        np.add.at(n, at, np.concatenate([numbers(c) for c in t.column("counts").to_pylist()]))
        word = pa.array([key[BEFORE:] for key in keys], pa.large_binary()).dictionary_encode()
        by_word = np.zeros(len(word.dictionary), "<i8")
        np.add.at(by_word, word.indices.to_numpy(), n)
        ends = np.cumsum([len(keys_) for keys_ in asked])[:-1]
        places = [packed(part.astype("<i4"), ascending=True) for part in np.split(at, ends)]
        none = [None] * len(asked)
        return pa.table(
            [
                pa.array([None, *t.column("batch").to_pylist()], pa.int64()),
                pa.array([t.column("shard")[0].as_py()] * (len(asked) + 1), pa.int64()),
                pa.array([packed(keys), *none], pa.binary()),
                pa.array([packed(n), *none], pa.binary()),
                pa.array([packed(by_word[word.indices.to_numpy()]), *none], pa.binary()),
                pa.array([None, *places], pa.binary()),
                pa.array([int((by_word > 0).sum()), *none], pa.int64()),
                pa.array([int(n.sum()), *none], pa.int64()),
            ],
            names=["batch", "shard", "words", "counts", "word_counts", "at", "n_words", "n_tokens"],
        )

    return packs.groupBy("shard").applyInArrow(
        add,
        "batch long, shard long, words binary, counts binary, word_counts binary, at binary, n_words long, n_tokens long",
    )


def _buckets(learned: DataFrame, buckets: int) -> DataFrame:
    """A row for each bucket: its distinct codes and their training counts; and the shards that sent
    it codes, with the places of these."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, words, counts in rows(batches, "shard", "words", "counts"):
            code, bucket, of, starts = distinct_codes(lines(words), buckets)
            times = np.repeat(numbers(counts), np.diff(np.append(starts, len(of))))
            total = np.bincount(of, times, len(code)).astype("<i8")
            cuts = _cuts(bucket)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(bucket[a]) for a, _ in cuts], pa.int64()),
                    pa.array([shard] * len(cuts), pa.int64()),
                    pa.array([packed(code[a:b], ascending=True) for a, b in cuts], pa.binary()),
                    pa.array([packed(total[a:b]) for a, b in cuts], pa.binary()),
                ],
                names=["bucket", "shard", "codes", "counts"],
            )

    def together(bucket: int, held: list[tuple]) -> pa.RecordBatch:
        sent = [numbers(codes, ascending=True) for _, codes, _ in held]
        code, n = merged(np.concatenate(sent), np.concatenate([numbers(counts) for _, _, counts in held]))
        at = [packed(np.searchsorted(code, own).astype("<i4"), ascending=True) for own in sent]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([bucket], pa.int64()),
                pa.array([packed(code, ascending=True)], pa.binary()),
                pa.array([packed(n)], pa.binary()),
                pa.array([[shard for shard, _, _ in held]], pa.list_(pa.int64())),
                pa.array([at], pa.list_(pa.binary())),
            ],
            names=["bucket", "codes", "counts", "shards", "at"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket."""
        last, held = None, []
        for bucket, *pack in rows(batches, "bucket", "shard", "codes", "counts"):
            if held and bucket != last:
                yield together(last, held)
                held = []
            last = bucket
            held.append(tuple(pack))
        if held:
            yield together(last, held)

    shards = learned.filter("batch IS NULL").select("shard", "words", "counts")
    packs = shards.mapInArrow(cut, "bucket long, shard long, codes binary, counts binary")
    dealt = packs.repartition(min(buckets, BUCKET_TASKS), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(
        merge, "bucket long, codes binary, counts binary, shards array<long>, at array<binary>"
    )


def _trained(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return codes[counts > 0], counts[counts > 0]


_SUMS = ("zero", "one", "log_w", "below_zero", "below_one")


def _top(buckets: DataFrame) -> list[Level]:
    """Levels of 0 to TOP bytes."""

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(x) for x in merged(*(np.concatenate(x) for x in zip(*held)))], names=["key", *_SUMS]
            )

        for codes, counts in rows(batches, "codes", "counts"):
            code, n = _trained(numbers(codes, ascending=True), numbers(counts))
            own = nodes_of(*merged(shortened(code, TOP + 1), n))
            key, *sums = weighed(deep_nodes(code, n), TOP + 1)[1]
            place = np.searchsorted(own.key, key)
            below = [np.zeros(len(own.key)) for _ in sums]
            for all_, some in zip(below, sums):
                all_[place] = some
            held.append((own.key, own.zero, own.one, *below))
            size += len(own.key)
            if size >= HELD_NODES:
                yield summed()
                held, size = [], 0
        if held:
            yield summed()

    schema = "key long, " + ", ".join(f"{name} double" for name in _SUMS)
    nodes = buckets.select("codes", "counts").mapInArrow(up, schema).groupBy("key").agg(*(F.sum(name).alias(name) for name in _SUMS))

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One task; the number of nodes has a bound that no corpus passes."""
        parts = [pa.Table.from_batches([batch]) for batch in batches]
        columns = [np.concatenate([np.zeros(0), *(p.column(x).to_numpy() for p in parts)]) for x in _SUMS]
        key = np.concatenate([np.zeros(0, np.int64), *(p.column("key").to_numpy() for p in parts)]).astype(np.int64)
        order = np.argsort(key)
        key, (zero, one, *below) = key[order], [x[order] for x in columns]
        levels = top_levels(key, zero, one, (key, *below))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(levels)], pa.binary())], names=["levels"])

    row = nodes.repartition(1).mapInArrow(built, "levels binary").first()
    nothing = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
    return pickle.loads(row["levels"]) if row else top_levels(*nothing, None)


def _code_logs(spark: SparkSession, buckets: DataFrame) -> DataFrame:
    """shard, bucket, logs: log10 probabilities in the order of the shard's codes."""
    top = spark.sparkContext.broadcast(_top(buckets))

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, codes, counts, shards, at in rows(batches, "bucket", "codes", "counts", "shards", "at"):
            code = numbers(codes, ascending=True)
            deep = deep_nodes(*_trained(code, numbers(counts)))
            levels = [*top.value, *mixed(deep, weighed(deep, TOP + 1)[0], TOP + 1, top.value[-1])]
            logs = log10_codes(code, levels).astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shards, pa.int64()),
                    pa.array([bucket] * len(shards), pa.int64()),
                    pa.array([packed(logs[numbers(own, "<i4", True)]) for own in at], pa.binary()),
                ],
                names=["shard", "bucket", "logs"],
            )

    return buckets.mapInArrow(down, "shard long, bucket long, logs binary")


def _answers(learned: DataFrame, logs: DataFrame, buckets: int) -> DataFrame:
    """batch, shard, counts of words and log10 probabilities of keys, in the order of the batch."""

    def answer(t: pa.Table, logs: pa.Table) -> pa.Table:
        batch = t.column("batch").to_pylist()
        own = batch.index(None)
        _, _, of, starts = distinct_codes(lines(t.column("words")[own].as_py()), buckets)
        packs = sorted(zip(logs.column("bucket").to_pylist(), logs.column("logs").to_pylist()))
        by_code = np.concatenate([numbers(p, "<f4") for _, p in packs]).astype(float)
        by_key = np.add.reduceat(by_code[of], starts).astype("<f4")
        words = numbers(t.column("word_counts")[own].as_py())
        asked = [i for i in range(len(batch)) if i != own]
        at = [numbers(t.column("at")[i].as_py(), "<i4", True) for i in asked]
        return pa.table(
            [
                pa.array([batch[i] for i in asked], pa.int64()),
                pa.array([t.column("shard")[own].as_py()] * len(asked), pa.int64()),
                pa.array([packed(words[a]) for a in at], pa.binary()),
                pa.array([packed(by_key[a]) for a in at], pa.binary()),
            ],
            names=["batch", "shard", "counts", "logs"],
        )

    sides = learned.drop("counts", "n_words", "n_tokens").groupBy("shard"), logs.groupBy("shard")
    return sides[0].cogroup(sides[1]).applyInArrow(answer, "batch long, shard long, counts binary, logs binary")


def score_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row.

    Learns from the documents whose crc32(doc_id as text) modulo 5 is not 1. NULL and empty texts
    are the end token alone. base_score is the smoothed unigram model; both scores are log10
    probabilities, and bits_per_byte is the model's code length for each byte coded. Without training
    documents both stay finite. Repeated rows count each time. No rows give no rows.
    """
    n_bytes = text_bytes(docs)
    shards, buckets = n_bytes // SHARD_BYTES + 1, n_bytes // BUCKET_BYTES + 1
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", (fold("doc_id", 5) != 1).alias("train")
    )
    sent = saved(spark, _send(texts, shards), "sent")
    learned = saved(spark, _learn(sent.filter("shard IS NOT NULL").select("batch", "shard", "words", "counts")), "keys")
    totals = learned.agg(F.sum("n_tokens"), F.sum("n_words")).first()
    n, v = int(totals[0] or 0), int(totals[1] or 0)
    codes = saved(spark, _buckets(learned, buckets), "codes")
    answers = _answers(learned, _code_logs(spark, codes), buckets)

    def score(own: pa.Table, found_: pa.Table) -> pa.Table:
        packs = sorted(zip(*(found_.column(x).to_pylist() for x in ("shard", "counts", "logs"))))
        c = np.concatenate([np.zeros(0, "<i8"), *(numbers(p) for _, p, _ in packs)])
        model = np.concatenate([np.zeros(0), *(numbers(p, "<f4").astype(float) for _, _, p in packs)])
        base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
        out = []
        for doc_id, train, coded, at in zip(*(own.column(x).to_pylist() for x in ("doc_id", "train", "coded", "at"))):
            at = numbers(at, "<i4")
            total = float(model[at].sum())
            sums = len(at), int((c[at] > 0).sum()), n, float(base[at].sum()), total
            out.append((doc_id, not train, *sums, -total * LOG2_10 / coded))
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), *[pa.float64()] * 3]
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 8, types)], names=names)

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, bits_per_byte double"
    )
    places = sent.filter("shard IS NULL").select("batch", "doc_id", "train", "coded", "at")
    return places.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(score, schema)
