"""SimHash near-duplicates, found with BK-trees over shards of the fingerprints.

Fingerprints within ``radius`` bits of each other agree on all but ``radius`` of any m blocks of
their bits. So for every choice of m - radius blocks the fingerprints that agree on them form a
shard, and a pair in reach meets in at least one shard. Each shard's fingerprints become a
BK-tree: a child hangs below its parent under their integer Hamming distance, and a query
at distance d from a node follows only the edges d - radius to d + radius. Large shards are cut
into blocks; the tree of a block is sent to every block of queries, each pair of blocks to a task
of its own, so a hot shard is spread and no task holds more than two blocks. m follows from the
number of distinct fingerprints, which keeps shards small at any size; every m is exact.

A task returns, for each fingerprint, one link to the least one it is connected to within the
task, never all pairs; the components of these links are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.common import ASCII_LOWER, emitted, rows, saved
from tidegate.llm.graph import components

SEED = 42
#: Fingerprints of a block of a shard: a tree has at most about so many nodes.
BLOCK = 1024
#: Rows a task gathers, to the end of the last shard, before it builds their trees together.
FOREST_ROWS = 120_000
#: Visits of (query, node) worked on at a time.
FRONTIER = 1_000_000


def fingerprint(text: str | None, shingle_words: int) -> int:
    """The 64-bit majority of the XXH64 values of the text's word shingles; 0 without words."""
    words = (text or "").encode().translate(ASCII_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle_words + 1)
    ends = ends[min(len(words), shingle_words) - 1 :]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, 16384):
        spans = zip(starts[at : at + 16384].tolist(), ends[at : at + 16384].tolist())
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.uint16 if len(bits) < 65536 else np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int) -> DataFrame:
    """doc_id, code: the fingerprint as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("code", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (
            (doc_id, int(np.uint64(fingerprint(text, shingle_words)).astype(np.int64)))
            for doc_id, text in rows(batches, "doc_id", "text")
        )
        yield from emitted(schema, found)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return picked.mapInArrow(task, "doc_id long, code long")


def block_count(n_codes: int, radius: int) -> int:
    """The least number of blocks whose shards hold some tens of random fingerprints."""
    for m in range(radius + 1, radius + 5):
        if n_codes / 2 ** (64 * (m - radius) / m) <= 64:
            return m
    return radius + 5


def shard_keys(code: Column, m: int, radius: int) -> list[Column]:
    cuts = [64 * i // m for i in range(m + 1)]
    masks = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(m)]
    keys = []
    for number, chosen in enumerate(combinations(range(m), m - radius)):
        mask = sum(masks[i] for i in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        # a collision only puts two shards into one tree
        keys.append(F.xxhash64(F.lit(number), code.bitwiseAND(F.lit(signed).cast("long"))))
    return keys


class Forest:
    """A BK-tree for each group, built level by level for all groups at once."""

    def __init__(self, group: np.ndarray, code: np.ndarray, member: np.ndarray):
        """member: positions, in ascending order of group, of the codes that become nodes."""
        self.code = code
        groups, first = np.unique(group[member], return_index=True)
        self.groups, self.roots = groups, member[first]
        active = np.delete(member, first)
        at = self.roots[np.searchsorted(groups, group[active])]
        keys, nodes = [], []
        while active.size:
            slot = at * 65 + np.bitwise_count(code[active] ^ code[at]).astype(np.int64)
            taken, where, of = np.unique(slot, return_index=True, return_inverse=True)
            child = active[where]
            keys.append(taken)
            nodes.append(child)
            below = child[of]
            stays = below != active
            active, at = active[stays], below[stays]
        self.keys = np.concatenate([np.zeros(0, np.int64), *keys])
        order = np.argsort(self.keys)
        self.keys = self.keys[order]
        self.nodes = np.concatenate([np.zeros(0, np.int64), *nodes])[order]

    def within(self, query: np.ndarray, group: np.ndarray, radius: int):
        """Pairs (query, node) of the same group at most ``radius`` apart, a level at a time."""
        place = np.searchsorted(self.groups, group[query])
        there = (place < len(self.groups)) & (
            self.groups[np.minimum(place, len(self.groups) - 1)] == group[query]
        )
        query, node = query[there], self.roots[place[there]]
        while query.size:
            far = np.bitwise_count(self.code[query] ^ self.code[node]).astype(np.int64)
            hit = (far <= radius) & (query != node)
            yield query[hit], node[hit]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(far - radius, 0))
            high = np.searchsorted(self.keys, node * 65 + np.minimum(far + radius, 64), "right")
            n = high - low
            query = np.repeat(query, n)
            node = self.nodes[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the classes of a and b; a label is the least position of its class."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def connect(group, code, in_tree, in_query, radius) -> np.ndarray:
    """The label of each position after linking queries and tree nodes of a group in reach."""
    forest = Forest(group, code, np.flatnonzero(in_tree))
    label = np.arange(len(code))
    if not len(forest.groups):
        return label
    queries = np.flatnonzero(in_query)
    sizes = np.bincount(group[in_tree], minlength=int(group.max()) + 1)[group[queries]]
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(FRONTIER, sizes.sum() + FRONTIER, FRONTIER))
    for part in np.split(queries, np.unique(np.minimum(cuts + 1, len(queries)))):
        for a, b in forest.within(part, group, radius):
            label = join_labels(label, a, b)
    return label


def link_shards(cells: DataFrame, radius: int) -> DataFrame:
    """a, b: for each code of a cell, the one it is linked to. Cells come together and sorted."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def solve(parts: list[tuple]) -> pa.RecordBatch:
        cell, code, tree, query = (np.concatenate(x) for x in zip(*parts))
        group = np.cumsum(np.concatenate(([0], cell[1:] != cell[:-1])))
        label = connect(group, code.view(np.uint64), tree, query, radius)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays(
            [pa.array(code[moved]), pa.array(code[label[moved]])], schema=schema
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = 0
        for batch in batches:
            cols = [
                batch.column(name).to_numpy(zero_copy_only=False)
                for name in ("cell", "code", "in_tree", "in_query")
            ]
            if not len(cols[0]):
                continue
            n += len(cols[0])
            if n >= FOREST_ROWS:  # up to the last whole cell
                cut = int(np.searchsorted(cols[0], cols[0][-1]))
                last = held[-1][0][-1] if held else None
                if cut or last != cols[0][-1]:
                    yield solve([*held, tuple(c[:cut] for c in cols)] if cut else held)
                    cols, held = [c[cut:] for c in cols], []
                    n = len(cols[0])
            held.append(tuple(cols))
        if held:
            yield solve(held)

    return cells.mapInArrow(task, "a long, b long")


def near_links(spark: SparkSession, codes: DataFrame, radius: int) -> DataFrame:
    """Links between distinct codes that keep every connection within ``radius`` bits."""
    m = block_count(codes.count(), radius)
    sharded = saved(
        spark,
        codes.select("code", F.explode(F.array(*shard_keys(F.col("code"), m, radius))).alias("shard")),
        "shards",
    )
    hot = (
        sharded.groupBy("shard")
        .count()
        .filter(F.col("count") > BLOCK)
        .select("shard", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    )
    hot = saved(spark, hot, "hot")
    own = F.pmod(F.xxhash64("code", F.lit(1)), F.col("blocks")).cast("int")
    blocks = (
        sharded.join(hot, "shard", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", own)
    )
    cells = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
        "code",
        (F.col("own") <= F.col("other")).alias("in_tree"),
        (F.col("own") >= F.col("other")).alias("in_query"),
    )
    return link_shards(cells.repartition("cell").sortWithinPartitions("cell"), radius)


def near_duplicates(
    spark: SparkSession, docs: DataFrame, shingle_words: int = 4, radius: int = 4
) -> DataFrame:
    """doc_id, fingerprint, component_id of every row.

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the least doc_id
    reachable. NULL and empty texts have the fingerprint 0 and link like any other; a text with
    fewer words than a shingle is one shingle. A NULL doc_id keeps its row and is nobody's least
    id; a component of nothing but NULL ids has a NULL component_id. Repeated rows stay repeated.
    Other columns are not read. An empty table gives no rows.
    """
    prints = saved(spark, fingerprints(docs, shingle_words), "prints")
    codes = saved(spark, prints.groupBy("code").agg(F.min("doc_id").alias("first_id")), "codes")
    found = components(spark, near_links(spark, codes.select("code"), radius))
    known = codes.join(found, codes["code"] == found["node"], "left").select(
        "code", "first_id", F.coalesce("component", "code").alias("component")
    )
    known = saved(spark, known, "known")
    least = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    least = saved(spark, least, "least")
    named = saved(spark, known.join(least, "component").select("code", "component_id"), "named")
    return prints.join(named, "code").select(
        "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id"
    )
