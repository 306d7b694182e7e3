"""Near-duplicate vectors by spherical-cap filters.

Filters are directions of a random product code: the vector, turned at random, is cut in two
halves, each half has its own code of random unit words, and every pair of words is a direction.
A vector passes the filters whose direction has an inner product of at least a threshold with it.
List decoding finds them all without trying each: a word of one half leaves a least value for the
other half, whose words are sorted. Vectors of a label that pass a common filter are compared.

The threshold is so low that a share RECALL of pairs at just COSINE pass a common filter, as random
pairs show for the very code, once, on the driver. The number of filters follows from the vectors of
the largest label, so that about SHARED of them pass each: with more words a vector passes more
filters, and recall does not fall with the table. A comparison is a matrix product and a copy of a
vector goes through the shuffle, so filters are as wide as a task can well compare. Equal vectors are
one class that links within itself. Classes that share a filter are compared in blocks; a pair
counts in the first filter both pass, so no pair leaves a task: a task returns link counts and, for
each class, one link to the least one it is connected to there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.common import saved
from tidegate.llm.graph import components
from tidegate.llm.simhash import join_labels
from tidegate.llm.vectors import matrix, usable

COSINE = 0.93
#: Share of pairs at just COSINE that are to pass a common filter, PAIRS the random pairs it is
#: measured on, and BEST the words of each half that are tried for a pair.
RECALL = 0.97
PAIRS = 1000
BEST = 160
#: Vectors that are to pass a filter, about, and the most words of a half.
SHARED = 2048
MOST_WORDS = 4096
#: Classes of a block within a filter.
BLOCK = 4096
SEED = 8


class Code:
    """The product code for vectors of ``width`` components; ``least`` is its threshold if known."""

    def __init__(self, width: int, words: int, least: float | None = None):
        rng = np.random.default_rng([SEED, width, words])
        self.turn = np.linalg.qr(rng.standard_normal((width, width)))[0]
        self.half = width // 2
        self.words = words

        def unit(n: int) -> np.ndarray:
            w = rng.standard_normal((words, n))
            return w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-300)

        self.left, self.right = unit(max(1, self.half)), unit(width - self.half)
        self.least = self.threshold(width) if least is None else least

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner products with the words of the left and of the right half."""
        y = x @ self.turn
        a = y[:, : self.half] @ self.left.T if self.half else np.zeros((len(x), self.words))
        return a, y[:, self.half :] @ self.right.T

    def threshold(self, width: int) -> float:
        """So low that a share RECALL of random pairs pass a common filter. Only the BEST words a half
        are tried, so it is never too high."""
        x, y = pairs_at(COSINE, width, PAIRS, SEED)
        n = min(BEST, self.words)

        def best(v: np.ndarray) -> np.ndarray:
            return np.argpartition(-v, n - 1, axis=1)[:, :n]

        common = []
        for at in range(0, PAIRS, 100):
            (a, b), (c, d) = (self.halves(v[at : at + 100]) for v in (x, y))
            for i, (p, q) in enumerate(zip(best(np.minimum(a, c)), best(np.minimum(b, d)))):
                common.append(np.minimum(a[i, p][:, None] + b[i, q], c[i, p][:, None] + d[i, q]).max())
        return float(np.quantile(common, 1 - RECALL, method="lower")) - 1e-9

    def passed(self) -> float:
        """Filters that random vectors pass on average."""
        x, _ = pairs_at(COSINE, self.turn.shape[0], PAIRS, SEED + 1)
        return len(self.decode(x)[0]) / PAIRS

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of all directions that reach the threshold, rows ascending."""
        a, b = self.halves(x)
        order = np.argsort(-b, axis=1)
        falling = np.take_along_axis(b, order, 1)
        row, word = np.nonzero(a + falling[:, :1] >= self.least)  # words with any partner
        need = self.least - a[row, word]
        n = np.empty(len(row), np.int64)
        starts = np.searchsorted(row, np.arange(len(x) + 1))
        for i in range(len(x)):
            own = slice(starts[i], starts[i + 1])
            n[own] = np.searchsorted(-falling[i], -need[own], "right")
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        row, word = np.repeat(row, n), np.repeat(word, n)
        return row, word * self.words + order[row, at]


@cache
def code_of(width: int, words: int, least: float) -> Code:
    """One code for all tasks of a worker."""
    return Code(width, words, least)


def code_for(width: int, n: int) -> Code:
    """The code of the fewest words with which n vectors of a label share a filter with few others."""
    words = 2
    while True:
        code = Code(width, words)
        if words >= MOST_WORDS or n * code.passed() <= SHARED * words**2:
            return code
        words *= 2


def normed(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def pairs_at(cosine: float, width: int, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """n random pairs of unit vectors at this cosine; of one component, pairs of equal ones."""
    rng = np.random.default_rng([seed, width, n])
    x, y = normed(rng.standard_normal((n, width))), rng.standard_normal((n, width))
    if width == 1:
        return x, x
    y = normed(y - (x * y).sum(axis=1, keepdims=True) * x)
    return x, cosine * x + np.sqrt(1 - cosine**2) * y


def compare(ids, x, passed, here, first, second):
    """(a, b) positions of pairs at least COSINE alike whose first common filter is this one."""
    for at in range(0, len(first), 256):
        some = first[at : at + 256]
        i, j = np.nonzero(x[some] @ x[second].T >= COSINE)
        i, j = some[i], second[j]
        keep = ids[i] != ids[j]
        i, j = i[keep], j[keep]
        for part in range(0, len(i), 4096):
            a, b = i[part : part + 4096], j[part : part + 4096]
            both = passed[a] & passed[b]
            byte = (both != 0).argmax(axis=1)
            low = both[np.arange(len(a)), byte]
            bit = byte * 8 + 7 - np.floor(np.log2(np.maximum(low, 1))).astype(np.int64)
            own = bit == here
            yield a[own], b[own]


def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["node", "links", "least"]
    for batch in batches:
        for row in range(batch.num_rows):
            members = batch.column("members")[row].values
            here = batch.column("filter")[row].as_py()
            ids = members.field("node").to_numpy()
            if len(ids) < 2:
                continue
            copies = members.field("copies").to_numpy()
            x = normed(matrix(members.field("x"), batch.column("kind")[row].as_py()).astype(float))
            tree = members.field("in_tree").to_numpy(zero_copy_only=False)
            query = members.field("in_query").to_numpy(zero_copy_only=False)
            lists = members.field("filters").to_pylist()
            # filters up to this one that some of this block share, as positions in order
            listed = np.frombuffer(b"".join(lists), "<i4")
            owner = np.repeat(np.arange(len(ids)), [len(f) // 4 for f in lists])
            values, n = np.unique(listed, return_counts=True)
            values = values[(n > 1) & (values <= here)]
            at = np.minimum(np.searchsorted(values, listed), len(values) - 1)
            own = values[at] == listed
            bits = np.zeros((len(ids), len(values)), bool)
            bits[owner[own], at[own]] = True
            passed = np.packbits(bits, axis=1)
            place = int(np.searchsorted(values, here))
            links = np.zeros(len(ids), np.int64)
            label = np.arange(len(ids))
            both = bool((tree & query).all())
            for a, b in compare(ids, x, passed, place, np.flatnonzero(query), np.flatnonzero(tree)):
                np.add.at(links, a, copies[b])
                if not both:
                    np.add.at(links, b, copies[a])
                label = join_labels(label, a, b)
            some = np.flatnonzero(links)
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[some]), pa.array(links[some]), pa.array(ids[label[some]])], names=names
                )


def _comparable(field: T.StructField) -> Column:
    """A label as text that is equal where the labels are."""
    label = F.col(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        label = label + F.lit(0.0)  # both zeros are one
    return label.cast("string")


def near_duplicates(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Rows link at a cosine of at least COSINE, in double precision, if their labels are equal and
    not NULL, compared as they are whatever their type, and their vectors equally long. Vectors that are NULL, empty, zero, or hold NULL or
    non-finite components link with nothing, nor do rows without an id; a row without links is its
    own component. Equal rows link with each other. An empty table gives no rows.
    """
    # single-precision components are kept as such until they are compared, which loses nothing
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    kind = "<f4" if single else "<f8"
    wide = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        _comparable(vectors.schema["label"]).alias("label"),
        F.when(usable("embedding"), F.col("embedding").cast("array<double>")).alias("x"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("x", pa.binary())])
        for batch in batches:
            packed = [
                (np.asarray(x, kind) + np.zeros(1, kind)).tobytes() if x is not None and any(x) else None
                for x in batch.column("x").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(packed, pa.binary())], schema=schema
            )

    packed = wide.mapInArrow(pack, "vec_id long, label string, x binary")
    # equal vectors, whatever the sign of their zeros, are equal bytes after packing x + 0.0
    linkable = F.col("x").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    all_rows = saved(
        spark,
        packed.withColumn("node", F.when(linkable, F.xxhash64("label", "x"))),
        "vectors",
    )
    classes = saved(
        spark,
        all_rows.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.first("label").alias("label"),
            F.first("x").alias("x"),
            F.count(F.lit(1)).alias("copies"),
            F.min("vec_id").alias("first_id"),
        ),
        "classes",
    )
    by_label = classes.groupBy("label", F.octet_length("x").alias("bytes")).count()
    # a row for each length of vectors
    largest = by_label.groupBy("bytes").agg(F.max("count").alias("n")).collect()
    codes = {}
    for row in largest:
        code = code_for(row["bytes"] // np.dtype(kind).itemsize, row["n"])
        codes[row["bytes"]] = (code.turn.shape[0], code.words, code.least)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("filters", pa.binary())])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                values = part.column("x").to_pylist()
                nodes, lists = part.column("node").to_pylist(), [b""] * len(values)
                for width in {len(value) for value in values}:
                    own = [i for i, value in enumerate(values) if len(value) == width]
                    x = matrix([values[i] for i in own], kind).astype(float)
                    row, found = code_of(*codes[width]).decode(normed(x))
                    for i, filters in zip(own, np.split(found, np.searchsorted(row, np.arange(1, len(own))))):
                        lists[i] = np.sort(filters).astype("<i4").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(lists, pa.binary())], schema=schema)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(f, "<i4") for f in batch.column("filters").to_pylist()]
            sizes = [len(f) for f in lists]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column("node").to_numpy(), sizes)),
                    pa.array(np.concatenate([np.zeros(0, "<i4"), *lists])),
                ],
                names=["node", "filter"],
            )

    decoded = saved(
        spark,
        classes.select("node", "x").mapInArrow(decode, "node long, filters binary"),
        "decoded",
    )
    known = saved(
        spark,
        classes.join(decoded, "node").withColumn("width", F.octet_length("x")),
        "known",
    )
    pairs = known.select("node", "filters").mapInArrow(spread, "node long, filter int")
    keyed = pairs.join(known.select("node", "label", "width"), "node")
    sizes = saved(
        spark,
        keyed.groupBy("label", "width", "filter").count().filter(F.col("count") > 1),
        "filters",
    )
    dealt = (
        keyed.join(sizes, ["label", "width", "filter"])
        .withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(
            "node",
            "filter",
            F.xxhash64(
                "label", "width", "filter", F.least("own", "other"), F.greatest("own", "other")
            ).alias("cell"),
            (F.col("own") <= F.col("other")).alias("in_tree"),
            (F.col("own") >= F.col("other")).alias("in_query"),
        )
    )
    full = dealt.join(known.select("node", "x", "copies", "filters"), "node")
    cells = full.groupBy("cell", "filter").agg(
        F.collect_list(F.struct("node", "x", "copies", "filters", "in_tree", "in_query")).alias("members")
    )
    found = saved(
        spark,
        cells.select("filter", "members", F.lit(kind).alias("kind")).mapInArrow(solve, "node long, links long, least long"),
        "found",
    )
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(spark, found.select("node", "least"))
    parts = (
        classes.select("node", "copies", "first_id")
        .join(counts, "node", "left")
        .join(joined, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    parts = saved(spark, parts, "parts")
    least = saved(spark, parts.groupBy("component").agg(F.min("first_id").alias("component_id")), "least")
    named = saved(
        spark,
        parts.join(least, "component").select(
            "node",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            "component_id",
        ),
        "named",
    )
    component = F.coalesce("component_id", "vec_id")
    return all_rows.join(named, "node", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
