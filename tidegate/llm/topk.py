"""Exact top-k by integer inner product: a Voronoi kNN join.

Data and queries are grouped by their nearest pivot. A group's summary is its pivot p, its size,
and its radius r: q.v lies within q.p plus or minus |q| r for every member v. For a query, the k-th
best of what is certain bounds the answer from below: the lower ends of whole groups, taken in
order until they hold k members, or its k best scores among the pivots, which are rows themselves.
The query is sent to just those groups whose upper end reaches that bound, meets their blocks, and
keeps k rows of each; the best k of those are the answer. Nothing is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.common import saved
from tidegate.llm.vectors import matrix, usable

#: Pivots: a bounded, documented number of rows, those of the least hash.
PIVOTS = 256
#: Members of a block, and queries of a block.
DATA_BLOCK = 1024
QUERY_BLOCK = 128
SCALE = 1024
#: Below every score, and its negative above every score.
NEVER = -(1 << 62)
NEVER_WIDE = -(1 << 200)
#: Vectors whose greatest component, times the root of their length, reaches this take no part: the
#: inner products of the others have fewer than 38 digits.
FARTHEST = 3e15
#: Share of |x| (|p| + radius) by which bounds are widened where they are not in exact integers.
SLACK = 1e-9
# Components are 32-bit integers where all scores are exact in doubles, else integer-valued doubles.
SMALL, WIDE = "<i4", "<f8"


def _greatest(column: str) -> Column:
    return F.array_max(F.transform(column, lambda x: F.abs(x)))


def kind_for(greatest: float, width: int) -> str:
    """SMALL if products of such components are exact in doubles when summed."""
    return SMALL if width * (SCALE * greatest + 1) ** 2 < 2.0**53 and SCALE * greatest < 2**31 - 1 else WIDE


def load(packed, kind: str) -> np.ndarray:
    """Rows for bounds: exact in 64-bit integers, or in doubles."""
    return matrix(packed, kind).astype(np.int64 if kind == SMALL else np.float64)


def exact(packed, kind: str) -> np.ndarray:
    """Rows whose inner products are exact: in doubles, or as Python's integers."""
    values = matrix(packed, kind)
    if kind == SMALL:
        return values.astype(np.float64)
    return np.array([int(v) for v in values.ravel()], object).reshape(values.shape)


def quantised(vectors: DataFrame, kind: str) -> DataFrame:
    """vec_id, q: components as floor(1024 * x), little-endian. Equal rows count once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("vec_id", pa.int64()), ("q", pa.binary())])
        for batch in batches:
            packed = [
                np.floor(SCALE * np.asarray(x, np.float64)).astype(kind).tobytes()
                for x in batch.column("x").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(packed, pa.binary())], schema=schema
            )

    return vectors.mapInArrow(task, "vec_id long, q binary").distinct()


def nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A pivot near each row, the nearest up to rounding, and the squared distance to it."""
    far = (x * x).sum(1)[:, None] - 2 * (x @ pivots.T) + (pivots * pivots).sum(1)[None, :]
    group = far.argmin(1)
    if x.dtype != np.int64:  # the difference again, without cancellation
        return group, ((x - pivots[group]) ** 2).sum(1)
    return group, far[np.arange(len(x)), group].astype(np.float64)


def slack_of(x: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> np.ndarray | float:
    """By how much a bound may be off: nothing in exact integers."""
    if x.dtype == np.int64:
        return 0.0
    reach = np.sqrt((pivots * pivots).sum(1)) + radius
    return SLACK * np.sqrt((x * x).sum(1))[:, None] * reach[None, :]


def certain_score(
    x: np.ndarray, own: np.ndarray, pivots: np.ndarray, pivot_ids: np.ndarray, size, radius, k: int
) -> np.ndarray:
    """A score that at least k candidates of each query reach."""
    dot = (x @ pivots.T).astype(np.float64)
    spread = np.sqrt((x * x).sum(1))[:, None] * radius[None, :]
    off = slack_of(x, pivots, radius)
    low = dot - spread - off
    order = np.argsort(-low, axis=1)
    # one more than k, as the query itself may be a member
    held = np.cumsum(np.asarray(size)[order], axis=1) > k
    place = np.where(held.any(1), held.argmax(1), -1)
    found = np.take_along_axis(low, order, 1)[np.arange(len(x)), place]
    sure = np.where(place >= 0, found, -np.inf)
    others = np.where(pivot_ids[None, :] == own[:, None], -np.inf, dot - off)
    if others.shape[1] >= k:
        sure = np.maximum(sure, np.partition(others, -k, axis=1)[:, -k])
    return sure


def top_k(
    spark: SparkSession, vectors: DataFrame, k: int = 10, every: int = 100
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each query among all other rows.

    Queries are the rows whose vec_id is divisible by ``every``. Ties go to the smaller vec_id; a
    query with fewer than k candidates returns all. Vectors that are NULL, empty, or hold NULL or
    non-finite components take no part, nor do rows without an id or of components beyond FARTHEST.
    Scores are exact; one beyond 64 bits is ranked and returned as NULL. Vectors only meet others of
    their length. Equal rows count once; different vectors under one id are all candidates, and a
    query never meets its own id. An empty table gives no rows.
    """
    schema = "query_id long, rank int, vec_id long, score long"
    fitting = usable("embedding") & F.col("vec_id").isNotNull()
    wide = vectors.filter(fitting).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x")
    )
    wide = wide.filter(_greatest("x") * F.sqrt(F.size("x").cast("double")) < FARTHEST)
    # a row for each length of vectors
    found = wide.groupBy(F.size("x").alias("width")).agg(F.max(_greatest("x")).alias("greatest")).collect()
    kinds = {row["width"]: kind_for(row["greatest"], row["width"]) for row in found}
    out = spark.createDataFrame([], schema)
    for width, kind in kinds.items():  # one in any ordinary table
        rows = saved(spark, quantised(wide.filter(F.size("x") == width), kind), "quantised")
        out = out.unionByName(_top_k(spark, rows, kind, k, every))
    return out


def _top_k(spark: SparkSession, rows: DataFrame, kind: str, k: int, every: int) -> DataFrame:
    chosen = rows.orderBy(F.xxhash64("vec_id", "q"), "vec_id", "q").limit(PIVOTS).collect()
    pivots = load([bytes(row["q"]) for row in chosen], kind)
    pivot_ids = np.array([row["vec_id"] for row in chosen], np.int64)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                group, far = nearest(load(batch.column("q"), kind), pivots)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("q"), pa.array(group.astype(np.int32)), pa.array(far)],
                    names=["vec_id", "q", "pivot", "far"],
                )

    placed = saved(
        spark, rows.mapInArrow(assign, "vec_id long, q binary, pivot int, far double"), "placed"
    )
    # one row a pivot
    summary = placed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()
    size, radius = np.zeros(len(pivots), np.int64), np.full(len(pivots), 0.0)
    for row in summary:
        size[row["pivot"]], radius[row["pivot"]] = row["n"], np.sqrt(row["far"]) * (1 + 1e-9)
    blocks = np.maximum(1, -(-size // DATA_BLOCK))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each block that may hold an answer of the query."""
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x = load(part.column("q"), kind)
                own = part.column("vec_id").to_numpy(zero_copy_only=False)
                sure = certain_score(x, own, pivots, pivot_ids, size, radius, k)
                high = (x @ pivots.T) + np.sqrt((x * x).sum(1))[:, None] * radius[None, :]
                high = high + np.abs(high) * 1e-12 + 1e-6 + slack_of(x, pivots, radius)
                reach = (high >= sure[:, None]) & (size > 0)[None, :]
                query, group = np.nonzero(reach)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(query)),
                        part.column("q").take(pa.array(query)),
                        pa.array(group.astype(np.int32)),
                        pa.array(blocks[group].astype(np.int32)),
                    ],
                    names=["query_id", "x", "pivot", "blocks"],
                )

    queries = placed.filter(F.col("vec_id") % every == 0)
    routed = queries.select("vec_id", "q").mapInArrow(
        route, "query_id long, x binary, pivot int, blocks int"
    )
    dealt = routed.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(4096)))
    # queries of a group in packs, each to every block of the group
    packs = (
        dealt.groupBy("pivot", "blocks", F.pmod("part", F.lit(64)).alias("pack"))
        .agg(F.collect_list(F.struct("query_id", "x")).alias("queries"))
        .withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    )
    count_of = F.create_map(*(F.lit(int(v)) for pair in enumerate(blocks) for v in pair))
    data = (
        placed.withColumn(
            "block", F.pmod(F.xxhash64("vec_id", "q"), count_of[F.col("pivot")]).cast("int")
        )
        .groupBy("pivot", "block")
        .agg(F.collect_list(F.struct("vec_id", "q")).alias("members"))
    )

    never, score_type = (NEVER, pa.int64()) if kind == SMALL else (NEVER_WIDE, pa.decimal128(38, 0))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                queries, members = batch.column("queries")[row], batch.column("members")[row]
                asked, vec = queries.values.field("query_id").to_numpy(), members.values.field("vec_id").to_numpy()
                x, v = exact(queries.values.field("x"), kind), exact(members.values.field("q"), kind)
                order = np.argsort(vec, kind="stable")
                vec, v = vec[order], v[order]
                for at in range(0, len(x), QUERY_BLOCK):
                    ids = asked[at : at + QUERY_BLOCK]
                    score = x[at : at + QUERY_BLOCK] @ v.T
                    score = score.astype(np.int64) if kind == SMALL else score
                    score[ids[:, None] == vec[None, :]] = never
                    best = np.argsort(-score, axis=1, kind="stable")[:, :k]
                    value = np.take_along_axis(score, best, 1).ravel()
                    real = np.array(value > never, bool)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(ids, best.shape[1])[real]),
                            pa.array(vec[best.ravel()][real]),
                            pa.array(value[real].tolist(), score_type) if kind == WIDE else pa.array(value[real]),
                        ],
                        names=["query_id", "vec_id", "score"],
                    )

    met = packs.join(data, ["pivot", "block"]).select("queries", "members")
    held = "long" if kind == SMALL else "decimal(38,0)"
    found = met.mapInArrow(solve, f"query_id long, vec_id long, score {held}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.col("score").try_cast("long").alias("score"))
    )
