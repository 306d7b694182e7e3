"""Merging a new extract into a published snapshot.

Parquet tables take no MERGE statement, and none is needed: with a full extract as the source,
"update matched, insert new, delete vanished" leaves exactly the source behind. What a MERGE adds,
the account of what changed, is one full outer join on the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.errors import ContractError


def _has_null(key: Sequence[str]) -> Column:
    return reduce(or_, (F.col(name).isNull() for name in key))


def _split_by_key(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete key, and rows whose key has a NULL.

    A NULL matches nothing, so the second part never needs to meet the other side. Left in the
    join, all of it would hash to one reducer. The filter for it reaches the scan, where files
    without NULL keys are skipped by their statistics.
    """
    return df.filter(~_has_null(key)), df.filter(_has_null(key))


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys without a NULL that occur more than once, with their number of rows."""
    counts = df.filter(~_has_null(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def require_unique_key(df: DataFrame, key: Sequence[str]) -> None:
    """Raise when a key repeats: several source rows cannot update one target row."""
    repeated = repeated_keys(df, key).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if repeated:
        raise ContractError(f"{repeated} key(s) occur more than once")


def merge_snapshot(
    target: DataFrame, source: DataFrame, key: Sequence[str], assume_unique: bool = False
) -> DataFrame:
    """Content of ``target`` after merging the full extract ``source`` into it.

    ``assume_unique`` skips the check of a source that was deduplicated by the key.
    """
    if not assume_unique:
        require_unique_key(source, key)
    return source.select(*target.columns)


def merge_upsert(
    target: DataFrame, source: DataFrame, key: Sequence[str], assume_unique: bool = False
) -> DataFrame:
    """Content of ``target`` after an upsert without the delete branch.

    ``assume_unique`` is for two frames that were deduplicated by the key, the NULL key included:
    each is evaluated once, by one full join. Otherwise the source is read for its check, its keys
    and its rows, the target's rows may repeat, and a small source can be broadcast.
    """
    columns = target.columns
    if assume_unique:
        joined = _full_join(_rows(target, key, columns, "old"), _rows(source, key, columns, "new"), key)
        return joined.select(F.coalesce("new", "old").alias("row")).select("row.*").select(*columns)
    require_unique_key(source, key)
    complete, keyless = _split_by_key(target, key)
    incoming = source.filter(~_has_null(key)).select(*key)
    untouched = complete.join(incoming, list(key), "left_anti").select(*columns)
    return untouched.unionByName(keyless).unionByName(source.select(*columns))


def _rows(
    df: DataFrame, key: Sequence[str], content: Sequence[str | Column], name: str
) -> DataFrame:
    return df.select(*key, F.struct(*content).alias(name))


def _full_join(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every row of both sides, paired where the key is equal; a key with a NULL pairs with none."""
    return old.join(new, list(key), "full_outer")


def change_report(
    old: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    compare: Sequence[str] | None = None,
    assume_unique: bool = False,
) -> DataFrame:
    """One row per key of either snapshot: INSERT, UPDATE, DELETE or UNCHANGED.

    ``compare`` are the columns whose change makes an UPDATE; all non-key columns by default. A
    key that repeats in both snapshots would pair all its rows, so both are checked first, by a
    count that combines map-side; ``assume_unique`` skips that for frames that were deduplicated
    by the key, the NULL key included. Each of those is evaluated once and joined as it is: of rows
    without a key it has one, which cannot crowd a reducer. Rows whose key has a NULL match nothing.
    """
    compared = list(compare) if compare is not None else [c for c in old.columns if c not in key]
    if assume_unique:
        return _actions(old, new, key, compared)
    require_unique_key(old, key)
    require_unique_key(new, key)
    old_complete, old_keyless = _split_by_key(old, key)
    new_complete, new_keyless = _split_by_key(new, key)
    return (
        _actions(old_complete, new_complete, key, compared)
        .unionByName(old_keyless.select(*key, F.lit("DELETE").alias("action")))
        .unionByName(new_keyless.select(*key, F.lit("INSERT").alias("action")))
    )


def _actions(
    old: DataFrame, new: DataFrame, key: Sequence[str], compared: Sequence[str]
) -> DataFrame:
    # A field that is never NULL tells a row's absence from NULL values in it.
    content = [F.lit(True).alias("present"), *compared]
    joined = _full_join(_rows(old, key, content, "old"), _rows(new, key, content, "new"), key)
    action = (
        F.when(F.col("old.present").isNull(), F.lit("INSERT"))
        .when(F.col("new.present").isNull(), F.lit("DELETE"))
        .when(F.col("old").eqNullSafe(F.col("new")), F.lit("UNCHANGED"))
        .otherwise(F.lit("UPDATE"))
    )
    return joined.select(*key, action.alias("action"))


#: Rows in a bucket, about, and the least and greatest number of buckets.
ROWS_PER_BUCKET = 10_000
BUCKETS = (64, 1 << 20)


def buckets_for(rows: int) -> int:
    """A number of buckets that keeps a bucket small and the table of their digests bounded."""
    return min(max(BUCKETS[0], -(-rows // ROWS_PER_BUCKET)), BUCKETS[1])


def _hashable(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Columns for a hash that passes over NULLs and takes no maps: each with whether it is there."""
    parts: list[Column] = []
    for field in (df.schema[name] for name in names):
        kind = field.dataType.simpleString()
        unordered = any(part in kind for part in ("map<", "variant"))
        nested = unordered or isinstance(field.dataType, (T.ArrayType, T.StructType))
        value = F.to_json(F.struct(F.col(field.name)), {"ignoreNullFields": "false"}) if nested else F.col(field.name)
        parts += [value, F.col(field.name).isNull()]
    return parts


def with_bucket(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """Add ``bucket``, a function of the key; equal keys, also ones with NULLs, share a bucket."""
    return df.withColumn("bucket", F.pmod(F.xxhash64(*_hashable(df, key)), F.lit(buckets)))


def bucket_digests(
    df: DataFrame, key: Sequence[str], compare: Sequence[str], buckets: int
) -> DataFrame:
    """bucket, n_rows, has_null_key and two sums of row hashes, for each bucket that has rows.

    Sums do not depend on order, combine map-side and count every copy of a row, so the exchange
    carries one row per task and bucket whatever the size of the table.
    """
    row = _hashable(df, [*key, *compare])
    hashes = {
        f"digest_{seed}": F.sum(F.xxhash64(F.lit(seed), *row).cast("decimal(38,0)")) for seed in (1, 2)
    }
    return with_bucket(df, key, buckets).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_or(_has_null(key)).alias("has_null_key"),
        *(total.alias(name) for name, total in hashes.items()),
    )


def compared_buckets(
    old: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    buckets: int,
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """bucket, is_changed and n_rows of ``new``, for the buckets either side has.

    Each side is read once, for an aggregate that shuffles one row per task and bucket. Rows of equal
    buckets are equal but for the chance that two sums of 64-bit hashes agree at once. A NULL in the
    key makes a bucket count as changed, since such rows pair with none. There are at most
    ``buckets`` rows, and they are needed more than once: write them.
    """
    compared = list(compare) if compare is not None else [c for c in old.columns if c not in key]
    ends = [
        bucket_digests(side, key, compared, buckets).select(
            "bucket", F.struct("n_rows", "has_null_key", "digest_1", "digest_2").alias(name)
        )
        for side, name in ((old, "old"), (new, "new"))
    ]
    differ = ~F.col("old").eqNullSafe(F.col("new")) | F.col("old.has_null_key")
    return ends[0].join(ends[1], "bucket", "full_outer").select(
        "bucket", differ.alias("is_changed"), F.col("new.n_rows").alias("n_rows")
    )


def rows_of_changed(
    df: DataFrame, key: Sequence[str], buckets: int, known: DataFrame
) -> DataFrame:
    """The rows whose bucket is changed in ``known``, of either side of the comparison."""
    wanted = known.filter("is_changed").select("bucket")
    return with_bucket(df, key, buckets).join(wanted, "bucket", "left_semi").drop("bucket")


def changes_by_bucket(
    old: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    buckets: int,
    known: DataFrame,
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """The change report of the buckets that differ; keys of the others are unchanged and left out.

    Both sides must be unique by the key, the NULL key included. Only rows of changed buckets are
    joined on the key; ``known`` is what ``compared_buckets`` found.
    """
    compared = list(compare) if compare is not None else [c for c in old.columns if c not in key]
    sides = [
        rows_of_changed(side.select(*key, *compared), key, buckets, known) for side in (old, new)
    ]
    return _actions(*sides, key, compared)


def change_totals(report: DataFrame, known: DataFrame) -> DataFrame:
    """action and n_rows of a report by buckets, with the unchanged rows of the buckets it left out."""
    same = known.filter(~F.col("is_changed")).select(F.lit("UNCHANGED").alias("action"), "n_rows")
    return change_counts(report).unionByName(same).groupBy("action").agg(F.sum("n_rows").alias("n_rows"))


def change_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("action").agg(F.count(F.lit(1)).alias("n_rows"))
