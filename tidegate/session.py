"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.errors import TidegateError

# Settings that change results (UTC, ANSI) or let AQE size the shuffles. The cluster's own
# executor, memory and shuffle settings are left alone.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Routes are few: keep a file open per route instead of sorting every task by route.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "tidegate", master: str | None = None, **extra: str) -> SparkSession:
    """Build a session; ``extra`` takes further settings with ``__`` standing for a dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SESSION_CONF | {key.replace("__", "."): value for key, value in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


MIB = 1024 * 1024


def scale_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Scan and shuffle sizes for one large input, to set before a run.

    AQE merges shuffle partitions but never splits a plan that is too coarse, so their number is
    an upper bound that grows with the data and never leaves cores idle. A shuffle has a block per
    pair of map and reduce task; from some terabytes on, tasks grow instead of the number of pairs.
    """
    size = 128 * MIB
    while size < 1024 * MIB and (input_bytes / size) ** 2 > 1e9:
        size *= 2
    return {
        "spark.sql.files.maxPartitionBytes": str(size),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(size),
        "spark.sql.shuffle.partitions": str(max(cores, -(-input_bytes // size))),
    }


_own_root: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where that is unset a local session uses a folder of its own; on a cluster a folder of one
    machine would not do, so it is an error.
    """
    shared = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise TidegateError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    if not _own_root:
        _own_root.append(tempfile.mkdtemp(prefix="tidegate-"))
    return _own_root[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the scratch root; nothing is created yet."""
    return f"{scratch_root(spark)}/tidegate/{name}-{uuid.uuid4().hex}"


def run_together(spark: SparkSession, *actions: Callable[[], Any]) -> list[Any]:
    """Run independent actions as concurrent jobs and return their results in order.

    A small job then fills the cores that the tail of a large one leaves idle. The first failure
    is raised once all actions have ended.
    """
    with ThreadPoolExecutor(len(actions)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
    return [action.result() for action in started]


def single_row(spark: SparkSession, values: Mapping[str, object], types: Mapping[str, str]) -> DataFrame:
    """One row of constants in one partition, built without a Python worker."""
    return spark.range(0, 1, 1, 1).select(
        *(F.lit(values[name]).cast(data_type).alias(name) for name, data_type in types.items())
    )
