"""Versioned snapshot tables on plain parquet.

A snapshot is written to a folder of its own and becomes visible by one more row in the table's
publication log, written last. Readers resolve the newest row, so they never see a half-written
snapshot, a failed publish leaves the previous one live, and older runs stay readable. Nothing is
renamed or overwritten in place: each attempt writes a folder of its own. Of writers that start from
the same version one alone can finish: it claims the next version by creating a file that must not
exist, before it adds the log row, and the others are refused.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from tidegate import storage
from tidegate.errors import TidegateError
from tidegate.session import single_row

LOG_TYPES = {
    "version": "long",
    "run_id": "string",
    "folder": "string",
    "schema": "string",
    "published_at_utc": "timestamp",
}
LOG_SCHEMA = ", ".join(f"{name} {data_type}" for name, data_type in LOG_TYPES.items())


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log = f"{self.root}/publications"
        self._written: dict[int, Mapping[str, object]] = {}

    def exists(self) -> bool:
        return storage.exists(self.spark, self._log)

    def history(self) -> DataFrame:
        """All publications: version, run, folder, schema and time."""
        if not self.exists():
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(self._log)

    def _newest(self, condition=None) -> Row | None:
        log = self.history() if condition is None else self.history().filter(condition)
        # each task hands on the newest row of its part of the log
        entry = F.struct("version", "run_id", "folder", "schema")
        return log.agg(F.max_by(entry, "version").alias("entry")).first()["entry"]

    def publish(self, df: DataFrame, run_id: str, sort_by: Sequence[str] = ()) -> int:
        """Write ``df`` as the next version, make it current, and return the version."""
        return self.commit(self.write(df, run_id, sort_by))

    def write(self, df: DataFrame, run_id: str, sort_by: Sequence[str] = ()) -> dict[str, object]:
        """Write the next version's data without making it current; ``commit`` takes the result.

        With ``sort_by`` the files hold ranges of these columns, in order, so a lookup or a range by
        them reads the files and row groups whose statistics allow it and skips the others.
        """
        newest = self._newest()
        version = newest["version"] + 1 if newest else 1
        folder = f"data/version={version:06d}-{run_id}-{uuid.uuid4().hex[:12]}"
        if sort_by:
            df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
        df.write.parquet(f"{self.root}/{folder}")
        return {"version": version, "run_id": run_id, "folder": folder, "schema": df.schema.json()}

    def commit(self, written: Mapping[str, object]) -> int:
        """Make written data the current version. Refused if another writer took the version.

        The claim is made by one atomic call of the file system, so two writers cannot both pass. A
        writer that dies between claim and log row leaves the version claimed: nobody can publish
        until ``release`` is called.
        """
        version = int(written["version"])
        newest = self._newest()
        if (newest["version"] if newest else 0) >= version or not storage.claim(self.spark, self._claim(version)):
            raise TidegateError(f"version {version} of {self.root} was claimed by another writer")
        entry = {**written, "published_at_utc": datetime.now(timezone.utc).isoformat()}
        single_row(self.spark, entry, LOG_TYPES).write.mode("append").parquet(self._log)
        self._written[version] = entry
        return version

    def _claim(self, version: int) -> str:
        return f"{self.root}/claims/version={version:06d}"

    def release(self) -> bool:
        """Give up the claim of a writer that died before its version was logged; True if there was
        one. Not to be called while a writer may still be at work."""
        newest = self._newest()
        claim = self._claim((newest["version"] if newest else 0) + 1)
        found = storage.exists(self.spark, claim)
        if found:
            storage.delete(self.spark, claim)
        return found

    def is_kept(self, folder: str) -> bool:
        """Whether the data of a publication was not expired."""
        return storage.exists(self.spark, f"{self.root}/{folder}")

    def _read(self, entry: Row | Mapping[str, object] | None, what: str) -> DataFrame:
        if entry is None:
            raise TidegateError(f"no {what} in {self.root}")
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.root}/{entry['folder']}")

    def read(self) -> DataFrame:
        """The current snapshot."""
        return self._read(self._newest(), "published snapshot")

    def as_of_run(self, run_id: str) -> DataFrame:
        """The newest snapshot a run published."""
        return self._read(self._newest(F.col("run_id") == run_id), f"snapshot of run {run_id!r}")

    def as_of_version(self, version: int) -> DataFrame:
        entry = self._written.get(version) or self._newest(F.col("version") == version)
        return self._read(entry, f"version {version}")

    def as_of_time(self, moment: datetime) -> DataFrame:
        """The snapshot that was current at a moment; a moment without a zone is refused."""
        if moment.tzinfo is None:
            raise ValueError("as of a time needs a time with a zone")
        at = F.lit(moment.astimezone(timezone.utc).isoformat()).cast("timestamp")
        return self._read(self._newest(F.col("published_at_utc") <= at), f"snapshot at {moment.isoformat()}")

    def expire(self, keep: int) -> int:
        """Delete the folders of all but the newest ``keep`` versions; returns how many."""
        if keep < 1:
            raise ValueError("at least the current version must be kept")
        newest = self._newest()
        if newest is None:
            return 0
        # folders that are still there, not the log of all there ever were
        folders = storage.glob(self.spark, f"{self.root}/data/version=*")
        numbers = [int(re.search(r"/version=(\d+)-[^/]*$", folder)[1]) for folder in folders]
        last_gone = newest["version"] - keep
        gone = [folder for folder, version in zip(folders, numbers) if version <= last_gone]
        for folder in gone:
            storage.delete(self.spark, folder)
        return len(gone)
