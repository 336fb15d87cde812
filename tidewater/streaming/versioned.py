"""A keyed Parquet table with versions.

Each commit writes the partitions that a batch touches to directories of its
own and then one log row: which directory each of these partitions now has.
A version is the latest directory of every partition, so a commit costs what it
touches, whatever the table holds, and a reader of an older version goes on
reading its own directories until they are retired.

    {path}/data/v=7/_part=2024-01-15/...      rows, written once
    {path}/_log/v=7/...                       version, batch_id, full, schema, parts

Every ``FULL_EVERY`` versions the log row lists all partitions, so that a
version is read from few rows and older ones can go. One writer at a time: a
stream's ``foreachBatch``, or a nightly run while no batch is under way; one that
finds a newer version than it read raises. A batch id that its writer has in the
log is not applied again; a crash before the log row leaves directories that no version names, and the
repeated batch overwrites them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.upsert import upsert
from tidewater.session import delete, read_if_there

FULL_EVERY = 10
LOG_SCHEMA = "version long, writer string, batch_id long, full boolean, schema string, parts array<struct<part:string,dir:string>>"
NO_PART = "none"


class ConcurrentCommitError(RuntimeError):
    """Another writer has committed since this one read the table."""


@dataclass(frozen=True)
class Version:
    """A snapshot: the directory of every partition."""

    version: int
    batch_id: int
    schema: T.StructType
    parts: dict[str, str]


class VersionedTable:
    """Rows with unique ``keys``. ``partition`` (an expression over key columns
    of type date or int; without it the table is one partition) decides which
    partition a key lives in, so an upsert needs only the batch's partitions.
    The last ``keep`` versions stay readable. ``read`` opens the log: the frame
    at a path, or None if there is none."""

    def __init__(self, path: str, keys: list[str], partition: Column | None = None, keep: int = 16, read=read_if_there):
        if keep < 1:
            raise ValueError("at least the last version is kept")
        self.path, self.keys, self.keep, self._read_log = path.rstrip("/"), keys, keep, read
        self.partition = F.lit(None).cast("int") if partition is None else partition

    # -- reading --------------------------------------------------------------
    def _log(self, spark: SparkSession) -> list:
        """Log rows, oldest first: at most ``keep + FULL_EVERY`` after a
        retirement, and no more entries than partitions and recent changes."""
        log = self._read_log(spark, f"{self.path}/_log")
        return [] if log is None else sorted(log.select("version", "writer", "batch_id", "full", "schema", "parts").collect())

    @staticmethod
    def _snapshots(log: list) -> dict[int, Version]:
        """Every version that the log can tell."""
        out, parts = {}, None
        for row in log:
            if row["full"]:
                parts = {}
            if parts is not None:
                parts = parts | {p["part"]: p["dir"] for p in row["parts"]}
                out[row["version"]] = Version(row["version"], row["batch_id"], T.StructType.fromJson(json.loads(row["schema"])), parts)
        return out

    def snapshot(self, spark: SparkSession, version: int | None = None) -> Version | None:
        """A version, by default the last one; None if there is none yet."""
        found = self._snapshots(self._log(spark))
        if version is None:
            return found[max(found)] if found else None
        if version not in found:
            raise ValueError(f"version {version} is not kept: {sorted(found)}")
        return found[version]

    def read(self, spark: SparkSession, version: int | None = None, parts: list[str] | None = None) -> DataFrame | None:
        """The rows of a version. The frame is bound to that version's
        directories: later commits do not change it. ``parts`` reads only these
        partitions."""
        found = self.snapshot(spark, version)
        return None if found is None else self._rows(spark, found, parts)

    def _rows(self, spark: SparkSession, version: Version, parts: list[str] | None = None) -> DataFrame:
        wanted = version.parts if parts is None else {p: version.parts[p] for p in parts if p in version.parts}
        dirs = [f"{self.path}/data/{d}" for _, d in sorted(wanted.items())]
        return spark.read.schema(version.schema).parquet(*dirs) if dirs else spark.createDataFrame([], version.schema)

    # -- writing --------------------------------------------------------------
    def _part(self, df: DataFrame) -> DataFrame:
        kind = df.select(self.partition.alias("p")).schema["p"].dataType
        if not isinstance(kind, (T.DateType, T.IntegerType, T.LongType)):
            raise TypeError(f"a partition is a date or a whole number, not {kind.simpleString()}")
        return df.withColumn("_part", F.coalesce(self.partition.cast("string"), F.lit(NO_PART)))

    def commit(self, batch: DataFrame, batch_id: int, writer: str = "stream") -> int:
        """Upsert ``batch`` and return the version it is in. Keys that are twice
        in the batch raise; a batch that is in the log already changes nothing;
        an empty one is logged and writes no data."""
        spark = batch.sparkSession
        log = self._log(spark)
        done = [row["version"] for row in log if (row["writer"], row["batch_id"]) == (writer, batch_id)]
        if done:
            return done[-1]
        last = self._snapshots(log)
        last = last[max(last)] if last else None
        version = 0 if last is None else last.version + 1
        batch = self._part(batch).persist()  # the stream's plan runs once
        try:
            touched = sorted(r[0] for r in batch.select("_part").distinct().collect())  # no more than there are partitions
            merged = batch
            if touched:
                if last is not None:
                    merged = upsert(self._part(self._rows(spark, last, touched)), batch, self.keys, null_safe=True)
                else:
                    merged = upsert(batch.limit(0), batch, self.keys, null_safe=True)
                (merged.hint("rebalance", "_part").write.mode("overwrite").partitionBy("_part")
                 .parquet(f"{self.path}/data/v={version}"))
        finally:
            batch.unpersist()
        changed = {p: f"v={version}/_part={p}" for p in touched}
        full = version % FULL_EVERY == 0
        parts = ((last.parts if last else {}) | changed) if full else changed
        row = (version, writer, batch_id, full, merged.drop("_part").schema.json(), sorted(parts.items()))
        if any(r["version"] >= version for r in self._log(spark)):
            raise ConcurrentCommitError(f"{self.path}: version {version} was committed meanwhile")
        (spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_log/v={version}"))
        if full:
            self.retire(spark)
        return version

    def retire(self, spark: SparkSession) -> list[str]:
        """Delete directories that only versions before the last ``keep`` name,
        then the log rows that no kept version needs. Returns the directories."""
        log = self._log(spark)
        found = self._snapshots(log)
        kept = sorted(found)[-self.keep :]
        if not kept:
            return []
        live = {d for v in kept for d in found[v].parts.values()}
        gone = sorted({p["dir"] for row in log for p in row["parts"]} - live)
        home = lambda d: d.split("/")[0]
        here = {home(d) for d in live}
        for d in sorted({d if home(d) in here else home(d) for d in gone}):
            delete(spark, f"{self.path}/data/{d}")
        base = max(row["version"] for row in log if row["full"] and row["version"] <= kept[0])
        for row in log:
            if row["version"] < base:
                delete(spark, f"{self.path}/_log/v={row['version']}")
        return gone
