"""File ingest and table writes.

``ingest_to_bronze`` is an incremental, checkpointed, append-only file ingest:
each landed file is read exactly once (the file source's checkpoint), output
goes through the Parquet file sink (its ``_spark_metadata`` log makes the
output exactly-once), and a restart resumes where it stopped. Audit columns
record when and from which file each row came.

Schema: explicit, else inferred from the files that no run has seen and kept in
a ledger at ``schema_location`` (``sources/ledger.py``), else an error. When newly
landed files carry new columns or wider types the stored schema follows; older
rows read back as NULL, by the stored schema, without looking at footers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.sources.ledger import SchemaLedger

AUDIT_COLUMNS = ["_ingest_ts", "_source_file"]


# --------------------------------------------------------------------------
# Schema resolution and evolution
# --------------------------------------------------------------------------


def infer_schema(spark: SparkSession, path: str | list[str], fmt: str, sampling_ratio: float = 1.0,
                 options: dict | None = None) -> T.StructType:
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt == "json":
        reader = reader.option("samplingRatio", sampling_ratio)
    if fmt == "csv":
        reader = reader.option("inferSchema", "true").option("samplingRatio", sampling_ratio)
    return reader.load(path).schema


def widen(old: T.StructType, new: T.StructType) -> T.StructType:
    """Add columns that appear in ``new``; never drop or retype old ones."""
    known = set(old.fieldNames())
    return T.StructType(list(old.fields) + [f for f in new.fields if f.name not in known])


def resolve_schema(spark: SparkSession, source_path: str, fmt: str, schema: T.StructType | None,
                   schema_location: str | None, options: dict | None = None,
                   sampling_ratio: float = 1.0) -> T.StructType:
    if schema is not None:
        return schema
    if schema_location is None:
        raise ValueError("either an explicit schema or a schema_location is required")
    ledger = SchemaLedger(spark, schema_location)
    return ledger.update(source_path, lambda paths: infer_schema(spark, paths, fmt, sampling_ratio, options))


# --------------------------------------------------------------------------
# Incremental ingest
# --------------------------------------------------------------------------


def ingest_to_bronze(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    checkpoint_path: str,
    file_format: str = "json",
    schema: T.StructType | None = None,
    schema_location: str | None = None,
    trigger_interval: str | None = None,
    max_files_per_trigger: int | None = None,
    options: dict | None = None,
    batch_id_column: bool = False,
):
    """Start (or, with ``trigger_interval=None``, run to completion) the ingest.

    ``batch_id_column=True`` adds ``_ingest_batch_id``: each micro-batch is
    written by ``foreachBatch`` into its own ``_ingest_batch_id=N`` slice with
    overwrite, so a retried batch replaces itself instead of duplicating.
    """
    resolved = resolve_schema(spark, source_path, file_format, schema, schema_location, options)
    reader = spark.readStream.format(file_format).schema(resolved).options(**(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(source_path)
    bronze = raw.select(
        "*",
        F.current_timestamp().alias("_ingest_ts"),
        F.col("_metadata.file_path").alias("_source_file"),
    )
    if batch_id_column:
        def write_batch(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{target_path.rstrip('/')}/_ingest_batch_id={batch_id}")

        writer = bronze.writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(write_batch)
    else:
        writer = (
            bronze.writeStream.format("parquet")
            .option("path", target_path)
            .option("checkpointLocation", checkpoint_path)
            .outputMode("append")
        )
    if trigger_interval is None:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return None
    return writer.trigger(processingTime=trigger_interval).start()


def read_bronze(spark: SparkSession, target_path: str, schema: T.StructType | None = None,
                schema_location: str | None = None) -> DataFrame:
    """Bronze with every column ever ingested (older files give NULL), by the
    given schema or the one in the ledger: no footer is read to plan it. Without
    either the footers are merged."""
    if schema is None and schema_location is not None:
        schema = SchemaLedger(spark, schema_location).schema()
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(target_path)
    audit = [T.StructField("_ingest_ts", T.TimestampType()), T.StructField("_source_file", T.StringType())]
    return spark.read.schema(T.StructType(schema.fields + audit)).parquet(target_path)


# --------------------------------------------------------------------------
# Table writes (S6, S13, S14) and clustered layouts
# --------------------------------------------------------------------------


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                dynamic: bool = False) -> None:
    """overwrite (full replace), append, or dynamic overwrite of touched partitions.

    Partitioned writes go through a REBALANCE on the partition columns: AQE
    gathers each partition value's rows into few files and splits a hot value
    over several tasks (no one-task-per-day bottleneck, no file explosion).
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def cluster_by(df: DataFrame, cols: list[str], num_partitions: int | None = None) -> DataFrame:
    """Range-partition and sort so Parquet min/max statistics prune well."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)


def zorder_key(df: DataFrame, cols: list[str], bits: int = 8, relative_error: float = 0.001):
    """Z-order (Morton) key: each column is bucketed by approximate quantiles
    (one aggregate; ``2**bits - 1`` bounds per column come back to the driver),
    then bucket bits are interleaved."""
    buckets = 1 << bits
    probs = [i / buckets for i in range(1, buckets)]
    row = df.agg(*[
        F.percentile_approx(F.col(c).cast("double"), probs, int(1 / relative_error)).alias(c) for c in cols
    ]).first()
    key = F.lit(0).cast("long")
    k = len(cols)
    for i, c in enumerate(cols):
        bounds = F.array(*[F.lit(float(b)) for b in sorted(set(row[c] or []))])
        value = F.col(c).cast("double")
        bucket = F.size(F.filter(bounds, _below(value))).cast("long")
        for bit in range(bits):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(one, bit * k + i))
    return key


def _below(value):
    return lambda b: b < value


def zorder_by(df: DataFrame, cols: list[str], num_partitions: int | None = None, bits: int = 8) -> DataFrame:
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_z", zorder_key(df, cols, bits))
    return keyed.repartitionByRange(n, "_z").sortWithinPartitions("_z").drop("_z")
