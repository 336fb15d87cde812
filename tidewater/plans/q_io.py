"""Ingest and table-write queries: the data goes through files written under
the shared checkpoint folder and is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.registry import query
from tidewater.session import scratch_path
from tidewater.sources import files

SPLIT = "1998-01-01 00:00:00"


# text formats default to millisecond timestamps; keep microseconds on the wire
MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _land(df, path, fmt, num_files=4, options=None):
    w = df.repartition(num_files).write.mode("overwrite").options(**(options or {}))
    if fmt == "csv":
        w = w.option("header", "true")
    w.format(fmt).save(path)


def _ingest_twice(spark, frame, fmt, split_col=None, options=None):
    """Land two file sets (before / after the split), run the ingest after
    each, then once more with nothing new: every file is read exactly once."""
    land, bronze, ckpt = (scratch_path(spark, x) for x in ("land", "bronze", "bronze-ckpt"))
    parts = [frame] if split_col is None else [
        frame.where(F.col(split_col) < F.lit(SPLIT).cast("timestamp_ntz")),
        frame.where(F.col(split_col) >= F.lit(SPLIT).cast("timestamp_ntz")),
    ]
    for i, part in enumerate(parts):
        _land(part, f"{land}/set={i}", fmt)
        files.ingest_to_bronze(spark, f"{land}/*", bronze, ckpt, fmt, schema=frame.schema, options=options)
    files.ingest_to_bronze(spark, f"{land}/*", bronze, ckpt, fmt, schema=frame.schema, options=options)
    return files.read_bronze(spark, bronze, frame.schema)


@query("ingest_files", "SELECT * FROM events")
def q_ingest_files(spark, t):
    """One landing zone per format (JSON, CSV, Parquet), each ingested
    incrementally twice (no re-reads), bronze tables unioned by name."""
    ev = t.events
    parts = {
        "json": (ev.where(F.col("event_type").isin("view", "click")), dict(MICROS)),
        "csv": (ev.where(F.col("event_type").isin("signup", "purchase")), {**MICROS, "header": "true"}),
        "parquet": (ev.where(~F.col("event_type").isin("view", "click", "signup", "purchase") | F.col("event_type").isNull()), {}),
    }
    frames = []
    for fmt, (part, opts) in parts.items():
        land, bronze, ckpt = (scratch_path(spark, f"{fmt}-{x}") for x in ("land", "bronze", "ckpt"))
        _land(part, f"{land}/set=0", fmt, options=opts)
        for _ in range(2):
            files.ingest_to_bronze(spark, f"{land}/*", bronze, ckpt, fmt, schema=ev.schema, options=opts)
        frames.append(files.read_bronze(spark, bronze, ev.schema).drop(*files.AUDIT_COLUMNS))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("ingest_json", "SELECT * FROM orders")
def q_ingest_json(spark, t):
    """JSON files ingested incrementally (audit columns dropped for comparison)."""
    bronze = _ingest_twice(spark, t.orders, "json", "o_orderdate")
    return bronze.drop(*files.AUDIT_COLUMNS)


@query("ingest_csv", "SELECT * FROM customer")
def q_ingest_csv(spark, t):
    """S3: CSV files with a header row."""
    return _ingest_twice(spark, t.customer, "csv", options={"header": "true"}).drop(*files.AUDIT_COLUMNS)


@query("ingest_parquet", "SELECT * FROM lineitem")
def q_ingest_parquet(spark, t):
    """S3: Parquet files."""
    return _ingest_twice(spark, t.lineitem, "parquet", "l_shipdate").drop(*files.AUDIT_COLUMNS)


@query(
    "ingest_audit",
    f"""
SELECT CASE WHEN o_orderdate < TIMESTAMP '{SPLIT}' THEN 0 ELSE 1 END AS file_set, count(*) AS rows
FROM orders GROUP BY 1""",
)
def q_ingest_audit(spark, t):
    """Audit columns — rows per landed file set, read off ``_source_file``."""
    bronze = _ingest_twice(spark, t.orders, "json", "o_orderdate")
    set_id = F.regexp_extract(F.col("_source_file"), r"/set=(\d+)/", 1).cast("int")
    return bronze.where(F.col("_ingest_ts").isNotNull()).groupBy(set_id.alias("file_set")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query(
    "ingest_evolved",
    f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderdate < TIMESTAMP '{SPLIT}' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders""",
)
def q_ingest_evolved(spark, t):
    """Schema inferred and kept in the ledger on the first run, widened
    from the new files alone when a later file set brings ``o_orderpriority``; earlier rows read it as NULL."""
    o = t.orders
    land, bronze, ckpt, sl = (scratch_path(spark, x) for x in ("eland", "ebronze", "eckpt", "eschema"))
    cut = F.lit(SPLIT).cast("timestamp_ntz")
    _land(o.where(F.col("o_orderdate") < cut).drop("o_orderpriority"), f"{land}/set=0", "json")
    files.ingest_to_bronze(spark, f"{land}/*", bronze, ckpt, "json", schema_location=sl)
    _land(o.where(F.col("o_orderdate") >= cut), f"{land}/set=1", "json")
    files.ingest_to_bronze(spark, f"{land}/*", bronze, ckpt, "json", schema_location=sl)
    b = files.read_bronze(spark, bronze, schema_location=sl)
    return b.select(
        F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), "o_orderstatus",
        F.col("o_totalprice").cast("double"), F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
        "o_orderpriority",
    )


@query("table_write_modes", "SELECT * FROM lineitem")
def q_table_write_modes(spark, t):
    """Overwrite partitioned, append, dynamic partition overwrite, read back."""
    li = t.lineitem
    path = scratch_path(spark, "lineitem-table")
    cut = F.lit(SPLIT).cast("timestamp_ntz")
    files.write_table(li.where(F.col("l_shipdate") < cut), path, "overwrite", ["l_returnflag"])
    files.write_table(li.where(F.col("l_shipdate") >= cut), path, "append", ["l_returnflag"])
    # replace partition R with a fresh copy of its rows; A and N stay untouched
    files.write_table(li.where(F.col("l_returnflag") == "R"), path, "overwrite", ["l_returnflag"], dynamic=True)
    return spark.read.parquet(path)


@query("clustered_write", "SELECT * FROM lineitem")
def q_clustered_write(spark, t):
    """Z-ordered layout on (l_partkey, l_suppkey), written and read back."""
    path = scratch_path(spark, "lineitem-z")
    files.write_table(files.zorder_by(t.lineitem, ["l_partkey", "l_suppkey"]), path)
    return spark.read.parquet(path)
