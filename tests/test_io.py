"""Ingest: exactly-once per file, batch ids, schema evolution; layouts."""

import pytest
from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.sources import files


def test_ingest_batch_ids_and_no_rereads(spark, tables):
    o = tables.orders
    land, bronze, ckpt = (scratch_path(spark, x) for x in ("tl", "tb", "tc"))
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    o.where(F.col("o_orderdate") < cut).write.json(f"{land}/a")
    files.ingest_to_bronze(spark, f"{land}/*", bronze, ckpt, "json", schema=o.schema, batch_id_column=True)
    o.where(F.col("o_orderdate") >= cut).write.json(f"{land}/b")
    files.ingest_to_bronze(spark, f"{land}/*", bronze, ckpt, "json", schema=o.schema, batch_id_column=True)
    files.ingest_to_bronze(spark, f"{land}/*", bronze, ckpt, "json", schema=o.schema, batch_id_column=True)
    b = files.read_bronze(spark, bronze)
    assert b.count() == o.count()
    assert {r[0] for r in b.select("_ingest_batch_id").distinct().collect()} == {0, 1}
    assert b.where(F.col("_source_file").isNull() | F.col("_ingest_ts").isNull()).count() == 0
    assert b.drop("_ingest_batch_id", *files.AUDIT_COLUMNS).exceptAll(o).count() == 0


def test_schema_required(spark):
    with pytest.raises(ValueError):
        files.resolve_schema(spark, "/nonexistent", "json", None, None)


def test_widen_keeps_old_columns():
    from pyspark.sql import types as T

    old = T.StructType([T.StructField("a", T.LongType())])
    new = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    w = files.widen(old, new)
    assert w.fieldNames() == ["a", "b"] and isinstance(w["a"].dataType, T.LongType)


def test_zorder_and_range_layouts_keep_rows(spark, tables):
    li = tables.lineitem
    z = files.zorder_by(li, ["l_partkey", "l_suppkey"], num_partitions=4)
    r = files.cluster_by(li, ["l_partkey"], num_partitions=4)
    for out in (z, r):
        assert out.exceptAll(li).count() == 0 and li.exceptAll(out).count() == 0
    # range layout: partitions cover disjoint key ranges
    spans = r.groupBy(F.spark_partition_id().alias("p")).agg(F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi")) \
        .orderBy("lo").collect()
    assert all(a.hi <= b.lo for a, b in zip(spans, spans[1:]))
