"""The schema ledger: only new files are opened, types widen safely."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import scratch_path
from tidewater.sources import files
from tidewater.sources.ledger import SchemaConflictError, SchemaLedger, evolve, wider


def local(path):
    return path.removeprefix("file:")


def spoil(path):
    """Make every data file below unreadable; name, size and time stay."""
    n = 0
    for d, _, names in os.walk(local(path)):
        for name in names:
            if name.startswith("part-"):
                p = os.path.join(d, name)
                st = os.stat(p)
                open(p, "r+b").write(b"{]" * (st.st_size // 2))
                os.utime(p, ns=(st.st_atime_ns, st.st_mtime_ns))
                crc = os.path.join(d, f".{name}.crc")
                if os.path.exists(crc):
                    os.remove(crc)
                n += 1
    return n


def paths(spark):
    return [scratch_path(spark, x) for x in ("gl", "gb", "gc", "gs")]


def test_a_run_opens_new_files_only(spark):
    land, bronze, ckpt, sl = paths(spark)
    go = lambda: files.ingest_to_bronze(spark, f"{land}/*", bronze, ckpt, "json", schema_location=sl)
    spark.range(40).select("id", F.lit("a").alias("name")).repartition(3).write.json(f"{land}/a")
    go()
    assert spoil(f"{land}/a") == 3
    spark.range(40, 50).select("id", F.lit("b").alias("name"), F.lit(1.5).alias("score")).repartition(2).write.json(f"{land}/b")
    go()
    opened = []
    ledger = SchemaLedger(spark, sl)
    ledger.update(f"{land}/*", lambda p: opened.append(p))
    go()
    assert opened == []
    assert [r["n"] for r in ledger.files().groupBy("run").agg(F.count("*").alias("n")).orderBy("run").collect()] == [3, 2]
    b = files.read_bronze(spark, bronze, schema_location=sl)
    assert b.columns == ["id", "name", "score", *files.AUDIT_COLUMNS]
    assert b.count() == 50 and b.where("score is null").count() == 40 and b.agg(F.sum("id")).first()[0] == sum(range(50))


def test_bronze_is_read_without_merging_footers(spark):
    land, bronze, ckpt, sl = paths(spark)
    spark.range(3).write.json(f"{land}/a")
    files.ingest_to_bronze(spark, f"{land}/*", bronze, ckpt, "json", schema_location=sl)
    spoil(bronze)
    assert files.read_bronze(spark, bronze, schema_location=sl).columns == ["id", *files.AUDIT_COLUMNS]  # planned, no file opened


def test_wider_types_are_read_back(spark):
    land, bronze, ckpt, sl = paths(spark)
    go = lambda: files.ingest_to_bronze(spark, f"{land}/*", bronze, ckpt, "parquet", schema_location=sl)
    spark.range(3).select(F.col("id").cast("int").alias("n"), F.lit(1.5).cast("float").alias("x"), F.lit("1.25").cast("decimal(5,2)").alias("m"),
                          F.lit("2024-01-01").cast("date").alias("d")).write.parquet(f"{land}/a")
    go()
    spark.range(2).select(F.lit(2**40).alias("n"), F.lit(2.5).alias("x"), F.lit("123456.1234").cast("decimal(12,4)").alias("m"),
                          F.lit("2024-01-02 03:04:05").cast("timestamp_ntz").alias("d")).write.parquet(f"{land}/b")
    go()
    b = files.read_bronze(spark, bronze, schema_location=sl)
    assert dict(b.dtypes)["n"] == "bigint" and dict(b.dtypes)["m"] == "decimal(12,4)" and dict(b.dtypes)["d"] == "timestamp_ntz"
    got = b.agg(F.sum("n"), F.sum("x"), F.sum("m").cast("double"), F.min("d"), F.count("d")).first()
    assert (got[0], got[1], got[2], str(got[3]), got[4]) == (3 + 2 * 2**40, 9.5, 3 * 1.25 + 2 * 123456.1234, "2024-01-01 00:00:00", 5)


def test_a_type_that_does_not_fit_raises_and_ingests_nothing(spark):
    land, bronze, ckpt, sl = paths(spark)
    go = lambda: files.ingest_to_bronze(spark, f"{land}/*", bronze, ckpt, "json", schema_location=sl)
    spark.range(3).write.json(f"{land}/a")
    go()
    spark.createDataFrame([("x",)], "id string").write.json(f"{land}/b")
    for _ in range(2):                      # it raises again: the file counts as unseen
        with pytest.raises(SchemaConflictError, match="id"):
            go()
    assert files.read_bronze(spark, bronze, schema_location=sl).count() == 3


def test_widening_rules():
    I, L, D, S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    assert wider(I, L) == wider(L, I) == L and wider(T.FloatType(), D) == D and wider(I, D) == D
    assert wider(L, D) is None and wider(S, L) is None and wider(T.DateType(), T.TimestampType()) is None
    assert wider(T.DecimalType(10, 2), T.DecimalType(8, 4)) == T.DecimalType(12, 4)
    assert wider(T.DecimalType(38, 0), T.DecimalType(38, 20)) is None
    assert wider(L, T.DecimalType(22, 2)) == T.DecimalType(22, 2) and wider(L, T.DecimalType(10, 2)) is None
    a = T.StructType([T.StructField("s", T.StructType([T.StructField("x", I)]), False), T.StructField("l", T.ArrayType(I))])
    b = T.StructType([T.StructField("l", T.ArrayType(L)), T.StructField("s", T.StructType([T.StructField("y", S)])), T.StructField("z", S)])
    e = evolve(a, b)
    assert e.simpleString() == "struct<s:struct<x:int,y:string>,l:array<bigint>,z:string>" and all(f.nullable for f in e.fields)
