"""Retention by partition: what is dropped, cut, kept; nothing else is read."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidewater.plans import governance as gv
from tidewater.plans import retention as rt
from tidewater.session import scratch_path

AS_OF = dt.datetime(2024, 1, 10, 12)


def stored(spark, spoil=()):
    df = spark.createDataFrame([(i, None if i == 99 else f"2024-01-{1 + i // 4:02d} {6 * (i % 4):02d}:00:00") for i in [*range(40), 99]], "id int, ts string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("day", F.to_date("ts"))
    path = scratch_path(spark, "rt")
    df.write.partitionBy("day").parquet(path)
    for d, _, names in os.walk(path.removeprefix("file:")):
        if any(s in d for s in spoil):
            for n in names:
                if n.endswith(".crc"):
                    os.remove(os.path.join(d, n))
                elif n.startswith("part-"):
                    open(os.path.join(d, n), "wb").write(b"unreadable")
    return path


def ids(spark, path):
    return sorted(r.id for r in spark.read.schema("id int, ts timestamp_ntz, day date").parquet(path).collect())


def test_only_the_cut_partition_is_read(spark):
    others = [f"day=2024-01-{d:02d}" for d in range(1, 11) if d != 7] + ["day=__HIVE"]
    path = stored(spark, others)
    report = {r.partition: r.action for r in rt.retain_table(spark, path, "day", "ts", 3, AS_OF).collect()}
    assert report == {f"2024-01-{d:02d}": "drop" if d < 7 else "cut" if d == 7 else "keep" for d in range(1, 11)} | {rt.DEFAULT_PARTITION: "keep"}
    left = sorted(n for n in os.listdir(path.removeprefix("file:")) if n.startswith("day="))
    assert left == [f"day=2024-01-{d:02d}" for d in range(7, 11)] + ["day=__HIVE_DEFAULT_PARTITION__"]
    assert ids(spark, f"{path}/day=2024-01-07") == [26, 27]
    plan = rt.rows_to_keep(spark, f"{path}/day=2024-01-07", "ts", AS_OF)._jdf.queryExecution().toString()
    assert "day=2024-01-07" in plan and "2024-01-08" not in plan


def test_rows_are_those_of_the_filter_and_a_second_run_is_a_no_op(spark):
    path = stored(spark)
    df = spark.createDataFrame(spark.read.parquet(path).drop("day").collect(), "id int, ts timestamp_ntz")
    want = sorted(r.id for r in gv.retain(df, "ts", 3, AS_OF).collect())
    assert 99 in want
    for _ in range(2):
        rt.retain_table(spark, path, "day", "ts", 3, AS_OF)
        assert ids(spark, path) == want
    assert sorted(r.id for r in gv.retain(df, "ts", 3, AS_OF, nulls="drop").collect()) == [i for i in want if i != 99]


def test_rows_without_a_time_are_dropped_or_routed(spark):
    path = stored(spark)
    rt.retain_table(spark, path, "day", "ts", 3, AS_OF, nulls="drop")
    assert 99 not in ids(spark, path)
    path, aside = stored(spark), scratch_path(spark, "aside")
    rt.retain_table(spark, path, "day", "ts", 3, AS_OF, nulls="route", route_path=aside)
    assert 99 not in ids(spark, path) and [r.id for r in spark.read.parquet(f"{aside}/*").collect()] == [99]


def test_months_and_bad_arguments(spark):
    names = ["m=2023-11-01", "m=2023-12-01", "m=2024-01-01", "_SUCCESS", "m=__HIVE_DEFAULT_PARTITION__"]
    got = dict(rt.plan_retention(names, "m", dt.datetime(2023, 12, 1), "month", "keep"))
    assert list(got.values()) == ["drop", "keep", "keep", "keep"]
    assert dict(rt.plan_retention(names, "m", dt.datetime(2023, 12, 31, 23), "month", "drop"))["m=2023-12-01"] == "cut"
    for bad in (lambda: rt.plan_retention(["x=1"], "m", AS_OF, "day", "keep"), lambda: rt.plan_retention(names, "m", AS_OF, "week", "keep"),
                lambda: rt.plan_retention(names, "m", AS_OF, "day", "lose"), lambda: rt.retain_table(spark, "/nowhere", "m", "t", 1, AS_OF, nulls="route"),
                lambda: gv.retain(spark.range(1), "id", 1, AS_OF, nulls="lose")):
        with pytest.raises(ValueError):
            bad()
