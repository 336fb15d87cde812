"""Digest trees find differing ranges; rows are read only there."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidewater.plans import quality as qa
from tidewater.plans import range_digest as rd
from tidewater.session import scratch_path

SCHEMA = "k long, v string, x double, at timestamp_ntz"


def frame(spark, rows):
    df = spark.createDataFrame(rows, "k long, v string, x double, s string")
    return df.select("k", "v", "x", F.col("s").cast("timestamp_ntz").alias("at"))


def some(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(-50, 400)]), rng.choice(["a", None, ""]), rng.choice([0.1, 1e6, None]), "2024-01-01 00:00:00") for _ in range(n)]


def rows(df):
    return sorted((tuple(r) for r in df.select("k", "v", "x", "at", "side").collect()), key=str)


def test_the_digest_is_portable(spark):
    df = frame(spark, [(7, "é", 1.5, "2024-01-02 03:04:05.000006"), (8, None, None, None)])
    got = {r.node: (r.rows, int(r.digest)) for r in rd.leaf_digests(df, "k", 1).collect()}
    text = lambda *p: int(hashlib.md5("\x1f".join(p).encode()).hexdigest()[:15], 16)
    assert got == {7: (1, text("2024-01-02 03:04:05.000006", "7", "é", "1.500000")), 8: (1, text("\\N", "8", "\\N", "\\N"))}
    with pytest.raises(TypeError):
        rd.portable(df.select(F.array("k").alias("a")), "a")


@pytest.mark.parametrize("seed", [1, 2])
def test_range_diff_equals_the_full_diff(spark, seed):
    rng = random.Random(seed)
    one = some(seed, 300)
    two = [r for r in one if rng.random() > 0.02] + some(seed + 9, 3) + one[:2]
    a, b = frame(spark, one), frame(spark, two)
    got = rows(rd.range_diff(a, b, "k", leaf=8, fanout=4, height=2))
    assert got == rows(qa.table_diff(a, b)) and got
    assert rows(rd.range_diff(a, b, "k", leaf=8, fanout=4, height=2, max_ranges=1)) == got
    assert rd.range_diff(a, a, "k", leaf=8, fanout=4, height=2).count() == 0


def test_only_differing_ranges_are_read(spark):
    path = scratch_path(spark, "rd")
    spark.range(0, 4000).select(F.col("id").alias("k"), F.lit("v").alias("v")).write.parquet(path)
    a = spark.read.parquet(path)
    b = a.withColumn("v", F.when(F.col("k").isin(1234, 1300, 3999), "w").otherwise(F.col("v")))
    trees = [rd.DigestTree(d, "k", leaf=100, fanout=4, height=2) for d in (a, b)]
    nodes = sorted(r.node for r in rd.differing_leaves(*trees).collect())
    assert nodes == [12, 13, 39]
    plan = rd.within(a, "k", 100, nodes)._jdf.queryExecution().toString()
    pushed = [x for x in plan.splitlines() if "PushedFilters" in x][0]
    assert "GreaterThanOrEqual(k,1200)" in pushed and "LessThan(k,1400)" in pushed and "LessThan(k,1300)" not in pushed
    assert rd.within(a, "k", 100, nodes).count() == 300
    with pytest.raises(ValueError, match="alike"):
        rd.differing_leaves(trees[0], rd.DigestTree(a, "k", leaf=50, fanout=4, height=2))
