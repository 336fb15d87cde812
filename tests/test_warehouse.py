"""SCD2 invariants, idempotence, surrogate keys, upsert and PIT joins."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators.keys import assign_surrogate_keys
from tidewater.operators.latest import latest_per_key
from tidewater.operators.pit_join import pit_join
from tidewater.operators.upsert import DuplicateKeyError, cdc_apply, upsert, upsert_partitioned_table
from tidewater.plans import warehouse as wh


@pytest.fixture(scope="module")
def dim(tables):
    return wh.build_dim_customer(tables.customer, tables.nation).cache()


def test_at_most_one_current_row_per_key(dim):
    assert dim.where("is_current").groupBy("c_custkey").count().where("count > 1").count() == 0


def test_versions_have_no_gap_or_overlap(dim):
    w = Window.partitionBy("c_custkey").orderBy("valid_from")
    nxt = dim.withColumn("next_from", F.lead("valid_from").over(w))
    bad = nxt.where(F.col("next_from").isNotNull() & (F.col("valid_to") != F.col("next_from")))
    assert bad.count() == 0
    assert nxt.where(F.col("next_from").isNull() & F.col("valid_to").isNotNull()).count() == 0


def test_surrogate_keys_dense_and_unique(dim):
    n = dim.count()
    stats = dim.agg(F.min("dim_customer_sk"), F.max("dim_customer_sk"), F.countDistinct("dim_customer_sk")).first()
    assert tuple(stats) == (1, n, n)


def test_reapplying_snapshot_is_noop(tables, dim):
    again = wh.build_dim_customer(tables.customer, tables.nation, reapply=True)
    assert again.exceptAll(dim).count() == 0 and dim.exceptAll(again).count() == 0


def test_every_fact_row_kept(tables):
    dc, dp = wh.build_dim_customer(tables.customer, tables.nation), wh.build_dim_product(tables.part)
    lines = wh.explode_order_lines(wh.orders_nested(tables.orders, tables.lineitem))
    fact = wh.build_fact_sales(lines, dc, dp)
    distinct_lines = lines.select("order_id", "line_id").distinct().count()
    assert fact.count() == distinct_lines
    salted = wh.build_fact_sales(lines, dc, dp, salt_buckets=3)
    assert fact.exceptAll(salted).count() == 0 and salted.exceptAll(fact).count() == 0


def test_pit_join_boundaries(spark):
    dim = spark.createDataFrame(
        [(1, 10, "2020-01-01 00:00:00", "2021-01-01 00:00:00"), (1, 11, "2021-01-01 00:00:00", None)],
        "k int, sk int, vf string, vt string",
    ).select("k", "sk", F.col("vf").cast("timestamp_ntz").alias("valid_from"),
             F.col("vt").cast("timestamp_ntz").alias("valid_to"))
    fact = spark.createDataFrame(
        [(1, "2019-12-31 23:59:59"), (1, "2020-06-01 00:00:00"), (1, "2021-01-01 00:00:00"), (2, "2021-01-01 00:00:00")],
        "k int, ts string",
    ).select("k", F.col("ts").cast("timestamp_ntz").alias("ts"))
    out = {(r["ts"].year, r["k"], r["sk"]) for r in pit_join(fact, dim, "k", "ts", "k", {"sk": "sk"}).collect()}
    assert out == {(2019, 1, None), (2020, 1, 10), (2021, 1, 11), (2021, 2, None)}


def test_latest_per_key_tie_breaks(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 3, "z"), (2, None, "q"), (2, 1, "p")],
                               "k int, ts int, v string")
    out = {(r.k, r.ts, r.v) for r in latest_per_key(df, "k", "ts").collect()}
    assert out == {(1, 5, "b"), (2, 1, "p")}


def test_upsert_rejects_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(2, "b"), (2, "c")], "k int, v string")
    with pytest.raises(DuplicateKeyError):
        upsert(t, s, ["k"]).collect()


def test_upsert_null_keys_match(spark):
    t = spark.createDataFrame([(None, "old"), (1, "x")], "k int, v string")
    s = spark.createDataFrame([(None, "new")], "k int, v string")
    assert sorted((r.k or 0, r.v) for r in upsert(t, s, ["k"]).collect()) == [(0, "new"), (1, "x")]


def test_upsert_twice_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = upsert(t, s, ["k"])
    twice = upsert(once, s, ["k"])
    assert once.exceptAll(twice).count() == 0 and twice.count() == 3


def test_cdc_latest_change_wins(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    ch = spark.createDataFrame(
        [("U", 1, 1, "a1"), ("D", 1, 2, None), ("I", 3, 1, "c"), ("U", 2, 5, "b2")],
        "op string, k int, change_ts int, v string")
    assert sorted(tuple(r) for r in cdc_apply(t, ch, ["k"]).collect()) == [(2, "b2"), (3, "c")]


def test_surrogate_keys_follow_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    out = assign_surrogate_keys(df, ["k"], "sk", 100).collect()
    assert sorted((r.k, r.sk) for r in out) == [(i, 101 + i) for i in range(1000)]


def test_upsert_partitioned_table(spark, tmp_path):
    from tidewater.operators.upsert import upsert_partitioned_table

    path, stage = str(tmp_path / "t"), str(tmp_path / "stage")
    spark.createDataFrame([(1, "d1", "a"), (2, "d1", "b"), (3, "d2", "c")], "k int, d string, v string") \
        .write.partitionBy("d").parquet(path)
    src = spark.createDataFrame([(2, "d1", "B"), (4, "d1", "D")], "k int, d string, v string")
    upsert_partitioned_table(spark, path, src, ["k"], "d", stage)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("k", "d", "v").collect())
    assert got == [(1, "d1", "a"), (2, "d1", "B"), (3, "d2", "c"), (4, "d1", "D")]


def test_initial_valid_from_and_unknown_member(spark, tables):
    v1 = wh.customer_snapshot(tables.customer, tables.nation, 1)
    d = wh.scd2_apply(None, v1, "c_custkey", wh.CUSTOMER_TRACKED, "1995-01-01 00:00:00", "sk",
                      initial_valid_from="1900-01-01 00:00:00")
    assert d.agg(F.min("valid_from")).first()[0].year == 1900
    dc, dp = wh.build_dim_customer(tables.customer, tables.nation), wh.build_dim_product(tables.part)
    lines = wh.explode_order_lines(wh.orders_nested(tables.orders, tables.lineitem))
    fact = wh.build_fact_sales(lines, dc, dp, unknown_sk=-1)
    assert fact.where(F.col("dim_customer_sk").isNull()).count() == 0
    assert fact.where(F.col("dim_customer_sk") == -1).count() > 0        # keys ending in 9 before 1998


def test_affected_dates_catch_late_days(spark, tables):
    dc, dp = wh.build_dim_customer(tables.customer, tables.nation), wh.build_dim_product(tables.part)
    lines = wh.explode_order_lines(wh.orders_nested(tables.orders, tables.lineitem))
    fact = wh.build_fact_sales(lines, dc, dp)
    full = wh.enrich_daily(wh.daily_sales(fact), dc, dp)
    late_day = fact.agg(F.min("order_date")).first()[0]
    # the target lost the earliest day (late data landed there); max-date misses it
    target = full.where(F.col("order_date") != F.lit(late_day))
    days = spark.createDataFrame([(late_day,)], "order_date date")
    fixed = wh.incremental_daily(target, fact, dc, dp, affected_dates=days)
    assert fixed.exceptAll(full).count() == 0 and full.exceptAll(fixed).count() == 0
    assert wh.incremental_daily(target, fact, dc, dp).count() < full.count()


def test_hot_key_pit_join_paths_agree(spark):
    """One customer holds a third of all fact rows: broadcast, shuffle and
    salted-shuffle point-in-time joins give the same rows."""
    n = 30000
    fact = spark.range(n).select(
        F.col("id").alias("line"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("cust"),
        (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_interval(days=(F.col("id") % 700).cast("int"))).alias("ts"),
    )
    dim = spark.range(500).select(F.col("id").alias("cust")).select(
        "cust", F.explode(F.array(F.lit(0), F.lit(1))).alias("v")
    ).select(
        "cust",
        (F.col("cust") * 10 + F.col("v")).alias("sk"),
        F.when(F.col("v") == 0, F.lit("2019-01-01")).otherwise(F.lit("2021-01-01")).cast("timestamp_ntz").alias("valid_from"),
        F.when(F.col("v") == 0, F.lit("2021-01-01")).cast("timestamp_ntz").alias("valid_to"),
    )
    bc = pit_join(fact, dim, "cust", "ts", "cust", {"sk": "sk"})
    smj = pit_join(fact, dim.hint("merge"), "cust", "ts", "cust", {"sk": "sk"})
    salted = pit_join(fact, dim, "cust", "ts", "cust", {"sk": "sk"}, salt_buckets=8)
    assert bc.count() == n and bc.where(F.col("sk").isNull()).count() == 0
    for other in (smj, salted):
        assert bc.exceptAll(other).count() == 0 and other.exceptAll(bc).count() == 0


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


@pytest.fixture()
def sales_rows(spark):
    """Orders with a repeated and an unknown customer, a repeated line, days before all versions."""
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    orders = spark.range(60).select(
        F.col("id").alias("o_orderkey"), F.when(F.col("id") % 7 != 0, F.col("id") % 5).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit("10.00").alias("o_totalprice"), (day("1994-12-01") + F.make_interval(days=(F.col("id") * 20).cast("int"))).alias("o_orderdate"),
        F.concat(F.lit("p"), F.col("id") % 2).alias("o_orderpriority"))
    line = spark.range(200).select(
        (F.col("id") % 55).alias("l_orderkey"), (F.col("id") % 6).alias("l_partkey"), (F.col("id") % 3).alias("l_suppkey"),
        (F.col("id") % 4).cast("int").alias("l_linenumber"), F.lit("2").alias("l_quantity"), F.lit("9.00").alias("l_extendedprice"), F.lit("N").alias("l_returnflag"))
    versions = lambda key, sk, n: spark.range(n).select(F.col("id").alias(key), F.explode(F.array(F.lit(0), F.lit(1))).alias("v")).select(
        key, (F.col(key) * 2 + F.col("v") + 1).alias(sk), F.when(F.col("v") == 0, day("1995-01-01")).otherwise(day("1996-06-01")).alias("valid_from"),
        F.when(F.col("v") == 0, day("1996-06-01")).alias("valid_to"), F.concat(F.lit("s"), "v").alias("c_mktsegment"), F.lit("X").alias("country"),
        F.lit("t").alias("p_type"), F.concat(F.lit("b"), "v").alias("p_brand"))
    return orders.unionByName(orders.where("o_orderkey % 10 = 3").withColumn("o_custkey", F.lit(4).cast("long"))), line, \
        versions("c_custkey", "dim_customer_sk", 4), versions("p_partkey", "dim_product_sk", 5)


def test_customers_of_headers_and_parts_give_the_same_mart(spark, sales_rows):
    orders, line, dc, dp = sales_rows
    slow = wh.build_fact_sales(wh.explode_order_lines(wh.orders_nested(orders, line)), dc, dp)
    fact = wh.build_fact_sales(wh.explode_order_lines(wh.orders_nested(wh.resolve_customers(orders, dc), line)), dc, dp)
    assert sorted(fact.collect(), key=str) == sorted(slow.collect(), key=str)
    assert fact.where("dim_customer_sk IS NULL").count() and fact.where("dim_customer_sk > 0").count()
    want = wh.enrich_daily(wh.daily_sales(slow), dc, dp)
    for parts in (fact, fact.hint("merge")):
        got = wh.enrich_daily(wh.daily_sales(parts, with_part=True), dc.hint("merge"), dp)
        assert got.columns == want.columns and sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        flat = spark.createDataFrame(fact.collect(), fact.schema)
        assert _exchanges(wh.daily_sales(flat)) == 1   # the orders of a group and the groups by one shuffle
        # and the customer's row is met there: its side and the product's two are all that is added
        assert _exchanges(wh.enrich_daily(wh.daily_sales(flat, with_part=True), dc.hint("merge"), dp.hint("merge"))) == 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_days_before_the_cutoff_pass_by_the_upsert(spark, sales_rows, monkeypatch):
    orders, line, dc, dp = sales_rows
    fact = wh.build_fact_sales(wh.explode_order_lines(wh.orders_nested(orders, line)), dc, dp)
    full = wh.enrich_daily(wh.daily_sales(fact), dc, dp)
    dateless = full.limit(1).withColumn("order_date", F.lit(None).cast("date"))
    target = full.where("order_date < DATE'1996-01-01'").unionByName(dateless)
    seen = []

    def spy(part, src, *a, **k):
        seen.append(part.select("order_date").distinct().count())
        return upsert(part, src, *a, **k)

    monkeypatch.setattr(wh, "upsert", spy)
    got = wh.incremental_daily(target, fact, dc, dp)
    assert seen == [1]  # only the last day's rows of the target are compared
    assert sorted(got.collect(), key=str) == sorted(full.unionByName(dateless).collect(), key=str)


def test_table_upsert_stages_only_the_rows_that_stay(spark, tmp_path):
    path, kept = str(tmp_path / "t"), str(tmp_path / "kept")
    spark.createDataFrame([(1, "a", "m1"), (2, "b", "m1"), (3, "c", "m2")], "k int, v string, m string").write.partitionBy("m").parquet(path)
    source = spark.createDataFrame([(2, "B", "m1"), (4, "d", "m3")], "k int, v string, m string")
    upsert_partitioned_table(spark, path, source, ["k"], "m", kept)
    assert [r.k for r in spark.read.parquet(kept).collect()] == [1]
    assert sorted((r.k, r.v, r.m) for r in spark.read.parquet(path).collect()) == [(1, "a", "m1"), (2, "B", "m1"), (3, "c", "m2"), (4, "d", "m3")]
