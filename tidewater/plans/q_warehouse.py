"""Warehouse queries: hash, latest-per-key, SCD2 dimensions, fact, marts, dims,
upsert and CDC — each paired with an independent DuckDB statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.hashing import attribute_hash_col
from tidewater.operators.latest import dedupe_ordered, latest_per_key
from tidewater.operators.upsert import cdc_apply, upsert, upsert_partitioned_table
from tidewater.plans import warehouse as wh
from tidewater.registry import query
from tidewater.session import scratch_path, stage
from tidewater.sources import files

# --------------------------------------------------------------------------
# SQL building blocks for the oracle (DuckDB dialect)
# --------------------------------------------------------------------------


def _hash_sql(cols: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
    return f"sha256(concat_ws('||', {parts}))"


CUST_SQL = """
cust AS (
  SELECT c.c_custkey, c.c_name, c.c_nationkey, CAST(c.c_acctbal AS DECIMAL(18,2)) AS c_acctbal,
         c.c_mktsegment, n.n_name AS country
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
cust_v1 AS (SELECT * FROM cust WHERE c_custkey % 10 <> 9),
cust_v2 AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal,
         CASE WHEN c_custkey % 5 = 0
              THEN (CASE WHEN c_mktsegment = 'BUILDING' THEN 'MACHINERY' ELSE 'BUILDING' END)
              ELSE c_mktsegment END AS c_mktsegment,
         country
  FROM cust
)"""

PART_SQL = """
prod_v1 AS (SELECT p_partkey, p_name, p_brand, p_type FROM part),
prod_v2 AS (
  SELECT p_partkey, p_name,
         CASE WHEN p_partkey % 7 = 0 THEN p_brand || '-R' ELSE p_brand END AS p_brand, p_type
  FROM part
)"""


def _scd2_two_loads_sql(prefix: str, v1: str, v2: str, key: str, tracked: list[str], sk: str,
                        third: bool = False) -> str:
    cols = ", ".join(tracked)
    h = _hash_sql(tracked)
    t1, t2 = "TIMESTAMP '1995-01-01 00:00:00'", "TIMESTAMP '1998-01-01 00:00:00'"
    body = f"""
{prefix}_h1 AS (SELECT {key}, {cols}, {h} AS _attr_hash FROM {v1}),
{prefix}_h2 AS (SELECT {key}, {cols}, {h} AS _attr_hash FROM {v2}),
{prefix}_d1 AS (
  SELECT row_number() OVER (ORDER BY {key}) AS {sk}, {key}, {cols}, _attr_hash,
         {t1} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
  FROM {prefix}_h1
),
{prefix}_chg AS (
  SELECT d.{key} FROM {prefix}_d1 d JOIN {prefix}_h2 s ON d.{key} = s.{key}
  WHERE d._attr_hash <> s._attr_hash
),
{prefix}_ins AS (
  SELECT s.* FROM {prefix}_h2 s LEFT JOIN {prefix}_d1 d ON d.{key} = s.{key}
  WHERE d.{key} IS NULL OR d._attr_hash <> s._attr_hash
),
{prefix} AS (
  SELECT {sk}, {key}, {cols}, _attr_hash, valid_from,
         CASE WHEN {key} IN (SELECT {key} FROM {prefix}_chg) THEN {t2} ELSE valid_to END AS valid_to,
         CASE WHEN {key} IN (SELECT {key} FROM {prefix}_chg) THEN FALSE ELSE is_current END AS is_current
  FROM {prefix}_d1
  UNION ALL
  SELECT (SELECT max({sk}) FROM {prefix}_d1) + row_number() OVER (ORDER BY {key}) AS {sk},
         {key}, {cols}, _attr_hash, {t2} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
         TRUE AS is_current
  FROM {prefix}_ins
)"""
    return body


DIM_CUSTOMER_SQL = _scd2_two_loads_sql(
    "dim_c", "cust_v1", "cust_v2", "c_custkey", wh.CUSTOMER_TRACKED, "dim_customer_sk"
)
DIM_PRODUCT_SQL = _scd2_two_loads_sql(
    "dim_p", "prod_v1", "prod_v2", "p_partkey", wh.PRODUCT_TRACKED, "dim_product_sk"
)

UNIT_PRICE_SQL = (
    "CAST(CAST((CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) * 2"
    " + CAST(l_quantity AS BIGINT)) // (CAST(l_quantity AS BIGINT) * 2) AS DECIMAL(12,0))"
    " * 0.01 AS DECIMAL(12,2))"
)

LINES_SQL = f"""
raw_lines AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_id, l_partkey AS sku, l_suppkey AS store_id,
         CAST(l_quantity AS INTEGER) AS qty, {UNIT_PRICE_SQL} AS unit_price, l_returnflag AS return_flag
  FROM lineitem
),
lines AS (
  SELECT r.order_id, o.o_custkey AS customer_id, o.o_orderdate AS order_ts,
         o.o_orderpriority AS channel, 'USD' AS currency, r.line_id, r.sku, r.store_id, r.qty,
         r.unit_price, CAST(r.qty * r.unit_price AS DECIMAL(23,2)) AS line_amount, r.return_flag
  FROM raw_lines r JOIN orders o ON r.order_id = o.o_orderkey
),
lines_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY order_id, line_id
      ORDER BY customer_id DESC, order_ts DESC, channel DESC, currency DESC, sku DESC,
               store_id DESC, qty DESC, unit_price DESC, line_amount DESC, return_flag DESC) AS rn
    FROM lines) WHERE rn = 1
)"""

FACT_SQL = f"""
fact AS (
  SELECT l.order_id, l.line_id, c.dim_customer_sk, p.dim_product_sk, l.store_id, l.channel,
         l.currency, l.qty, l.unit_price, l.line_amount, l.return_flag, l.order_ts,
         CAST(l.order_ts AS DATE) AS order_date
  FROM lines_dedup l
  LEFT JOIN dim_c c ON l.customer_id = c.c_custkey AND l.order_ts >= c.valid_from
       AND l.order_ts < coalesce(c.valid_to, TIMESTAMP '9999-12-31 00:00:00')
  LEFT JOIN dim_p p ON l.sku = p.p_partkey AND l.order_ts >= p.valid_from
       AND l.order_ts < coalesce(p.valid_to, TIMESTAMP '9999-12-31 00:00:00')
)"""

WITH_FACT = f"WITH {CUST_SQL},\n{PART_SQL},\n{DIM_CUSTOMER_SQL},\n{DIM_PRODUCT_SQL},\n{LINES_SQL},\n{FACT_SQL}"


def _daily_sql(src: str) -> str:
    return f"""
SELECT order_date, dim_customer_sk, dim_product_sk, store_id, channel, currency,
       CAST(sum(qty) AS BIGINT) AS units, CAST(sum(line_amount) AS DECIMAL(33,2)) AS gross_revenue,
       count(DISTINCT order_id) AS orders
FROM {src}
GROUP BY order_date, dim_customer_sk, dim_product_sk, store_id, channel, currency"""


ENRICHED_SQL = f"""{WITH_FACT},
daily AS ({_daily_sql('fact')})
SELECT d.*, c.c_mktsegment AS customer_segment, c.country, p.p_type AS category, p.p_brand AS brand
FROM daily d
LEFT JOIN dim_c c ON d.dim_customer_sk = c.dim_customer_sk
LEFT JOIN dim_p p ON d.dim_product_sk = p.dim_product_sk"""


# --------------------------------------------------------------------------
# Shared Spark builders
# --------------------------------------------------------------------------


def _dims(t):
    return wh.build_dim_customer(t.customer, t.nation), wh.build_dim_product(t.part)


def _fact(t, dims=None):
    dc, dp = dims or _dims(t)
    lines = wh.explode_order_lines(wh.orders_nested(wh.resolve_customers(t.orders, dc), t.lineitem))
    return wh.build_fact_sales(lines, dc, dp), dc, dp


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------

ATTR_COLS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query(
    "attribute_hash",
    f"""
SELECT c_custkey, {_hash_sql(ATTR_COLS)} AS _attr_hash
FROM (SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal,
             c_mktsegment FROM customer)""",
)
def q_attribute_hash(spark, t):
    """Change-detection hash of tracked customer attributes."""
    c = t.customer.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    return c.select("c_custkey", attribute_hash_col(ATTR_COLS).alias("_attr_hash"))


@query(
    "latest_per_key",
    """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""",
)
def q_latest_per_key(spark, t):
    """Newest event per user, ties broken by event_id."""
    return latest_per_key(t.events, "user_id", ["ts"], ["event_id"])


@query(
    "dedup_lines",
    """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
             l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC,
             l_shipdate DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
)
def q_dedup_lines(spark, t):
    """One line per (order, line number), survivor fixed by all columns."""
    return dedupe_ordered(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("scd2_dimension", f"WITH {CUST_SQL},\n{DIM_CUSTOMER_SQL}\nSELECT * FROM dim_c")
def q_scd2_dimension(spark, t):
    """Customer dimension after two snapshots."""
    return wh.build_dim_customer(t.customer, t.nation)


@query("scd2_idempotent", f"WITH {CUST_SQL},\n{DIM_CUSTOMER_SQL}\nSELECT * FROM dim_c")
def q_scd2_idempotent(spark, t):
    """Applying the second snapshot again changes nothing."""
    return wh.build_dim_customer(t.customer, t.nation, reapply=True)


@query("scd2_from_bronze", f"WITH {CUST_SQL},\n{DIM_CUSTOMER_SQL}\nSELECT * FROM dim_c")
def q_scd2_from_bronze(spark, t):
    """C1+W1: the second load reads an append-only bronze holding both
    snapshots (ingest-time stamped); the latest row per key wins."""
    d1 = wh.scd2_apply(None, wh.customer_snapshot(t.customer, t.nation, 1), wh.CUSTOMER_KEY,
                       wh.CUSTOMER_TRACKED, wh.FIRST_LOAD, "dim_customer_sk")
    stamp = lambda df, ts: df.withColumn("_ingest_ts", F.lit(ts).cast("timestamp_ntz"))
    bronze = stamp(wh.customer_snapshot(t.customer, t.nation, 1), "1997-12-01 00:00:00").unionByName(
        stamp(wh.customer_snapshot(t.customer, t.nation, 2), "1997-12-31 00:00:00"))
    return wh.scd2_apply(d1, bronze, wh.CUSTOMER_KEY, wh.CUSTOMER_TRACKED, wh.SECOND_LOAD,
                         "dim_customer_sk", source_ts="_ingest_ts")


@query("product_dimension", f"WITH {PART_SQL},\n{DIM_PRODUCT_SQL}\nSELECT * FROM dim_p")
def q_product_dimension(spark, t):
    """Product dimension (SCD2 on part, brand changes in the 2nd snapshot)."""
    return wh.build_dim_product(t.part)


@query(
    "exploded_lines",
    f"""WITH {LINES_SQL}
SELECT order_id, customer_id, order_ts, channel, currency, line_id, sku, store_id, qty, unit_price,
       line_amount, return_flag FROM lines""",
)
def q_exploded_lines(spark, t):
    """Nested order records exploded to one row per line."""
    return wh.explode_order_lines(wh.orders_nested(t.orders, t.lineitem))


@query(
    "conformed_orders",
    """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_ts,
       o_orderpriority AS channel, 'USD' AS currency, o_orderstatus AS status,
       CAST(o_totalprice AS DECIMAL(12,2)) AS total,
       CAST(count(l.l_orderkey) AS BIGINT) AS line_count
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY ALL""",
)
def q_conformed_orders(spark, t):
    """ORDER conformed projection (header + number of lines received)."""
    nested = wh.orders_nested(t.orders, t.lineitem)
    header = [c for c in nested.columns if c != "lines"]
    return nested.groupBy(*header).agg(F.sum(F.when(F.col("lines").isNull(), F.lit(0)).otherwise(F.size("lines"))).cast("long").alias("line_count"))


@query("pit_fact_sales", f"{WITH_FACT}\nSELECT * FROM fact")
def q_pit_fact_sales(spark, t):
    """Sales fact with surrogate keys valid at order time."""
    return _fact(t)[0]


@query("pit_fact_sales_salted", f"{WITH_FACT}\nSELECT * FROM fact")
def q_pit_fact_sales_salted(spark, t):
    """J1 hot-key variant: salted point-in-time joins give identical rows."""
    dc, dp = _dims(t)
    lines = wh.explode_order_lines(wh.orders_nested(t.orders, t.lineitem))
    return wh.build_fact_sales(lines, dc, dp, salt_buckets=4)


@query("sales_daily", f"{WITH_FACT}\n{_daily_sql('fact')}")
def q_sales_daily(spark, t):
    """A1: daily sales at the six-column grain."""
    return wh.daily_sales(_fact(t)[0])


@query("sales_daily_enriched", ENRICHED_SQL)
def q_sales_daily_enriched(spark, t):
    """Daily sales with customer segment, country, category, brand."""
    fact, dc, dp = _fact(t)
    return wh.enrich_daily(wh.daily_sales(fact, with_part=True), dc, dp)


@query("sales_daily_incremental", ENRICHED_SQL)
def q_sales_daily_incremental(spark, t):
    """Mart built up to 2000-01-01, then one incremental run
    (days >= max(order_date)) upserted on the full grain. The fact and the
    first mart are staged (they are the stored tables the run reads)."""
    fact, dc, dp = _fact(t)
    fact = stage(fact, "fact-sales")
    cut = F.lit("2000-01-01").cast("date")
    first = stage(wh.enrich_daily(wh.daily_sales(fact.where(F.col("order_date") < cut), with_part=True), dc, dp), "mart")
    return wh.incremental_daily(first, fact, dc, dp)


@query("sales_daily_incremental_table", ENRICHED_SQL)
def q_sales_daily_incremental_table(spark, t):
    """P10/A6/J6/S13 on stored tables: the fact and the mart are written
    partitioned by month (``order_month``; day partitions suit production
    volumes, months suit this scale). The mart is built up to 2000-01-01;
    the incremental run recomputes the days from max(order_date) on — the
    cutoff also bounds ``order_month``, so the fact scan is partition-pruned
    — and upserts only the touched month partitions of the mart."""
    fact, dc, dp = _fact(t)
    month = F.trunc("order_date", "MM").alias("order_month")
    fact_path, mart_path = scratch_path(spark, "fact_sales"), scratch_path(spark, "fact_sales_daily")
    files.write_table(fact.select("*", month), fact_path, "overwrite", ["order_month"])
    fact_tbl = spark.read.parquet(fact_path)
    first = wh.enrich_daily(
        wh.daily_sales(fact_tbl.where(F.col("order_date") < F.lit("2000-01-01").cast("date")), with_part=True), dc, dp
    )
    files.write_table(first.select("*", month), mart_path, "overwrite", ["order_month"])
    cut = wh.incremental_cutoff(spark.read.parquet(mart_path))
    recent = fact_tbl.where(F.col("order_month") >= F.trunc(F.lit(cut).cast("date"), "MM"))
    src = wh.incremental_source(spark.read.parquet(mart_path), recent.drop("order_month"), dc, dp)
    upsert_partitioned_table(spark, mart_path, src.select("*", month), wh.MART_GRAIN, "order_month",
                             scratch_path(spark, "mart-staging"))
    return spark.read.parquet(mart_path).drop("order_month")


@query(
    "returns_daily",
    f"""{WITH_FACT}
{_daily_sql("(SELECT * FROM fact WHERE return_flag = 'R')")}""",
)
def q_returns_daily(spark, t):
    """A10: returned lines at the daily grain."""
    fact = _fact(t)[0]
    return wh.daily_sales(fact.where(F.col("return_flag") == "R"))


@query(
    "dim_date",
    """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS d0, max(CAST(o_orderdate AS DATE)) AS d1 FROM orders),
days AS (SELECT CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key, date,
       CAST(isodow(date) AS INTEGER) AS day_of_week,
       'FY' || CAST(year(date + INTERVAL 11 MONTH) AS VARCHAR) || '-P'
            || lpad(CAST(month(date + INTERVAL 11 MONTH) AS VARCHAR), 2, '0') AS fiscal_period
FROM days""",
)
def q_dim_date(spark, t):
    """Calendar days spanned by the orders, ISO weekday, fiscal period."""
    return wh.dim_date(t.orders)


@query(
    "dim_store",
    """
SELECT row_number() OVER (ORDER BY s_suppkey) AS dim_store_sk, s_suppkey AS store_id,
       n.n_name AS nation, r.r_name AS region
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
)
def q_dim_store(spark, t):
    """Store dimension with surrogate keys."""
    return wh.dim_store(t.supplier, t.nation, t.region).select("dim_store_sk", "store_id", "nation", "region")


@query(
    "sales_by_store_region",
    f"""{WITH_FACT},
stores AS (
  SELECT row_number() OVER (ORDER BY s_suppkey) AS dim_store_sk, s_suppkey AS store_id, r.r_name AS region
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT f.order_date, s.dim_store_sk, s.region, CAST(sum(f.line_amount) AS DECIMAL(33,2)) AS gross_revenue
FROM fact f LEFT JOIN stores s ON f.store_id = s.store_id
GROUP BY f.order_date, s.dim_store_sk, s.region""",
)
def q_sales_by_store_region(spark, t):
    """store_id resolved to dim_store_sk, revenue per day and store."""
    fact = _fact(t)[0]
    stores = wh.dim_store(t.supplier, t.nation, t.region)
    return wh.resolve_store(fact, stores).groupBy("order_date", "dim_store_sk", "region").agg(
        F.sum("line_amount").alias("gross_revenue")
    )


UPSERT_SQL = f"""WITH {CUST_SQL},
src AS (SELECT * FROM cust_v2 WHERE c_custkey % 5 = 0 OR c_custkey % 10 = 9)
SELECT * FROM cust_v1 WHERE c_custkey NOT IN (SELECT c_custkey FROM src)
UNION ALL SELECT * FROM src"""


@query("upsert", UPSERT_SQL)
def q_upsert(spark, t):
    """Keyed upsert of changed and new customers into the first snapshot."""
    v1 = wh.customer_snapshot(t.customer, t.nation, 1)
    v2 = wh.customer_snapshot(t.customer, t.nation, 2)
    src = v2.where((F.col("c_custkey") % 5 == 0) | (F.col("c_custkey") % 10 == 9))
    return upsert(v1, src, ["c_custkey"])


CDC_SQL = f"""WITH {CUST_SQL},
changes AS (
  SELECT 'I' AS op, TIMESTAMP '1998-01-01 00:00:00' AS change_ts, * FROM cust_v2 WHERE c_custkey % 10 = 9
  UNION ALL
  SELECT 'U', TIMESTAMP '1998-02-01 00:00:00', * FROM cust_v2 WHERE c_custkey % 5 = 0
  UNION ALL
  SELECT 'D', TIMESTAMP '1998-03-01 00:00:00', * FROM cust_v2 WHERE c_custkey % 7 = 3
),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY change_ts DESC) AS rn FROM changes)
  WHERE rn = 1
)
SELECT * FROM cust_v1 WHERE c_custkey NOT IN (SELECT c_custkey FROM latest)
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, country FROM latest WHERE op <> 'D'"""


@query("cdc_apply", CDC_SQL)
def q_cdc_apply(spark, t):
    """Change feed (insert/update/delete) applied to the first snapshot."""
    v1 = wh.customer_snapshot(t.customer, t.nation, 1)
    v2 = wh.customer_snapshot(t.customer, t.nation, 2)

    def tagged(op, ts, cond):
        return v2.where(cond).select(
            F.lit(op).alias("op"), F.lit(ts).cast("timestamp_ntz").alias("change_ts"), *v2.columns
        )

    changes = (
        tagged("I", "1998-01-01 00:00:00", F.col("c_custkey") % 10 == 9)
        .unionByName(tagged("U", "1998-02-01 00:00:00", F.col("c_custkey") % 5 == 0))
        .unionByName(tagged("D", "1998-03-01 00:00:00", F.col("c_custkey") % 7 == 3))
    )
    return cdc_apply(v1, changes, ["c_custkey"])


@query(
    "exploded_shipments",
    """
SELECT l_orderkey AS order_id, l_linenumber AS customer_id, l_shipdate AS order_ts, l_linestatus AS channel, 'USD' AS currency,
       l_linenumber * 10 + i AS line_id, l_partkey AS sku, l_suppkey AS store_id, i AS qty,
       CAST(i AS DECIMAL(12,2)) AS unit_price, CAST(i * i AS DECIMAL(12,2)) AS line_amount, l_returnflag AS return_flag
FROM (SELECT *, unnest(range(1, l_linenumber % 4 + 1))::INTEGER AS i FROM lineitem)""",
)
def q_exploded_shipments(spark, t):
    """Records whose arrays hold none to three lines, or are NULL."""
    line = lambda i: F.struct(
        (F.col("l_linenumber") * 10 + i).alias("line_id"), F.col("l_partkey").alias("sku"), F.col("l_suppkey").alias("store_id"), i.alias("qty"),
        i.cast("decimal(12,2)").alias("unit_price"), (i * i).cast("decimal(12,2)").alias("line_amount"), F.col("l_returnflag").alias("return_flag"))
    parts = F.col("l_linenumber") % 4
    lines = F.transform(F.slice(F.array(F.lit(1), F.lit(2), F.lit(3)), F.lit(1), parts), line)
    lines = F.when((parts > 0) | (F.col("l_orderkey") % 2 == 0), lines)  # none: an empty array or NULL
    nested = t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("customer_id"), F.col("l_shipdate").alias("order_ts"),
                               F.col("l_linestatus").alias("channel"), F.lit("USD").alias("currency"), lines.alias("lines"))
    return wh.explode_order_lines(nested)
