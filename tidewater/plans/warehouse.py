"""Layered warehouse: SCD2 dimensions, point-in-time sales fact, daily marts.

Stand-ins on the driver's TPC-H-like tables (see FIXTURES.md, part C):
customer snapshots feed the customer dimension, part snapshots the product
dimension, orders + lineitem the order lines, supplier/nation/region the store
dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.hashing import attribute_hash_col
from tidewater.functions.time import ntz_literal
from tidewater.operators.keys import assign_surrogate_keys, max_key
from tidewater.operators.latest import dedupe_ordered, latest_per_key
from tidewater.operators.nested import explode_array
from tidewater.operators.pit_join import pit_join
from tidewater.operators.upsert import assert_unique, upsert
from tidewater.session import stage

SCD2_META = ["_attr_hash", "valid_from", "valid_to", "is_current"]


# --------------------------------------------------------------------------
# SCD type 2 (C1, C3, J4, J7) with surrogate keys
# --------------------------------------------------------------------------


def scd2_apply(
    target: DataFrame | None,
    source: DataFrame,
    key: str,
    tracked: list[str],
    effective_ts: str,
    sk_col: str,
    source_ts: str | None = None,
    hash_mode: str = "compatible",
    initial_valid_from: str | None = None,
) -> DataFrame:
    """Return the new dimension after applying one source snapshot.

    Per natural key: unchanged hash -> row kept as is; changed -> current row
    closed at ``effective_ts`` and a new current row opened at the same
    instant (no gap, no overlap); new key -> new current row; key absent from
    the snapshot -> untouched. Historical rows pass through without a join.
    Applying the same snapshot twice is a no-op. A NULL key is a key like any
    other (keys compare null-safe). A snapshot with a key twice raises, unless
    ``source_ts`` says which row is the latest; so does one dated before a
    version that it changes. The result is staged. New rows get dense surrogate
    keys after the current maximum, in natural-key order. On the first load
    ``initial_valid_from`` (e.g. '1900-01-01') lets facts older than the load
    still find a version.
    """
    eff = ntz_literal(effective_ts)
    if source_ts:
        src = latest_per_key(source, key, [source_ts])
    else:
        assert_unique(source, [key])
        src = source
    src = src.select(key, *tracked).withColumn("_attr_hash", attribute_hash_col(tracked, hash_mode))
    out_cols = [sk_col, key, *tracked, *SCD2_META]

    if target is None:
        first_from = ntz_literal(initial_valid_from) if initial_valid_from else eff
        fresh = src.select(
            key,
            *tracked,
            "_attr_hash",
            first_from.alias("valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"),
            F.lit(True).alias("is_current"),
        )
        return stage(assign_surrogate_keys(fresh, [key, "valid_from"], sk_col, 0).select(*out_cols), "scd2")

    start = max_key(target, sk_col)
    history = target.where(~F.col("is_current")).select(*out_cols)
    cur = target.where(F.col("is_current")).select(
        *[F.col(c).alias(f"t_{c}") for c in out_cols]
    )
    cur = cur.withColumn("_t_here", F.lit(True))
    s = src.select(*[F.col(c).alias(f"s_{c}") for c in src.columns], F.lit(True).alias("_s_here"))
    j = cur.join(s, F.col(f"t_{key}").eqNullSafe(F.col(f"s_{key}")), "full_outer")

    t_here = F.col("_t_here").isNotNull()
    s_here = F.col("_s_here").isNotNull()
    changed = t_here & s_here & ~F.col("t__attr_hash").eqNullSafe(F.col("s__attr_hash"))
    old_row = F.struct(
        F.col(f"t_{sk_col}").alias(sk_col),
        F.col(f"t_{key}").alias(key),
        *[F.col(f"t_{c}").alias(c) for c in tracked],
        F.col("t__attr_hash").alias("_attr_hash"),
        F.col("t_valid_from").alias("valid_from"),
        F.when(changed, eff).otherwise(F.col("t_valid_to")).alias("valid_to"),
        F.when(changed, F.lit(False)).otherwise(F.col("t_is_current")).alias("is_current"),
    )
    new_row = F.struct(
        F.lit(None).cast("long").alias(sk_col),
        F.col(f"s_{key}").alias(key),
        *[F.col(f"s_{c}").alias(c) for c in tracked],
        F.col("s__attr_hash").alias("_attr_hash"),
        eff.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    rows = F.array_compact(
        F.array(F.when(t_here, old_row), F.when((~t_here) | changed, new_row))
    )
    merged = stage(j.select(F.explode(rows).alias("r")).select("r.*"), "scd2-merged")
    if not merged.where(F.col("valid_to") < F.col("valid_from")).isEmpty():
        raise ValueError(f"snapshot of {effective_ts} is older than a version that it would close")
    keyed = merged.where(F.col(sk_col).isNotNull())
    fresh = assign_surrogate_keys(
        merged.where(F.col(sk_col).isNull()), [key, "valid_from"], sk_col, start
    )
    return stage(history.unionByName(keyed).unionByName(fresh.select(*out_cols)), "scd2")


# --------------------------------------------------------------------------
# Stand-in snapshots on the driver tables
# --------------------------------------------------------------------------

CUSTOMER_KEY = "c_custkey"
CUSTOMER_TRACKED = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "country"]
PRODUCT_KEY = "p_partkey"
PRODUCT_TRACKED = ["p_name", "p_brand", "p_type"]
FIRST_LOAD = "1995-01-01 00:00:00"
SECOND_LOAD = "1998-01-01 00:00:00"


def customer_snapshot(customer: DataFrame, nation: DataFrame, version: int) -> DataFrame:
    """v1 lacks keys ending in 9; v2 moves every fifth customer to another segment."""
    base = customer.join(
        nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")),
        "c_nationkey",
        "left",
    ).select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"),
        "c_mktsegment",
        "country",
    )
    if version == 1:
        return base.where(F.col("c_custkey") % 10 != 9)
    moved = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("MACHINERY")).otherwise(F.lit("BUILDING"))
    return base.withColumn(
        "c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, moved).otherwise(F.col("c_mktsegment"))
    )


def product_snapshot(part: DataFrame, version: int) -> DataFrame:
    base = part.select("p_partkey", "p_name", "p_brand", "p_type")
    if version == 1:
        return base
    return base.withColumn(
        "p_brand",
        F.when(F.col("p_partkey") % 7 == 0, F.concat(F.col("p_brand"), F.lit("-R"))).otherwise(
            F.col("p_brand")
        ),
    )


def build_dim_customer(customer: DataFrame, nation: DataFrame, reapply: bool = False) -> DataFrame:
    d1 = scd2_apply(
        None, customer_snapshot(customer, nation, 1), CUSTOMER_KEY, CUSTOMER_TRACKED, FIRST_LOAD, "dim_customer_sk"
    )
    v2 = customer_snapshot(customer, nation, 2)
    d2 = scd2_apply(d1, v2, CUSTOMER_KEY, CUSTOMER_TRACKED, SECOND_LOAD, "dim_customer_sk")
    if reapply:
        d2 = scd2_apply(d2, v2, CUSTOMER_KEY, CUSTOMER_TRACKED, SECOND_LOAD, "dim_customer_sk")
    return d2


def build_dim_product(part: DataFrame) -> DataFrame:
    d1 = scd2_apply(None, product_snapshot(part, 1), PRODUCT_KEY, PRODUCT_TRACKED, FIRST_LOAD, "dim_product_sk")
    return scd2_apply(d1, product_snapshot(part, 2), PRODUCT_KEY, PRODUCT_TRACKED, SECOND_LOAD, "dim_product_sk")


# --------------------------------------------------------------------------
# Order lines (P1-P4, P12) and the sales fact
# --------------------------------------------------------------------------

CUSTOMER_SK = "dim_customer_sk"
HEADER_FIELDS = ["order_id", "customer_id", "order_ts", "channel", "currency"]
LINE_FIELDS = ["line_id", "sku", "store_id", "qty", "unit_price", "line_amount", "return_flag"]


def _unit_price(extended: str, qty: str) -> F.Column:
    """extended / qty rounded half-up to cents, in exact integer arithmetic."""
    cents = f"CAST(CAST({extended} AS DECIMAL(12,2)) * 100 AS BIGINT)"
    q = f"CAST({qty} AS BIGINT)"
    return F.expr(
        f"CASE WHEN {q} > 0 THEN CAST(CAST(({cents} * 2 + {q}) div ({q} * 2) AS DECIMAL(12,0))"
        f" * 0.01 AS DECIMAL(12,2)) END"
    )


def order_lines_raw(lineitem: DataFrame) -> DataFrame:
    """Line records in the order-line vocabulary (one per lineitem row)."""
    qty = F.col("l_quantity").cast("int")
    unit = _unit_price("l_extendedprice", "l_quantity")
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_id"),
        F.col("l_partkey").alias("sku"),
        F.col("l_suppkey").alias("store_id"),
        qty.alias("qty"),
        unit.alias("unit_price"),
        (qty * unit).alias("line_amount"),
        F.col("l_returnflag").alias("return_flag"),
    )


def resolve_customers(orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """J1 on the order headers: all lines of an order have its customer and time,
    so the customer version is looked up once per order, on rows of a quarter of
    the number and width, and not once per line."""
    return pit_join(orders, dim_customer, "o_custkey", "o_orderdate", CUSTOMER_KEY, {CUSTOMER_SK: CUSTOMER_SK})


def orders_nested(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Bronze-shaped order records: header columns + ``lines array<struct>``.

    Each delivered line arrives as its own order record carrying a one-line
    array (no per-order gathering, so a huge order never becomes one giant
    array in one task); orders that never received lines arrive with a NULL
    array. A customer version that ``resolve_customers`` found stays in the header.
    """
    lines = order_lines_raw(lineitem)
    header = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_orderpriority").alias("channel"),
        F.lit("USD").alias("currency"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total"),
        *[c for c in orders.columns if c == CUSTOMER_SK],
    )
    with_lines = lines.join(header, "order_id", "inner").select(
        *header.columns, F.array(F.struct(*LINE_FIELDS)).alias("lines")
    )
    seen = lines.select("order_id").distinct()
    without = header.join(seen, "order_id", "left_anti").select(
        *header.columns, F.lit(None).cast(with_lines.schema["lines"].dataType).alias("lines")
    )
    return with_lines.unionByName(without)


def explode_order_lines(nested: DataFrame) -> DataFrame:
    keep = [*HEADER_FIELDS, *[c for c in nested.columns if c == CUSTOMER_SK]]
    return explode_array(nested, "lines", keep, {f: f for f in LINE_FIELDS})


def build_fact_sales(lines: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
                     salt_buckets: int = 1, unknown_sk: int | None = None) -> DataFrame:
    """Dedupe (ordered, before the joins) -> PIT customer -> PIT product.

    Lines whose headers went through ``resolve_customers`` have their customer
    version already: it depends on customer and time alone, which the dedupe
    compares, so the same lines survive with the same version.
    Lines with no dimension version at order time keep a NULL key (reported
    by the mart tests), or ``unknown_sk`` (e.g. -1, the 'unknown' member).
    """
    keys = ["order_id", "line_id"]
    deduped = dedupe_ordered(lines, keys, [c for c in lines.columns if c not in (*keys, CUSTOMER_SK)])
    with_c = deduped if CUSTOMER_SK in lines.columns else pit_join(
        deduped, dim_customer, "customer_id", "order_ts", CUSTOMER_KEY,
        {CUSTOMER_SK: CUSTOMER_SK}, salt_buckets=salt_buckets,
    )
    with_p = pit_join(
        with_c, dim_product, "sku", "order_ts", PRODUCT_KEY,
        {"dim_product_sk": "dim_product_sk"}, salt_buckets=salt_buckets,
    )
    if unknown_sk is not None:
        for c in ("dim_customer_sk", "dim_product_sk"):
            with_p = with_p.withColumn(c, F.coalesce(F.col(c), F.lit(unknown_sk).cast("long")))
    return with_p.select(
        "order_id", "line_id", "dim_customer_sk", "dim_product_sk", "store_id", "channel",
        "currency", "qty", "unit_price", "line_amount", "return_flag", "order_ts",
        F.to_date("order_ts").alias("order_date"),
    )


# --------------------------------------------------------------------------
# Daily mart (C5, A1, J3, P10, A6), returns (A10)
# --------------------------------------------------------------------------

MART_GRAIN = ["order_date", "dim_customer_sk", "dim_product_sk", "store_id", "channel", "currency"]


#: Parts that the days of one customer version are dealt to.
CUSTOMER_PARTS = 4
PART = "_part"


def _part(spread: F.Column) -> F.Column:
    """The part of a row by the other columns of its grain. Rows of no customer
    version are dealt over all tasks (they meet no row of the dimension)."""
    return F.when(F.col(CUSTOMER_SK).isNull(), spread).otherwise(F.pmod(spread, F.lit(CUSTOMER_PARTS)))


def daily_sales(fact: DataFrame, with_part: bool = False) -> DataFrame:
    """A1. The rows are dealt once, by customer version and part: both the orders
    of a group and the groups are counted there, and ``enrich_daily`` looks the
    customer up there if it is given the part."""
    spread = F.xxhash64(*[c for c in MART_GRAIN if c != CUSTOMER_SK])
    dealt = fact.withColumn(PART, _part(spread)).repartition(CUSTOMER_SK, PART)
    daily = dealt.groupBy(*MART_GRAIN, PART).agg(
        F.sum("qty").alias("units"),
        F.sum("line_amount").alias("gross_revenue"),
        F.count_distinct("order_id").alias("orders"),
    )
    return daily if with_part else daily.drop(PART)


def enrich_daily(daily: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Attributes by surrogate key (the dimensions are staged tables, so
    Spark knows their bytes and broadcasts the small ones). Rows with their part
    (``daily_sales``) meet a copy of the customer's row in that part, where they
    are already; the part goes."""
    c = dim_customer.select(CUSTOMER_SK, F.col("c_mktsegment").alias("customer_segment"), "country")
    p = dim_product.select("dim_product_sk", F.col("p_type").alias("category"), F.col("p_brand").alias("brand"))
    on = [CUSTOMER_SK]
    if PART in daily.columns:
        c = c.withColumn(PART, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(CUSTOMER_PARTS - 1).cast("long"))))
        on.append(PART)
    return daily.join(c, on, "left").join(p, "dim_product_sk", "left").select(
        *[x for x in daily.columns if x != PART], "customer_segment", "country", "category", "brand"
    )


def incremental_cutoff(target: DataFrame, col: str = "order_date", default: str = "1900-01-01"):
    """``coalesce(max(order_date), default)`` as a literal (static pruning)."""
    row = target.agg(F.max(col).alias("m")).first()
    return row["m"] if row and row["m"] is not None else default


def _since(cut, lookback_days: int) -> F.Column:
    return F.col("order_date") >= F.date_sub(F.lit(cut).cast("date"), lookback_days)


def incremental_source(target: DataFrame, fact: DataFrame, dim_customer: DataFrame,
                       dim_product: DataFrame, lookback_days: int = 0,
                       affected_dates: DataFrame | None = None) -> DataFrame:
    """Mart rows to recompute (P10).

    Default: days >= max(target day) - ``lookback_days``; the cutoff is a
    literal, so a fact partitioned by ``order_date`` is pruned statically.
    ``affected_dates`` (a DataFrame with ``order_date``, e.g. the days late
    orders landed on) recomputes exactly those days instead — the case a
    plain max-date cutoff misses.
    """
    if affected_dates is not None:
        fresh = fact.join(affected_dates.select("order_date").distinct(), "order_date", "left_semi")
    else:
        fresh = fact.where(_since(incremental_cutoff(target), lookback_days))
    return enrich_daily(daily_sales(fresh, with_part=True), dim_customer, dim_product)


def incremental_daily(target: DataFrame, fact: DataFrame, dim_customer: DataFrame,
                      dim_product: DataFrame, lookback_days: int = 0,
                      affected_dates: DataFrame | None = None) -> DataFrame:
    """Recompute the selected days and upsert them on the full grain (J6). The
    day is in the grain, so target rows of days before the cutoff match no
    recomputed row: they pass by the upsert."""
    src = stage(incremental_source(target, fact, dim_customer, dim_product, lookback_days, affected_dates), "mart-rows")
    if affected_dates is not None:
        return upsert(target, src, MART_GRAIN, null_safe=True, check_unique=False)
    again = F.coalesce(_since(incremental_cutoff(target), lookback_days), F.lit(False))
    merged = upsert(target.where(again), src, MART_GRAIN, null_safe=True, check_unique=False)
    return target.where(~again).unionByName(merged, allowMissingColumns=True)


# --------------------------------------------------------------------------
# Date and store dimensions
# --------------------------------------------------------------------------


def dim_date(orders: DataFrame, ts_col: str = "o_orderdate", fiscal_offset_months: int = 11) -> DataFrame:
    """One row per calendar day spanned by the facts; fiscal year starts in Feb."""
    bounds = orders.agg(F.min(F.to_date(ts_col)).alias("d0"), F.max(F.to_date(ts_col)).alias("d1"))
    days = bounds.select(F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAY"))).alias("date"))
    shifted = F.add_months("date", fiscal_offset_months)
    return days.select(
        (F.year("date") * 10000 + F.month("date") * 100 + F.dayofmonth("date")).alias("date_key"),
        "date",
        (F.weekday("date") + 1).alias("day_of_week"),
        F.concat(F.lit("FY"), F.year(shifted).cast("string"), F.lit("-P"),
                 F.lpad(F.month(shifted).cast("string"), 2, "0")).alias("fiscal_period"),
    )


def dim_store(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    stores = (
        supplier.select(F.col("s_suppkey").alias("store_id"), "s_nationkey")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("store_id", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
        .distinct()
    )
    return assign_surrogate_keys(stores, ["store_id"], "dim_store_sk", 0)


def resolve_store(df: DataFrame, stores: DataFrame) -> DataFrame:
    s = stores.select("store_id", "dim_store_sk", "region")
    return df.join(s, "store_id", "left")
