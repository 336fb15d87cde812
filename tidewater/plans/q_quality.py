"""Quality queries: suites, gate, freshness, checksums, diffs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators.latest import dedupe_ordered
from tidewater.plans import quality as qa
from tidewater.plans import warehouse as wh
from tidewater.plans.q_warehouse import WITH_FACT, _daily_sql, _fact
from tidewater.plans import range_digest as rd
from tidewater.registry import query
from tidewater.session import stage


def _sql_lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else repr(v)


def suite_sql(suite: qa.Suite, source: str) -> str:
    """The suite as one SQL statement over the relation ``source`` (oracle)."""
    parts = []
    for i, e in enumerate(suite.expectations):
        kind, kw = e["expectation_type"], e.get("kwargs", {})
        c = kw.get("column")
        head = f"'{suite.name}' AS suite, {i} AS idx, '{kind}' AS expectation"
        if kind == "expect_table_row_count_to_be_between":
            conds = []
            if kw.get("min_value") is not None:
                conds.append(f"count(*) >= {kw['min_value']}")
            if kw.get("max_value") is not None:
                conds.append(f"count(*) <= {kw['max_value']}")
            cond = " AND ".join(conds) or "TRUE"
            parts.append(f"SELECT {head}, CAST(NULL AS VARCHAR) AS \"column\", count(*) AS element_count, "
                         f"CAST(0 AS BIGINT) AS unexpected_count, {cond} AS success FROM {source}")
            continue
        if kind == "expect_column_values_to_be_unique":
            parts.append(
                f"SELECT {head}, '{c}' AS \"column\", CAST(coalesce(sum(n), 0) AS BIGINT) AS element_count, "
                f"CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS unexpected_count, "
                f"coalesce(sum(CASE WHEN n > 1 THEN n END), 0) = 0 AS success "
                f"FROM (SELECT {c}, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c})"
            )
            continue
        if kind == "expect_column_values_to_not_be_null":
            elem, bad, col = "count(*)", f"{c} IS NULL", f"'{c}'"
        elif kind == "expect_column_values_to_be_in_set":
            vals = ", ".join(_sql_lit(v) for v in kw["value_set"])
            elem, bad, col = f"count({c})", f"{c} IS NOT NULL AND {c} NOT IN ({vals})", f"'{c}'"
        elif kind == "expect_column_values_to_be_between":
            conds = []
            if kw.get("min_value") is not None:
                conds.append(f"{c} < {kw['min_value']}")
            if kw.get("max_value") is not None:
                conds.append(f"{c} > {kw['max_value']}")
            elem, bad, col = f"count({c})", f"{c} IS NOT NULL AND ({' OR '.join(conds)})", f"'{c}'"
        elif kind == "expect_column_values_to_match_regex":
            elem, bad, col = f"count({c})", f"{c} IS NOT NULL AND NOT regexp_matches({c}, '{kw['regex']}')", f"'{c}'"
        elif kind == "expect_column_pair_values_a_to_be_greater_than_b":
            a, b = kw["column_A"], kw["column_B"]
            op = ">=" if kw.get("or_equal") else ">"
            both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
            elem, bad, col = f"count(*) FILTER (WHERE {both})", f"{both} AND NOT ({a} {op} {b})", f"'{a},{b}'"
        elif kind == "expect_column_values_to_satisfy_expression":
            elem, bad, col = f"count({c})", f"{c} IS NOT NULL AND NOT coalesce({kw['expression']}, FALSE)", f"'{c}'"
        else:
            raise ValueError(kind)
        parts.append(
            f"SELECT {head}, {col} AS \"column\", CAST({elem} AS BIGINT) AS element_count, "
            f"CAST(count(*) FILTER (WHERE {bad}) AS BIGINT) AS unexpected_count, "
            f"count(*) FILTER (WHERE {bad}) = 0 AS success FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


ORDERS_SRC_SQL = """
WITH o AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_ts,
         o_orderpriority AS channel, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS total,
         s.subtotal
  FROM orders LEFT JOIN (
    SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS subtotal
    FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o_orderkey
)"""


@query("suite_orders", f"{ORDERS_SRC_SQL}\n{suite_sql(qa.ORDERS_SUITE, 'o')}")
def q_suite_orders(spark, t):
    """Q1-Q6: the orders suite compiled to one aggregate + one unique job."""
    return qa.validate(qa.orders_for_suite(t.orders, t.lineitem), qa.ORDERS_SUITE)


@query("suite_lineitem", suite_sql(qa.LINEITEM_SUITE, "lineitem"))
def q_suite_lineitem(spark, t):
    """Q1-Q6 on lineitem (value sets and ranges)."""
    return qa.validate(t.lineitem, qa.LINEITEM_SUITE)


@query("mart_tests", f"{WITH_FACT}, daily AS ({_daily_sql('fact')})\n{suite_sql(qa.MART_SUITE, 'daily')}")
def q_mart_tests(spark, t):
    """Q8: mart tests (not_null, expression >= 0); PIT misses show as failures."""
    return qa.validate(wh.daily_sales(_fact(t)[0]), qa.MART_SUITE)


@query("suite_result_gate", "SELECT * FROM lineitem")
def q_suite_result_gate(spark, t):
    """Q10: lineitem promoted only because its suite passes."""
    return qa.gate(t.lineitem, qa.LINEITEM_SUITE)


FRESH_AS_OF = "2001-08-02 06:30:00"


@query(
    "freshness",
    f"""
SELECT 'orders' AS table_name, max(o_orderdate) AS max_ts, TIMESTAMP '{FRESH_AS_OF}' AS as_of,
       date_diff('second', max(o_orderdate), TIMESTAMP '{FRESH_AS_OF}') AS lag_seconds,
       CASE WHEN date_diff('second', max(o_orderdate), TIMESTAMP '{FRESH_AS_OF}') > 86400 THEN 'error'
            WHEN date_diff('second', max(o_orderdate), TIMESTAMP '{FRESH_AS_OF}') > 21600 THEN 'warn'
            ELSE 'pass' END AS status
FROM orders""",
)
def q_freshness(spark, t):
    """Q9: warn after 6 h, error after 24 h since the newest order."""
    return qa.freshness(t.orders, "o_orderdate", FRESH_AS_OF, table="orders")


@query("suite_identifiers", suite_sql(qa.IDENTIFIER_SUITE, "customer"))
def q_suite_identifiers(spark, t):
    """Q7: values that must match a pattern; one of the patterns fails."""
    return qa.validate(t.customer, qa.IDENTIFIER_SUITE)


@query("table_checksum")
def q_table_checksum(spark, t):
    """Q11: order-insensitive checksum of lineitem and of a re-partitioned copy."""
    li = t.lineitem
    return qa.table_checksum(li, "lineitem").unionByName(qa.table_checksum(li.repartition(7), "lineitem_copy"))


@query(
    "table_diff",
    """
WITH d AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
               l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) AS rn
    FROM lineitem) WHERE rn = 1)
SELECT *, 'left_only' AS side FROM (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM d)
UNION ALL
SELECT *, 'right_only' AS side FROM (SELECT * FROM d EXCEPT ALL SELECT * FROM lineitem)""",
)
def q_table_diff(spark, t):
    """Q11: row differences (with multiplicity) between lineitem and its de-duplicated copy."""
    li = t.lineitem
    return qa.table_diff(li, dedupe_ordered(li, ["l_orderkey", "l_linenumber"]))


LEAF_KEYS = 512

ORDERS_TEXT = "concat_ws(chr(31), CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), CAST(o_orderkey AS VARCHAR), " \
              "o_orderpriority, o_orderstatus, CAST(CAST(round(CAST(o_totalprice AS DECIMAL(38,10)), 6) AS DECIMAL(38,6)) AS VARCHAR))"


@query(
    "table_range_digest",
    f"""
SELECT CAST(floor(o_orderkey / {LEAF_KEYS}) AS BIGINT) AS node, count(*) AS rows,
       CAST(sum(CAST(CAST('0x' || substr(md5({ORDERS_TEXT}), 1, 15) AS BIGINT) AS DECIMAL(38,0))) AS DECIMAL(38,0)) AS digest
FROM orders GROUP BY 1""",
)
def q_table_range_digest(spark, t):
    """Q11: portable digests of the orders by range of keys."""
    return rd.leaf_digests(t.orders, "o_orderkey", LEAF_KEYS)


CHANGED_SQL = """
c AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 1009 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 1013 <> 7)"""


@query(
    "table_range_diff",
    f"""WITH {CHANGED_SQL}
SELECT *, 'left_only' AS side FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM c)
UNION ALL SELECT *, 'right_only' AS side FROM (SELECT * FROM c EXCEPT ALL SELECT * FROM orders)""",
)
def q_table_range_diff(spark, t):
    """Q11: a copy with changed and missing rows; digests find the ranges, rows
    are compared only there."""
    o = t.orders
    price = F.when(F.col("o_orderkey") % 1009 == 5, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    copy = stage(o.where(F.col("o_orderkey") % 1013 != 7).withColumn("o_totalprice", price), "orders-copy")
    return rd.range_diff(o, copy, "o_orderkey", LEAF_KEYS)
