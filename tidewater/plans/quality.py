"""Expectation suites, promotion gate, freshness and table checksums (Q1-Q11).

A suite is a list of ``{"expectation_type": ..., "kwargs": {...}}`` entries
(the common JSON suite format). All row-level expectations of a suite compile
into ONE aggregate job over the table; each uniqueness check adds one grouped
job (partial aggregation, so a hot value costs one row per input partition).
Value expectations ignore NULLs; not-null counts them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.dedup import union_by_name


class QualityGateError(RuntimeError):
    def __init__(self, suite: str, failed: list[dict]):
        super().__init__(f"suite {suite!r} failed: {failed}")
        self.suite, self.failed = suite, failed


@dataclass
class Suite:
    name: str
    expectations: list[dict] = field(default_factory=list)

    @classmethod
    def from_json(cls, text: str) -> "Suite":
        raw = json.loads(text)
        return cls(raw["expectation_suite_name"], raw["expectations"])


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def _row_check(kind: str, kw: dict) -> tuple[str | None, Column, Column]:
    """(column label, element_count, unexpected_count) aggregate expressions."""
    c = kw.get("column")
    if kind == "expect_table_row_count_to_be_between":
        return None, F.count(F.lit(1)), F.lit(0).cast("long")
    if kind == "expect_column_values_to_not_be_null":
        return c, F.count(F.lit(1)), _count_if(F.col(c).isNull())
    present = F.col(c).isNotNull() if c else None
    if kind == "expect_column_values_to_be_in_set":
        return c, F.count(c), _count_if(present & ~F.col(c).isin(*kw["value_set"]))
    if kind == "expect_column_values_to_be_between":
        bad = F.lit(False)
        if kw.get("min_value") is not None:
            bad = bad | (F.col(c) < F.lit(kw["min_value"]))
        if kw.get("max_value") is not None:
            bad = bad | (F.col(c) > F.lit(kw["max_value"]))
        return c, F.count(c), _count_if(present & bad)
    if kind == "expect_column_values_to_match_regex":
        return c, F.count(c), _count_if(present & ~F.col(c).rlike(kw["regex"]))
    if kind == "expect_column_pair_values_a_to_be_greater_than_b":
        a, b = F.col(kw["column_A"]), F.col(kw["column_B"])
        both = a.isNotNull() & b.isNotNull()
        ok = (a >= b) if kw.get("or_equal") else (a > b)
        return f"{kw['column_A']},{kw['column_B']}", _count_if(both), _count_if(both & ~ok)
    if kind == "expect_column_values_to_satisfy_expression":
        e = F.expr(kw["expression"])
        return c, F.count(c), _count_if(present & ~F.coalesce(e, F.lit(False)))
    raise ValueError(f"unsupported expectation {kind}")


RESULT_SCHEMA = (
    "suite string, idx int, expectation string, column string, element_count long, "
    "unexpected_count long, success boolean"
)


def validate(df: DataFrame, suite: Suite) -> DataFrame:
    """One result row per expectation (see ``RESULT_SCHEMA``)."""
    aggs, meta, frames = [], [], []
    for i, e in enumerate(suite.expectations):
        kind, kw = e["expectation_type"], e.get("kwargs", {})
        if kind == "expect_column_values_to_be_unique":
            c = kw["column"]
            groups = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
            frames.append(
                groups.agg(
                    F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("element_count"),
                    F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias(
                        "unexpected_count"
                    ),
                ).select(
                    F.lit(suite.name).alias("suite"), F.lit(i).alias("idx"), F.lit(kind).alias("expectation"),
                    F.lit(c).alias("column"), "element_count", "unexpected_count",
                    (F.col("unexpected_count") == 0).alias("success"),
                )
            )
            continue
        col, elem, unexp = _row_check(kind, kw)
        aggs += [elem.alias(f"e{i}"), unexp.alias(f"u{i}")]
        meta.append((i, kind, col, kw))
    if aggs:
        one = df.agg(*aggs)
        rows = []
        for i, kind, col, kw in meta:
            elem, unexp = F.col(f"e{i}").cast("long"), F.col(f"u{i}").cast("long")
            if kind == "expect_table_row_count_to_be_between":
                ok = F.lit(True)
                if kw.get("min_value") is not None:
                    ok = ok & (elem >= kw["min_value"])
                if kw.get("max_value") is not None:
                    ok = ok & (elem <= kw["max_value"])
            else:
                ok = unexp == 0
            rows.append(
                F.struct(
                    F.lit(suite.name).alias("suite"), F.lit(i).alias("idx"), F.lit(kind).alias("expectation"),
                    F.lit(col).cast("string").alias("column"), elem.alias("element_count"),
                    unexp.alias("unexpected_count"), ok.alias("success"),
                )
            )
        frames.insert(0, one.select(F.inline(F.array(*rows))))
    return union_by_name(frames)


def gate(df: DataFrame, suite: Suite) -> DataFrame:
    """Promotion gate: return ``df`` unchanged if every expectation passes."""
    failed = [r.asDict() for r in validate(df, suite).where(~F.col("success")).collect()]
    if failed:
        raise QualityGateError(suite.name, failed)
    return df


def freshness(df: DataFrame, ts_col: str, as_of: str, warn_hours: float = 6, error_hours: float = 24,
              table: str = "table") -> DataFrame:
    """pass / warn / error by hours between ``max(ts_col)`` and ``as_of``."""
    lag = F.col("lag_seconds")
    return df.agg(F.max(ts_col).alias("max_ts")).select(
        F.lit(table).alias("table_name"),
        "max_ts",
        F.lit(as_of).cast("timestamp_ntz").alias("as_of"),
        (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.col("max_ts").cast("timestamp")))
        .cast("long").alias("lag_seconds"),
    ).withColumn(
        "status",
        F.when(lag > error_hours * 3600, "error").when(lag > warn_hours * 3600, "warn").otherwise("pass"),
    )


def table_checksum(df: DataFrame, label: str) -> DataFrame:
    """Order-insensitive fingerprint: row count and sum of 64-bit row hashes."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h).cast("decimal(38,0)").alias("checksum")).select(
        F.lit(label).alias("table_name"), "rows", "checksum"
    )


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows (with multiplicity) present in one copy but not the other."""
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).withColumn("side", F.lit("left_only")).unionByName(
        b.exceptAll(a).withColumn("side", F.lit("right_only"))
    )


# --------------------------------------------------------------------------
# Suites used on the driver tables (value sets adapted to the stand-ins)
# --------------------------------------------------------------------------

ORDERS_SUITE = Suite(
    "orders_bronze_suite",
    [
        {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 1, "max_value": 1_000_000_000}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "order_id"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "customer_id"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "order_ts"}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "order_id"}},
        {"expectation_type": "expect_column_values_to_be_in_set",
         "kwargs": {"column": "channel", "value_set": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]}},
        {"expectation_type": "expect_column_values_to_be_in_set",
         "kwargs": {"column": "status", "value_set": ["F", "O", "P"]}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "total", "min_value": 0, "max_value": 1_000_000}},
        {"expectation_type": "expect_column_pair_values_a_to_be_greater_than_b",
         "kwargs": {"column_A": "total", "column_B": "subtotal", "or_equal": True}},
    ],
)

MART_SUITE = Suite(
    "fact_sales_daily_tests",
    [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "order_date"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "dim_customer_sk"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "dim_product_sk"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "gross_revenue"}},
        {"expectation_type": "expect_column_values_to_satisfy_expression",
         "kwargs": {"column": "gross_revenue", "expression": "gross_revenue >= 0"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "units"}},
        {"expectation_type": "expect_column_values_to_satisfy_expression",
         "kwargs": {"column": "units", "expression": "units >= 0"}},
    ],
)

LINEITEM_SUITE = Suite(
    "lineitem_silver_suite",
    [
        {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 1}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "l_orderkey"}},
        {"expectation_type": "expect_column_values_to_be_in_set",
         "kwargs": {"column": "l_returnflag", "value_set": ["A", "N", "R"]}},
        {"expectation_type": "expect_column_values_to_be_in_set",
         "kwargs": {"column": "l_linestatus", "value_set": ["O", "F"]}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "l_discount", "min_value": 0, "max_value": 1}},
        {"expectation_type": "expect_column_pair_values_a_to_be_greater_than_b",
         "kwargs": {"column_A": "l_extendedprice", "column_B": "l_tax", "or_equal": True}},
    ],
)


IDENTIFIER_SUITE = Suite(
    "identifier_suite",
    [
        {"expectation_type": "expect_column_values_to_match_regex", "kwargs": {"column": "c_name", "regex": r"^Customer#\d{9,}$"}},
        {"expectation_type": "expect_column_values_to_match_regex", "kwargs": {"column": "c_name", "regex": r"^Customer#\d{8}[0-8]$"}},
        {"expectation_type": "expect_column_values_to_match_regex", "kwargs": {"column": "c_mktsegment", "regex": "^[A-Z]+$"}},
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "c_name"}},
    ],
)


def orders_for_suite(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders in the suite's vocabulary; subtotal = discounted line amounts."""
    net = (F.col("l_extendedprice").cast("decimal(12,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))
    sub = lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(F.sum(net).alias("subtotal"))
    o = orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_ts"), F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("decimal(12,2)").alias("total"),
    )
    return o.join(sub, "order_id", "left")
