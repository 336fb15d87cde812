"""Digests of a table by key range, as a tree (Q11).

Rows are grouped by ranges of an integer key (``leaf`` keys each, ranges of ranges
``fanout`` by ``fanout`` above); a node's digest is the row count and the sum of
60 bits of each row's MD5. Rows become text in a stated way, so that another
engine computes the same digests. Two copies are compared from the root down:
only children of differing nodes are looked at, and rows are read only from the
leaves that differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import stage

HEX_DIGITS = 15
SEPARATOR = "\x1f"


def portable(df: DataFrame, column: str) -> Column:
    """A value as text: NULL as ``\\N``, doubles with six decimals, times with
    microseconds, the rest as cast."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        text = F.round(c.cast("decimal(38,10)"), 6).cast("decimal(38,6)").cast("string")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(kind, (T.StringType, T.IntegralType, T.DecimalType, T.DateType, T.BooleanType)):
        text = c.cast("string")
    else:
        raise TypeError(f"no portable text for {column!r} of type {kind.simpleString()}")
    return F.coalesce(text, F.lit("\\N"))


def row_digest(df: DataFrame) -> Column:
    text = F.concat_ws(SEPARATOR, *[portable(df, c) for c in sorted(df.columns)])
    return F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("decimal(38,0)")


def leaf_of(key: str, leaf: int) -> Column:
    """The range of a key; rows without one share a range of their own."""
    k = F.col(key).cast("long")
    return F.coalesce(F.floor(k / F.lit(leaf)), F.lit(-(1 << 62)))


def leaf_digests(df: DataFrame, key: str, leaf: int = 1000) -> DataFrame:
    """``node, rows, digest`` of every key range that holds a row: one pass, summed
    within each task first."""
    return (df.select(leaf_of(key, leaf).alias("node"), row_digest(df).alias("_d"))
            .groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.sum("_d").cast("decimal(38,0)").alias("digest")))


def parents(digests: DataFrame, fanout: int) -> DataFrame:
    """The digests one level up."""
    up = F.floor(F.col("node") / F.lit(fanout))
    return (digests.groupBy(up.alias("node"))
            .agg(F.sum("rows").alias("rows"), F.sum("digest").cast("decimal(38,0)").alias("digest")))


class DigestTree:
    """Levels of digests of one table, staged: ``levels[0]`` are the leaves. A
    tree of a copy that does not change is built once and compared often."""

    def __init__(self, df: DataFrame, key: str, leaf: int = 1000, fanout: int = 64, height: int = 3):
        if leaf < 1 or fanout < 2 or height < 0:
            raise ValueError("a range holds a key, a node two children")
        self.key, self.leaf, self.fanout = key, leaf, fanout
        self.levels = [stage(leaf_digests(df, key, leaf), "digest-0")]
        for i in range(height):
            self.levels.append(stage(parents(self.levels[-1], fanout), f"digest-{i + 1}"))


def differing_leaves(a: DigestTree, b: DigestTree) -> DataFrame:
    """``node`` of the leaf ranges that differ, found from the top level down."""
    if (a.key, a.leaf, a.fanout, len(a.levels)) != (b.key, b.leaf, b.fanout, len(b.levels)):
        raise ValueError("the trees are not built alike")
    above = None
    for one, two in zip(reversed(a.levels), reversed(b.levels)):
        if above is not None:  # children of differing nodes only
            child = F.floor(F.col("node") / F.lit(a.fanout)) == F.col("_up")
            one, two = (x.join(above, child, "left_semi") for x in (one, two))
        x, y = (d.select("node", F.struct("rows", "digest").alias(f"_{s}")) for d, s in ((one, "x"), (two, "y")))
        differing = x.join(y, "node", "full").where(~F.col("_x").eqNullSafe(F.col("_y"))).select("node")
        above = stage(differing, "digest-diff").select(F.col("node").alias("_up"))
    return above.select(F.col("_up").alias("node"))


def within(df: DataFrame, key: str, leaf: int, nodes: list[int]) -> DataFrame:
    """The rows of some leaf ranges: neighbouring ranges become one literal range
    of keys, which reaches the scan."""
    spans: list[list[int]] = []
    for n in sorted(n for n in nodes if n != -(1 << 62)):
        if spans and spans[-1][1] == n * leaf:
            spans[-1][1] = (n + 1) * leaf
        else:
            spans.append([n * leaf, (n + 1) * leaf])
    here = F.col(key).isNull() if -(1 << 62) in nodes else F.lit(False)
    for lo, hi in spans:
        here = here | ((F.col(key) >= lo) & (F.col(key) < hi))
    return df.where(here)


def range_diff(a: DataFrame, b: DataFrame, key: str, leaf: int = 1000, max_ranges: int = 1000, **kw) -> DataFrame:
    """Rows (with multiplicity) that only one copy holds, with ``side``; only leaf
    ranges whose digests differ are compared by row. More than ``max_ranges`` of
    them are joined by their number, no longer by literals; the result is the
    same."""
    cols = sorted(a.columns)
    a, b = a.select(*cols), b.select(*cols)
    leaves = differing_leaves(DigestTree(a, key, leaf, **kw), DigestTree(b, key, leaf, **kw))
    nodes = [r["node"] for r in leaves.limit(max_ranges + 1).collect()]
    if len(nodes) <= max_ranges:
        x, y = within(a, key, leaf, nodes), within(b, key, leaf, nodes)
    else:
        x, y = (d.join(leaves, leaf_of(key, leaf) == F.col("node"), "left_semi") for d in (a, b))
    return (x.exceptAll(y).withColumn("side", F.lit("left_only"))
            .unionByName(y.exceptAll(x).withColumn("side", F.lit("right_only"))))
