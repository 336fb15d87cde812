"""Connected components of a link table, as DataFrames.

Alternating large-star and small-star steps: each step groups links by their
node, takes the least neighbour and hangs the others on it. Minima are taken
with map-side partial aggregates and joined back, so a node with very many
links is never gathered in one task. Each round is written to the shared
folder, so a lost executor costs that round only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import stage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # written first: the links of a node with very many are then split by the join
    least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    hung = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node of a link table with columns ``a`` and
    ``b`` (any orderable type): root is the least node of its component, and
    each node but the root has one row. Links to itself and repeated links do no
    harm; an empty table gives no rows. Runs until nothing changes."""
    links = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    seen = None
    while True:
        n, mark = links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if not n or (n, mark) == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = n, mark
        links = stage(_small_star(_large_star(links)), label)
