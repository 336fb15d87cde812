"""A bounded store of the keys a stream has delivered (U4).

Keys lie by event date, in segments; a segment is what one micro-batch added, or
several merged: ``FANOUT`` segments of a level become one of the next, so a date
has at most ``FANOUT - 1`` segments a level, each key is rewritten once a level,
and a batch opens a number of directories that hardly grows. Each segment has its
key files, bucketed by hash, and a bitmap of the hashes:

    {path}/keys/g=12/_date=2024-01-15/_b=3/    the keys
    {path}/bits/g=12/_date=2024-01-15/         per 32,768 hashes one bitmap
    {path}/_log/b=12/                          the segments of every date after batch 12

A new key is looked up in the bitmaps alone. Only keys whose bit is set are
compared with key files, of their buckets, in the dates within the horizon; dates
beyond it are dropped. All directories come from the log: nothing is listed. The
logs of the last two batches are kept, so that a repeated batch starts from what
it started from before.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import delete, read_if_there

FANOUT = 8
NO_DATE = "none"


@dataclass(frozen=True, order=True)
class Segment:
    batch: int
    level: int


class SeenKeys:
    """``bits`` is the size of a date's bitmap (more bits, fewer needless
    comparisons), ``buckets`` the number of key files that a date is split into."""

    def __init__(self, path: str, keys: list[str], horizon_days: int, bits: int = 1 << 24, buckets: int = 4):
        self.path, self.keys, self.horizon, self.bits, self.buckets = path.rstrip("/"), keys, horizon_days, bits, buckets
        self.opened: list[int] = []  # directories opened by each batch

    # -- expressions ----------------------------------------------------------
    def hashed(self, df: DataFrame, date: Column) -> DataFrame:
        """``df`` with its date as text and the place of its key in the bitmaps."""
        h = F.pmod(F.xxhash64(*self.keys), F.lit(self.bits))
        return (df.withColumn("_date", F.coalesce(date.cast("string"), F.lit(NO_DATE))).withColumn("_h", h)
                .withColumn("_b", (F.col("_h") % self.buckets).cast("int")))

    # -- the log --------------------------------------------------------------
    def states(self, spark: SparkSession) -> dict[int, dict[str, list[Segment]]]:
        """By batch, the segments of every date."""
        log = read_if_there(spark, f"{self.path}/_log")
        out: dict[int, dict[str, list[Segment]]] = {}
        for row in [] if log is None else log.select("batch", "date", "segments").collect():  # dates times levels
            here = out.setdefault(row["batch"], {})
            if row["date"] is not None:
                here[row["date"]] = sorted(Segment(s["batch"], s["level"]) for s in row["segments"])
        return out

    def _dirs(self, kind: str, state: dict[str, list[Segment]], dates) -> list[str]:
        return [f"{self.path}/{kind}/g={s.batch}/_date={d}" for d in sorted(dates) for s in state.get(d, [])]

    def _read_keys(self, like: DataFrame, dirs: list[str]) -> DataFrame:
        """Key files of some directories: the keys with the types of ``like``."""
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.select(*self.keys).schema)
        reader = like.sparkSession.read.option("basePath", f"{self.path}/keys")
        return reader.schema(f"{kinds}, _h long, g long, _date string, _b int").parquet(*dirs).select(*self.keys, "_h", "_b", "_date")

    # -- looking up and adding ------------------------------------------------
    def near(self, state: dict[str, list[Segment]], earliest: dt.date | None) -> list[str]:
        """Dates of the store that a batch with rows from ``earliest`` on is
        compared with."""
        if earliest is None:
            return [d for d in state if d == NO_DATE]
        edge = str(earliest - dt.timedelta(days=self.horizon))
        return [d for d in state if d == NO_DATE or d >= edge]

    def unseen(self, fresh: DataFrame, state: dict[str, list[Segment]], dates: list[str]) -> DataFrame:
        """The rows of ``fresh`` (hashed, keys unique, persisted) that no segment of
        ``dates`` holds."""
        spark = fresh.sparkSession
        bits = self._dirs("bits", state, dates)
        self.opened.append(len(bits))
        if not bits:
            return fresh
        bitmaps = spark.read.schema("bucket long, bitmap binary").parquet(*bits)
        place = F.bitmap_bit_position("_h")
        asked = fresh.select("_h", "_b", F.bitmap_bucket_number("_h").alias("bucket"), place.alias("_at"))
        byte = F.conv(F.hex(F.substring("bitmap", (F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.expr("shiftright(_byte, cast(_at % 8 as int)) & 1") == 1
        maybe = asked.join(bitmaps, "bucket").withColumn("_byte", byte).where(is_set).select("_h", "_b").distinct().persist()
        try:
            buckets = [r[0] for r in maybe.select("_b").distinct().collect()]  # no more than there are buckets
            if not buckets:
                return fresh
            keys = self._dirs("keys", state, dates)
            self.opened[-1] += len(keys)
            held = self._read_keys(fresh, keys).where(F.col("_b").isin(buckets))
            held = held.join(maybe.select("_h").distinct(), "_h", "left_semi").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)])
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)])
            return fresh.join(held, same, "left_anti")
        finally:
            maybe.unpersist()

    def add(self, new: DataFrame, batch_id: int, states: dict[int, dict[str, list[Segment]]], prior: int | None) -> None:
        """Add the keys of ``new`` (hashed) as batch ``batch_id``, merge the
        segments that are due, drop dates beyond the horizon, and log it."""
        spark = new.sparkSession
        state = dict(states[prior]) if prior is not None else {}
        dates = sorted(r[0] for r in new.select("_date").distinct().collect())  # days of one batch
        rows, bits = new.select(*self.keys, "_h", "_b", "_date"), None
        merged: list[tuple[str, Segment]] = []
        for d in dates:
            level, here = 0, list(state.get(d, []))
            while len(due := [s for s in here if s.level == level]) >= FANOUT - 1:
                merged += [(d, s) for s in due]
                here = [s for s in here if s.level != level]
                level += 1
            state[d] = sorted([*here, Segment(batch_id, level)])
        by_date: dict[str, list[str]] = {}
        for d, s in merged:
            by_date.setdefault(d, []).append(f"{self.path}/keys/g={s.batch}/_date={d}")
        for d, dirs in sorted(by_date.items()):
            rows = rows.unionByName(self._read_keys(rows, dirs))
        if dates:
            rows.hint("rebalance", "_date", "_b").write.mode("overwrite").partitionBy("_date", "_b").parquet(f"{self.path}/keys/g={batch_id}")
            kept = self._read_keys(rows, [f"{self.path}/keys/g={batch_id}"])
            bits = kept.groupBy("_date", F.bitmap_bucket_number("_h").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_h")).alias("bitmap"))
            bits.hint("rebalance", "_date").write.mode("overwrite").partitionBy("_date").parquet(f"{self.path}/bits/g={batch_id}")
        known = [d for d in state if d != NO_DATE]
        if known:
            edge = str(dt.date.fromisoformat(max(known)) - dt.timedelta(days=self.horizon))
            state = {d: s for d, s in state.items() if d == NO_DATE or d >= edge}
        log = [(batch_id, d, [(s.batch, s.level) for s in segs]) for d, segs in sorted(state.items())] or [(batch_id, None, [])]
        (spark.createDataFrame(log, "batch long, date string, segments array<struct<batch:long,level:int>>").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/_log/b={batch_id}"))
        self._sweep(spark, states, prior, state)

    def _sweep(self, spark: SparkSession, states: dict, prior: int | None, state: dict[str, list[Segment]]) -> None:
        """Delete what only logs before the last two name."""
        named = lambda s: {(d, x.batch) for d, segs in s.items() for x in segs}
        live = named(state) | (named(states[prior]) if prior is not None else set())
        whole = {b for _, b in live}
        for b in [b for b in states if prior is not None and b < prior]:
            gone = named(states[b]) - live
            for d, g in sorted(gone):
                for kind in ("keys", "bits"):
                    delete(spark, f"{self.path}/{kind}/g={g}/_date={d}" if g in whole else f"{self.path}/{kind}/g={g}")
            delete(spark, f"{self.path}/_log/b={b}")
