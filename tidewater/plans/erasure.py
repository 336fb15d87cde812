"""Erasure over a key graph.

A graph lists tables with their primary keys and edges "rows of ``child`` whose
``child_key`` is the ``parent_key`` of an erased row of ``parent`` go too". From
the erased rows of any start table the graph is walked to a fixpoint: each round
takes the rows that the last round erased, follows every edge by a semi join and
keeps what was not erased before. Cycles end because only new rows are carried
on; a table that several edges reach loses the union. Adding a table or an edge
is a line of the graph.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.dedup import union_by_name
from tidewater.session import stage


@dataclass(frozen=True)
class KeyEdge:
    """``child.child_key`` refers to ``parent.parent_key``. A copy or an extract
    is a child by the key it was copied under."""

    parent: str
    parent_key: str
    child: str
    child_key: str


@dataclass(frozen=True)
class KeyGraph:
    """``keys``: the primary key columns of every table."""

    keys: dict[str, list[str]]
    edges: list[KeyEdge]

    def __post_init__(self):
        unknown = {t for e in self.edges for t in (e.parent, e.child)} - set(self.keys)
        if unknown:
            raise ValueError(f"edges name tables without a primary key: {sorted(unknown)}")

    def carried(self, table: str) -> list[str]:
        """Columns of an erased row that are kept: its key and what edges ask for."""
        return list(dict.fromkeys([*self.keys[table], *[e.parent_key for e in self.edges if e.parent == table]]))

    def reached_from(self, table: str) -> list[str]:
        """Tables that erasing rows of ``table`` can touch, itself first."""
        found = [table]
        for t in found:
            found += [c for c in dict.fromkeys(e.child for e in self.edges if e.parent == t) if c not in found]
        return found


def _same(left: DataFrame, right: DataFrame, keys: list[str]):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_{k}") for k in keys])


def erased_rows(tables: dict[str, DataFrame], graph: KeyGraph, start: str, subjects: DataFrame,
                subject_key: str, max_rounds: int | None = None) -> dict[str, DataFrame]:
    """Per table the primary keys (and referred columns) of the rows to erase.

    ``subjects[subject_key]`` names values of that column of ``start``. Every
    round's new rows are staged; their bytes tell Spark whether a key set is
    broadcast. NULL references follow no edge. ``max_rounds``, if given, raises
    when it would cut the walk."""
    absent = [t for t in graph.reached_from(start) if t not in tables]
    if absent:
        raise ValueError(f"the graph reaches tables that are not given: {absent}")
    s = subjects.select(F.col(subject_key).alias("_subject")).where(F.col("_subject").isNotNull()).distinct()
    first = tables[start].join(s, F.col(subject_key) == F.col("_subject"), "left_semi")
    fresh = {start: stage(first.select(*graph.carried(start)), f"erase-{start}")}
    done: dict[str, DataFrame] = {}
    rounds = 0
    while fresh:
        fresh = {t: df for t, df in fresh.items() if not df.isEmpty()}
        for t, df in fresh.items():
            done[t] = df if t not in done else done[t].unionByName(df)
        if fresh and max_rounds is not None and rounds >= max_rounds:
            raise ValueError(f"rows beyond round {max_rounds} are to be erased")
        rounds += 1
        found: dict[str, list[DataFrame]] = {}
        for e in graph.edges:
            if e.parent in fresh:
                refs = fresh[e.parent].select(F.col(e.parent_key).alias("_ref")).where(F.col("_ref").isNotNull()).distinct()
                hit = tables[e.child].join(refs, F.col(e.child_key) == F.col("_ref"), "left_semi")
                found.setdefault(e.child, []).append(hit.select(*graph.carried(e.child)))
        fresh = {}
        for t, parts in found.items():
            new = parts[0] if len(parts) == 1 else union_by_name(parts).distinct()
            if t in done:
                old = _renamed(done[t], graph.keys[t])
                new = new.join(old, _same(new, old, graph.keys[t]), "left_anti")
            fresh[t] = stage(new, f"erase-{t}")
    return done


def erase_cascade(tables: dict[str, DataFrame], graph: KeyGraph, start: str, subjects: DataFrame,
                  subject_key: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """(the reached tables without the erased rows, the erasure log ``table_name,
    erased_rows`` with a row per reached table). Rows whose whole primary key is
    that of an erased row go, so repeated rows go together."""
    spark = next(iter(tables.values())).sparkSession
    gone = erased_rows(tables, graph, start, subjects, subject_key)
    kept = {}
    for t in graph.reached_from(start):
        if t in gone:
            old = _renamed(gone[t], graph.keys[t]).distinct()
            kept[t] = tables[t].join(old, _same(tables[t], old, graph.keys[t]), "left_anti")
        else:
            kept[t] = tables[t]
    return kept, erasure_log(spark, graph, start, gone)


def erasure_log(spark: SparkSession, graph: KeyGraph, start: str, gone: dict[str, DataFrame]) -> DataFrame:
    """Erased rows by table; tables that the graph reaches and that lost none
    have 0."""
    counts = [gone[t].agg(F.count(F.lit(1)).alias("erased_rows")).select(F.lit(t).alias("table_name"), "erased_rows")
              for t in graph.reached_from(start) if t in gone]
    none = [(t, 0) for t in graph.reached_from(start) if t not in gone]
    if none:
        counts.append(spark.createDataFrame(none, "table_name string, erased_rows long"))
    return union_by_name(counts)
