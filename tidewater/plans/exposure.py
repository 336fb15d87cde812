"""Classify before exposure.

A register holds every column that a classification run has looked at, with its
type, and the hits of that run. A view for a role is built from the register: a
column that it does not hold, or holds with another type, is masked for everyone
until the next run; a tagged column is masked as the role's rule for its
sensitivity says; the rest is shown.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.plans import governance as gv
from tidewater.session import read_if_there

#: From the least to the most protected; an unknown sensitivity counts as the last.
SENSITIVITY_ORDER = ["PII", "PHI", "PCI"]


@dataclass(frozen=True)
class RoleRule:
    """``masking`` by sensitivity (``hash``, ``tokenize``, ``none``); a sensitivity
    that is not listed is shown as ``<masked>``."""

    role: str
    masking: dict[str, str]
    condition: str | None = None

    def __post_init__(self):
        odd = set(self.masking.values()) - {"hash", "tokenize", "none"}
        if odd:
            raise ValueError(f"unknown masking {sorted(odd)} for role {self.role!r}")


class ClassificationRegister:
    """Columns and hits of the last run, at ``path``. ``record`` replaces the rows
    of the tables it is given and keeps those of others."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def record(self, tables: dict[str, DataFrame], hits: DataFrame, run_id: int) -> None:
        """``hits`` as ``best_per_tag`` gives them. The register is bounded by the
        number of columns, and one row per (table, column)."""
        found: dict[tuple[str, str], list] = {}
        for r in hits.where(F.col("table_fqn").isin(list(tables))).collect():  # columns times tags
            found.setdefault((r["table_fqn"], r["column"]), []).append((r["tag"], r["sensitivity"], float(r["confidence"])))
        rows = [(t, f.name, f.dataType.simpleString(), sorted(found.get((t, f.name), [])), run_id)
                for t, df in tables.items() for f in df.schema.fields]
        kept = [tuple(r) for r in self._rows() if r["table_fqn"] not in tables]
        schema = "table_fqn string, column string, data_type string, tags array<struct<tag:string,sensitivity:string,confidence:double>>, run_id long"
        self.spark.createDataFrame(rows + kept, schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run={run_id}")

    def _rows(self) -> list:
        stored = read_if_there(self.spark, self.path)
        if stored is None:
            return []
        last = stored.agg(F.max("run")).first()[0]
        return stored.where(F.col("run") == last).drop("run").collect()

    def columns(self, table_fqn: str) -> dict[str, tuple[str, list]]:
        """``column: (type, tags)`` of a table as last classified."""
        return {r["column"]: (r["data_type"], list(r["tags"])) for r in self._rows() if r["table_fqn"] == table_fqn}


def strictest(tags: list) -> str | None:
    """The most protected sensitivity among a column's tags."""
    rank = {s: i for i, s in enumerate(SENSITIVITY_ORDER)}
    return max((t["sensitivity"] for t in tags), key=lambda s: rank.get(s, len(rank)), default=None)


def exposures(df: DataFrame, known: dict[str, tuple[str, list]], rule: RoleRule) -> dict[str, str]:
    """By column: ``raw``, ``hash``, ``tokenize`` or ``masked``."""
    out = {}
    for f in df.schema.fields:
        kind, tags = known.get(f.name, (None, []))
        if kind != f.dataType.simpleString():
            out[f.name] = "masked"
        elif (sensitivity := strictest(tags)) is None:
            out[f.name] = "raw"
        else:
            out[f.name] = {"none": "raw"}.get(m := rule.masking.get(sensitivity, "masked"), m)
    return out


def exposed_view(df: DataFrame, table_fqn: str, register: ClassificationRegister, rules: list[RoleRule], role: str,
                 salt: str = "", session: dict[str, object] | None = None) -> DataFrame:
    """``df`` as ``role`` may see it. Unlisted roles are denied, and so is a table
    that was never classified."""
    rule = next((r for r in rules if r.role == role), None)
    if rule is None:
        raise gv.AccessDenied(f"role {role!r} has no access to {table_fqn}")
    known = register.columns(table_fqn)
    if not known:
        raise gv.AccessDenied(f"{table_fqn} has not been classified")
    how = exposures(df, known, rule)
    rows = df.where(F.expr(gv.bind_session(rule.condition, session))) if rule.condition else df
    plain = {"raw": "none"}
    return rows.select(*[gv.mask_column(f"`{c}`" if how[c] == "raw" else c, plain.get(how[c], how[c]), salt).alias(c) for c in df.columns])
