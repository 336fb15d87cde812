"""Schema ledger of a landing zone.

The ledger remembers which files were looked at and the schema that fits all of
them, so a run infers from the files that are new and reads of the bronze table
need no footers:

    {location}/files/run=N      path, modified, length of the files first seen in run N
    {location}/schemas/run=N    the schema as JSON, written when it changed

A run that finds no new file opens none. A new column is added; a column whose
new files need a wider type is widened if Parquet files of the old type can be
read as the new one; any other change of type raises, since rows would silently
turn into NULLs. The schema is written before the files, so a crash between the
two repeats the inference.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import read_if_there, stage

FILE_KEY = ["path", "modified", "length"]
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


class SchemaConflictError(ValueError):
    """New files hold a type that the stored one cannot be widened to."""


def wider(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The narrowest of the two that holds both and that files of either type can
    be read as; None if there is none."""
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    for a, b in ((old, new), (new, old)):
        if type(a) in _WHOLE and type(b) in _WHOLE and _WHOLE[type(a)] < _WHOLE[type(b)]:
            return b
        if isinstance(a, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType)) and isinstance(b, T.DoubleType):
            return b
        if isinstance(a, T.DateType) and isinstance(b, T.TimestampNTZType):
            return b
        if type(a) in _WHOLE and isinstance(b, T.DecimalType) and b.precision - b.scale >= _WHOLE[type(a)]:
            return b
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(old.scale, new.scale)
        whole = max(old.precision - old.scale, new.precision - new.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return evolve(old, new)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        inner = wider(old.elementType, new.elementType)
        return None if inner is None else T.ArrayType(inner, old.containsNull or new.containsNull)
    return None


def evolve(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` with the columns that only ``new`` has, all nullable, and with
    types widened; a type that cannot be widened raises."""
    known = {f.name: f for f in new.fields}
    out = []
    for f in old.fields:
        kind = wider(f.dataType, known[f.name].dataType) if f.name in known else f.dataType
        if kind is None:
            raise SchemaConflictError(f"column {f.name!r} is {f.dataType.simpleString()}, new files hold {known[f.name].dataType.simpleString()}")
        out.append(T.StructField(f.name, kind, True))
    names = set(old.fieldNames())
    return T.StructType(out + [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name not in names])


class SchemaLedger:
    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")

    def files(self) -> DataFrame | None:
        """Every file seen: ``path, modified, length, run``."""
        return read_if_there(self.spark, f"{self.location}/files")

    def schema(self) -> T.StructType | None:
        """The schema that fits all files seen."""
        stored = read_if_there(self.spark, f"{self.location}/schemas")
        row = None if stored is None else stored.orderBy(F.desc("run")).first()
        return T.StructType.fromJson(json.loads(row["schema"])) if row else None

    def unseen(self, source_path: str) -> DataFrame:
        """Files of the landing zone that no run has looked at: a listing, no file
        is opened. A file that was replaced counts as new."""
        here = self.spark.read.format("binaryFile").load(source_path).select("path", F.col("modificationTime").alias("modified"), "length")
        seen = self.files()
        return here if seen is None else here.join(seen.select(*FILE_KEY), FILE_KEY, "left_anti")

    def update(self, source_path: str, infer) -> T.StructType:
        """Look at the files that are new: ``infer(paths)`` gives the schema of a
        path or a list of paths. Returns the schema that fits all files."""
        stored, seen = self.schema(), self.files()
        new = stage(self.unseen(source_path), "ledger-new")
        run = 0 if seen is None else (seen.agg(F.max("run")).first()[0] or 0) + 1
        if stored is None:
            resolved = infer(source_path)
        else:
            paths = [r["path"] for r in new.select("path").collect()]  # what landed since the last run
            resolved = evolve(stored, infer(paths)) if paths else stored
        if resolved != stored:
            row = self.spark.createDataFrame([(resolved.json(),)], "schema string")
            row.coalesce(1).write.mode("overwrite").parquet(f"{self.location}/schemas/run={run}")
        if not new.isEmpty():
            new.write.mode("overwrite").parquet(f"{self.location}/files/run={run}")
        return resolved
