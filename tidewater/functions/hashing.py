"""Hash-based column helpers: change-detection hashes, salted masks, tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_SEPARATOR = "||"


def attribute_hash_col(cols: list[str], mode: str = "compatible") -> Column:
    """SHA-256 hex over tracked attributes.

    ``compatible``: NULL becomes '' and values are joined with ``||`` — the
    established change-detection hash (NULL and '' collide, a value holding
    ``||`` can shift). ``strict``: hash of the JSON of the struct, which keeps
    NULL distinct from '' and is unambiguous.
    """
    if mode == "strict":
        return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)


def attribute_hash(
    df: DataFrame, cols: list[str], out: str = "_attr_hash", mode: str = "compatible"
) -> DataFrame:
    return df.withColumn(out, attribute_hash_col(cols, mode))


def salted_sha256(col: Column | str, salt: str = "") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)


def token_of(col: Column | str, salt: str = "", length: int = 32) -> Column:
    """Deterministic vault token: a prefix of the salted SHA-256 (hex)."""
    return F.substring(salted_sha256(col, salt), 1, length)
