"""Message framing on the event wire.

A registry-framed message is ``1 magic byte + 4-byte schema id + payload``.
The payload is decoded with ``from_avro`` when the Avro connector is on the
classpath, otherwise it is JSON decoded with ``from_json``. Undecodable
payloads are kept (PERMISSIVE) with the raw text in ``_corrupt_record`` so
they can be routed to a dead-letter sink instead of failing the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADER_BYTES = 5
CORRUPT_COL = "_corrupt_record"
# Full microsecond precision on the wire (the JSON default stops at millis).
JSON_TIME_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def frame(payload: Column, schema_id: int = 1) -> Column:
    """Prefix a payload with the magic byte and a big-endian schema id."""
    header = F.unhex(F.lit("00" + format(schema_id, "08x")))
    return F.concat(header, payload.cast("binary"))


def strip_header(value: Column) -> Column:
    """``substring(value, 6, length(value) - 5)`` on the binary message."""
    return F.substring(value, F.lit(HEADER_BYTES + 1), F.length(value) - HEADER_BYTES)


def with_corrupt_field(schema: T.StructType) -> T.StructType:
    if CORRUPT_COL in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])


def decode(df: DataFrame, schema: T.StructType, value_col: str = "value", keep: list[str] | None = None,
           avro_schema_json: str | None = None) -> DataFrame:
    """Strip the header, decode the payload, flatten; keep transport columns."""
    payload = strip_header(F.col(value_col))
    if avro_schema_json is not None:
        from pyspark.sql.avro.functions import from_avro  # needs the spark-avro package

        evt = from_avro(payload, avro_schema_json, {"mode": "PERMISSIVE"})
    else:
        evt = F.from_json(
            payload.cast("string"), with_corrupt_field(schema),
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL, **JSON_TIME_OPTIONS},
        )
    keep = [c for c in (keep or []) if c not in schema.fieldNames()]
    return df.select(*keep, evt.alias("_evt")).select(*keep, "_evt.*")


TRANSPORT_COLUMNS = ["msg_key", "topic", "partition", "offset", "kafka_ts"]


def decode_bus_records(df: DataFrame, schema: T.StructType, avro_schema_json: str | None = None) -> DataFrame:
    """Decode message-bus records (``key, value, topic, partition, offset,
    timestamp`` — the Kafka source's columns). The record key stays as
    ``msg_key`` so a payload field with the same name (e.g. the vehicle id)
    is not ambiguous; the broker time becomes ``kafka_ts``."""
    transport = df.select(
        F.col("key").cast("string").alias("msg_key"), "topic", "partition", "offset",
        F.col("timestamp").alias("kafka_ts"), "value",
    )
    return decode(transport, schema, keep=TRANSPORT_COLUMNS, avro_schema_json=avro_schema_json)


def as_bus_records(df: DataFrame, key_col: str, offset_col: str, topic: str = "events",
                   partitions: int = 8, ts_col: str | None = None, partition: Column | None = None) -> DataFrame:
    """Frame rows the way the bus delivers them (for replay and tests):
    key bytes, framed JSON value, topic, partition (by key hash unless an
    expression is given), offset."""
    dealt = F.pmod(F.xxhash64(F.col(key_col)), F.lit(partitions)) if partition is None else partition
    return df.select(
        F.col(key_col).cast("string").cast("binary").alias("key"),
        frame(F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_TIME_OPTIONS)).alias("value"),
        F.lit(topic).alias("topic"),
        dealt.cast("int").alias("partition"),
        F.col(offset_col).cast("long").alias("offset"),
        (F.col(ts_col).cast("timestamp") if ts_col else F.current_timestamp()).alias("timestamp"),
    )


def split_dead_letters(decoded: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, dead letters): a row is bad if it failed to parse or lacks a required field."""
    bad_cond = F.col(CORRUPT_COL).isNotNull()
    for c in required:
        bad_cond = bad_cond | F.col(c).isNull()
    good = decoded.where(~bad_cond).drop(CORRUPT_COL)
    bad = decoded.where(bad_cond)
    return good, bad
