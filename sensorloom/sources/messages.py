"""Message formats: JSON records, and protobuf lists of (name, time, value)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import wire_time

# The fields of a record on the wire.
TAG_SCHEMA = "name string, time string, value decimal(38,4), topic string, tag_type int, out_name string, str_value string, timestamp long, is_normal int, calculate_type string, calculate_param string, task_name string, line_id int, win_size long, win_slide long, curr_n_before int, op string, status int, a double, lower_int int, upper_int int, dt double, r double, total_index int, curr_index int, curr_cal string"


def decode_json(df: DataFrame, column: str = "value", schema: str = TAG_SCHEMA) -> DataFrame:
    """One record per JSON text; texts that are no record go."""
    parsed = df.withColumn("_r", F.from_json(F.col(column).cast("string"), schema)).where("_r is not null and _r.name is not null")
    return parsed.select("_r.*")


def encode_json(df: DataFrame, topic: str | Column | None = None, key: Column | None = None) -> DataFrame:
    """value (JSON of all columns) and, if given, topic and key, as a Kafka sink takes them.

    A topic that is a column is each row's own, such as one per line: F.concat(F.lit("dwd-"), F.col("line_id")).
    """
    more = [] if topic is None else [(F.lit(topic) if isinstance(topic, str) else topic).cast("string").alias("topic")]
    more += [] if key is None else [key.cast("string").alias("key")]
    return df.select(F.to_json(F.struct("*")).alias("value"), *more)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        shift += 7
        if b < 128:
            return value, at


def _fields(data: bytes):
    """(number, bytes) of the length-delimited fields of a message; others are passed over."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        if tag & 7 == 2:
            size, at = _varint(data, at)
            if at + size > len(data):
                raise ValueError("message ends early")
            yield tag >> 3, data[at : at + size]
            at += size
        elif tag & 7 == 0:
            _, at = _varint(data, at)
        else:
            at += {1: 8, 5: 4}[tag & 7]


def unpack_tags(data: bytes | None) -> list[tuple[str, str, str]]:
    """The (name, time, value) texts of a list message (field 1 repeated: name 1, time 2, value 3); [] if it is broken."""
    out = []
    try:
        for number, part in _fields(data or b""):
            if number == 1:
                f = dict(_fields(part))
                out.append(tuple(f.get(k, b"").decode() for k in (1, 2, 3)))
    except (IndexError, KeyError, ValueError):
        return []
    return out


def pack_tags(tags) -> bytes:
    """A list message of (name, time, value) texts."""
    def varint(n: int) -> bytes:
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def field(number: int, data: bytes) -> bytes:
        return varint(number << 3 | 2) + varint(len(data)) + data

    return b"".join(field(1, b"".join(field(k, t.encode()) for k, t in zip((1, 2, 3), tag) if t)) for tag in tags)


def decode_protobuf(df: DataFrame, column: str = "value", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, name, time and text of each tag of the messages in ``column``, in Arrow batches."""
    keep = keep or [c for c in df.columns if c != column]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keep)
    schema = f"{kept}, place int, name string, time string, text string" if kept else "place int, name string, time string, text string"

    def work(batches):
        for b in batches:
            rows = [(i, k, *t) for i, m in enumerate(b.column(column).to_pylist()) for k, t in enumerate(unpack_tags(m))]
            i, k, n, t, v = zip(*rows) if rows else ([], [], [], [], [])
            cols = [b.column(c).take(pa.array(i, pa.int64())) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(k, pa.int32()), *(pa.array(x, pa.string()) for x in (n, t, v))], names=[*keep, "place", "name", "time", "text"])

    return df.select(*keep, column).mapInArrow(work, schema)


def encode_protobuf(df: DataFrame, column: str = "tags", time: str = "time", topic: str | None = None) -> DataFrame:
    """``df`` with ``value``: a list message of the array ``column`` of (name, value), all of the time in ``time``.

    This is how results go back as raw tags: route.feedback groups them by time.
    """
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema.fields)}, value binary"

    def work(batches):
        for b in batches:
            packed = [pack_tags([(t["name"], at, str(t["value"])) for t in tags or []]) for tags, at in zip(b.column(column).to_pylist(), b.column(time).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(packed, pa.binary())], names=[*b.schema.names, "value"])

    out = df.mapInArrow(work, schema)
    return out if topic is None else out.withColumn("topic", F.lit(topic))


def clean_tags(df: DataFrame) -> DataFrame:
    """(name, time, text) -> those columns with ms, value decimal(18,4) and str_value.

    true and false count as 1 and 0 and keep their text; empty names, times and values, and values that are no number,
    go.
    """
    word = F.lower(F.trim("text"))
    boolean = word.isin("true", "false")
    value = F.when(boolean, (word == "true").cast("int").cast("decimal(18,4)")).otherwise(F.round(F.col("text").try_cast("decimal(38,10)"), 4).try_cast("decimal(18,4)"))
    out = df.where("name <> '' and time <> '' and text <> ''").withColumn("ms", wire_time(F.col("time"))).withColumn("value", value).withColumn("str_value", F.when(boolean, F.col("text")))
    return out.where("ms is not null and value is not null").drop("text")
