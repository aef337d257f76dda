"""Alerts: one nested row per new source with its object, its history and its forced history, and their encodings."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nullsafe import null_if

MIN_CUTOUT, MAX_CUTOUT, HISTORY_THRESHOLD = 30, 102, 2
ORBIT_PREFIX = "MPCORB_"


def cutout_extent(bbox_size: Column, least: int = MIN_CUTOUT, most: int = MAX_CUTOUT) -> Column:
    return F.least(F.greatest(bbox_size, F.lit(least)), F.lit(most))


def with_program(df: DataFrame, program: int = 0) -> DataFrame:
    return df.withColumn("programId", F.lit(program))


def _record(df: DataFrame) -> Column:
    return F.struct(*df.columns)


def histories(sources: DataFrame, name: str, order: list[str]) -> DataFrame:
    """diaObjectId and its rows as a list in the given order."""
    keyed = F.struct(*order, _record(sources).alias("_row"))
    lists = sources.groupBy("diaObjectId").agg(F.sort_array(F.collect_list(keyed)).alias("_list"))
    return lists.select("diaObjectId", F.transform("_list", lambda r: r.getField("_row")).alias(name))


def orbit(df: DataFrame) -> Column:
    """The orbit record: prefixed columns without their prefix, numbers as doubles, a designation made up from the unpacked one where the packed one is missing."""
    names = [c for c in df.columns if c.startswith(ORBIT_PREFIX)]
    have = {c.removeprefix(ORBIT_PREFIX): F.col(c) for c in names}
    text = ("unpacked_primary_provisional_designation", "packed_primary_provisional_designation", "mpc_orb_jsonb", "designation")
    fields = {n: c.cast("string") if n in text or isinstance(df.schema[f"{ORBIT_PREFIX}{n}"].dataType, T.StringType) else c.cast("double") for n, c in have.items() if n != "id"}
    unpacked = fields.get("unpacked_primary_provisional_designation")
    if unpacked is not None:
        fields["packed_primary_provisional_designation"] = F.coalesce(fields.get("packed_primary_provisional_designation", F.lit(None).cast("string")), F.replace(unpacked, F.lit(" "), F.lit("")))
        fields.setdefault("designation", unpacked)
    return F.struct(F.lit(0).cast("long").alias("id"), *[c.alias(n) for n, c in fields.items()])


def assemble(sources: DataFrame, objects: DataFrame, history: DataFrame, forced: DataFrame, solar: DataFrame | None = None, threshold: int = HISTORY_THRESHOLD, observation: tuple[str, str] = ("", ""), as_of: bool = False, stamps: DataFrame | None = None) -> DataFrame:
    """One alert per source, thirteen fields.

    A source with an object carries it (null if the object is unknown), its history if the object has more than one source (null
    otherwise, or if no history was loaded) and its forced history if it has ``threshold`` sources (an empty list otherwise). A
    source without one carries its solar-system record and orbit. With ``as_of``, ``sources`` may hold many visits, and of
    ``history`` each alert takes what is older than its own source. ``stamps``: diaSourceId and the bytes of the three cutouts.
    """
    prv = histories(history, "prvDiaSources", ["midpointMjdTai", "diaSourceId"]).withColumnRenamed("diaObjectId", "_h")
    fps = histories(forced, "prvDiaForcedSources", ["midpointMjdTai", "diaForcedSourceId"]).withColumnRenamed("diaObjectId", "_f")
    obj = objects.select(F.col("diaObjectId").alias("_o"), F.col("nDiaSources").alias("_n"), F.struct(*objects.columns).alias("diaObject"))
    # What is joined by source comes first, so that no list is shuffled after it was attached; sources with an object don't pass through the join with the solar system.
    own = sources.select("diaSourceId", "diaObjectId", _record(sources).alias("diaSource"))
    if solar is not None:
        record = solar.select(F.col("diaSourceId").alias("_s"), F.struct(*[c for c in solar.columns if not c.startswith(ORBIT_PREFIX)]).alias("ssSource"), orbit(solar).alias("mpc_orbits"))
        known = F.coalesce(F.col("diaObjectId") != 0, F.lit(False))
        own = own.where(known).unionByName(own.where(~known).join(record, F.col("diaSourceId") == F.col("_s"), "left"), allowMissingColumns=True)
    if stamps is not None:
        own = own.join(stamps.withColumnRenamed("diaSourceId", "_c"), F.col("diaSourceId") == F.col("_c"), "left")
    # Sources without an object take nothing from these joins; keys of their own spread them over the tasks.
    spread = own.withColumn("_k", F.when(F.col("diaObjectId") != 0, F.col("diaObjectId")).otherwise(-1 - F.pmod(F.xxhash64("diaSourceId"), F.lit(1 << 20))))
    joined = spread.join(obj, F.col("_k") == F.col("_o"), "left").join(prv, F.col("_k") == F.col("_h"), "left").join(fps, F.col("_k") == F.col("_f"), "left")
    has = F.col("diaObjectId") != 0
    empty_forced = F.array().cast(joined.schema["prvDiaForcedSources"].dataType)
    reason, target = (null_if(F.lit(x), "") for x in observation)
    past = F.filter("prvDiaSources", lambda r: r.getField("midpointMjdTai") < F.col("diaSource.midpointMjdTai")) if as_of else F.col("prvDiaSources")
    null = F.lit(None).cast("string")
    return joined.select(
        "diaSourceId",
        F.lit(reason if isinstance(reason, Column) else None).cast("string").alias("observation_reason"),
        F.lit(target if isinstance(target, Column) else None).cast("string").alias("target_name"),
        "diaSource",
        F.when(has & (F.col("_n") > 1), past).alias("prvDiaSources"),
        F.when(has & (F.col("_n") >= threshold), F.coalesce("prvDiaForcedSources", empty_forced)).otherwise(empty_forced).alias("prvDiaForcedSources"),
        null.alias("prvDiaNondetectionLimits"),
        F.when(has, F.col("diaObject")).alias("diaObject"),
        (F.when(~has, F.col("ssSource")) if solar is not None else null).alias("ssSource"),
        (F.when(~has, F.col("mpc_orbits")) if solar is not None else null).alias("MPCORB"),
        *[(F.lit(None) if stamps is None else F.col(c)).cast("binary").alias(c) for c in ("cutoutDifference", "cutoutScience", "cutoutTemplate")],
    )


def confluent(schema_id: Column, body: Column) -> Column:
    """Wire format: a zero byte, the schema id in four big-endian bytes, the encoded record."""
    return F.concat(F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(schema_id.cast("long")), 8, "0"))), body)


# --- Avro bodies: no Avro connector is assumed, so records are encoded in the Python workers -----------------------


def zigzag(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 0x7F:
        out.append((n & 0x7F) | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def avro_schema(kind: T.DataType, name: str = "alert") -> Any:
    """Avro schema of a Spark type; every field may be null."""
    simple = {T.LongType: "long", T.IntegerType: "int", T.ShortType: "int", T.ByteType: "int", T.DoubleType: "double", T.FloatType: "float", T.BooleanType: "boolean", T.StringType: "string", T.BinaryType: "bytes"}
    if isinstance(kind, T.StructType):
        return {"type": "record", "name": name, "fields": [{"name": f.name, "type": ["null", avro_schema(f.dataType, f"{name}_{f.name}")], "default": None} for f in kind]}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": ["null", avro_schema(kind.elementType, f"{name}_item")]}
    return simple[type(kind)]


def _array_block(n: int, items: bytes) -> bytes:
    """The items of an array in one block that tells its length, so that a reader can pass over it."""
    return zigzag(-n) + zigzag(len(items)) + items if n else b""


def _writer(kind: T.DataType) -> Callable[[Any], bytes]:
    """Encoder of one value, null or not, of a Spark type."""
    if isinstance(kind, T.StructType):
        parts = [(f.name, _writer(f.dataType)) for f in kind]
        body = lambda v: b"".join(w(v[n]) for n, w in parts)
    elif isinstance(kind, T.ArrayType):
        item = _writer(kind.elementType)
        body = lambda v: _array_block(len(v), b"".join(map(item, v))) + b"\x00"
    elif isinstance(kind, T.DoubleType | T.FloatType):
        code = "<d" if isinstance(kind, T.DoubleType) else "<f"
        body = lambda v: struct.pack(code, v)
    elif isinstance(kind, T.BooleanType):
        body = lambda v: b"\x01" if v else b"\x00"
    elif isinstance(kind, T.StringType):
        body = lambda v: zigzag(len(v.encode())) + v.encode()
    elif isinstance(kind, T.BinaryType):
        body = lambda v: zigzag(len(v)) + bytes(v)
    else:
        body = lambda v: zigzag(int(v))
    return lambda v: b"\x00" if v is None else b"\x02" + body(v)


def encoded_fields(batch: pa.RecordBatch, schema: T.StructType) -> Iterator[list[bytes]]:
    """The encoded fields of every row. A list that is that of the row before, as in the alerts of one object, is the same bytes object and not encoded again."""
    columns: list[Iterator[bytes]] = []

    def lists(column: pa.Array, write: Callable[[Any], bytes]) -> Iterator[bytes]:
        last, data = None, b""
        for value in column:
            if last is None or not value.equals(last):
                last, data = value, write(value.as_py())
            yield data

    for f in schema:
        column, write = batch.column(batch.schema.get_field_index(f.name)), _writer(f.dataType)
        columns.append(lists(column, write) if isinstance(f.dataType, T.ArrayType) else map(write, column.to_pylist()))
    return map(list, zip(*columns, strict=True))


def avro_bodies(alerts: DataFrame, beside: dict[str, Column] | None = None) -> DataFrame:
    """diaSourceId and the Avro body (without a schema) of every alert, and the columns ``beside`` that are worked out from it."""
    schema, rows = alerts.schema, alerts.withColumns(beside or {})
    kept = ["diaSourceId", *(beside or {})]
    made = T.StructType([*(rows.schema[c] for c in kept), T.StructField("body", T.BinaryType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [b"".join(fields) for fields in encoded_fields(batch, schema)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(bodies, pa.binary())], names=[*kept, "body"])

    return rows.mapInArrow(encode, made)


def decode_avro(kind: T.DataType, data: bytes, at: int = 0, wanted: set[str] | None = None) -> tuple[Any, int]:
    """The value of a body made by :func:`avro_bodies`, and where it ends. Of a record, only the fields ``wanted`` if given; the others are passed over."""

    def number(at: int) -> tuple[int, int]:
        shift = n = 0
        while True:
            b = data[at]
            at, n, shift = at + 1, n | (b & 0x7F) << shift, shift + 7
            if b < 0x80:
                return (n >> 1) ^ -(n & 1), at

    def value(kind: T.DataType, at: int) -> tuple[Any, int]:
        if data[at] == 0:
            return None, at + 1
        return plain(kind, at + 1)

    def after(kind: T.DataType, at: int) -> int:
        """Where a value ends; the blocks of a list are passed over by their length, where they tell it."""
        if isinstance(kind, T.ArrayType) and data[at] != 0:
            n, at = number(at + 1)
            while n:
                if n < 0:
                    size, at = number(at)
                    at += size
                else:
                    for _ in range(n):
                        at = after(kind.elementType, at)
                n, at = number(at)
            return at
        if isinstance(kind, T.StructType) and data[at] != 0:
            at += 1
            for f in kind:
                at = after(f.dataType, at)
            return at
        return value(kind, at)[1]

    def plain(kind: T.DataType, at: int) -> tuple[Any, int]:
        if isinstance(kind, T.StructType):
            out = {}
            for f in kind:
                out[f.name], at = value(f.dataType, at)
            return out, at
        if isinstance(kind, T.ArrayType):
            out = []
            n, at = number(at)
            while n:
                if n < 0:
                    n, (_, at) = -n, number(at)
                for _ in range(n):
                    v, at = value(kind.elementType, at)
                    out.append(v)
                n, at = number(at)
            return out, at
        if isinstance(kind, T.DoubleType):
            return struct.unpack_from("<d", data, at)[0], at + 8
        if isinstance(kind, T.FloatType):
            return struct.unpack_from("<f", data, at)[0], at + 4
        if isinstance(kind, T.BooleanType):
            return data[at] == 1, at + 1
        n, at = number(at)
        if isinstance(kind, T.StringType):
            return data[at : at + n].decode(), at + n
        if isinstance(kind, T.BinaryType):
            return bytes(data[at : at + n]), at + n
        return n, at

    if wanted is not None and isinstance(kind, T.StructType):
        some = {}
        for f in kind:
            if f.name in wanted:
                some[f.name], at = value(f.dataType, at)
            else:
                at = after(f.dataType, at)
        return some, at
    return plain(kind, at)


def messages(alerts: DataFrame, schema_id: int) -> DataFrame:
    """key, value and headers as a message sink takes them."""
    stamp = F.unix_millis(F.current_timestamp()).cast("string").cast("binary")
    return avro_bodies(alerts).select(
        F.col("diaSourceId").cast("string").cast("binary").alias("key"),
        confluent(F.lit(schema_id), F.col("body")).alias("value"),
        F.array(F.struct(F.lit("producer_timestamp").alias("key"), stamp.alias("value"))).alias("headers"),
    )


def produce(alerts: DataFrame, schema_id: int, servers: str, topic: str, options: dict[str, str] | None = None, failures: str | None = None) -> str:
    """Send to a Kafka topic by Spark's connector; if that fails and ``failures`` is given, write the messages there instead.

    Returns where they went. Missing settings are an error.
    """
    if not servers or not topic:
        raise ValueError("Kafka needs servers and a topic")
    out = messages(alerts, schema_id)
    try:
        out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).options(**{f"kafka.{k}": v for k, v in ({"compression.type": "snappy", "linger.ms": "5", "batch.size": str(2 << 20)} | (options or {})).items()}).save()
        return topic
    except Exception:
        if failures is None:
            raise
        out.write.mode("append").parquet(failures)
        return failures
