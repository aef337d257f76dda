"""Alert files: Avro object containers, one per visit and detector, and a Spark data source that reads them.

A file is a header (schema, codec, sync marker) and blocks of whole records, each followed by the marker. Files are written by the
tasks, each from rows that arrive sorted, so a task holds one block; a visit and detector of very many alerts gets several files.
A file is moved to its place when it is whole, and the same alerts make the same bytes, so a task that is run again changes nothing.
Reading splits files at the markers.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.alerts import avro_bodies, avro_schema, decode_avro, encoded_fields, zigzag  # noqa: F401
from ..scratch import materialize, new_path, release, shuffles_removed

# Fixed values of the container format.
MAGIC, SYNC_BYTES, CODECS = b"Obj\x01", 16, ("null", "deflate")
#: Bytes of records at which a block ends, alerts of a file, bytes of a file that a task reads.
BLOCK_BYTES, MOST_ROWS, SPLIT_BYTES = 1 << 20, 10_000, 64 << 20
#: Bytes of an encoded field from which it is compressed before the rows are shuffled, and not again when they are written.
LARGE_BYTES = 1 << 15
#: Rounds in which files are written at most; each has two files for every task that can run at a time, at least.
ROUNDS = 8
_LAST = b"\x03\x00"  # the last, empty, part of a compressed block that was put together


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if ":/" in folder else (pafs.LocalFileSystem(), folder)


def header(schema: T.StructType, codec: str, marker: bytes) -> bytes:
    entries = {"avro.schema": json.dumps(avro_schema(schema)).encode(), "avro.codec": codec.encode()}
    body = b"".join(zigzag(len(k)) + k.encode() + zigzag(len(v)) + v for k, v in entries.items())
    return MAGIC + zigzag(len(entries)) + body + zigzag(0) + marker


def block(bodies: list[bytes], codec: str, marker: bytes) -> bytes:
    data = b"".join(bodies)
    if codec == "deflate":
        raw = zlib.compressobj(6, zlib.DEFLATED, -15)
        data = raw.compress(data) + raw.flush()
    return zigzag(len(bodies)) + zigzag(len(data)) + data + marker


def _piece(data: bytes) -> bytes:
    """Compressed bytes that end at a whole byte and refer to nothing before them, so that pieces can be put side by side."""
    raw = zlib.compressobj(6, zlib.DEFLATED, -15)
    return raw.compress(data) + raw.flush(zlib.Z_FULL_FLUSH)


#: Where the large fields of a body are: each stands after the next ``plain`` bytes of the body, as ``size`` bytes of ``file`` from ``at`` on.
_PARTS = "array<struct<plain: bigint, size: bigint, digest: binary, file: string, at: bigint>>"


class _Large:
    """The large fields of a task, each different one once, in a file of a folder that all tasks reach."""

    def __init__(self, folder: str):
        self.folder, self.name = folder, f"large-{uuid.uuid4().hex}"
        self.out: pa.NativeFile | None = None
        self.at: dict[bytes, int] = {}

    def place(self, data: bytes) -> dict[str, Any]:
        digest = hashlib.md5(data).digest()
        if digest not in self.at:
            if self.out is None:
                store, top = _place(self.folder)
                self.out = store.open_output_stream(f"{top}/{self.name}", compression=None)
            self.at[digest] = self.out.tell()
            self.out.write(data)
        return {"size": len(data), "digest": digest, "file": self.name, "at": self.at[digest]}

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def _whole(body: bytes, parts: list[dict[str, Any]] | None, store: pafs.FileSystem, top: str) -> bytes:
    """A body with its large fields."""
    out, at = [], 0
    for part in parts or []:
        with store.open_input_file(f"{top}/{part['file']}") as file:
            file.seek(part["at"])
            data = file.read(part["size"])
        if len(data) != part["size"]:
            raise ValueError(f"{part['file']} ends within a field")
        out += [body[at : at + part["plain"]], data]
        at += part["plain"]
    return b"".join([*out, body[at:]])


def _encoded(alerts: DataFrame, keys: dict[str, Column], codec: str, folder: str | None = None) -> DataFrame:
    """diaSourceId, keys, body, size and parts of every alert. A body with a large field is compressed (``packed``); ``size`` is that of the plain one.

    With a ``folder``, large fields are written there and not into the body; ``parts`` says where they are. The alerts of an object have the same lists, so each is
    written once by a task and not once for every alert.
    """
    schema, kept = alerts.schema, ["diaSourceId", *keys]
    rows = alerts.withColumns(keys)
    made = T.StructType([*(rows.schema[c] for c in kept), T.StructField("body", T.BinaryType()), T.StructField("packed", T.BooleanType()), T.StructField("size", T.LongType()), T.StructField("parts", T._parse_datatype_string(_PARTS))])
    deflated = codec == "deflate"
    parts_type = pa.list_(pa.struct([("plain", pa.int64()), ("size", pa.int64()), ("digest", pa.binary()), ("file", pa.string()), ("at", pa.int64())]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, shrunk, place = b"", b"", {}
        shrink = _piece if deflated else bytes
        large = _Large(folder) if folder is not None else None
        try:
            for batch in batches:
                bodies, packed, sizes, parts, at, held = [], [], [], [], 0, 0
                for i, fields in enumerate(encoded_fields(batch, schema)):
                    sizes.append(sum(map(len, fields)))
                    has = (deflated or large is not None) and any(len(f) >= LARGE_BYTES for f in fields)
                    packed.append(has and deflated)
                    own: list[dict[str, Any]] = []
                    if has:
                        out, small = [], []
                        for f in fields:
                            if len(f) < LARGE_BYTES:
                                small.append(f)
                                continue
                            if f is not last:
                                last, shrunk = f, shrink(f)
                                place = large.place(shrunk) if large is not None else {}
                            out.append(shrink(b"".join(small)))
                            if large is None:
                                out.append(shrunk)
                            else:
                                own.append(place | {"plain": sum(map(len, out)) - sum(part["plain"] for part in own)})
                            small = []
                        bodies.append(b"".join([*out, shrink(b"".join(small))]))
                    else:
                        bodies.append(b"".join(fields))
                    parts.append(own or None)
                    held += len(bodies[-1])
                    if held >= 16 * BLOCK_BYTES or i == batch.num_rows - 1:
                        columns = [pa.array(bodies, pa.binary()), pa.array(packed), pa.array(sizes, pa.int64()), pa.array(parts, parts_type)]
                        yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c))[at : i + 1] for c in kept), *columns], names=[*kept, "body", "packed", "size", "parts"])
                        bodies, packed, sizes, parts, at, held = [], [], [], [], i + 1, 0
        finally:
            if large is not None:
                large.close()

    return rows.mapInArrow(encode, made)


def _mixed_block(held: list[tuple[bytes, bool]], codec: str, marker: bytes) -> bytes:
    """A block of bodies of which some are compressed already."""
    if not any(packed for _, packed in held):
        return block([body for body, _ in held], codec, marker)
    data = b"".join(b"".join(b for b, _ in run) if packed else _piece(b"".join(b for b, _ in run)) for packed, run in itertools.groupby(held, key=lambda h: h[1])) + _LAST
    return zigzag(len(held)) + zigzag(len(data)) + data + marker


_WRITTEN = "visit long, detector long, file string, alerts long, bytes long"


def write_alert_files(alerts: DataFrame, folder: str, codec: str = "deflate", most_rows: int = MOST_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Write ``{visit}_{detector}.avro`` files to a folder that all tasks reach; returns visit, detector, file, alerts and bytes of each.

    Visit and detector are those of the alert's source; a null one is written as ``null``. Beyond ``most_rows`` alerts the further
    files of a visit and detector are named ``{visit}_{detector}_{n}.avro``. Files of the same name are replaced. No alerts: no files.
    ``counted``: visit and detector of every alert, from which the files are counted; without it the alerts are worked out twice.
    Each alert's bytes are shuffled once, without its large lists: those are compressed and written before, once for the alerts of an object, to a folder beside the
    files that goes at the end. Encoded alerts are kept in parts; the files of one part after another are written, and the part and its shuffle go before the next.
    """
    if codec not in CODECS:
        raise ValueError(f"codec {codec} is none of {CODECS}")
    schema, run = alerts.schema, uuid.uuid4().hex
    fs, root = _place(folder)
    unfinished = f"{root}/_unfinished-{run}"
    fs.create_dir(unfinished, recursive=True)
    keys = {"_visit": F.col("diaSource.visit").cast("long"), "_detector": F.col("diaSource.detector").cast("long")}
    own = counted.select(F.col("visit").cast("long").alias("_v"), F.col("detector").cast("long").alias("_d")) if counted is not None else alerts.select(keys["_visit"].alias("_v"), keys["_detector"].alias("_d"))
    files = materialize(own.groupBy("_v", "_d").agg(F.ceil(F.count("*") / most_rows).alias("_files")), "alert-counts")
    spark = alerts.sparkSession
    n_files = files.agg(F.sum("_files")).first()[0] or 0
    n_rounds = max(1, min(ROUNDS, n_files // (2 * spark.sparkContext.defaultParallelism)))
    same = F.col("_visit").eqNullSafe(F.col("_v")) & F.col("_detector").eqNullSafe(F.col("_d"))
    parted = _encoded(alerts, keys, codec, unfinished).join(F.broadcast(files), same, "left")
    parted = parted.select("_visit", "_detector", F.pmod(F.xxhash64("diaSourceId"), F.coalesce("_files", F.lit(1))).alias("_file"), "diaSourceId", "body", "packed", "size", "parts")

    def name(visit: int | None, detector: int | None, part: int) -> str:
        return "_".join("null" if x is None else str(x) for x in (visit, detector)) + (f"_{part}" if part else "") + ".avro"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _place(folder)
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("_visit", "_detector", "_file", "body", "packed", "size", "parts")), strict=True))
        for key, group in itertools.groupby(rows, key=lambda row: row[:3]):
            file = name(*key)
            marker = hashlib.md5(file.encode()).digest()
            own = f"{top}/_unfinished-{run}/{uuid.uuid4().hex}"
            n, size, held = 0, 0, []
            with store.open_output_stream(own, compression=None) as out:
                out.write(header(schema, codec, marker))
                for *_, body, packed, plain, parts in group:
                    held.append((_whole(body, parts, store, f"{top}/_unfinished-{run}"), packed))
                    n, size = n + 1, size + plain
                    if size >= BLOCK_BYTES:
                        out.write(_mixed_block(held, codec, marker))
                        size, held = 0, []
                if held:
                    out.write(_mixed_block(held, codec, marker))
                length = out.tell()
            store.move(own, f"{top}/{file}")
            visit, detector, _ = key
            yield pa.RecordBatch.from_pydict({"visit": pa.array([visit], pa.int64()), "detector": pa.array([detector], pa.int64()), "file": [file], "alerts": pa.array([n], pa.int64()), "bytes": pa.array([length], pa.int64())})

    order = ["_visit", "_detector", "_file"]
    parts, made = new_path(spark, "alert-bodies"), new_path(spark, "alert-files")
    with shuffles_removed(spark):
        rounded = parted.withColumn("_round", F.pmod(F.xxhash64(*order), F.lit(n_rounds)).cast("int"))
        rounded.write.partitionBy("_round").option("compression", "zstd").parquet(parts)
        there = spark.read.schema(rounded.schema).parquet(parts).select("_round").distinct().collect()
        for n in sorted(row["_round"] for row in there):
            part = spark.read.schema(parted.schema).parquet(f"{parts}/_round={n}")
            dealt = part.repartition(*order).sortWithinPartitions(*order, "diaSourceId", "body", "parts")
            dealt.mapInArrow(write, _WRITTEN).write.mode("append").option("compression", "zstd").parquet(made)
            release(part)
    release(files)
    fs.delete_dir(unfinished)
    return spark.read.schema(_WRITTEN).parquet(made) if there else spark.createDataFrame([], _WRITTEN)


def spark_type(schema: Any) -> T.DataType:
    """The type that :func:`~skymatch.operators.alerts.avro_schema` makes this schema of; any other schema is an error."""
    simple = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "float": T.FloatType(), "boolean": T.BooleanType(), "string": T.StringType(), "bytes": T.BinaryType()}

    def optional(union: Any) -> T.DataType:
        if not isinstance(union, list) or len(union) != 2 or union[0] != "null":
            raise ValueError(f"a field must be null or one type, not {union}")
        return spark_type(union[1])

    if isinstance(schema, str):
        return simple[schema]
    if schema["type"] == "record":
        return T.StructType([T.StructField(f["name"], optional(f["type"])) for f in schema["fields"]])
    if schema["type"] == "array":
        return T.ArrayType(optional(schema["items"]))
    raise ValueError(f"no type for {schema}")


class _Bytes:
    """Reads numbers and pieces of a file from a place on."""

    def __init__(self, file: pa.NativeFile, at: int = 0):
        self.file = file
        file.seek(at)

    def take(self, n: int) -> bytes:
        data = self.file.read(n)
        if len(data) != n:
            raise ValueError("the file ends within a block")
        return data

    def number(self) -> int:
        n = shift = 0
        while True:
            (b,) = self.take(1)
            n, shift = n | (b & 0x7F) << shift, shift + 7
            if b < 0x80:
                return (n >> 1) ^ -(n & 1)

    def header(self) -> tuple[T.StructType, str, bytes]:
        if self.take(4) != MAGIC:
            raise ValueError("not an Avro container")
        entries = {}
        while n := self.number():
            for _ in range(n):
                key = self.take(self.number()).decode()
                entries[key] = self.take(self.number())
        codec = entries.get("avro.codec", b"null").decode()
        if codec not in CODECS:
            raise ValueError(f"codec {codec} is none of {CODECS}")
        return spark_type(json.loads(entries["avro.schema"])), codec, self.take(SYNC_BYTES)


def _next_marker(file: pa.NativeFile, marker: bytes, start: int, stop: int) -> int | None:
    """Where the first marker that begins in [start, stop) begins."""
    file.seek(start)
    at, tail = start, b""
    while at - len(tail) < stop:
        data = file.read(1 << 16)
        found = (tail + data).find(marker)
        if found >= 0:
            place = at - len(tail) + found
            return place if place < stop else None
        if not data:
            return None
        at, tail = at + len(data), (tail + data)[-(SYNC_BYTES - 1) :]
    return None


class FilePart(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


class _AlertReader(DataSourceReader):
    def __init__(self, folder: str, split: int, schema: T.StructType):
        self.folder, self.split, self.schema = folder, split, schema

    def partitions(self) -> list[InputPartition]:
        return [FilePart(path, at, at + self.split) for path, size in alert_files(self.folder) for at in range(0, size, self.split)] or [FilePart("", 0, 0)]

    def read(self, partition: FilePart) -> Iterator[tuple]:
        """The records of the blocks whose marker before them begins in this part of the file."""
        if not partition.path:
            return
        store, _ = _place(self.folder)
        with store.open_input_file(partition.path) as file:
            kind, codec, marker = _Bytes(file).header()
            at = _next_marker(file, marker, max(partition.start, file.tell() - SYNC_BYTES), partition.stop)
            size = file.size()
            names = [f.name for f in self.schema]
            while at is not None and at < partition.stop and at + SYNC_BYTES < size:
                data = _Bytes(file, at + SYNC_BYTES)
                n = data.number()
                records = data.take(data.number())
                at = file.tell()
                if data.take(SYNC_BYTES) != marker:
                    raise ValueError(f"{partition.path}: no marker after the block that ends at {at}")
                records = zlib.decompress(records, -15) if codec == "deflate" else records
                place = 0
                for _ in range(n):
                    record, place = decode_avro(kind, records, place, set(names))
                    yield tuple(record.get(c) for c in names)


def alert_files(folder: str) -> list[tuple[str, int]]:
    """Paths and sizes of the finished files of a folder."""
    fs, root = _place(folder)
    found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    return sorted((f.path, f.size) for f in found if f.is_file and f.extension == "avro" and not f.base_name.startswith(("_", ".")))


class AlertSource(DataSource):
    """``spark.read.format("alert_files").load(folder)``; option ``splitBytes``. The schema is that of the first file."""

    @classmethod
    def name(cls) -> str:
        return "alert_files"

    def schema(self) -> T.StructType:
        files = alert_files(self.options["path"])
        if not files:
            raise ValueError(f"no alert files in {self.options['path']}")
        fs, _ = _place(self.options["path"])
        with fs.open_input_file(files[0][0]) as file:
            return _Bytes(file).header()[0]

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _AlertReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)), schema)


def read_alert_files(spark: SparkSession, folder: str, schema: T.StructType | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The alerts of all files of a folder; fields that a file lacks are null, and those that ``schema`` lacks are not decoded. An empty folder needs a schema."""
    spark.dataSource.register(AlertSource)
    reader = spark.read.format("alert_files").option("splitBytes", str(split_bytes))
    return (reader.schema(schema) if schema is not None else reader).load(folder)
