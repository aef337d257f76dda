"""Shared pieces: the scratch folder that every executor can read, and word splitting inside tasks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_SCRATCH: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where that is unset on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
        return _OWN_SCRATCH.setdefault("root", tempfile.mkdtemp(prefix="skymatch-"))
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/skymatch/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the scratch folder and read it back: later steps neither recompute it nor lose it with an executor."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Delete tables made by :func:`materialize` that no later step reads."""
    for df in frames:
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/skymatch/" in f}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone as far as ASCII words can tell; the two letters that ``lower`` turns into ASCII take the exact, slower way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    exact = F.translate(text, upper, upper.lower())
    return F.when(text.contains("K") | text.contains("İ"), exact).otherwise(F.lower(text))


# --- inside tasks -----------------------------------------------------------------------------------------------

_ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def space_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; bytes.split() splits at exactly these six characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_space_words(text: str | None) -> list[bytes]:
    """The same after lower-casing A-Z (bytes.lower() leaves all other characters alone)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def alnum_words(text: str | None) -> list[bytes]:
    """Words of ASCII letters, digits and any non-ASCII characters, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_ALNUM).split() if text else []


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bounded number of words."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.limit:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; fewer words make one shingle of the whole sequence; none make none."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, dtype=np.uint64)
    width = min(k, n)
    out = np.full(n - width + 1, np.uint64(width), dtype=np.uint64)
    for j in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : n - width + 1 + j])
    return np.unique(out)


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of the named columns of Arrow batches, one by one."""
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size: int = 512, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded rows and bytes from an iterator of tuples."""

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += sum(len(x) if isinstance(x, bytes | str) else 8 * x.size if isinstance(x, np.ndarray) else 8 for x in row)
        if len(held) >= size or weight >= max_bytes:
            yield batch(held)
            held, weight = [], 0
    if held:
        yield batch(held)
