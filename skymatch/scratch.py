"""Intermediate tables in the folder that every executor can read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

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


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the tables written here go when each is finished, not when the driver's memory is next cleaned."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
