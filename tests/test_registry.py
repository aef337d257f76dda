"""Every registered query runs on tables of a handful of rows, and agrees with its SQL."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from skymatch.plans import registry


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    spark.range(60).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(f"{root}/customer.parquet")
    kinds = F.element_at(F.array(*map(F.lit, ("click", "view", "purchase", "signup", "error"))), (F.col("id") % 5 + 1).cast("int"))
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 4_001)
    spark.range(600).select(F.col("id").alias("event_id"), (F.col("id") * 7 % 6).alias("user_id"), kinds.alias("event_type"), ts.cast("timestamp_ntz").alias("ts"), (F.col("id") * 13 % 97).cast("double").alias("value")).coalesce(1).write.parquet(f"{root}/events.parquet")
    line = {"l_orderkey": F.col("id") % 50, "l_linenumber": (F.col("id") % 4 + 1).cast("int"), "l_partkey": F.col("id") * 7 % 20, "l_suppkey": F.col("id") * 3 % 11, "l_quantity": (F.col("id") % 31).cast("double"), "l_extendedprice": (F.col("id") * 5 % 77).cast("double"), "l_discount": F.col("id") % 10 / 100.0, "l_tax": F.col("id") % 8 / 100.0}
    spark.range(400).select(*[c.alias(n) for n, c in line.items()]).coalesce(1).write.parquet(f"{root}/lineitem.parquet")
    return root


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return str(value)
    return repr(float(value)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_agrees_with_sql(spark, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    got = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    con = duckdb.connect()
    for t in ("customer", "events", "lineitem"):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet/*.parquet'")
    out = con.sql(registry.ORACLES[name])
    order = sorted(range(len(out.columns)), key=lambda i: out.columns[i])
    assert sorted(df.columns) == [out.columns[i] for i in order]
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in out.fetchall())
