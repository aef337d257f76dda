"""Counts of a visit and the metrics read from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for a number of alerts, or their delay, where none were asked for.
NOT_PRODUCED = -1


def visit_counts(associated: DataFrame, new_objects: DataFrame, counts: DataFrame, ephemerides: DataFrame | None = None) -> DataFrame:
    """One row per visit and detector: updated, unassociated and new objects, solar-system objects in all and matched."""
    key = ["visit", "detector"]
    new = new_objects.groupBy(*key).agg(F.count("*").alias("numNewDiaObjects"))
    solar = associated.groupBy(*key).agg(F.count(F.when(F.col("ssObjectId") != 0, 1)).alias("numAssociatedSsObjects"))
    out = counts.select(*key, F.col("nUpdatedDiaObjects").alias("numUpdatedDiaObjects"), F.col("nUnassociatedDiaObjects").alias("numUnassociatedDiaObjects")).join(new, key, "left").join(solar, key, "left")
    if ephemerides is not None:
        out = out.join(ephemerides.groupBy(*key).agg(F.count("*").alias("numTotalSolarSystemObjects")), key, "left")
    else:
        out = out.withColumn("numTotalSolarSystemObjects", F.lit(0).cast("long"))
    return out.fillna(0)


def fraction_updated() -> Column:
    """Share of the objects in view that were seen again; none where there were none."""
    u, n = F.col("numUpdatedDiaObjects"), F.col("numUnassociatedDiaObjects")
    return F.when((u > 0) | (n > 0), u / (u + n))


def _value(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


METRICS: dict[str, Callable[[], Column]] = {
    "numNewDiaObjects": _value("numNewDiaObjects"),
    "numUnassociatedDiaObjects": _value("numUnassociatedDiaObjects"),
    "fracUpdatedDiaObjects": fraction_updated,
    "numTotalSolarSystemObjects": _value("numTotalSolarSystemObjects"),
    "numAssociatedSsObjects": _value("numAssociatedSsObjects"),
}


def metrics(counts: DataFrame) -> DataFrame:
    """visit, detector, metric and value; metrics without a value have no row."""
    values = F.array(*[F.struct(F.lit(n).alias("metric"), m().cast("double").alias("value")) for n, m in METRICS.items()])
    return counts.select("visit", "detector", F.explode(values).alias("m")).select("visit", "detector", "m.metric", "m.value").where(F.col("value").isNotNull())


def whole(text: Column) -> Column:
    """A counter kept as text: null where missing, an error where it is no whole number."""
    number = text.try_cast("bigint")
    return F.when(text.isNull(), None).when(number.isNull(), F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast("bigint")).otherwise(number)


def single_source_objects(objects: DataFrame) -> DataFrame:
    """How many objects of the whole table have exactly one source."""
    return objects.where(F.col("nDiaSources") == 1).agg(F.count("*").alias("totalUnassociatedDiaObjects"))
