"""Statistics of each object over its full history, per band, from a registry of aggregates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import unit_vector
from ..functions.nullsafe import finite, known
from ..sources.schemas import BANDS


def _measured(flux: str) -> Column:
    return finite(F.col(flux)) & finite(F.col(f"{flux}Err")) & (F.col(f"{flux}Err") > 0)


def _weight(flux: str) -> Column:
    e = F.col(f"{flux}Err").cast("double")
    return F.when(_measured(flux), 1 / (e * e))


def weighted_mean(flux: str, name: str) -> dict[str, Column]:
    w = _weight(flux)
    return {name: F.sum(F.col(flux) * w) / F.sum(w), f"{name}Err": F.sqrt(1 / F.sum(w))}


def _finite(flux: str) -> Column:
    return F.when(finite(F.col(flux)), F.col(flux).cast("double"))


#: Name of a statistic -> column names and aggregates of one band's rows.
STATISTICS: dict[str, Callable[[], dict[str, Column]]] = {
    "meanFlux": lambda: weighted_mean("psfFlux", "psfFluxMean") | {"psfFluxNdata": F.count(F.when(_measured("psfFlux"), 1))},
    "sigmaFlux": lambda: {"psfFluxSigma": F.stddev_samp(_finite("psfFlux"))},
    "minMaxFlux": lambda: {"psfFluxMin": F.min(F.when(known(F.col("psfFlux")), F.col("psfFlux"))), "psfFluxMax": F.max(F.when(known(F.col("psfFlux")), F.col("psfFlux")))},
    "maxSlopeFlux": lambda: {"psfFluxMaxSlope": F.max("_slope")},
    "meanErrFlux": lambda: {"psfFluxErrMean": F.avg(F.when(finite(F.col("psfFluxErr")), F.col("psfFluxErr").cast("double")))},
    "meanTotFlux": lambda: weighted_mean("scienceFlux", "scienceFluxMean"),
}


def with_slopes(sources: DataFrame) -> DataFrame:
    """``_slope``: change of flux over time since the source before, of the same object and band; none without a step in time."""
    order = W.partitionBy("diaObjectId", "band").orderBy("midpointMjdTai", "diaSourceId")
    valid = finite(F.col("psfFlux")) & known(F.col("midpointMjdTai"))
    used = sources.withColumn("_f", F.when(valid, F.col("psfFlux").cast("double"))).withColumn("_t", F.when(valid, F.col("midpointMjdTai")))
    f = F.last("_f", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1))
    t = F.last("_t", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1))
    step = F.col("_t") - t
    return used.withColumn("_slope", F.when(step > 0, (F.col("_f") - f) / step)).drop("_f", "_t")


def band_statistics(sources: DataFrame, names: list[str] | None = None, bands: tuple[str, ...] = BANDS) -> DataFrame:
    """One row per object, columns ``{band}_{statistic}``; null for bands without sources."""
    names = list(STATISTICS) if names is None else names
    if unknown := [n for n in names if n not in STATISTICS]:
        raise ValueError(f"no statistics {unknown}")
    aggregates = {c: a for n in names for c, a in STATISTICS[n]().items()}
    rows = with_slopes(sources) if "maxSlopeFlux" in names else sources
    # A row per band first, then the bands of an object side by side: a tenth of the expressions of an aggregate per band and statistic.
    long = rows.groupBy("diaObjectId", "band").agg(*[a.alias(c) for c, a in aggregates.items()])
    entry = F.when(F.col("band").isin(*bands), F.struct("band", F.struct(*aggregates).alias("s")))
    wide = long.groupBy("diaObjectId").agg(F.map_from_entries(F.collect_list(entry)).alias("_m"))
    of_band = lambda b: F.try_element_at("_m", F.lit(b))
    return wide.select("diaObjectId", *[of_band(b).getField(c).alias(f"{b}_{c}") for b in bands for c in aggregates])


def mean_positions(sources: DataFrame) -> DataFrame:
    """Direction of the mean unit vector, which has no wrap at RA 0, and the number of sources."""
    x, y, z = unit_vector(F.col("ra"), F.col("dec"))
    m = sources.where(known(F.col("ra")) & known(F.col("dec"))).groupBy("diaObjectId").agg(F.avg(x).alias("x"), F.avg(y).alias("y"), F.avg(z).alias("z"), F.count("*").alias("nDiaSources"))
    return m.select("diaObjectId", F.pmod(F.degrees(F.atan2("y", "x")), F.lit(360.0)).alias("ra"), F.degrees(F.atan2(F.col("z"), F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y")))).alias("dec"), "nDiaSources")


def summarize(objects: DataFrame, sources: DataFrame, updated_ids: DataFrame, names: list[str] | None = None) -> DataFrame:
    """``objects`` with the statistics of the updated ones worked out again from all their sources."""
    history = sources.join(updated_ids, "diaObjectId", "left_semi")
    fresh = mean_positions(history).join(band_statistics(history, names), "diaObjectId")
    changed = [c for c in fresh.columns if c != "diaObjectId"]
    both = objects.alias("o").join(fresh.alias("f"), "diaObjectId", "left").withColumn("_new", F.col("f.ra").isNotNull())
    pick = lambda c: F.when(F.col("_new"), F.col(f"f.{c}")).otherwise(F.col(f"o.{c}")) if c in objects.columns else F.col(f"f.{c}")
    kept = [F.col(f"o.{c}").alias(c) for c in objects.columns if c not in changed and c != "diaObjectId"]
    return both.select("diaObjectId", *kept, *[pick(c).alias(c) for c in changed])
