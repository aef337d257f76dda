"""Raw detections to standard sources: constants of the visit, footprint sizes, flags, calibrated columns, schema."""

from __future__ import annotations

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import flags, photometry
from ..sources.schemas import DIA_SOURCE, conform
from .filters import sky_mask

if TYPE_CHECKING:
    from ..sources.plan_files import Plan


@dataclass(frozen=True)
class TransformConfig:
    remove_sky: bool = False
    pack_flags: bool = False
    flag_names: tuple[str, ...] = ()
    #: A source whose visit and detector have no exposure is an error; else its band and midpoint are unknown.
    require_exposure: bool = False


def bbox_size(x: Column, y: Column, box: Column) -> Column:
    """Side of a square around the centroid that holds the footprint, but at most twice the footprint's longer side."""
    lo_x, lo_y, hi_x, hi_y = (box.getField(n) for n in ("minX", "minY", "maxX", "maxY"))
    around = F.ceil(2 * F.greatest(F.abs(hi_x - x), F.abs(lo_x - x), F.abs(hi_y - y), F.abs(lo_y - y)))
    longer = F.greatest(hi_x - lo_x + 1, hi_y - lo_y + 1)
    return F.least(around, (2 * longer).cast("long"))


def peak_significance(box: Column) -> Column:
    """Significance of the first peak, NaN where it has none."""
    return F.coalesce(F.try_element_at(box.getField("peaks"), F.lit(1)).getField("significance"), F.lit(float("nan")))


def midpoint(begin: Column, end: Column, allow_unbounded: bool = False) -> Column:
    """Middle of a timespan. One missing end is an error, or stands for no length if that is allowed; both missing are an error."""
    if allow_unbounded:
        a, b = F.coalesce(begin, end), F.coalesce(end, begin)
        return F.when(a.isNull(), F.raise_error(F.lit("the timespan has no ends")).cast("double")).otherwise(a + (b - a) / 2)
    return F.when(begin.isNull() | end.isNull(), F.raise_error(F.lit("the timespan is unbounded")).cast("double")).otherwise(begin + (end - begin) / 2)


def enriched(df: DataFrame, exposures: DataFrame, processed_mjd: float, require_exposure: bool = False) -> DataFrame:
    """With band and midpoint of the exposure (one row per visit and detector), processing time, and ids not yet given.

    Every row stays. Where there is no exposure, band and midpoint are null, or ``require_exposure`` makes it an error.
    """
    e = exposures.select("visit", "detector", "band", "midpointMjdTai", F.lit(True).alias("_exposed"))
    both = df.drop("band", "midpointMjdTai").join(e, ["visit", "detector"], "left")
    if require_exposure:
        where = F.concat(F.lit("no exposure of visit "), F.coalesce(F.col("visit").cast("string"), F.lit("null")), F.lit(" detector "), F.coalesce(F.col("detector").cast("string"), F.lit("null")))
        both = both.withColumn("band", F.when(F.col("_exposed"), F.col("band")).otherwise(F.raise_error(where).cast("string")))
    both = both.drop("_exposed")
    zero = F.lit(0).cast("long")
    return both.withColumns({"timeProcessedMjdTai": F.lit(processed_mjd), "diaObjectId": zero, "ssObjectId": zero, "detector": F.col("detector").cast("short")})


def transform(raw: DataFrame, exposures: DataFrame, processed_mjd: float, config: TransformConfig = TransformConfig(), plan: Plan | None = None) -> DataFrame:
    """Standard sources of raw detections, with a boolean column per flag under its standard name, or packed into ``flags``.

    A ``plan`` read from files stands for the built-in projection, bits and rename rules.
    """
    projection, layout, rules = (photometry.PROJECTION, {"flags": flags.FLAG_BITS}, flags.RENAMES) if plan is None else (plan.projection, plan.layout, plan.renames)
    df = raw.where(~sky_mask(raw)) if config.remove_sky else raw
    df = enriched(df, exposures, processed_mjd, config.require_exposure)
    if "footprint" in df.columns:
        box = F.col("footprint")
        df = df.withColumns({"bboxSize": bbox_size(F.col("slot_Centroid_x"), F.col("slot_Centroid_y"), box), "snr": peak_significance(box)})
    named = flags.flag_columns(df, list(config.flag_names), rules)
    if config.pack_flags:
        if unknown := [n for n in config.flag_names if not any(n in bits for bits in layout.values())]:
            raise KeyError(f"flags without a bit: {unknown}")
        df = df.withColumns({column: flags.pack({n: bits[n] for n in config.flag_names if n in bits}) for column, bits in layout.items()})
        named = {}
    out = df.select(*photometry.projection(df.columns, projection), *[c.alias(f"_flag_{n}") for n, c in named.items()])
    standard = [F.col(f.name) if f.name in out.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in DIA_SOURCE]
    full = out.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(standard, DIA_SOURCE, strict=True)], *[F.col(f"_flag_{n}").alias(n) for n in named if n not in DIA_SOURCE.names])
    return full if named else conform(full, "diaSource")


def exposure_faults(exposures: DataFrame, template: bool = False) -> DataFrame:
    """visit, detector and everything that an exposure lacks to be used."""
    needed = {"calibration": "no photometric calibration", "crval": "no world coordinates", "band": "no band", "min_x": "no bounding box", "psf_sigma": "no point spread function"}
    if not template:
        needed |= {"date_mjd": "no date", "boresight_ra": "no boresight", "rotation": "no rotation"}
    missing = lambda c: F.col(c).isNull() if c in exposures.columns else F.lit(True)
    faults = F.array_compact(F.array(*[F.when(missing(c), F.lit(why)) for c, why in needed.items()]))
    return exposures.select("visit", "detector", faults.alias("faults")).where(F.size("faults") > 0)


def require_exposures(exposures: DataFrame, template: bool = False) -> None:
    """All faults of up to twenty exposures in one error, with the number of exposures that have any."""
    faults = exposure_faults(exposures, template)
    if found := faults.limit(20).collect():
        raise ValueError(f"{faults.count()} exposures can't be used: " + "; ".join(f"visit {r['visit']} detector {r['detector']}: {', '.join(r['faults'])}" for r in found))
