"""Row filters and splits of detection catalogs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nullsafe import any_flag, ge, ieee_div, le, lt
from ..scratch import materialize
from ..sources.schemas import require

VISIT = ["visit", "detector"]
TRAIL = "ext_trailedSources_Naive"


@dataclass(frozen=True)
class FilterConfig:
    remove_sky: bool = False
    bad_flags: tuple[str, ...] = ("base_PixelFlags_flag_crCenter", "base_PixelFlags_flag_high_varianceCenterAll")
    remove_negative: bool = True
    min_snr: float = -2.0
    flux: str = "ip_diffim_forced_PsfFlux_instFlux"
    remove_trailed: bool = True
    #: Arcseconds per second: ten degrees a day.
    max_trail_rate: float = 36000 / 3600 / 24
    #: Arcseconds a pixel and seconds where neither the catalog nor an exposure tells.
    pixel_scale: float = 0.2
    exposure_time: float = 30.0


def sky_mask(df: DataFrame) -> Column:
    return F.coalesce(F.col("sky_source"), F.lit(False))


def flag_mask(flags: tuple[str, ...]) -> Column:
    return any_flag(map(F.col, flags), null_as=False)


def snr_mask(flux: str, least: float) -> Column:
    """Direct signal to noise below ``least``."""
    return lt(ieee_div(F.col(flux), F.col(f"{flux}Err")), least)


def with_trail_limit(df: DataFrame, config: FilterConfig, exposures: DataFrame | None = None) -> DataFrame:
    """``df`` with _trail_limit, the longest trail in pixels that is kept: by the scale that the visit's own catalog shows and the time of its exposure.

    ``exposures`` (visit, detector, exposureTime) has a row per exposure; a visit without one, or without a time, takes the default.
    A table without visits or positions shows no scale, so it takes both defaults, as does a source of an unknown visit or detector.
    """
    default = F.lit(config.max_trail_rate * config.exposure_time / config.pixel_scale)
    if not {*VISIT, "id", "x", "y", "coord_ra", "coord_dec"} <= set(df.columns):
        return df.withColumn("_trail_limit", default)
    scales = catalog_pixel_scale(df, config.pixel_scale)
    time = F.lit(config.exposure_time)
    if exposures is not None:
        scales = scales.join(exposures.select(*VISIT, F.col("exposureTime").cast("double").alias("_time")), VISIT, "left")
        time = F.coalesce("_time", time)
    limits = scales.select(*VISIT, (config.max_trail_rate * time / F.col("pixel_scale")).alias("_trail_limit"))
    return df.join(limits, VISIT, "left").withColumn("_trail_limit", F.coalesce("_trail_limit", default))


def trail_mask(limit: Column) -> Column:
    """Trail at least as long as the limit, or off the image, or suspected long and at the edge."""
    flag = lambda name: F.coalesce(F.col(f"{TRAIL}_flag_{name}"), F.lit(False))
    return ge(F.col(f"{TRAIL}_length"), limit) | flag("off_image") | (flag("suspect_long_trail") & flag("edge"))


def footprint_trail_mask(limit: Column) -> Column:
    """Where no trail could be measured: the diagonal of the footprint box at least as long as the limit."""
    w, h = (F.col(f"footprint.max{a}") - F.col(f"footprint.min{a}") + 1 for a in "XY")
    return F.coalesce(F.col(f"{TRAIL}_flag"), F.lit(False)) & ge(F.sqrt((w * w + h * h).cast("double")), limit)


def rules(df: DataFrame, config: FilterConfig = FilterConfig()) -> dict[str, Column]:
    """The rejection rules in their order."""
    out: dict[str, Column] = {}
    if config.remove_sky:
        out["sky"] = sky_mask(df)
    if config.bad_flags:
        out["flags"] = flag_mask(config.bad_flags)
    if config.remove_negative:
        out["snr"] = snr_mask(config.flux, config.min_snr)
    return out


def classified(df: DataFrame, config: FilterConfig = FilterConfig(), exposures: DataFrame | None = None) -> DataFrame:
    """``df`` with is_rejected (by any rule but trails), is_long (by its trail alone) and reason (the first rule that rejects)."""
    masks = rules(df, config)
    long = F.lit(False)
    if config.remove_trailed:
        df = with_trail_limit(df, config, exposures)
        long = trail_mask(F.col("_trail_limit"))
        if "footprint" in df.columns:
            long = long | footprint_trail_mask(F.col("_trail_limit"))
    reason = F.lit(None).cast("string")
    for name, mask in reversed([*masks.items(), ("trail", long)]):
        reason = F.when(mask, name).otherwise(reason)
    rejected = any_flag(masks.values(), null_as=False)
    return df.withColumns({"is_rejected": rejected, "is_long": long, "reason": reason}).drop("_trail_limit")


@dataclass
class ThreeWay:
    """A source may be both rejected and long; it is kept only if it is neither."""

    kept: DataFrame
    rejected: DataFrame
    long_trailed: DataFrame


def three_way(df: DataFrame, config: FilterConfig = FilterConfig(), exposures: DataFrame | None = None) -> ThreeWay:
    marked, own = materialize(classified(df, config, exposures), "classified"), df.columns  # read three times
    return ThreeWay(marked.where(~F.col("is_rejected") & ~F.col("is_long")).select(own), marked.where("is_rejected").select(own), marked.where("is_long").select(own))


def attribution(df: DataFrame, config: FilterConfig = FilterConfig(), exposures: DataFrame | None = None) -> DataFrame:
    """How many sources each rule was the first to reject."""
    return classified(df, config, exposures).where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("n"))


def catalog_pixel_scale(df: DataFrame, default: float = 0.2, tolerance: float = 0.1) -> DataFrame:
    """visit, detector and arcseconds per pixel from the leftmost source and the source farthest from it.

    The default stands in for fewer than two sources, a scale that can't be worked out (NaN included), and one that is over ``tolerance`` off.
    """
    left = df.groupBy(*VISIT).agg(F.min_by(F.struct("x", "y", "coord_ra", "coord_dec"), F.struct("x", "id")).alias("l"), F.count("*").alias("n"))
    dx, dy = F.col("x") - F.col("l.x"), F.col("y") - F.col("l.y")
    with_left = df.join(left, VISIT).withColumn("pixels", F.sqrt(dx * dx + dy * dy))
    far = with_left.groupBy(*VISIT).agg(F.max_by(F.struct("coord_ra", "coord_dec", "pixels", "l", "n"), F.struct("pixels", "id")).alias("f"))
    # Law of cosines on the sphere, with the angle between the meridians.
    cosine = F.sin("f.coord_dec") * F.sin("f.l.coord_dec") + F.cos("f.coord_dec") * F.cos("f.l.coord_dec") * F.cos(F.col("f.coord_ra") - F.col("f.l.coord_ra"))
    arcsec = F.degrees(F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0)))) * 3600
    scale = ieee_div(arcsec, F.col("f.pixels"))
    good = (F.col("f.n") > 1) & le(F.abs(scale - default) / default, tolerance)
    return far.select(*VISIT, F.when(good, scale).otherwise(default).alias("pixel_scale"))


def with_reliability(sources: DataFrame, scores: DataFrame, source_id: str = "id") -> DataFrame:
    """reliability and reliabilityVersion from ``scores`` (id, score, version); ids that don't pair up are an error."""
    s = scores.select(F.col("id").alias("_sid"), F.col("score").alias("reliability"), F.col("version").alias("reliabilityVersion"))
    both = sources.drop("reliability", "reliabilityVersion").join(s, F.col(source_id) == F.col("_sid"), "full")
    if both.where(F.col(source_id).isNull() | F.col("_sid").isNull()).limit(1).count():
        raise ValueError("sources and reliability scores have different ids")
    return both.drop("_sid")


def reliability_split(sources: DataFrame, least: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Kept and rejected (score below ``least``); an unknown score is kept."""
    low = lt(F.col("reliability"), least)
    return sources.where(~low), sources.where(low)


@dataclass(frozen=True)
class QualityConfig:
    """What a source must pass to found a new object. A threshold of 0 turns its test off."""

    bad_flags: tuple[str, ...] = ("centroid_flag", "pixelFlags_crCenter", "pixelFlags_nodataCenter", "pixelFlags_interpolatedCenter", "pixelFlags_saturatedCenter", "pixelFlags_suspectCenter", "pixelFlags_streakCenter", "glint_trail")
    snr: float = 0.0
    low_reliability_snr: float = 0.0
    reliability: float = 0.1
    low_snr_reliability: float = 0.1
    flux: str = "apFlux"


def poor(df: DataFrame, config: QualityConfig = QualityConfig()) -> Column:
    """Not good enough to found an object: a flag, low signal to noise, low reliability, or both rather low."""
    require(df, [*config.bad_flags, config.flux, f"{config.flux}Err", "reliability"], "the source table")
    snr = F.abs(ieee_div(F.col(config.flux), F.col(f"{config.flux}Err")))
    bad = any_flag(map(F.col, config.bad_flags), null_as=False)
    if config.snr > 0:
        bad = bad | lt(snr, config.snr)
    if config.reliability > 0:
        bad = bad | lt(F.col("reliability"), config.reliability)
    if min(config.low_reliability_snr, config.low_snr_reliability) > 0:
        bad = bad | (lt(snr, config.low_reliability_snr) & lt(F.col("reliability"), config.low_snr_reliability))
    return bad


def quality_split(df: DataFrame, config: QualityConfig = QualityConfig()) -> tuple[DataFrame, DataFrame]:
    bad = poor(df, config)
    return df.where(~bad), df.where(bad)


@dataclass(frozen=True)
class HistoryConfig:
    reliability: float = 0.5
    trail_length: float = 1.4
    bad_flags: tuple[str, ...] = field(default=("glint_trail", "isDipole"))
    threshold: int = 2


def good_objects(objects: DataFrame, history: DataFrame, config: HistoryConfig = HistoryConfig()) -> DataFrame:
    """Objects with enough good sources; an unknown flag value counts as bad, a flag that the table lacks is not asked for."""
    require(history, ["diaObjectId", "reliability", "trailLength"], "the source history")
    flags = [F.col(f) for f in config.bad_flags if f in history.columns]
    good = ge(F.col("reliability"), config.reliability) & le(F.col("trailLength"), config.trail_length) & ~any_flag(flags, null_as=True)
    enough = history.where(good).groupBy("diaObjectId").agg(F.count("*").alias("_n")).where(F.col("_n") >= config.threshold)
    return objects.join(enough.select("diaObjectId"), "diaObjectId", "left_semi")


def check_bands(df: DataFrame, valid: tuple[str, ...]) -> None:
    """Bands outside the list are an error."""
    if unknown := [r["band"] for r in df.select("band").distinct().where(~F.col("band").isin(*valid)).limit(20).collect()]:
        raise ValueError(f"bands {unknown} are not among {valid}")
