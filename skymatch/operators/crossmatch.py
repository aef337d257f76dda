"""Spherical range join and pair scores.

A pair is a source and an object whose unit vectors are at most the radius apart. Space is cut into cubes about twenty radii
wide: an object lies in one cube, a source is copied into each cube its radius touches (about 1.3 on average), and an
equi-join on the cube is followed by the exact test. There is no wrap at RA 0 and no special case at the poles.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions.geometry import chord, ra_difference, unit_vector
from ..functions.nullsafe import finite, known

VISIT = ["visit", "detector"]


@dataclass(frozen=True)
class MatchConfig:
    """Radius, least and substitute position errors, all in arcseconds."""

    radius: float = 1.0
    error_floor: float = 0.05
    error_fallback: float = 0.2
    cell_radii: float = 20.0
    patch_radii: float = 200.0


def drop_unplaced(sources: DataFrame) -> DataFrame:
    """Without the sources that have no position; they take part in no later step."""
    return sources.where(known(F.col("ra")) & known(F.col("dec")))


def unplaced(sources: DataFrame, id_col: str = "diaSourceId") -> DataFrame:
    """Ids of the sources that have no position, to be reported."""
    return sources.where(~(known(F.col("ra")) & known(F.col("dec")))).select(id_col)


def range_join(left: DataFrame, right: DataFrame, radius: Column | float, most: float, cell_radii: float = 20.0, on: list[str] | None = None) -> DataFrame:
    """Pairs of rows of ``left`` (lx, ly, lz) and ``right`` (rx, ry, rz) at a chord of at most ``radius`` (at most ``most``), with ``chord``.

    ``on``: further columns, present in both, that must be equal.
    """
    width = cell_radii * most
    cell = lambda c: F.floor(F.col(c) / width)
    touched = lambda c: F.sequence(F.floor((F.col(c) - most) / width), F.floor((F.col(c) + most) / width))
    copies = left
    for axis in "xyz":
        copies = copies.withColumn(f"c{axis}", F.explode(touched(f"l{axis}")))
    placed = right.withColumns({f"c{axis}": cell(f"r{axis}") for axis in "xyz"})
    # Both sides are shuffled by cube: beside a broadcast the pairs would be made in as few tasks as the sources have files.
    pairs = copies.join(placed.hint("merge"), ["cx", "cy", "cz", *(on or [])])
    length = chord(tuple(F.col(f"l{a}") for a in "xyz"), tuple(F.col(f"r{a}") for a in "xyz"))
    return pairs.withColumn("chord", length).where(F.col("chord") <= radius).drop("cx", "cy", "cz")


def _joined(sources: DataFrame, objects: DataFrame, config: MatchConfig) -> DataFrame:
    x, y, z = unit_vector(F.col("ra"), F.col("dec"))
    placed = drop_unplaced(sources)
    left = placed.select(*VISIT, "diaSourceId", F.col("ra").alias("sRa"), F.col("dec").alias("sDec"), _error(sources, "raErr", "sRaErr"), _error(sources, "decErr", "sDecErr"), x.alias("lx"), y.alias("ly"), z.alias("lz"))
    right = objects.where(known(F.col("ra")) & known(F.col("dec"))).select("diaObjectId", F.col("ra").alias("oRa"), F.col("dec").alias("oDec"), _error(objects, "raErr", "oRaErr"), _error(objects, "decErr", "oDecErr"), x.alias("rx"), y.alias("ry"), z.alias("rz"))
    r = math.radians(config.radius / 3600)
    return range_join(left, right, r, r, config.cell_radii)


def candidates(sources: DataFrame, objects: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """All (visit, detector, source, object) pairs within the radius, with positions, errors and chord."""
    return _joined(sources, objects, config).drop("lx", "ly", "lz", "rx", "ry", "rz")


PATCH = ["px", "py", "pz"]


def _patches(pairs: DataFrame, config: MatchConfig) -> DataFrame:
    """With the patch (a wide cube) of a pair's object, and ``open``: whether objects of other patches may be near the source too."""
    width, reach = config.patch_radii * math.radians(config.radius / 3600), 1.01 * math.radians(config.radius / 3600)
    whole = [F.floor((F.col(f"l{a}") - reach) / width) == F.floor((F.col(f"l{a}") + reach) / width) for a in "xyz"]
    return pairs.withColumns({f"p{a}": F.floor(F.col(f"r{a}") / width) for a in "xyz"} | {"open": ~(whole[0] & whole[1] & whole[2])})


def _error(df: DataFrame, name: str, alias: str) -> Column:
    return (F.col(name).cast("double") if name in df.columns else F.lit(None).cast("double")).alias(alias)


def _usable(c: Column) -> Column:
    return finite(c) & (c > 0)


def variance(a: Column, b: Column, config: MatchConfig) -> Column:
    """Sum of two squared errors in square degrees: unusable errors replaced, the sum floored."""
    one = lambda e: F.when(_usable(e), e).otherwise(config.error_fallback / 3600)
    return F.greatest(one(a) * one(a) + one(b) * one(b), F.lit((config.error_floor / 3600) ** 2))


def nll(config: MatchConfig = MatchConfig()) -> Column:
    """Gaussian negative log likelihood of a pair; errors are in coordinate degrees, so there is no cosine of the declination."""
    va, vd = variance(F.col("sRaErr"), F.col("oRaErr"), config), variance(F.col("sDecErr"), F.col("oDecErr"), config)
    dra, ddec = ra_difference(F.col("sRa"), F.col("oRa")), F.col("sDec") - F.col("oDec")
    return 0.5 * (dra * dra / va + ddec * ddec / vd) + 0.5 * F.log(va * vd)


def _has_errors(df: DataFrame) -> Column:
    """Aggregate: some usable raErr and some usable decErr, not necessarily in one row."""
    found = [F.coalesce(F.max(_usable(F.col(c).cast("double"))), F.lit(False)) if c in df.columns else F.lit(False) for c in ("raErr", "decErr")]
    return found[0] & found[1]


def error_modes(sources: DataFrame, objects: DataFrame) -> DataFrame:
    """Per visit and detector, whether pairs are scored by likelihood: both catalogs have some usable raErr and some usable decErr."""
    ours = drop_unplaced(sources).groupBy(*VISIT).agg(F.count("*").alias("_n"), _has_errors(sources).alias("ours"))
    theirs = objects.agg(F.count("*"), _has_errors(objects).alias("theirs")).select("theirs").scalar()
    return ours.select(*VISIT, (F.col("ours") & theirs).alias("by_likelihood"))


def scored(sources: DataFrame, objects: DataFrame, config: MatchConfig = MatchConfig(), patches: bool = False) -> DataFrame:
    """visit, detector, diaSourceId, diaObjectId and score of all candidates, in the mode of their visit and detector; with their patch if asked for."""
    pairs = _joined(sources, objects, config).join(F.broadcast(error_modes(sources, objects)), VISIT)
    kept = [*PATCH, "open"] if patches else []
    return (_patches(pairs, config) if patches else pairs).select(*VISIT, *kept, "diaSourceId", "diaObjectId", F.when(F.col("by_likelihood"), nll(config)).otherwise(F.col("chord")).alias("score"), "chord", "by_likelihood")


def unmatched_price(config: MatchConfig = MatchConfig(), over: WindowSpec | None = None) -> Column:
    """The price of leaving a source unmatched, above every score: an aggregate of pairs, or the same over a window."""
    most = lambda c: F.max(c) if over is None else F.max(c).over(over)
    return F.when(most("by_likelihood"), most("score") + 1).otherwise(F.lit(1.01 * math.radians(config.radius / 3600) + 1e-300))


def unmatched_cost(pairs: DataFrame, config: MatchConfig = MatchConfig()) -> DataFrame:
    """Per visit and detector, the price of leaving a source unmatched."""
    return pairs.groupBy(*VISIT).agg(unmatched_price(config).alias("unmatched"))
