"""Solar-system objects: positions from Chebyshev coefficients, the cone and image masks, and their match with sources."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import Box, Wcs, in_cone, unit_vector
from .crossmatch import range_join

#: Added to the radius of a field, in degrees; error of a position in arcseconds where none is given.
CONE_BUFFER, DEFAULT_ERROR, IMAGE_MARGIN = 0.208, 2.0, 10
ORBIT_PREFIX = "MPCORB_"
# Element names of the short orbit table and of the long one.
CLASSIC_ELEMENTS = {"q": "q", "e": "e", "inc": "i", "node": "node", "argPeri": "argperi", "t_p_MJD_TDB": "peri_time", "epochMJD_TDB": "epoch_mjd"}


def chebyshev(coefficients: Column, t: Column) -> Column:
    """Value at ``t`` in [-1, 1] of the series, by Clenshaw's recurrence over the array; an empty array gives 0."""
    c = coefficients
    start = F.struct(F.lit(0.0).alias("b1"), F.lit(0.0).alias("b2"))
    rest = F.reverse(F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))))
    step = lambda acc, x: F.struct((2.0 * t * acc.getField("b1") - acc.getField("b2") + x).alias("b1"), acc.getField("b1").alias("b2"))
    end = F.aggregate(rest, start, step)
    return F.coalesce(F.try_element_at(c, F.lit(1)), F.lit(0.0)) + t * end.getField("b1") - end.getField("b2")


def positions(ephemerides: DataFrame, mjd: Column) -> DataFrame:
    """ephRa and ephDec in degrees at ``mjd``, from the series of the object less those of the observer."""
    t = (2 * mjd - F.col("tmin") - F.col("tmax")) / (F.col("tmax") - F.col("tmin"))
    x, y, z = (chebyshev(F.col(f"obj_{a}_poly"), t) - chebyshev(F.col(f"obs_{a}_poly"), t) for a in "xyz")
    placed = ephemerides.withColumns({"_x": x, "_y": y, "_z": z})
    ra = F.pmod(F.degrees(F.atan2("_y", "_x")), F.lit(360.0))
    dec = F.degrees(F.atan2(F.col("_z"), F.sqrt(F.col("_x") * F.col("_x") + F.col("_y") * F.col("_y"))))
    return placed.withColumns({"ephRa": ra, "ephDec": dec}).drop("_x", "_y", "_z")


def in_field(ephemerides: DataFrame, ra: float, dec: float, radius: float) -> DataFrame:
    """Ephemerides in the field's bounding circle and its buffer."""
    return ephemerides.where(in_cone(F.col("ephRa"), F.col("ephDec"), ra, dec, radius + CONE_BUFFER))


def on_image(ephemerides: DataFrame, wcs: Wcs, box: Box, margin: int = IMAGE_MARGIN) -> DataFrame:
    """Ephemerides in the padded image whose pixel leads back to their position (projections repeat themselves far away)."""
    x, y = wcs.sky_to_pixel(F.col("ephRa"), F.col("ephDec"))
    back_ra, back_dec = wcs.pixel_to_sky(F.col("_px"), F.col("_py"))
    cosine = reduce(lambda a, b: a + b, (p * q for p, q in zip(unit_vector(back_ra, back_dec), unit_vector(F.col("ephRa"), F.col("ephDec")), strict=True)))
    near = cosine > math.cos(math.radians(1 / 3600))
    return ephemerides.withColumns({"_px": x, "_py": y}).where(F.coalesce(box.grown(margin).contains(F.col("_px"), F.col("_py")) & near, F.lit(False))).drop("_px", "_py")


def match(sources: DataFrame, ephemerides: DataFrame, most_error: float = 60.0) -> DataFrame:
    """diaSourceId, ssObjectId and separation in arcseconds: each object's nearest source within its error, and each source's nearest such object.

    ``ephemerides`` may carry visit and detector; then they must agree. Those with an error above ``most_error`` arcseconds are
    joined by themselves, in cells as wide as the largest of them asks for.
    """
    error = F.coalesce(F.col("`Err(arcsec)`"), F.lit(DEFAULT_ERROR))
    on = [c for c in ("visit", "detector") if c in ephemerides.columns]
    lx, ly, lz = unit_vector(F.col("ephRa"), F.col("ephDec"))
    rx, ry, rz = unit_vector(F.col("ra"), F.col("dec"))
    left = ephemerides.select(*on, "ssObjectId", F.radians(error / 3600).alias("_r"), lx.alias("lx"), ly.alias("ly"), lz.alias("lz"))
    right = sources.select(*on, "diaSourceId", rx.alias("rx"), ry.alias("ry"), rz.alias("rz"))
    most, largest = math.radians(most_error / 3600), ephemerides.agg(F.max(error)).first()[0] or 0.0
    pairs = range_join(left.where(F.col("_r") <= most), right, F.col("_r"), most, on=on)
    if largest > most_error:
        pairs = pairs.unionByName(range_join(left.where(F.col("_r") > most), right, F.col("_r"), math.radians(largest / 3600), cell_radii=2.0, on=on))
    first = W.partitionBy(*on, "ssObjectId").orderBy("chord", "diaSourceId")
    second = W.partitionBy("diaSourceId").orderBy("chord", "ssObjectId")
    best = pairs.withColumn("n", F.row_number().over(first)).where("n = 1").withColumn("n", F.row_number().over(second)).where("n = 1")
    return best.select("diaSourceId", "ssObjectId", (F.degrees("chord") * 3600).alias("separation"))


def associate(sources: DataFrame, ephemerides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sources with their ssObjectId, and the others, which go on to the match with objects."""
    found = match(sources, ephemerides).select("diaSourceId", F.col("ssObjectId").alias("_ss"))
    both = sources.join(found, "diaSourceId", "left")
    return both.where(F.col("_ss").isNotNull()).withColumn("ssObjectId", F.col("_ss")).drop("_ss"), both.where(F.col("_ss").isNull()).drop("_ss")


def single_frame(sources: DataFrame, ephemerides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same for the sources of a single image (id, coordinates in radians). No ephemerides is an error."""
    if ephemerides.isEmpty():
        raise ValueError("no solar-system objects in this field")
    named = sources.withColumnsRenamed({"id": "diaSourceId"}).withColumns({"ra": F.degrees("coord_ra"), "dec": F.degrees("coord_dec")})
    return associate(named, ephemerides)


def elements(table: DataFrame) -> DataFrame:
    """Orbital elements under the common prefix: the whole long table where it is one, else the classic elements renamed, else none."""
    if "mpc_orb_jsonb" in table.columns:
        names = {c: c for c in table.columns if c not in ("ObjID", "ssObjectId")}
    elif "q" in table.columns:
        names = {c: to for c, to in CLASSIC_ELEMENTS.items() if c in table.columns}
    else:
        names = {}
    # Dates are not carried; their columns stay, empty.
    kinds = dict(table.dtypes)
    columns = [(F.lit(None).cast("string") if kinds[c] in ("timestamp", "date", "timestamp_ntz") else F.col(c)).alias(f"{ORBIT_PREFIX}{to}") for c, to in names.items()]
    return table.select("ObjID", *columns)


def packed_to_id(designation: Column) -> Column:
    """A packed designation of up to seven ASCII characters as a long: its bytes, the first one highest. A longer one has no id (null); it does not end the job."""
    text = F.rtrim(designation)
    return F.when(F.length(text) <= 7, F.conv(F.hex(text), 16, 10).cast("long"))


def id_to_packed(number: Column) -> Column:
    """The packed designation that an id stands for; none for 0."""
    return F.when(number != 0, F.unhex(F.hex(number.cast("long"))).cast("string"))


def finished(ephemerides: DataFrame) -> DataFrame:
    """Position error and magnitude where the service gave none."""
    magnitude = F.col("trailedSourceMagTrue") if "trailedSourceMagTrue" in ephemerides.columns else F.lit(None)
    error = F.col("`Err(arcsec)`") if "Err(arcsec)" in ephemerides.columns else F.lit(None)
    return ephemerides.withColumns({"Err(arcsec)": F.coalesce(error.cast("double"), F.lit(DEFAULT_ERROR)), "trailedSourceMagTrue": F.coalesce(magnitude.cast("double"), F.lit(float("nan")))})
