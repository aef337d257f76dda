"""Forced photometry at the positions of objects, and the table of its results."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from ..functions.geometry import Box, Wcs
from ..sources.schemas import conform, empty_forced

DROPPED = ("coord_ra", "coord_dec")
#: Positions of one image that a task holds at once, on average.
IMAGE_ROWS = 500


@dataclass(frozen=True)
class Exposure:
    """What a visit and detector tells of its image. ``difference``, ``direct`` and ``template`` hold its pixels as :func:`psf_fluxes` takes them; without the first two nothing is measured, and alerts carry stamps of those that are there."""

    visit: int
    detector: int
    band: str
    midpoint_mjd: float
    wcs: Wcs
    box: Box
    calibration: float = 1.0
    calibration_err: float = 0.0
    psf_sigma: float = 1.5
    shutter_close: float | None = None
    rotation: float | None = None
    difference: DataFrame | None = None
    direct: DataFrame | None = None
    template: DataFrame | None = None

    def faults(self) -> list[str]:
        """Everything that it lacks to be used."""
        finite = lambda v: v is not None and math.isfinite(v)
        found = {
            "no photometric calibration": not finite(self.calibration) or self.calibration <= 0 or not finite(self.calibration_err),
            "no world coordinates": self.wcs is None,
            "no band": not self.band,
            "no bounding box": self.box is None,
            "no point spread function": not finite(self.psf_sigma) or self.psf_sigma <= 0,
            "no date": not finite(self.midpoint_mjd),
        }
        return [what for what, lacking in found.items() if lacking]


def with_history(objects: DataFrame, threshold: int = 2) -> DataFrame:
    """Objects with enough sources; an unknown count is not enough."""
    return objects.where(F.col("nDiaSources") >= threshold)


def with_images(positions: DataFrame, images: DataFrame, most: int = IMAGE_ROWS) -> PandasCogroupedOps:
    """Positions and their image side by side, in parts of about ``most`` positions of a visit and detector, each with a copy of the image: a crowded image is no large task."""
    counts = positions.groupBy("visit", "detector").agg(F.ceil(F.count("*") / most).alias("_parts")).select(F.col("visit").alias("_v"), F.col("detector").alias("_d"), "_parts")
    same = F.col("visit").eqNullSafe(F.col("_v")) & F.col("detector").eqNullSafe(F.col("_d"))
    dealt = positions.join(F.broadcast(counts), same).drop("_v", "_d").withColumn("_part", F.pmod(F.xxhash64("id"), "_parts"))
    copies = images.join(F.broadcast(counts), same).drop("_v", "_d").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    keys = ["visit", "detector", "_part"]
    ours, theirs = (df.select(*[F.col(c).alias(c) for c in df.columns if c != "_parts"]) for df in (dealt, copies))
    return ours.groupBy(*keys).cogroup(theirs.groupBy(*keys))


def psf_fluxes(positions: DataFrame, images: DataFrame, sigma: float, radius: int = 12) -> DataFrame:
    """Flux and error of a Gaussian of width ``sigma`` at (x, y) on an image, by weighted sums over its pixels.

    ``positions``: visit, detector, id, x, y. ``images``: visit, detector, width, pixels and variance (row-wise arrays). A task
    holds one image with a part of its positions. Positions whose pixels lie outside have null results.
    """

    def run(key: tuple, where: pd.DataFrame, image: pd.DataFrame) -> pd.DataFrame:
        out = where[["visit", "detector", "id"]].assign(flux=np.nan, fluxErr=np.nan)
        if not len(image) or not len(where):
            return out
        width = int(image["width"].iloc[0])
        pixels, variance = (np.asarray(image[c].iloc[0], dtype=float).reshape(-1, width) for c in ("pixels", "variance"))
        rows, cols = np.mgrid[: pixels.shape[0], :width]
        for i, (x, y) in enumerate(where[["x", "y"]].itertuples(index=False)):
            a, b = int(round(x)), int(round(y))
            if not (0 <= a < width and 0 <= b < pixels.shape[0]):
                continue
            cut = np.s_[max(0, b - radius) : b + radius + 1, max(0, a - radius) : a + radius + 1]
            psf = np.exp(-((cols[cut] - x) ** 2 + (rows[cut] - y) ** 2) / (2 * sigma**2))
            psf /= 2 * np.pi * sigma**2
            norm = float((psf**2).sum())
            out.loc[out.index[i], ["flux", "fluxErr"]] = [float((psf * pixels[cut]).sum()) / norm, float(np.sqrt((psf**2 * variance[cut]).sum())) / norm]
        return out

    return with_images(positions, images).applyInPandas(run, "visit long, detector int, id long, flux double, fluxErr double")


def calibrated(flux: str, err: str, calib: float, calib_err: float = 0.0) -> tuple[Column, Column]:
    f, e = F.col(flux), F.col(err)
    return f * calib, F.sqrt(F.pow(e * calib, 2) + F.pow(f * calib_err, 2))


def merge_measurements(difference: DataFrame, direct: DataFrame, exposure: dict, processed_mjd: float) -> DataFrame:
    """Standard forced sources from the measurements on the difference image and on the direct image, joined by object."""
    calib, calib_err = exposure.get("calibration", 1.0), exposure.get("calibration_err", 0.0)
    science, science_err = calibrated("flux", "fluxErr", calib, calib_err)
    on_direct = direct.select("diaObjectId", science.alias("scienceFlux"), science_err.alias("scienceFluxErr"))
    flux, err = calibrated("flux", "fluxErr", calib, calib_err)
    joined = difference.withColumns({"psfFlux": flux, "psfFluxErr": err, "ra": F.degrees("coord_ra"), "dec": F.degrees("coord_dec")}).join(on_direct, "diaObjectId").drop(*DROPPED)
    constant = {"visit": exposure["visit"], "detector": exposure["detector"], "band": exposure["band"], "midpointMjdTai": exposure["midpointMjdTai"], "timeProcessedMjdTai": processed_mjd}
    return conform(joined.withColumns({k: F.lit(v) for k, v in constant.items()}), "diaForcedSource")


def trim(forced: DataFrame, updated_ids: DataFrame, wcs: Wcs, box: Box) -> DataFrame:
    """Forced sources inside the image, or of objects that this visit updated."""
    x, y = wcs.sky_to_pixel(F.col("ra"), F.col("dec"))
    marked = forced.join(updated_ids.select("diaObjectId").distinct().withColumn("_u", F.lit(True)), "diaObjectId", "left")
    # The cheap test first: pixels are worked out for the other objects alone.
    return marked.where(F.col("_u").isNotNull() | F.coalesce(box.contains(x, y), F.lit(False))).drop("_u")


def forced_id(visit: Column, detector: Column, object_id: Column) -> Column:
    """A positive id from visit, detector and object, whatever their size: the same whenever it is worked out. Ids are told apart within an object, the key
    of the table, where 63 bits never meet in practice."""
    return F.xxhash64(visit.cast("long"), detector.cast("long"), object_id.cast("long")).bitwiseAND(F.lit((1 << 63) - 1))


def measure(objects: DataFrame, updated_ids: DataFrame, exposure: Exposure, processed_mjd: float, threshold: int = 2) -> DataFrame:
    """Standard forced sources of all objects with enough history, on both images of an exposure, trimmed to the image and the updated objects."""
    if exposure.difference is None or exposure.direct is None:
        return conform(empty_forced(objects.sparkSession), "diaForcedSource")
    x, y = exposure.wcs.sky_to_pixel(F.col("ra"), F.col("dec"))
    at = with_history(objects, threshold).select(F.lit(exposure.visit).cast("long").alias("visit"), F.lit(exposure.detector).alias("detector"), F.col("diaObjectId").alias("id"), "ra", "dec", x.alias("x"), y.alias("y"))
    at = at.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    own = ["visit", "detector", "id", "x", "y"]
    difference, direct = (psf_fluxes(at.select(own), images, exposure.psf_sigma) for images in (exposure.difference, exposure.direct))
    named = at.select("id", forced_id(F.col("visit"), F.col("detector"), F.col("id")).alias("diaForcedSourceId"), F.radians("ra").alias("coord_ra"), F.radians("dec").alias("coord_dec"))
    placed = difference.join(named, "id").withColumnRenamed("id", "diaObjectId").drop("visit", "detector")
    about = {"visit": exposure.visit, "detector": exposure.detector, "band": exposure.band, "midpointMjdTai": exposure.midpoint_mjd, "calibration": exposure.calibration, "calibration_err": exposure.calibration_err}
    merged = merge_measurements(placed, direct.withColumnRenamed("id", "diaObjectId"), about, processed_mjd)
    return trim(merged, updated_ids, exposure.wcs, exposure.box)


def load_or_empty(objects: DataFrame, forced: DataFrame | None) -> DataFrame:
    """Forced sources of the given objects, the two-column empty table where none are wanted."""
    if forced is None:
        return empty_forced(objects.sparkSession)
    return forced.join(objects.select("diaObjectId"), "diaObjectId", "left_semi")


def cutouts(extents: DataFrame, images: DataFrame) -> DataFrame:
    """visit, detector, id and a square of pixels (row-wise, null outside the image) of side ``extent`` around (x, y); null where the centre lies outside."""

    def run(key: tuple, where: pd.DataFrame, image: pd.DataFrame) -> pd.DataFrame:
        out = where[["visit", "detector", "id"]].assign(pixels=None)
        if not len(image):
            return out
        width = int(image["width"].iloc[0])
        pixels = np.asarray(image["pixels"].iloc[0], dtype=float).reshape(-1, width)
        cells = []
        for x, y, extent in where[["x", "y", "extent"]].itertuples(index=False):
            a, b, n = int(round(x)), int(round(y)), int(extent)
            if not (0 <= a < width and 0 <= b < pixels.shape[0]):
                cells.append(None)
                continue
            square = np.full((n, n), np.nan)
            left, low = a - n // 2, b - n // 2
            x0, x1, y0, y1 = max(0, left), min(width, left + n), max(0, low), min(pixels.shape[0], low + n)
            square[y0 - low : y1 - low, x0 - left : x1 - left] = pixels[y0:y1, x0:x1]
            cells.append(square.ravel().tolist())
        return out.assign(pixels=cells)

    return with_images(extents, images).applyInPandas(run, "visit long, detector int, id long, pixels array<double>")


