"""Small images around sources as the alerts carry them: calibrated pixels and errors, the sky's grid there, and the profile of a point.

A task holds one image with some of the sources on it. A source whose centre lies off the image has no stamp; pixels of a stamp that lie off it are NaN.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fits import image_file
from .alerts import cutout_extent
from .forced import Exposure, with_images

#: Pixels to each side of the centre of the profile.
PROFILE_RADIUS = 10


def crop(pixels: np.ndarray, x: float, y: float, extent: int) -> tuple[np.ndarray, int, int] | None:
    """A square of side ``extent`` around the pixel of (x, y), NaN outside the image, and its first column and row; nothing where the centre lies outside."""
    a, b = math.floor(x + 0.5), math.floor(y + 0.5)
    height, width = pixels.shape
    if not (0 <= a < width and 0 <= b < height):
        return None
    out = np.full((extent, extent), np.nan)
    left, low = a - extent // 2, b - extent // 2
    x0, x1, y0, y1 = max(0, left), min(width, left + extent), max(0, low), min(height, low + extent)
    out[y0 - low : y1 - low, x0 - left : x1 - left] = pixels[y0:y1, x0:x1]
    return out, left, low


def profile(sigma: float, x: float, y: float) -> np.ndarray:
    """A Gaussian point of sum one on the pixels around the pixel of (x, y)."""
    side = np.arange(-PROFILE_RADIUS, PROFILE_RADIUS + 1)
    across, up = side + math.floor(x + 0.5) - x, side + math.floor(y + 0.5) - y
    out = np.exp(-(up[:, None] ** 2 + across[None, :] ** 2) / (2 * sigma**2))
    return out / out.sum()


def width_at(grid: np.ndarray | None, x: float, y: float, shape: tuple[int, int], mean: float) -> float:
    """Width of a point at (x, y) from a square grid over the image; the image's mean width where the grid is missing or says nothing of use."""
    if grid is None or not len(grid):
        return mean
    n = math.isqrt(len(grid))
    row, column = (min(n - 1, max(0, int(v / size * n))) for v, size in ((y, shape[0]), (x, shape[1])))
    sigma = float(grid[row * n + column])
    return sigma if math.isfinite(sigma) and sigma > 0 else mean


def stamps(at: DataFrame, images: DataFrame, exposure: Exposure) -> DataFrame:
    """id and stamp: FITS bytes of the calibrated square of side ``extent`` around (x, y), with errors (ERR) and the profile (PSF) there.

    ``at``: visit, detector, id, x, y, extent and ``matrix`` (degrees per pixel there, row by row). ``images``: as for forced fluxes; a column ``sigmas`` (a square grid,
    row by row) may tell the width of a point over the image.
    """
    calibration, mean, box, rotation = exposure.calibration, exposure.psf_sigma, exposure.box, exposure.rotation

    def run(key: tuple, where: pd.DataFrame, image: pd.DataFrame) -> pd.DataFrame:
        out = where[["id"]].assign(stamp=None)
        if not len(image) or not len(where):
            return out
        one = image.iloc[0]
        width = int(one["width"])
        pixels, variance = (np.asarray(one[c], dtype=float).reshape(-1, width) for c in ("pixels", "variance"))
        grid = np.asarray(one["sigmas"], dtype=float) if "sigmas" in image and one["sigmas"] is not None else None
        found: list[bytes | None] = []
        for r in where.itertuples(index=False):
            x, y = r.x - box.min_x, r.y - box.min_y
            cut = crop(pixels, x, y, int(r.extent)) if math.isfinite(x) and math.isfinite(y) else None
            if cut is None:
                found.append(None)
                continue
            square, left, low = cut
            errors = np.sqrt(crop(variance, x, y, int(r.extent))[0])
            a, b, c, d = (float(v) for v in r.matrix)
            header = {
                "CTYPE1": "RA---TAN", "CTYPE2": "DEC--TAN", "CRVAL1": float(r.ra), "CRVAL2": float(r.dec), "CRPIX1": x - left + 1, "CRPIX2": y - low + 1,
                "CD1_1": a, "CD1_2": b, "CD2_1": c, "CD2_2": d, "BUNIT": "nJy", "ROTPA": rotation,
            }
            found.append(image_file(square * calibration, header, err=errors * calibration, psf=profile(width_at(grid, x, y, pixels.shape, mean), x, y)))
        return out.assign(stamp=found)

    return with_images(at, images).applyInPandas(run, "id long, stamp binary")


def alert_stamps(sources: DataFrame, exposure: Exposure) -> DataFrame:
    """diaSourceId, cutoutDifference, cutoutScience and cutoutTemplate of a visit's sources, from those images that the exposure has."""
    x, y = exposure.wcs.sky_to_pixel(F.col("ra"), F.col("dec"))
    size = F.coalesce(F.col("bboxSize").cast("int"), F.lit(0)) if "bboxSize" in sources.columns else F.lit(0)
    at = sources.select(F.lit(exposure.visit).cast("long").alias("visit"), F.lit(exposure.detector).alias("detector"), F.col("diaSourceId").alias("id"), "ra", "dec", x.alias("x"), y.alias("y"), cutout_extent(size).alias("extent"))
    change, across = exposure.wcs.local_matrix(F.col("x"), F.col("y")), F.cos(F.radians("dec"))
    at = at.where("x is not null and y is not null").withColumn("_m", change).withColumn("matrix", F.array(F.col("_m")[0] * across, F.col("_m")[1] * across, F.col("_m")[2], F.col("_m")[3])).drop("_m")
    out = sources.select("diaSourceId")
    for name, images in (("cutoutDifference", exposure.difference), ("cutoutScience", exposure.direct), ("cutoutTemplate", exposure.template)):
        if images is None:
            out = out.withColumn(name, F.lit(None).cast("binary"))
        else:
            out = out.join(stamps(at, images, exposure).select(F.col("id").alias("diaSourceId"), F.col("stamp").alias(name)), "diaSourceId", "left")
    return out
