"""Stamps of alerts, taken apart by a reader of their own."""

import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from skymatch.functions import fits
from skymatch.functions.geometry import Box, Wcs
from skymatch.operators import stamps
from skymatch.operators.forced import Exposure

IMAGE = "visit bigint, detector int, width int, pixels array<double>, variance array<double>"
STEP, WIDTH, HEIGHT = 1 / 3600, 60, 50
SKY = Wcs((10.0, 30.0), (30.0, 25.0), ((-STEP, 0.0), (0.0, STEP)))


def parse(data):
    """Name, header and pixels of every unit of a file."""
    out, at = [], 0
    assert len(data) % 2880 == 0
    while at < len(data):
        header = {}
        while True:
            line = data[at : at + 80].decode("ascii")
            at += 80
            if line.startswith("END "):
                break
            value = line[10:].split(" /")[0].strip()
            header[line[:8].strip()] = value.strip("'").strip() if value.startswith("'") else {"T": True, "F": False, "": None}.get(value, value)
        at += -at % 2880
        n = int(header["NAXIS1"]) * int(header["NAXIS2"])
        pixels = np.array(struct.unpack(f">{n}d", data[at : at + 8 * n])).reshape(int(header["NAXIS2"]), int(header["NAXIS1"]))
        at += 8 * n
        at += -at % 2880
        out.append((header.get("EXTNAME"), header, pixels))
    return out


def values():
    return [float(1000 * row + column) for row in range(HEIGHT) for column in range(WIDTH)]


def exposure(spark, **more):
    rows = [(1, 2, WIDTH, values(), [4.0] * WIDTH * HEIGHT)]
    image = spark.createDataFrame(rows, IMAGE)
    return Exposure(1, 2, "g", 60000.0, SKY, Box(0, 0, WIDTH - 1, HEIGHT - 1), calibration=2.0, rotation=12.5, difference=image, direct=image.withColumn("pixels", F.transform("pixels", lambda p: p + 0.5)), **more)


def sources(spark, places):
    at = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(places)], "diaSourceId bigint, x double, y double")
    ra, dec = SKY.pixel_to_sky(F.col("x"), F.col("y"))
    return at.select("diaSourceId", ra.alias("ra"), dec.alias("dec"), F.lit(31).alias("bboxSize"))


def test_stamps_of_a_visit(spark):
    places = [(30, 25), (2, 3), (59.4, 49.4), (-5, 20), (30, 80)]
    missing = spark.createDataFrame([(9, None, 1.0, None)], "diaSourceId bigint, ra double, dec double, bboxSize int")
    got = {r.diaSourceId: r for r in stamps.alert_stamps(sources(spark, places).unionByName(missing), exposure(spark)).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 9} and all(r.cutoutTemplate is None for r in got.values())
    assert all(got[i].cutoutDifference is None and got[i].cutoutScience is None for i in (3, 4, 9))
    for i in range(3):
        x, y = places[i]
        for column, offset in (("cutoutDifference", 0.0), ("cutoutScience", 0.5)):
            (_, header, pixels), (err, _, errors), (psf, _, shape) = parse(bytes(got[i][column]))
            assert pixels.shape == (31, 31) and (err, psf) == ("ERR", "PSF") and header["BUNIT"] == "nJy" and float(header["ROTPA"]) == 12.5
            left, low = math.floor(x + 0.5) - 15, math.floor(y + 0.5) - 15
            for row in range(31):
                for column_ in range(31):
                    a, b = left + column_, low + row
                    if 0 <= a < WIDTH and 0 <= b < HEIGHT:
                        assert pixels[row, column_] == 2 * (1000 * b + a + offset) and errors[row, column_] == 4.0
                    else:
                        assert math.isnan(pixels[row, column_]) and math.isnan(errors[row, column_])
            # The header's grid puts the source where it is: its own pixel is the reference.
            assert float(header["CRPIX1"]) == pytest.approx(x - left + 1, abs=1e-6) and float(header["CRPIX2"]) == pytest.approx(y - low + 1, abs=1e-6)
            assert [float(header[k]) for k in ("CD1_1", "CD1_2", "CD2_1", "CD2_2")] == pytest.approx([-STEP, 0, 0, STEP], abs=1e-3 * STEP)
            assert shape.sum() == pytest.approx(1) and shape.shape == (21, 21)


def test_width_of_a_point_and_its_fallback(spark):
    e = exposure(spark)
    grid = [1.0, float("nan"), 3.0, -1.0]  # lower left, lower right, upper left, upper right
    with_grid = e.difference.withColumn("sigmas", F.array(*map(F.lit, grid)))
    places = [(10, 10), (50, 10), (10, 40), (50, 40)]
    at = sources(spark, places)
    e = Exposure(**{**e.__dict__, "difference": with_grid, "direct": None})
    got = {r.diaSourceId: parse(bytes(r.cutoutDifference))[2][2] for r in stamps.alert_stamps(at, e).collect()}
    for i, sigma in enumerate([1.0, 1.5, 3.0, 1.5]):
        assert got[i] == pytest.approx(stamps.profile(sigma, 0.0, 0.0), abs=1e-9)
        assert got[i][10, 10] == pytest.approx(1 / (2 * math.pi * sigma**2), rel=0.02)


def test_cards():
    assert fits.card("A", float("nan")).strip() == b"A       =" and fits.card("B", "it's").startswith(b"B       = 'it''s")
    assert all(len(fits.card(k, v)) == 80 for k, v in (("X", 1), ("Y", -2.7777777777777776e-04), ("Z", None), ("W", True)))
    with pytest.raises(ValueError):
        fits.card("LONG", "x" * 80)
