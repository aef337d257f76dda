"""A visit from its sources to its alerts, held against what the made-up sky says."""

import dataclasses
import math

import pytest
from pyspark.sql import functions as F

from skymatch.functions.geometry import Box, Polygon, Wcs
from skymatch.operators import forced, stats
from skymatch.operators.forced import Exposure
from skymatch.sources import store
from skymatch.sources.schemas import empty
from skymatch.streaming.visits import OUTPUTS, Steps, VisitConfig, VisitInput, process_batch, process_visit

SOURCE = "diaSourceId bigint, visit bigint, detector int, ra double, dec double, psfFlux double, psfFluxErr double, midpointMjdTai double, band string"
IMAGE = "visit bigint, detector int, width int, pixels array<double>, variance array<double>"
STEP = 1 / 3600
SKY = Wcs((10.025, 1.0), (128.0, 128.0), ((-STEP, 0.0), (0.0, STEP)))
SIDE = 256
ALL = VisitConfig(outputs=OUTPUTS)


def rows(visit, shift):
    """Six sources 36 arcseconds apart; the pixel scale is one arcsecond."""
    return [(100 * visit + i, visit, 1, 10.0 + 0.01 * i + shift, 1.0, 5.0 + visit, 1.0, 60000.0 + visit, "g") for i in range(6)]


def exposure(spark, visit, **more):
    flat = lambda v: spark.createDataFrame([(visit, 1, SIDE, [v] * SIDE * SIDE, [1.0] * SIDE * SIDE)], IMAGE)
    return Exposure(visit, 1, "g", 60000.0 + visit, SKY, Box(0, 0, SIDE - 1, SIDE - 1), calibration=2.0, shutter_close=0.0, difference=flat(0.0), direct=flat(1.0), **more)


def solar(spark):
    return spark.createDataFrame([(2, 1, 77, 10.05 + 1e-5, 1.0, "2015 MK4", 1.5), (3, 1, 78, 10.0, 1.0, "none", 1.0), (2, 1, 79, 50.0, 1.0, "far", 1.0)], "visit bigint, detector int, ssObjectId bigint, ephRa double, ephDec double, MPCORB_designation string, MPCORB_q double")


def two_visits(spark, tmp_path, config=ALL):
    catalog = store.Catalog(spark, str(tmp_path / "c"))
    sources = spark.createDataFrame(rows(1, 0.0) + rows(2, 1e-5), SOURCE)
    given = lambda visit, detector: VisitInput(exposure(spark, visit), solar(spark))
    return catalog, process_batch(catalog, sources, config, given=given, outputs=str(tmp_path / "out"))


def test_whole_visit(spark, tmp_path):
    catalog, (one, two) = two_visits(spark, tmp_path)
    names = ("numNewDiaObjects", "numUpdatedDiaObjects", "numUnassociatedDiaObjects", "numTotalSolarSystemObjects", "numAssociatedSsObjects", "numAlerts")
    assert [one.counts[n] for n in names] == [6, 0, 0, 0, 0, 6]
    assert [two.counts[n] for n in names] == [0, 5, 1, 1, 1, 6]  # source 205 is the solar-system object, so object 105 was not seen
    assert two.counts["secondsSinceShutterClose"] > 0
    assert {"objects", "history", "labelled", "associatedSources", "updatedObjects", "forcedSources", "alerts", "catalog"} <= set(two.steps) and 0 < sum(two.steps.values()) < two.counts["seconds"]

    objects = {r.diaObjectId: r for r in store.latest_objects(catalog.read("diaObject")).collect()}
    assert {i: r.nDiaSources for i, r in objects.items()} == {100 + i: 2 if i < 5 else 1 for i in range(6)}
    assert objects[100].validityStartMjdTai == 60002.0 and objects[105].validityStartMjdTai == 60001.0

    measured = catalog.read("diaForcedSource").collect()
    assert sorted(r.diaObjectId for r in measured) == [100, 101, 102, 103, 104]  # only they have two sources
    assert len({r.diaForcedSourceId for r in measured}) == 5 and {(r.visit, r.detector, r.band, r.midpointMjdTai) for r in measured} == {(2, 1, "g", 60002.0)}
    sigma = 1.5
    # A flat image of ones: sum of the profile over sum of its square, times the calibration.
    assert all(r.psfFlux == 0 and r.scienceFlux == pytest.approx(2 * 4 * math.pi * sigma**2, rel=1e-3) for r in measured)
    assert all(r.ra == pytest.approx(10.0 + 0.01 * (r.diaObjectId - 100) + 5e-6, abs=1e-9) for r in measured)

    alerts = {r.diaSourceId: r for r in spark.read.parquet(str(tmp_path / "out" / "alerts" / "run=2_1")).collect()}
    assert sorted(alerts) == [200 + i for i in range(6)]
    assert all([h.diaSourceId for h in alerts[200 + i].prvDiaSources] == [100 + i] and len(alerts[200 + i].prvDiaForcedSources) == 1 for i in range(5))
    assert alerts[200].diaObject.validityStartMjdTai == 60002.0
    # The sources lie 36 pixels apart on an image of 256: stamps of all of them, of the two images that there are.
    assert all(len(a.cutoutDifference) % 2880 == 0 and len(a.cutoutScience) % 2880 == 0 and a.cutoutTemplate is None for a in alerts.values())
    assert alerts[205].diaObject is None and alerts[205].ssSource.ssObjectId == 77 and alerts[205].MPCORB.q == 1.5


def test_without_outputs(spark, tmp_path):
    catalog, (one, two) = two_visits(spark, tmp_path, VisitConfig())
    assert one.counts["numAlerts"] == two.counts["numAlerts"] == two.counts["secondsSinceShutterClose"] == -1
    assert two.counts["numUpdatedDiaObjects"] == 5 and not (tmp_path / "out").exists()
    with pytest.raises(ValueError, match="no outputs"):
        process_batch(store.Catalog(spark, str(tmp_path / "d")), spark.createDataFrame(rows(1, 0.0), SOURCE), VisitConfig(outputs=("x",)), outputs="x")


def test_what_is_there_before_an_error_stays(spark, tmp_path):
    def broken(*_, **__):
        raise ZeroDivisionError("broken")

    catalog, out = store.Catalog(spark, str(tmp_path / "c")), str(tmp_path / "out")
    sources = spark.createDataFrame(rows(1, 0.0), SOURCE)
    with pytest.raises(ZeroDivisionError):
        process_visit(catalog, sources, 1, 1, dataclasses.replace(ALL, steps=Steps(summarize=broken)), outputs=out)
    assert spark.read.parquet(f"{out}/associatedSources/run=1_1").count() == 6 and catalog.status(1, 1) is None
    with pytest.raises(store.AfterWriteError):
        process_visit(catalog, sources, 1, 1, dataclasses.replace(ALL, steps=Steps(package=broken)), outputs=out)
    assert catalog.status(1, 1) == store.WRITTEN and spark.read.parquet(f"{out}/updatedObjects/run=1_1").count() == 6
    with pytest.raises(store.AfterWriteError):
        process_visit(catalog, sources, 1, 1, ALL, outputs=out)


def test_steps_are_exchanged(spark, tmp_path):
    catalog = store.Catalog(spark, str(tmp_path / "c"))
    calls = []

    def summarize(*args):
        calls.append("summarize")
        return stats.summarize(*args)

    def measure(objects, *args):
        calls.append("measure")
        return forced.measure(objects, *args)

    config = VisitConfig(steps=Steps(summarize=summarize, measure=measure))
    process_visit(catalog, spark.createDataFrame(rows(1, 0.0), SOURCE), 1, 1, config, given=VisitInput(exposure(spark, 1)))
    assert calls == ["summarize", "measure"] and catalog.read("diaForcedSource").count() == 0


def test_preloaded_objects_are_refreshed(spark, tmp_path):
    catalog = store.Catalog(spark, str(tmp_path / "c"))
    sources = spark.createDataFrame(rows(1, 0.0) + rows(2, 1e-5), SOURCE)
    early = catalog.load(SKY.corners(Box(0, 0, SIDE - 1, SIDE - 1)), 60002.0)  # before the first visit wrote its objects
    process_visit(catalog, sources, 1, 1)
    got = process_visit(catalog, sources, 2, 1, given=VisitInput(exposure(spark, 2), preloaded=early))
    assert got.counts["numUpdatedDiaObjects"] == 6 and got.counts["numNewDiaObjects"] == 0


def test_refresh_that_fails_keeps_the_preloaded(spark, tmp_path):
    catalog, said = store.Catalog(spark, str(tmp_path / "c")), []
    objects = spark.createDataFrame([(1, 10.0, 1.0)], "diaObjectId bigint, ra double, dec double")
    catalog.write(1, 1, 60000.0, objects, empty(spark, "diaSource"), empty(spark, "diaForcedSource"))
    for file in (tmp_path / "c" / "diaObject").rglob("*.parquet"):
        file.write_text("no table")
    region = Polygon.of_degrees([(9, 0), (11, 0), (11, 2), (9, 2)])
    assert catalog.refreshed(objects, region, said.append).collect() == objects.collect() and len(said) == 1


def test_export(spark, tmp_path):
    catalog = store.Catalog(spark, str(tmp_path / "c"))
    process_batch(catalog, spark.createDataFrame(rows(1, 0.0) + rows(2, 1e-5), SOURCE))
    region = Polygon.of_degrees([(9.995, 0.9), (10.025, 0.9), (10.025, 1.1), (9.995, 1.1)])
    for _ in range(2):  # the second export replaces the first
        catalog.export(region, str(tmp_path / "e"), 60002.5, tract=4, patch=7)
    read = lambda t: spark.read.parquet(str(tmp_path / "e" / t)).where("tract = 4 and patch = 7")
    assert sorted(r.diaObjectId for r in read("diaObject").collect()) == [100, 101, 102]
    assert sorted(r.diaSourceId for r in read("diaSource").collect()) == [100, 101, 102, 200, 201, 202]


def test_visits_that_cannot_be_used_stop_before_any_write(spark, tmp_path):
    catalog = store.Catalog(spark, str(tmp_path / "c"))
    sources = spark.createDataFrame(rows(1, 0.0), SOURCE)
    bad = dataclasses.replace(exposure(spark, 1), band="", calibration=0.0, psf_sigma=float("nan"))
    with pytest.raises(ValueError, match="no photometric calibration, no band, no point spread function"):
        process_visit(catalog, sources, 1, 1, given=VisitInput(bad))
    with pytest.raises(ValueError, match="bands"):
        process_visit(catalog, sources.withColumn("band", F.lit("x")), 1, 1)
    assert catalog.status(1, 1) is None and catalog.state().version == 0


def test_a_visit_stores_all_statistics(spark, tmp_path):
    catalog = store.Catalog(spark, str(tmp_path / "c"))
    process_batch(catalog, spark.createDataFrame(rows(1, 0.0) + rows(2, 1e-5), SOURCE), VisitConfig(drop_empty=True))
    got = store.latest_objects(catalog.read("diaObject")).where("diaObjectId = 100").first()
    assert (got.g_psfFluxMean, got.g_psfFluxMin, got.g_psfFluxMax, got.g_psfFluxMaxSlope, got.g_psfFluxErrMean, got.g_psfFluxNdata) == pytest.approx((6.5, 6.0, 7.0, 1.0, 1.0, 2))
    assert got.g_psfFluxSigma == pytest.approx(0.5**0.5) and got.g_scienceFluxMean is None and got.r_psfFluxMean is None


def test_forced_ids_of_long_visit_numbers(spark):
    df = spark.createDataFrame([(2025010100123, d, i) for d in (7, 1007) for i in range(50)], "visit bigint, detector int, id bigint")
    ids = [r[0] for r in df.select(forced.forced_id(F.col("visit"), F.col("detector"), F.col("id"))).collect()]
    assert len(set(ids)) == 100 and min(ids) >= 0


def test_local_matrix(spark):
    got = spark.range(1).select(SKY.local_matrix(F.lit(128.0), F.lit(128.0))).first()[0]
    assert got == pytest.approx([-STEP / math.cos(math.radians(1.0)), 0.0, 0.0, STEP], abs=1e-9)
