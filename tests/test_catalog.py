"""Filters, lifecycle, alerts, store and stream on small literal tables."""

import math

import pytest
from pyspark.sql import functions as F

from skymatch.functions import flags, geometry, nullsafe
from skymatch.operators import alerts, detections, filters, forced, lifecycle, metrics, solarsystem, stats
from skymatch.sources import store
from skymatch.sources.schemas import conform, empty
from skymatch.streaming.visits import VisitConfig, process_batch, run_stream

NAN = float("nan")


def test_null_rules(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (NAN, 1.0), (None, 1.0), (6.0, 3.0)], "a double, b double")
    got = [str(r[0]) for r in df.select(nullsafe.ieee_div(F.col("a"), F.col("b"))).collect()]
    assert got == ["inf", "-inf", "nan", "nan", "None", "2.0"]
    assert [r[0] for r in df.select(nullsafe.ge(F.col("a"), 0.5)).collect()] == [True, False, False, False, False, True]


def test_flags():
    packed = flags.PackedFlags({"flags": {"base_PixelFlags_flag": 0, "base_PixelFlags_flag_offimage": 2}})
    assert [packed.mask(n) for n in (["base_PixelFlags_flag"], ["base_PixelFlags_flag_offimage"], ["base_PixelFlags_flag", "base_PixelFlags_flag_offimage"])] == [1, 4, 5]
    assert packed.exists("base_PixelFlags_flag") and not packed.exists("other")
    with pytest.raises(ValueError):
        packed.mask(["other"])
    with pytest.raises(ValueError):
        packed.exists("x", "no column")
    assert flags.renamed("base_PixelFlags_flag_crCenter") == "pixelFlags_crCenter" and flags.renamed("slot_Shape_flag") == "shape_flag"


def test_three_way(spark):
    rows = [(i, i < 5, 5 <= i < 11, -100.0 if i in (11, 12) else 10.0, 3.0, 80.0 if 13 <= i < 17 else 1.0) for i in range(32)]
    df = spark.createDataFrame(rows, "id int, sky_source boolean, base_PixelFlags_flag_crCenter boolean, ip_diffim_forced_PsfFlux_instFlux double, ip_diffim_forced_PsfFlux_instFluxErr double, ext_trailedSources_Naive_length double")
    df = df.withColumns({f"ext_trailedSources_Naive_flag_{n}": F.lit(False) for n in ("off_image", "suspect_long_trail", "edge")} | {"base_PixelFlags_flag_high_varianceCenterAll": F.lit(None).cast("boolean")})
    t = filters.three_way(df, filters.FilterConfig(remove_sky=True))
    assert (t.kept.count(), t.rejected.count(), t.long_trailed.count()) == (15, 13, 4)
    assert {r.reason: r.n for r in filters.attribution(df, filters.FilterConfig(remove_sky=True)).collect()} == {"sky": 5, "flags": 6, "snr": 2, "trail": 4}


def test_sources_of_unknown_visits_stay(spark):
    rows = [(i, None if i % 3 == 0 else 1, None if i % 5 == 0 else 2, 80.0 if i % 2 else 1.0, float(i * 10), 0.0, math.radians(i * 10 * 0.2 / 3600), 0.0) for i in range(30)]
    df = spark.createDataFrame(rows, "id bigint, visit bigint, detector int, ext_trailedSources_Naive_length double, x double, y double, coord_ra double, coord_dec double")
    df = df.withColumns({f"ext_trailedSources_Naive_flag_{n}": F.lit(False) for n in ("off_image", "suspect_long_trail", "edge")})
    t = filters.three_way(df, filters.FilterConfig(bad_flags=(), remove_negative=False))
    assert sorted(r.id for r in t.kept.collect()) == list(range(0, 30, 2)) and sorted(r.id for r in t.long_trailed.collect()) == list(range(1, 30, 2))


def test_sources_without_an_exposure_stay_or_are_an_error(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 9, 1), (3, None, 1)], "id bigint, visit bigint, detector int")
    e = spark.createDataFrame([(1, 1, "g", 60000.5)], "visit bigint, detector int, band string, midpointMjdTai double")
    got = {r.id: (r.band, r.midpointMjdTai) for r in detections.enriched(df, e, 60001.0).collect()}
    assert got == {1: ("g", 60000.5), 2: (None, None), 3: (None, None)}
    with pytest.raises(Exception, match="no exposure of visit 9 detector 1"):
        detections.enriched(df.where("id < 3"), e, 60001.0, require_exposure=True).collect()


def test_reliability_and_quality(spark):
    s = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    scored = filters.with_reliability(s, spark.createDataFrame([(1, 0.2, "v"), (2, NAN, "v"), (3, 0.9, "v")], "id bigint, score double, version string"))
    kept, low = filters.reliability_split(scored, 0.5)
    assert sorted(r.id for r in kept.collect()) == [2, 3] and [r.id for r in low.collect()] == [1]
    with pytest.raises(ValueError):
        filters.with_reliability(s, spark.createDataFrame([(1, 0.2, "v")], "id bigint, score double, version string"))


@pytest.mark.parametrize("most,fails", [(0, False), (99, True), (100, True), (101, False)])
def test_new_object_guard(spark, most, fails):
    df = spark.range(101)
    if fails:
        with pytest.raises(RuntimeError):
            lifecycle.too_many_new(df, most)
    else:
        lifecycle.too_many_new(df, most)


def test_good_objects(spark):
    o = spark.createDataFrame([(1,), (2,)], "diaObjectId bigint")
    h = spark.createDataFrame([(1, 0.9, 1.0, None), (1, 0.9, 1.0, None), (2, 0.9, 1.0, False), (2, 0.5, 1.4, False)], "diaObjectId bigint, reliability double, trailLength double, glint_trail boolean")
    assert [r[0] for r in filters.good_objects(o, h).collect()] == [2]
    assert sorted(r[0] for r in filters.good_objects(o, h.drop("glint_trail")).collect()) == [1, 2]
    with pytest.raises(RuntimeError):
        filters.good_objects(o, h.drop("reliability"))


def test_firsts_differ_on_nulls(spark):
    df = spark.createDataFrame([(1, 1, None, "a"), (1, 2, 5, "b")], "k int, o int, x int, y string")
    assert [tuple(r) for r in lifecycle.first_values(df, ["k"], ["o"]).collect()] == [(1, 1, 5, "a")]
    assert [tuple(r) for r in lifecycle.first_rows(df, ["k"], ["o"]).collect()] == [(1, 1, None, "a")]
    with pytest.raises(RuntimeError):
        lifecycle.require_unique(df.withColumnRenamed("k", "diaObjectId"), "diaObject")


def test_counts_and_statistics(spark):
    rows = [(i, i % 20, "gri"[i % 3], 10.0 + i % 7, 1.0 + i % 2, float(i), 10.0, 1.0, 0.1 * i, 1.0) for i in range(205)]
    s = spark.createDataFrame(rows, "diaSourceId bigint, diaObjectId bigint, band string, psfFlux double, psfFluxErr double, midpointMjdTai double, scienceFlux double, scienceFluxErr double, ra double, dec double")
    o = spark.range(21).withColumnRenamed("id", "diaObjectId")
    n = {r.diaObjectId: r.nDiaSources for r in lifecycle.count_sources(o, s).collect()}
    assert n == {i: 11 if i < 5 else 10 for i in range(20)} | {20: None}
    row = stats.band_statistics(s).where("diaObjectId = 0").first()
    assert all(math.isfinite(row[f"{b}_psfFluxMean"]) for b in "gri") and all(row[f"{b}_psfFluxMean"] is None for b in "uzy")
    full = stats.summarize(o.withColumn("nDiaSources", F.lit(0)), s, spark.range(3).withColumnRenamed("id", "diaObjectId"))
    assert {r.diaObjectId: r.nDiaSources for r in full.collect()} == {i: 11 if i < 3 else 0 for i in range(21)}
    with pytest.raises(ValueError):
        stats.band_statistics(s, ["unknown"])


def test_wcs_round_trip(spark):
    for kind in ("TAN", "SIN"):
        w = geometry.Wcs((215.604, 53.1595), (1110.0, 560.0), ((5.1e-05, 1.86e-07), (-8.3e-07, -5.1e-05)), kind)
        df = spark.createDataFrame([(0.0, 0.0), (1152.0, 1023.0), (300.5, 700.25)], "x double, y double")
        ra, dec = w.pixel_to_sky(F.col("x"), F.col("y"))
        x, y = w.sky_to_pixel(F.col("ra"), F.col("dec"))
        for r in df.withColumns({"ra": ra, "dec": dec}).select("x", "y", x.alias("a"), y.alias("b")).collect():
            assert (r.a, r.b) == pytest.approx((r.x, r.y), abs=1e-6)
        region = w.corners(geometry.Box(0, 0, 1152, 1023))
        inside = df.withColumns({"ra": ra, "dec": dec}).where(region.padded(20).contains(F.col("ra"), F.col("dec"))).count()
        assert inside == 3 and len(region.corners) == 4


def test_chebyshev_and_positions(spark):
    root = math.sqrt(2)
    e = spark.createDataFrame([(-1.0, 1.0, [0.0], [0.0], [0.0], [1.0], [1.0], [root])], "tmin double, tmax double, obs_x_poly array<double>, obs_y_poly array<double>, obs_z_poly array<double>, obj_x_poly array<double>, obj_y_poly array<double>, obj_z_poly array<double>")
    r = solarsystem.positions(e, F.lit(0.0)).first()
    assert (r.ephRa, r.ephDec) == pytest.approx((45.0, 45.0))
    c = spark.range(1).select(solarsystem.chebyshev(F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)), F.lit(0.5)), solarsystem.chebyshev(F.array().cast("array<double>"), F.lit(0.5)), solarsystem.chebyshev(F.array(F.lit(4.0)), F.lit(0.5))).first()
    assert tuple(c) == pytest.approx((1 + 1 + 3 * (2 * 0.25 - 1), 0.0, 4.0))


def test_designations(spark):
    df = spark.createDataFrame([("K15MK4Q",), ("00001",), ("2015 MK4",)], "d string").withColumn("i", solarsystem.packed_to_id(F.col("d")))
    assert df.where("i is null").first().d == "2015 MK4"
    df = df.where("i is not null")
    got = df.select("d", "i", solarsystem.id_to_packed(F.col("i")).alias("back")).collect()
    assert got[0].i == 21164728253101137 and all(r.back == r.d for r in got)


def test_solar_association(spark):
    e = spark.createDataFrame([(1, 45.0, 45.0, 1.0), (2, 46.0, 45.0, 1.0)], "ssObjectId bigint, ephRa double, ephDec double, `Err(arcsec)` double")
    s = spark.createDataFrame([(10, 45.0, 45.0 + 0.5 / 3600), (11, 45.0, 45.0 + 0.8 / 3600), (12, 46.0, 45.1)], "diaSourceId bigint, ra double, dec double").withColumn("ssObjectId", F.lit(0).cast("long"))
    found, rest = solarsystem.associate(s, e)
    assert [(r.diaSourceId, r.ssObjectId) for r in found.collect()] == [(10, 1)] and sorted(r.diaSourceId for r in rest.collect()) == [11, 12]
    w = geometry.Wcs((45.0, 45.0), (100.0, 100.0), ((-1e-4, 0.0), (0.0, 1e-4)))
    assert [r.ssObjectId for r in solarsystem.on_image(e, w, geometry.Box(0, 0, 200, 200)).collect()] == [1]
    assert [r.ssObjectId for r in solarsystem.in_field(e, 45.0, 45.0, 0.1).collect()] == [1]
    with pytest.raises(ValueError):
        solarsystem.single_frame(s, e.limit(0))


def test_midpoint(spark):
    df = spark.createDataFrame([(1.0, 3.0)], "a double, b double")
    assert df.select(detections.midpoint(F.col("a"), F.col("b"))).first()[0] == 2.0
    assert df.select(detections.midpoint(F.col("a"), F.lit(None).cast("double"), True)).first()[0] == 1.0
    with pytest.raises(Exception, match="unbounded"):
        df.select(detections.midpoint(F.col("a"), F.lit(None).cast("double"))).collect()


def test_transform(spark):
    raw = spark.createDataFrame([(1, 5, 2, False, 0.1, 0.2, 10.0, 20.0, 4.0, 1.0, True)], "id bigint, visit bigint, detector int, sky_source boolean, coord_ra double, coord_dec double, slot_Centroid_x double, slot_Centroid_y double, slot_PsfFlux_instFlux double, slot_PsfFlux_instFluxErr double, slot_Centroid_flag boolean")
    raw = raw.withColumns({"footprint": F.expr("named_struct('minX', 1, 'minY', 12, 'maxX', 18, 'maxY', 28, 'peaks', array(named_struct('significance', 397.5D)))"), "base_LocalPhotoCalib": F.lit(2.0), "base_LocalPhotoCalibErr": F.lit(0.0)})
    e = spark.createDataFrame([(5, 2, "g", 60000.5)], "visit bigint, detector int, band string, midpointMjdTai double")
    r = detections.transform(raw, e, 60001.0, detections.TransformConfig(flag_names=("slot_Centroid_flag",))).first()
    assert (r.diaSourceId, r.bboxSize, r.snr, r.psfFlux, r.psfFluxErr, r.band, r.diaObjectId, r.centroid_flag) == (1, 18, 397.5, 8.0, 2.0, "g", 0, True)
    assert r.ra == pytest.approx(math.degrees(0.1)) and r.midpointMjdTai == 60000.5 and r.apFlux is None
    packed = detections.transform(raw, e, 60001.0, detections.TransformConfig(flag_names=("slot_Centroid_flag",), pack_flags=True)).first()
    assert packed.flags == 1 << 12
    with pytest.raises(KeyError):
        detections.transform(raw, e, 60001.0, detections.TransformConfig(flag_names=("missing",)))


def test_forced_photometry_and_cutouts(spark):
    width = 41
    psf = [math.exp(-((i % width - 20) ** 2 + (i // width - 20) ** 2) / 8) / (8 * math.pi) * 500 for i in range(width * width)]
    images = spark.createDataFrame([(1, 2, width, psf, [1.0] * width * width)], "visit bigint, detector int, width int, pixels array<double>, variance array<double>")
    at = spark.createDataFrame([(1, 2, 7, 20.0, 20.0), (1, 2, 8, 99.0, 20.0)], "visit bigint, detector int, id bigint, x double, y double")
    r = {x.id: x for x in forced.psf_fluxes(at, images, 2.0).collect()}
    assert r[7].flux == pytest.approx(500, rel=1e-3) and r[7].fluxErr > 0 and not (r[8].flux and math.isfinite(r[8].flux))
    c = {x.id: x.pixels for x in forced.cutouts(at.withColumn("extent", F.lit(30)), images).collect()}
    assert len(c[7]) == 900 and c[8] is None


def test_alert_round_trip(spark):
    src = spark.createDataFrame([(1, 10, 3, 1, 5.0, 1.5, "g"), (2, 0, 3, 1, 5.0, None, None)], "diaSourceId bigint, diaObjectId bigint, visit bigint, detector int, midpointMjdTai double, psfFlux float, band string")
    hist = spark.createDataFrame([(0, 10, 2, 1, 4.0, 1.0, "g")], src.schema)
    obj = spark.createDataFrame([(10, 2)], "diaObjectId bigint, nDiaSources bigint")
    fsc = spark.createDataFrame([(5, 10, 4.0)], "diaForcedSourceId bigint, diaObjectId bigint, midpointMjdTai double")
    solar = spark.createDataFrame([(2, 77, "2015 MK4", 1.5)], "diaSourceId bigint, ssObjectId bigint, MPCORB_unpacked_primary_provisional_designation string, MPCORB_q double")
    a = alerts.assemble(src, obj, hist, fsc, solar, observation=("", "field"))
    assert len(a.columns) == 13
    one, two = a.orderBy("diaSourceId").collect()
    assert [h.diaSourceId for h in one.prvDiaSources] == [0] and len(one.prvDiaForcedSources) == 1 and one.diaObject.nDiaSources == 2 and one.ssSource is None
    assert two.diaObject is None and two.prvDiaSources is None and two.prvDiaForcedSources == [] and two.ssSource.ssObjectId == 77 and two.MPCORB.packed_primary_provisional_designation == "2015MK4"
    assert one.observation_reason is None and one.target_name == "field"
    for r in alerts.avro_bodies(a).collect():
        value, end = alerts.decode_avro(a.schema, bytes(r.body))
        assert end == len(r.body) and value == {x.diaSourceId: x for x in (one, two)}[r.diaSourceId].asDict(recursive=True)
    m = alerts.messages(a, 703).first()
    assert bytes(m.value[:5]) == b"\x00\x00\x00\x02\xbf" and m.headers[0].key == "producer_timestamp"


def test_alert_fallback(spark, tmp_path):
    a = spark.createDataFrame([(1,)], "diaSourceId bigint")
    with pytest.raises(ValueError):
        alerts.produce(a, 1, "", "t")
    assert alerts.produce(a, 1, "localhost:1", "t", failures=str(tmp_path / "f")) == str(tmp_path / "f")
    assert spark.read.parquet(str(tmp_path / "f")).count() == 1


def test_metrics(spark):
    c = spark.createDataFrame([(1, 1, 27, 15, 4, 5, 1), (2, 1, 0, 0, 0, 0, 0)], "visit int, detector int, numUpdatedDiaObjects bigint, numUnassociatedDiaObjects bigint, numNewDiaObjects bigint, numTotalSolarSystemObjects bigint, numAssociatedSsObjects bigint")
    got = {(r.visit, r.metric): r.value for r in metrics.metrics(c).collect()}
    assert got[1, "fracUpdatedDiaObjects"] == pytest.approx(27 / 42) and (2, "fracUpdatedDiaObjects") not in got and got[1, "numNewDiaObjects"] == 4
    t = spark.createDataFrame([("7",), (None,)], "t string")
    assert [r[0] for r in t.select(metrics.whole(F.col("t"))).collect()] == [7, None]
    with pytest.raises(Exception, match="whole number"):
        spark.createDataFrame([("x",)], "t string").select(metrics.whole(F.col("t"))).collect()


def test_merge_and_conform(spark):
    assert conform(spark.range(1).withColumnRenamed("id", "diaObjectId"), "diaObject").dtypes == empty(spark, "diaObject").dtypes
    o = spark.createDataFrame([(1, "g")], "diaSourceId bigint, band string")
    m = lifecycle.merge_catalogs(o, spark.createDataFrame([(2, "r", 9)], "diaSourceId bigint, band string, extra int"), "diaSource")
    assert m.columns == o.columns and sorted(map(tuple, m.collect())) == [(1, "g"), (2, "r")]


def visit_rows(visit, shift):
    return [(100 * visit + i, visit, 1, 10.0 + 0.01 * i + shift, 1.0, 5.0 + visit, 1.0, 60000.0 + visit, "g") for i in range(6)]


SOURCE = "diaSourceId bigint, visit bigint, detector int, ra double, dec double, psfFlux double, psfFluxErr double, midpointMjdTai double, band string"


def test_visits_in_time_order(spark, tmp_path):
    catalog = store.Catalog(spark, str(tmp_path / "c"))
    batch = spark.createDataFrame(visit_rows(2, 1e-5) + visit_rows(1, 0.0), SOURCE)
    results = process_batch(catalog, batch)
    assert [(r.visit, r.counts["numNewDiaObjects"], r.counts["numUpdatedDiaObjects"]) for r in results] == [(1, 6, 0), (2, 0, 6)]
    objects = store.latest_objects(catalog.read("diaObject"))
    assert {r.diaObjectId: r.nDiaSources for r in objects.collect()} == {100 + i: 2 for i in range(6)}
    assert process_batch(catalog, batch) == []  # a replay changes nothing
    with pytest.raises(RuntimeError):
        process_batch(catalog, spark.createDataFrame(visit_rows(3, 0.5), SOURCE), VisitConfig(most_new_objects=5))


def test_stream(spark, tmp_path):
    df = spark.createDataFrame(visit_rows(1, 0.0), SOURCE)
    df.write.parquet(str(tmp_path / "in"))
    catalog = store.Catalog(spark, str(tmp_path / "c"))
    got = run_stream(spark, str(tmp_path / "in"), df.schema, catalog, str(tmp_path / "k"))
    assert [(r.visit, r.counts["numNewDiaObjects"]) for r in got] == [(1, 6)] and catalog.status(1, 1) == store.DONE
    assert run_stream(spark, str(tmp_path / "in"), df.schema, catalog, str(tmp_path / "k")) == []


def test_pixels_of_updated_objects_are_not_worked_out(spark):
    class Spoiled:
        def sky_to_pixel(self, ra, dec):
            x = F.when(ra > 0, F.raise_error(F.lit("a pixel")).cast("double")).otherwise(F.lit(0.0))
            return x, x

    rows = spark.createDataFrame([(1, 7, 10.0, 1.0), (2, 7, 10.0, 1.0), (3, 8, -1.0, 1.0)], "diaForcedSourceId long, diaObjectId long, ra double, dec double")
    kept = forced.trim(rows, spark.createDataFrame([(7,), (7,)], "diaObjectId long"), Spoiled(), geometry.Box(0, 0, 9, 9))
    assert sorted(r.diaForcedSourceId for r in kept.collect()) == [1, 2, 3]
