"""Plans from files: the same plan as the built-in one, a plan of one's own, and files that are wrong."""

import pytest
from pyspark.sql import functions as F

from skymatch.functions import flags, photometry
from skymatch.operators import detections

pytest.importorskip("yaml")
from skymatch.sources import plan_files  # noqa: E402


def raw_catalog(spark):
    """Four raw detections with every column that the projection and the flags ask for."""
    names = {c for _, functor, args in photometry.PROJECTION for c in photometry._needs(functor, args)} - {"band", "visit", "detector", "diaObjectId", "midpointMjdTai", "timeProcessedMjdTai", "flags"}
    numbers = [(F.col("id") * (n + 1) / 7).alias(c) for n, c in enumerate(sorted(names - {"id"}))]
    bits = [(F.col("id") % (b + 2) == 0).alias(n) for n, b in flags.FLAG_BITS.items()]
    return spark.range(6, 30, 6, numPartitions=2).select("id", F.lit(1).cast("long").alias("visit"), F.lit(2).alias("detector"), *numbers, *bits)


def exposures(spark):
    return spark.createDataFrame([(1, 2, "g", 60000.0)], "visit bigint, detector int, band string, midpointMjdTai double")


def written(tmp_path, text):
    path = tmp_path / "file.yaml"
    path.write_text(text)
    return str(path)


def test_the_built_in_plan_from_files_is_the_same_plan(spark, tmp_path):
    loaded = plan_files.Plan.load(*plan_files.Plan().save(str(tmp_path)))
    assert loaded == plan_files.Plan() and list(loaded.renames) == list(flags.RENAMES) and len(loaded.projection) == 61
    raw, e = raw_catalog(spark), exposures(spark)
    for config in (detections.TransformConfig(flag_names=tuple(flags.FLAG_BITS)), detections.TransformConfig(pack_flags=True, flag_names=tuple(flags.FLAG_BITS))):
        own = detections.transform(raw, e, 60100.0, config)
        same = detections.transform(raw, e, 60100.0, config, plan=loaded)
        assert same.columns == own.columns and same.sameSemantics(own)
        assert sorted(map(str, same.collect())) == sorted(map(str, own.collect())) and same.count() == 4


def test_a_plan_of_ones_own(spark, tmp_path):
    funcs = written(tmp_path, "funcs:\n  diaSourceId: {functor: Column, args: id}\n  x: {functor: Column, args: [height]}\n  ra: {functor: RAColumn}\n  psfFlux:\n    functor: LocalNanojansky\n    args: f\n  flags: {functor: Column, args: flags}\n")
    (tmp_path / "bits.yaml").write_text("tableName: Other\ncolumns: []\n---\ntableName: DiaSource\ncolumns:\n- columnName: flags\n  bitList:\n  - {name: odd, bit: 3, doc: an odd one}\n  - {name: big, bit: 62}\n")
    (tmp_path / "rules.yaml").write_text("flag_rename_rules:\n- [o, strange_o]\n---\nflag_rename_rules:\n- [b, huge_b]\n")
    plan = plan_files.Plan.load(funcs, str(tmp_path / "bits.yaml"), str(tmp_path / "rules.yaml"))
    assert plan.projection == [("diaSourceId", "Column", ("id",)), ("x", "Column", ("height",)), ("ra", "RAColumn", ()), ("psfFlux", "LocalNanojansky", ("f",)), ("flags", "Column", ("flags",))]
    raw = spark.sql("select id, 1L as visit, 2 as detector, id * 10.0 as height, radians(id * 1.0) as coord_ra, 3.0 * id as f, 2.0 as base_LocalPhotoCalib, id % 2 = 1 as odd, id > 2 as big from range(1, 5)")
    named = ("odd", "big")
    got = {r.diaSourceId: r for r in detections.transform(raw, exposures(spark), 60100.0, detections.TransformConfig(flag_names=named), plan=plan).collect()}
    assert {i: (r.x, round(r.ra, 6), r.psfFlux, r.strange_odd, r.huge_big) for i, r in got.items()} == {i: (10.0 * i, float(i), 6.0 * i, i % 2 == 1, i > 2) for i in range(1, 5)}
    packed = detections.transform(raw, exposures(spark), 60100.0, detections.TransformConfig(pack_flags=True, flag_names=named), plan=plan)
    assert {r.diaSourceId: r.flags for r in packed.collect()} == {i: 8 * (i % 2) + (i > 2) * 2**62 for i in range(1, 5)}


@pytest.mark.parametrize(
    "text, words",
    [
        ("funcs:\n  a: {functor: Nothing, args: b}\n", "a asks for the functor Nothing"),
        ("funcs:\n  a: {args: b}\n", "a has no functor"),
        ("funcs:\n  a:\n", "a has no functor"),
        ("funcs:\n  a: {functor: LocalNanojanskyErr, args: b}\n", "a, LocalNanojanskyErr"),
        ("funcs:\n  a: {functor: RAColumn, args: b}\n", "a, RAColumn"),
        ("funcs:\n  a: {functor: Column, args: [3]}\n", "no names"),
        ("funcs:\n  a: {functor: Column, args: b}\n  a: {functor: Column, args: c}\n", "a more than once"),
        ("funcs:\n  a: {functor: Column, args: b}\n---\nfuncs:\n  a: {functor: Column, args: b}\n", "a more than once"),
        ("other: 1\n", "has no funcs"),
        ("", "has no funcs"),
    ],
)
def test_wrong_projections(tmp_path, text, words):
    with pytest.raises(ValueError, match=words):
        plan_files.load_projection(written(tmp_path, text))


@pytest.mark.parametrize("bits", ["[{name: a, bit: 63}]", "[{name: a, bit: -1}]", "[{name: a, bit: true}]", "[{name: a, bit: x}]", "[{name: a, bit: 1}, {name: b, bit: 1}]", "[{name: a, bit: 1}, {name: a, bit: 2}]"])
def test_wrong_bits(tmp_path, bits):
    with pytest.raises(ValueError):
        plan_files.load_flags(written(tmp_path, f"tableName: DiaSource\ncolumns:\n- columnName: flags\n  bitList: {bits}\n"))


def test_renames(tmp_path):
    assert plan_files.load_flags(written(tmp_path, "tableName: Other\n")) == {}
    with pytest.raises(ValueError, match="covers"):
        plan_files.load_renames(written(tmp_path, "flag_rename_rules:\n- [slot, s]\n- [slot_Shape, shape]\n"))
    with pytest.raises(ValueError, match="pair"):
        plan_files.load_renames(written(tmp_path, "flag_rename_rules:\n- [slot]\n"))


def test_names_of_a_database(spark, tmp_path):
    names = plan_files.load_names(written(tmp_path, "DiaObject:\n  diaObjectId: id\n  ra: coord_ra\nDiaSource:\n  diaSourceId: id\n"))
    df = spark.createDataFrame([(1, 2.0, 3)], "diaObjectId long, ra double, more int")
    raw = names["DiaObject"].raw(df)
    assert raw.columns == ["id", "coord_ra", "more"] and names["DiaObject"].database(raw).columns == df.columns and raw.first() == (1, 2.0, 3)
    with pytest.raises(ValueError, match="twice"):
        names["DiaSource"].raw(spark.createDataFrame([(1, 2)], "diaSourceId long, id long"))
    with pytest.raises(ValueError, match="more than one"):
        plan_files.load_names(written(tmp_path, "DiaObject:\n  a: id\n  b: id\n"))
