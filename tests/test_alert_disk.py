"""What alert files take of the disk on their way: large lists once, rows of forced sources shuffled once, nothing left behind."""

import os

import pytest
from pyspark.sql import functions as F

from skymatch.operators import alerts
from skymatch.plans import catalog_queries
from skymatch.sources import containers

MOST = [(i / 7, i) for i in range(6000)]
KIND = "diaSourceId bigint, diaSource struct<visit: bigint, detector: bigint>, long array<struct<mjd: double, n: int>>, name string, more array<struct<mjd: double, n: int>>"


def rows(n=24):
    return [(i, (1 + i % 2, 2), [MOST, None, [(1.0, 2)], MOST[::-1]][i // 2 % 4], f"n{i}", MOST if i % 3 == 0 else None) for i in range(n)]


@pytest.mark.parametrize("codec", containers.CODECS)
def test_large_lists_are_written_once_and_not_shuffled(spark, tmp_path, codec):
    made = spark.createDataFrame(rows(), KIND).coalesce(1)
    (tmp_path / "large").mkdir()
    got = containers._encoded(made, {"_visit": F.col("diaSource.visit")}, codec, str(tmp_path / "large")).collect()
    files = {f: (tmp_path / "large" / f).read_bytes() for f in os.listdir(tmp_path / "large")}
    assert len(files) == 1 and sum(len(r.body) for r in got) < 5_000
    places = {(p.file, p.at, p.size) for r in got for p in r.parts or []}
    assert len(places) == 2 and sum(size for *_, size in places) == sum(map(len, files.values()))
    inline = {r.diaSourceId: r for r in containers._encoded(made, {"_visit": F.col("diaSource.visit")}, codec).collect()}
    store, top = containers._place(str(tmp_path / "large"))
    for r in got:
        parts = [p.asDict() for p in r.parts] if r.parts else None
        assert containers._whole(bytes(r.body), parts, store, top) == bytes(inline[r.diaSourceId].body) and (r.packed, r.size) == (inline[r.diaSourceId].packed, inline[r.diaSourceId].size)


@pytest.mark.parametrize("codec", containers.CODECS)
def test_files_are_whole_however_the_alerts_are_dealt(spark, tmp_path, codec):
    made = spark.createDataFrame([*rows(), (3, (2, 2), MOST[::-1], "n3", None)], KIND)
    for n in (1, 4):
        folder = str(tmp_path / str(n))
        containers.write_alert_files(made.repartition(n), folder, codec, most_rows=5)
        assert sorted(map(str, containers.read_alert_files(spark, folder).collect())) == sorted(map(str, made.collect()))
        assert all(f.endswith(".avro") for f in os.listdir(folder))
    one, four = ({f: (tmp_path / n / f).read_bytes() for f in os.listdir(tmp_path / n)} for n in ("1", "4"))
    assert one == four and len(one) > 2


def test_a_cut_field_is_an_error(tmp_path):
    large = containers._Large(str(tmp_path))
    place = large.place(b"x" * 100) | {"plain": 1}
    large.close()
    store, top = containers._place(str(tmp_path))
    assert containers._whole(b"ab", [place], store, top) == b"a" + b"x" * 100 + b"b"
    with pytest.raises(ValueError, match="ends within a field"):
        containers._whole(b"ab", [place | {"size": 101}], store, top)


def test_forced_rows_are_shuffled_once(spark):
    """From the table to the lists: one exchange for copies, lists and join; of the sources only those without an object pass through the join with the solar system."""
    made = catalog_queries._alerts(spark, "/root/testdata/sf0.001").select("diaSourceId", "prvDiaForcedSources")
    lines = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].split("\n")
    at = next(i for i, line in enumerate(lines) if "lineitem.parquet" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
    above, now = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < now:
            above.append(line)
            now = depth(line)
    assert sum("Exchange hashpartitioning" in line for line in above) == 1 and any("Window" in line for line in above) and any("collect_list" in line for line in above)


def test_sources_with_unknown_object_have_no_solar_record(spark):
    sources = spark.createDataFrame([(1, 7, 1.0), (2, 0, 2.0), (3, None, 3.0), (4, 0, 4.0)], "diaSourceId bigint, diaObjectId bigint, midpointMjdTai double")
    objects = spark.createDataFrame([(7, 3)], "diaObjectId bigint, nDiaSources bigint")
    solar = spark.createDataFrame([(i, 5, "2015 MK4") for i in (1, 2, 3)], "diaSourceId bigint, ssObjectId bigint, MPCORB_unpacked_primary_provisional_designation string")
    made = alerts.assemble(sources, objects, sources, sources.withColumnRenamed("diaSourceId", "diaForcedSourceId"), solar)
    got = {r.diaSourceId: r for r in made.collect()}
    assert sorted(got) == [1, 2, 3, 4] and [i for i in got if got[i].ssSource is not None] == [2] and got[2].MPCORB.designation == "2015 MK4" and got[1].diaObject.nDiaSources == 3


def test_files_are_written_in_rounds_and_parts_go(spark, tmp_path, monkeypatch):
    """Many files in several rounds: all alerts, and neither parts nor shuffle files nor a changed setting are left."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, root = spark.conf.get(name), containers.new_path(spark, "x").rsplit("/", 1)[0]
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    made = spark.createDataFrame([(i, (i % 90, 2), [(i / 3, i)] * (i % 3), f"n{i}", None) for i in range(400)], KIND)
    rounds, release = [], containers.release
    monkeypatch.setattr(containers, "release", lambda df: rounds.extend(f.rsplit("/", 2)[-2] for f in df.inputFiles()[:1] if "_round=" in f) or release(df))
    out = containers.write_alert_files(made, str(tmp_path / "a"), counted=made.select("diaSource.*"))
    assert {(r.visit, r.detector, r.file, r.alerts) for r in out.collect()} == {(v, 2, f"{v}_2.avro", 4 + (v < 40)) for v in range(90)}
    assert len(rounds) == len(set(rounds)) == containers.ROUNDS and spark.conf.get(name) == setting
    assert sorted(map(str, containers.read_alert_files(spark, str(tmp_path / "a")).collect())) == sorted(map(str, made.collect()))
    new = sorted(set(os.listdir(root)) - before)
    assert [f.split("-")[1] for f in new if any(x.endswith(".parquet") for _, _, files in os.walk(f"{root}/{f}") for x in files)] == ["files"]
