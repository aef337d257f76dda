"""Commits, versions, merges and pruned loads of the stored catalogs."""

import glob
import math
import random

import pytest
from pyspark.sql import functions as F

from skymatch.functions.geometry import Polygon
from skymatch.sources import store
from skymatch.sources.schemas import empty

OBJECT = "diaObjectId bigint, ra double, dec double, nDiaSources bigint"
SOURCE = "diaSourceId bigint, diaObjectId bigint, ra double, dec double, midpointMjdTai double, band string, visit bigint"
FORCED = "diaForcedSourceId bigint, diaObjectId bigint, ra double, dec double, midpointMjdTai double, visit bigint"
EAST, WEST = [Polygon.of_degrees([(a, 0.5), (a + 1, 0.5), (a + 1, 1.5), (a, 1.5)]) for a in (20.0, 10.0)]


def rows(spark, objects, sources=(), forced=()):
    return spark.createDataFrame(list(objects), OBJECT), spark.createDataFrame(list(sources), SOURCE), spark.createDataFrame(list(forced), FORCED)


def ids(df, column="diaObjectId"):
    return sorted(r[column] for r in df.collect())


def test_a_crash_between_tables_is_invisible(spark, tmp_path):
    catalog = store.Catalog(spark, str(tmp_path / "c"))
    catalog.write(1, 0, 60000.0, *rows(spark, [(1, 10.5, 1.0, 1)], [(11, 1, 10.5, 1.0, 59999.0, "g", 1)]))
    put = catalog._put

    def broken(table, *more):
        if table == "diaForcedSource":
            raise OSError("disk")
        put(table, *more)

    catalog._put = broken
    two = rows(spark, [(1, 10.6, 1.0, 2), (2, 10.7, 1.0, 1)], [(12, 1, 10.6, 1.0, 60000.0, "g", 2)], [(5, 1, 10.6, 1.0, 60000.0, 2)])
    with pytest.raises(OSError):
        catalog.write(2, 0, 60001.0, *two)
    for reader in (catalog, store.Catalog(spark, str(tmp_path / "c"))):
        assert [reader.read(t).count() for t in store.TABLES] == [1, 1, 0] and reader.status(2, 0) is None
    catalog._put = put
    catalog.write(2, 0, 60001.0, *two)
    assert [catalog.read(t).count() for t in store.TABLES] == [2, 3, 1] and catalog.status(2, 0) == store.WRITTEN
    with pytest.raises(RuntimeError):
        catalog.write(2, 0, 60001.0, *two)
    assert len(catalog.vacuum(keep_versions=5)) == 1  # what the failed write left
    assert [catalog.read(t).count() for t in store.TABLES] == [2, 3, 1]


def test_two_writers_take_different_numbers(spark, tmp_path):
    one, two = (store.Catalog(spark, str(tmp_path / "c")) for _ in range(2))
    one.log(1, 0, store.DONE)
    state = two.entries.state
    two.entries.state = lambda version=None, calls=[]: (calls.append(1), state(version) if len(calls) > 1 else type(state())())[1]  # an outdated look at the log
    two.log(2, 0, store.DONE)
    two.entries.state = state
    assert one.state().version == 2 and one.status(1, 0) == one.status(2, 0) == store.DONE
    assert not one.files.put_new("_log/00000000000000000002.json", "{}") and two.state().version == 2
    assert [n for n in one.files.names("_log") if n.startswith("_")] == []


def test_versions_merges_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "c")
    catalog = store.Catalog(spark, path, cell_degrees=1.0)
    for visit in range(1, 7):
        catalog.write(visit, 0, 60000.0 + visit, *rows(spark, [(1, 10.5 + visit / 1000, 1.0, visit)], [(10 + visit, 1, 10.5, 1.0, 60000.0 + visit - 0.5, "g", visit)], [(100 + visit, 1, 10.5, 1.0, 60000.0 + visit, visit)]))
        catalog.log(visit, 0, store.DONE)
    before = {t: sorted(map(str, catalog.read(t).collect())) for t in store.TABLES}
    assert catalog.merge_commits(fan_in=7) == []
    assert len(catalog.merge_commits(fan_in=3)) == 6
    state = store.Catalog(spark, path, 1.0).state()
    assert list(state.live.values()) == [1] and state.status[6, 0] == store.DONE
    assert {t: sorted(map(str, catalog.read(t).collect())) for t in store.TABLES} == before
    assert ids(catalog.at(5).read("diaSource"), "diaSourceId") == [11, 12, 13]  # commit and status of two visits, and a commit
    assert catalog.load_objects(WEST).first().nDiaSources == 6 and catalog.at(5).load_objects(WEST).first().nDiaSources == 3
    with pytest.raises(ValueError, match="alone"):
        catalog.at(5).write(9, 0, 60009.0, *rows(spark, []))
    with pytest.raises(ValueError, match="no version"):
        catalog.at(500).read("diaSource")
    assert len(catalog.vacuum()) == 6
    assert {t: sorted(map(str, store.Catalog(spark, path, 1.0).read(t).collect())) for t in store.TABLES} == before


def test_a_new_reader_starts_at_a_checkpoint(spark, tmp_path):
    catalog = store.Catalog(spark, str(tmp_path / "c"))
    for visit in range(5):
        catalog.log(visit, 0, store.DONE)
    catalog.entries.checkpoint(every=5)
    catalog.log(5, 0, store.DONE)
    reader = store.Catalog(spark, str(tmp_path / "c"))
    read, seen = reader.files.read, []
    reader.files.read = lambda name: (seen.append(name), read(name))[1]
    assert reader.state().version == 6 and all(reader.status(v, 0) == store.DONE for v in range(6))
    assert [n.rsplit(".")[-1] for n in seen] == ["state", "json"]


def test_an_object_is_found_where_it_is_however_far_it_moved(spark, tmp_path):
    catalog = store.Catalog(spark, str(tmp_path / "c"), cell_degrees=1.0)
    catalog.write(1, 0, 60001.0, *rows(spark, [(1, 10.5, 1.0, 1), (2, 10.6, 1.0, 1)], [(11, 1, 10.5, 1.0, 60000.5, "g", 1), (12, 2, 10.6, 1.0, 60000.5, "g", 1)]))
    loaded = catalog.load_objects(WEST)
    catalog.write(2, 0, 60002.0, *rows(spark, [(1, 20.5, 1.0, 2)], [(13, 1, 20.5, 1.0, 60001.5, "g", 2)], [(7, 2, 10.6, 1.0, 60001.5, 2)]), before=loaded)
    assert ids(catalog.load_objects(WEST)) == [2] and ids(catalog.load_objects(EAST)) == [1]
    for known in (catalog.load_objects(EAST), None, catalog.load_objects(EAST).drop("cells"), catalog.load_objects(EAST).withColumn("cells", F.lit(None).cast("array<bigint>"))):
        objects = catalog.load_objects(EAST) if known is None else known
        assert ids(catalog.load_sources(objects, 60003.0), "diaSourceId") == [11, 13]  # its source of the old place too
    assert ids(catalog.load_forced(catalog.load_objects(WEST), 60003.0), "diaForcedSourceId") == [7]
    catalog.write(3, 0, 60003.0, *rows(spark, [(1, 10.4, 1.0, 3)]))  # back again, cells looked up
    assert ids(catalog.load_objects(WEST)) == [1, 2] and ids(catalog.load_objects(EAST)) == []


def test_loads_read_their_cells_and_periods_alone(spark, tmp_path):
    path = str(tmp_path / "c")
    catalog = store.Catalog(spark, path, cell_degrees=1.0)
    sources = [(i, 1 + i % 2, 10.5 + 10 * (i % 2), 1.0, 60000.5 - 50 * (i // 2), "g", 1) for i in range(30)]
    catalog.write(1, 0, 60001.0, *rows(spark, [(1, 10.5, 1.0, 1), (2, 20.5, 1.0, 1)], sources))
    objects = catalog.load_objects(WEST)
    found = catalog.load_sources(objects, 60001.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(part for part in plan.split("\n") if "PartitionFilters: [" in part and "diaSourceId" in part)
    assert "cell#" in scan.split("PartitionFilters: [")[1].split("]")[0] and "period#" in scan.split("PartitionFilters: [")[1].split("]")[0]
    want = ids(found, "diaSourceId")
    assert want == [i for i in range(0, 30, 2) if 60000.5 - 50 * (i // 2) > 60001 - 365]
    cells = {int(p.split("cell=")[1].split("/")[0]) for p in glob.glob(f"{path}/diaSource/*/cell=*")}
    mine = set(store.cells_of(WEST, 1.0)) & cells
    assert len(cells) == 2 and len(mine) == 1
    spoiled = 0
    for file in glob.glob(f"{path}/diaSource/*/cell=*/period=*/*.parquet"):
        cell, period = (int(file.split(f"{k}=")[1].split("/")[0]) for k in ("cell", "period"))
        if cell not in mine or period < (60001 - 365) // 30:
            open(file, "w").write("no table")
            spoiled += 1
    assert spoiled >= 20 and ids(catalog.load_sources(objects, 60001.0), "diaSourceId") == want


def test_empty_columns_may_be_left_out(spark, tmp_path):
    catalog = store.Catalog(spark, str(tmp_path / "c"))
    catalog.write(1, 0, 60001.0, *rows(spark, [(1, 10.5, 1.0, 1)], [(11, 1, 10.5, 1.0, 60000.5, None, 1)]), drop_empty=True)
    file = glob.glob(f"{tmp_path}/c/diaSource/commit=*/cell=*/period=*/*.parquet")[0]
    assert set(spark.read.parquet(file).columns) == {"diaSourceId", "diaObjectId", "ra", "dec", "midpointMjdTai", "visit"}
    row = catalog.read("diaSource").first()
    assert row.band is None and row.psfFlux is None and row.diaSourceId == 11


@pytest.mark.parametrize("degrees", [5.0, 0.7, 33.0])
def test_cells_of_circles(spark, degrees):
    """Cells as a column, as a list, and the cells of points in the circle agree."""
    rng = random.Random(7)
    circles = [(i, rng.choice([0.0, 0.1, 359.9, rng.uniform(0, 360)]), rng.choice([-89.9, 89.5, 0.0, rng.uniform(-90, 90)]), rng.choice([0.01, 1.0, 8.0])) for i in range(40)]
    points = []
    for i, ra, dec, radius in circles:
        for _ in range(60):
            r, turn = math.radians(radius * math.sqrt(rng.random())), rng.uniform(0, 2 * math.pi)
            d = math.asin(math.sin(math.radians(dec)) * math.cos(r) + math.cos(math.radians(dec)) * math.sin(r) * math.cos(turn))
            a = math.radians(ra) + math.atan2(math.sin(turn) * math.sin(r) * math.cos(math.radians(dec)), math.cos(r) - math.sin(math.radians(dec)) * math.sin(d))
            points.append((i, math.degrees(a) % 360, math.degrees(d)))
    fields = spark.createDataFrame(circles, "i int, a double, d double, r double").select("i", store.field_cells(F.col("a"), F.col("d"), F.col("r"), degrees).alias("cells"))
    inside = spark.createDataFrame(points, "i int, ra double, dec double").withColumn("cell", store.sky_cell(F.col("ra"), F.col("dec"), degrees))
    assert inside.join(fields, "i").where(~F.array_contains("cells", F.col("cell"))).count() == 0
    assert fields.where(F.size("cells") != F.size(F.array_distinct("cells"))).count() == 0


def test_many_cells_share_few_folders(spark, tmp_path):
    """Cells that are almost empty lie in common folders, and loads, older versions and merges say the same as with a folder each."""
    stripe = [(i, 10.005 + 0.01 * (i % 20), 1.005 + 0.01 * (i // 20), 1) for i in range(400)]
    sources = [(1000 + i, i, ra, dec, 60000.5 - 40 * (i % 3), "g", 1) for i, ra, dec, _ in stripe]
    forced = [(5000 + i, i, ra, dec, 60000.5, 1) for i, ra, dec, _ in stripe]
    region = Polygon.of_degrees([(10.03, 1.03), (10.09, 1.03), (10.09, 1.09), (10.03, 1.09)])
    found = {}
    for degrees in (0.01, 1.0):
        catalog = store.Catalog(spark, str(tmp_path / str(degrees)), cell_degrees=degrees)
        catalog.write(1, 0, 60001.0, *rows(spark, stripe, sources, forced))
        catalog.write(2, 0, 60002.0, *rows(spark, [(0, 10.051, 1.051, 2), (63, 15.0, 5.0, 2)], [(3000, 0, 10.051, 1.051, 60001.0, "g", 2)]))  # one comes into the region and one leaves it
        load = lambda c: [ids(c.load_objects(region)), ids(c.load(region, 60003.0).sources, "diaSourceId"), ids(c.load(region, 60003.0).forced, "diaForcedSourceId")]  # noqa: B023, E731
        found[degrees] = [load(catalog), load(catalog.at(1))]
        catalog.merge_commits(fan_in=2)
        found[degrees] += [load(catalog), catalog.read("diaSource").count()]
        if degrees == 0.01:
            for table in store.TABLES:
                for commit in glob.glob(f"{catalog.path}/{table}/commit=*"):
                    assert len(glob.glob(f"{commit}/**/*.parquet", recursive=True)) <= store.LEAST_FOLDERS
            merged = catalog.read("diaObject").where("diaObjectId = 0").collect()
            assert len(merged) == len({(r.cell, r.nDiaSources) for r in merged})  # a folder holds a version once
    assert found[0.01] == found[1.0] and found[0.01][0] == found[0.01][2] and found[0.01][0][0] != found[0.01][1][0]
    assert 0 in found[0.01][0][0] and 63 in found[0.01][1][0] and 63 not in found[0.01][0][0]


@pytest.mark.parametrize("side", [2, 64])
def test_blocks_of_cells_as_numbers_and_columns(spark, side):
    cells = [-1, 0, 1, 7, 18001, 18000 * 91 + 17, 162_018_000]
    got = spark.createDataFrame([(c,) for c in cells], "cell long").select("cell", store.block_of(F.col("cell"), side, 0.02).alias("b")).collect()
    assert [store.block_of(r.cell, side, 0.02) for r in got] == [r.b for r in got]
    assert all(store.block_of(store.block_of(c, side, 0.02), side * 2, 0.02) == store.block_of(c, side * 2, 0.02) for c in cells)


def test_history_of_one_window_is_spread_over_tasks(spark):
    """A window's sources are no single task, and the pairs are those of all rows compared."""
    rng = random.Random(5)
    sources = [(i, rng.randrange(1, 300), 60001.0 + rng.random() * 6) for i in range(1500)] + [(9000, 3, None)]
    visits = [(1, 60004.0), (2, 60007.5), (3, 60001.0)]
    s, v = spark.createDataFrame(sources, "diaSourceId long, diaObjectId long, midpointMjdTai double"), spark.createDataFrame(visits, "visit long, visitMjd double")
    small = "spark.sql.autoBroadcastJoinThreshold"  # tables of this size would else be copied to every task
    before = spark.conf.get(small)
    spark.conf.set(small, "-1")
    try:
        found = store.history_as_of(v, s, 7.0).select("visit", "diaSourceId", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set(small, before)
    assert sorted((r.visit, r.diaSourceId) for r in found) == sorted((n, i) for n, t in visits for i, _, m in sources if m is not None and t - 7 < m < t)
    sizes = [sum(r.task == task for r in found) for task in {r.task for r in found}]
    assert len(sizes) > 20 and max(sizes) < len(found) / 8
