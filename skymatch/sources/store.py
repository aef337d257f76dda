"""The catalogs at rest: loads by region and time, commits of a visit, older versions, and merges of small commits.

Tables are Parquet folders, parted by sky cell and, for sources, by periods of days. A commit that would leave its cells almost empty puts square blocks of
them in one folder, under the block's first cell; the block's side is part of the commit's name, so the number of folders follows the rows and not the sky. Objects are versions: a visit adds the rows that it changed, and a
load takes each object's latest. A version lies in the cell of its position and in every cell where an object was before, so each of an object's cells
holds its newest version, however far it moved. Sources and forced sources lie in a cell of their object. A load reads the cells of its objects and the
periods of its window alone. All tables of a visit become visible with one entry of the log (``commits``); a write that failed before it does no harm.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import Polygon, unit_vector
from ..functions.nullsafe import known
from ..operators.lifecycle import first_values, nullify_ids
from .commits import DONE, WRITTEN, Files, Log
from .schemas import KEYS, SCHEMAS, conform, empty, empty_forced, schema

#: Days of history; padding of a region in arcseconds when loading, refreshing and exporting; degrees of a stored cell; days of a stored period.
HISTORY_DAYS, LOAD_PADDING, REFRESH_PADDING, CELL_DEGREES, PERIOD_DAYS = 365.0, 20.0, 2.0, 5.0, 30.0
#: Parts of the sources of a window, and tasks over which those of all windows are spread.
HISTORY_PARTS, HISTORY_TASKS = 64, 192
#: Cell of rows without a position, and period of rows without a time.
NOWHERE = -1
#: Commits of one level that are merged into one of the next.
FAN_IN = 32
#: Cells share folders only where the whole sky has more cells than this, and so that a folder holds this many rows on average; a table may always have the least number of folders.
FEW_CELLS, FOLDER_ROWS, LEAST_FOLDERS = 100_000, 50_000, 64
#: Sides of blocks of cells: each divides the next.
SIDES = tuple(1 << n for n in range(15))


class AfterWriteError(RuntimeError):
    """Something failed after a visit was written; the visit must not be run again as it is."""


def sky_cell(ra: Column, dec: Column, degrees: float = CELL_DEGREES) -> Column:
    """Stripe of declination and step of right ascension, as one number."""
    return (F.floor((dec + 90.0) / degrees) * _steps(degrees) + F.floor(F.pmod(ra, F.lit(360.0)) / degrees)).cast("long")


def _steps(degrees: float) -> int:
    """Numbers that a stripe takes."""
    return math.ceil(360 / degrees) + 1


def block_of(cell, side: int, degrees: float = CELL_DEGREES):
    """The first cell of the block of ``side`` times ``side`` cells that a cell (a number or a column) lies in."""
    if side == 1:
        return cell
    n = _steps(degrees)
    if isinstance(cell, int):
        return cell if cell == NOWHERE else cell // n // side * side * n + cell % n // side * side
    stripe = F.floor(F.floor(cell / n) / side) * side
    return F.when(cell == NOWHERE, cell).otherwise(stripe * n + F.floor(F.pmod(cell, F.lit(n)) / side) * side).cast("long")


def side_of(folder: str) -> int:
    """Side of a commit's blocks of cells, from its name."""
    return int(folder.rpartition("-side")[2]) if "-side" in folder else 1


def period(mjd: Column) -> Column:
    return F.coalesce(F.floor(mjd / PERIOD_DAYS).cast("int"), F.lit(NOWHERE))


def cells_of(region: Polygon, degrees: float = CELL_DEGREES) -> list[int]:
    """Cells that the bounding circle of a region may touch."""
    ra, dec, radius = region.bounding_circle()
    low, high = max(-90.0, dec - radius), min(90.0, dec + radius)
    last = math.ceil(360 / degrees) - 1
    cells = set()
    for stripe in range(math.floor((low + 90) / degrees), math.floor((high + 90) / degrees) + 1):
        widest = min(89.9, max(abs(low), abs(high)))
        half = math.degrees(math.asin(min(1.0, math.sin(math.radians(min(radius, 90))) / math.cos(math.radians(widest))))) if abs(dec) + radius < 89 else 180.0
        for west, east in ((ra - half, ra + half), (ra - half + 360, ra + half + 360), (ra - half - 360, ra + half - 360)):
            steps = range(max(0, math.floor(west / degrees)), min(last, math.floor(east / degrees)) + 1)
            cells |= {stripe * _steps(degrees) + s for s in steps}
    return sorted(cells)


def in_region(df: DataFrame, region: Polygon) -> DataFrame:
    """Rows inside a region."""
    return df.where(region.contains(F.col("ra"), F.col("dec")))


def latest_objects(versions: DataFrame) -> DataFrame:
    """The newest version of every object."""
    return versions.groupBy("diaObjectId").agg(F.max_by(F.struct(*versions.columns), F.coalesce("validityStartMjdTai", F.lit(0.0))).alias("v")).select("v.*")


def before(df: DataFrame, mjd: float | Column, days: float = HISTORY_DAYS) -> DataFrame:
    """Rows of the time window that ends before ``mjd``."""
    t = mjd if isinstance(mjd, Column) else F.lit(mjd)
    return df.where((F.col("midpointMjdTai") < t) & (F.col("midpointMjdTai") > t - days))


def history_as_of(visits: DataFrame, sources: DataFrame, days: float = HISTORY_DAYS) -> DataFrame:
    """Per visit (visit, visitMjd), the sources of the window before it. ``visits`` may carry further columns to join on, such as a cell."""
    on = [c for c in visits.columns if c in sources.columns and c not in ("visit", "visitMjd")]
    past = sources.drop("visit") if "visit" in sources.columns else sources
    # Whole windows as buckets make it an equi-join: the past of a visit lies in its own bucket or the one before. A bucket's sources are dealt by object,
    # with a copy of its visits each, into a fixed number of tasks: few buckets are no large tasks.
    v = visits.withColumn("_b", F.floor(F.col("visitMjd") / days)).withColumn("_b", F.explode(F.array(F.col("_b"), F.col("_b") - 1)))
    v = v.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(HISTORY_PARTS - 1).cast("long"))))
    s = past.withColumns({"_b": F.floor(F.col("midpointMjdTai") / days), "_part": F.pmod(F.xxhash64("diaObjectId"), F.lit(HISTORY_PARTS).cast("long"))})
    s = s.repartition(HISTORY_TASKS, *on, "_b", "_part")
    return v.join(s, [*on, "_b", "_part"]).where((F.col("midpointMjdTai") < F.col("visitMjd")) & (F.col("midpointMjdTai") > F.col("visitMjd") - days)).drop("_b", "_part")


def field_cells(ra: Column, dec: Column, radius: Column, degrees: float) -> Column:
    """Cells that circles on the sky (radius below 60 degrees) may touch, as an array: a column expression, so fields of any number are cut up in tasks."""
    low, high = F.greatest(F.lit(-90.0), dec - radius), F.least(F.lit(90.0), dec + radius)
    widest = F.greatest(F.abs(low), F.abs(high))
    half = F.when(widest >= 89.0, 180.0).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(radius)) / F.cos(F.radians(widest))))))
    last = math.ceil(360 / degrees) - 1

    def steps(turn: float) -> Column:
        first, final = F.greatest(F.lit(0).cast("long"), F.floor((ra - half + turn) / degrees)), F.least(F.lit(last).cast("long"), F.floor((ra + half + turn) / degrees))
        return F.when(first <= final, F.sequence(first, final)).otherwise(F.array().cast("array<bigint>"))

    all_steps = F.array_distinct(F.concat(steps(0.0), steps(360.0), steps(-360.0)))
    stripes = F.sequence(F.floor((low + 90.0) / degrees), F.floor((high + 90.0) / degrees))
    return F.flatten(F.transform(stripes, lambda stripe: F.transform(all_steps, lambda s: stripe * _steps(degrees) + s)))


def history_in_fields(fields: DataFrame, sources: DataFrame, days: float = HISTORY_DAYS, degrees: float = CELL_DEGREES) -> DataFrame:
    """Per field (visit, visitMjd, fieldRa, fieldDec, fieldRadius in degrees), the sources within it from the ``days`` before it.

    An equi-join on the sky cell and a bucket of time as long as the window: a field is copied to the cells that it touches and two buckets, a source has
    one key, and neither side is compared beyond its key. Sources without a position or time are in no field.
    """
    past = sources.drop("visit", "cell").where(known(F.col("ra")) & known(F.col("dec")))
    past = past.withColumns({"cell": sky_cell(F.col("ra"), F.col("dec"), degrees), "_b": F.floor(F.col("midpointMjdTai") / days)})
    keyed = fields.withColumn("cell", F.explode(field_cells(F.col("fieldRa"), F.col("fieldDec"), F.col("fieldRadius"), degrees)))
    bucket = F.floor(F.col("visitMjd") / days)
    keyed = keyed.withColumn("_b", F.explode(F.array(bucket, bucket - 1)))
    near = F.lit(0.0)
    for a, b in zip(unit_vector(F.col("ra"), F.col("dec")), unit_vector(F.col("fieldRa"), F.col("fieldDec")), strict=True):
        near = near + (a - b) * (a - b)
    within = F.sqrt(near) <= 2 * F.sin(F.radians(F.col("fieldRadius")) / 2)
    in_time = (F.col("midpointMjdTai") < F.col("visitMjd")) & (F.col("midpointMjdTai") > F.col("visitMjd") - days)
    return keyed.join(past, ["cell", "_b"]).where(in_time & within).drop("cell", "_b")


def _rows_before(table: str, rows: DataFrame, objects: DataFrame, mjd: float) -> DataFrame:
    found = before(rows, mjd).join(objects.select("diaObjectId"), "diaObjectId", "left_semi")
    return conform(first_values(found, KEYS[table], ["midpointMjdTai"]), table)


def sources_before(rows: DataFrame, objects: DataFrame, mjd: float) -> DataFrame:
    """The objects' sources of the window before ``mjd``, one row per source."""
    return _rows_before("diaSource", rows, objects, mjd)


def forced_before(rows: DataFrame, objects: DataFrame, mjd: float) -> DataFrame:
    """The same for forced sources."""
    return _rows_before("diaForcedSource", rows, objects, mjd)


@dataclass
class Loaded:
    objects: DataFrame
    sources: DataFrame
    forced: DataFrame


class Catalog:
    """Catalogs in a folder that all executors share; ``version`` gives their state after that many entries of the log, to read alone."""

    def __init__(self, spark: SparkSession, path: str, cell_degrees: float = CELL_DEGREES, version: int | None = None):
        self.spark, self.path, self.cell_degrees, self.version = spark, path.rstrip("/"), cell_degrees, version
        self.files = Files(spark, self.path)
        self.entries = Log(self.files)

    def at(self, version: int) -> Catalog:
        """The catalogs as they were at a version."""
        return Catalog(self.spark, self.path, self.cell_degrees, version)

    def state(self):
        return self.entries.state(self.version)

    def remove(self, folder: str) -> None:
        """Take away a folder of working tables."""
        if not folder.startswith("_work/"):
            raise ValueError(f"{folder} is no working folder")
        self.files.delete(folder)

    @staticmethod
    def _stored(table: str) -> T.StructType:
        """Columns of a table at rest."""
        cells = [T.StructField("cells", T.ArrayType(T.LongType()))] if table == "diaObject" else []
        parts = [T.StructField("commit", T.StringType()), T.StructField("cell", T.LongType())]
        return T.StructType([*schema(table), *cells, *parts, *([] if table == "diaObject" else [T.StructField("period", T.IntegerType())])])

    def _read(self, table: str, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self._stored(table))
        # With the schema given no file is opened to plan a load; cell and period prune folders.
        at = f"{self.path}/{table}"
        return self.spark.read.schema(self._stored(table)).option("basePath", at).parquet(*[f"{at}/commit={f}" for f in folders])

    def read(self, table: str) -> DataFrame:
        """All rows of a table with the cell of the folder that they lie in; objects lie in each cell that they have been in."""
        return self._read(table, list(self.state().live)).drop("commit")

    def _read_cells(self, table: str, cells: list[int]) -> DataFrame:
        """Rows of the folders that hold the cells."""
        found = [self._read(table, folders).where(F.col("cell").isin(sorted({block_of(c, side, self.cell_degrees) for c in cells}))) for side, folders in self._by_side(list(self.state().live)).items()]
        return reduce(DataFrame.unionByName, found or [self._read(table, [])]).drop("commit")

    @staticmethod
    def _by_side(folders: list[str]) -> dict[int, list[str]]:
        return {side: [f for f in folders if side_of(f) == side] for side in sorted(set(map(side_of, folders)))}

    def _side(self, tables: dict[str, DataFrame], least: int = 1) -> int:
        """The smallest side, ``least`` or more, with which the folders of no table are many for its rows."""
        if math.ceil(180 / self.cell_degrees) * _steps(self.cell_degrees) <= FEW_CELLS:
            return least
        found = least
        for table, df in tables.items():
            parts = self._parts(table)
            cells = df.groupBy(*parts).agg(F.count("*").alias("n"))
            blocks = [F.count_distinct(block_of(F.col("cell"), side, self.cell_degrees), *parts[1:]) for side in SIDES]
            rows, *counts = cells.agg(F.sum("n"), *blocks).first()
            most = max(LEAST_FOLDERS, (rows or 0) // FOLDER_ROWS)
            found = max(found, next((side for side, n in zip(SIDES, counts, strict=True) if n <= most), SIDES[-1]))
        return found

    def load_objects(self, region: Polygon) -> DataFrame:
        """Objects whose newest version lies in the region, with the cells that they have been in."""
        versions = self._read_cells("diaObject", cells_of(region, self.cell_degrees)).drop("cell")
        found = in_region(latest_objects(versions), region)
        return conform(first_values(found, KEYS["diaObject"], ["diaObjectId"]), T.StructType([*schema("diaObject"), T.StructField("cells", T.ArrayType(T.LongType()))]))

    def _history(self, table: str, objects: DataFrame, mjd: float) -> DataFrame:
        """Rows of the cells that the objects have been in and of the periods of the window."""
        rows = None
        if "cells" in objects.columns:
            seen = objects.select(F.explode_outer("cells").alias("cell")).distinct().collect()  # cells of the sky, not objects
            if all(r["cell"] is not None for r in seen):
                rows = self._read_cells(table, [r["cell"] for r in seen])
        rows = self.read(table) if rows is None else rows
        return rows.where(F.col("period").between(math.floor((mjd - HISTORY_DAYS) / PERIOD_DAYS), math.floor(mjd / PERIOD_DAYS))).drop("cell", "period")

    def load_sources(self, objects: DataFrame, mjd: float) -> DataFrame:
        """The objects' sources of the window before ``mjd``. Objects without ``cells`` are looked for in all cells."""
        return sources_before(self._history("diaSource", objects, mjd), objects, mjd)

    def load_forced(self, objects: DataFrame, mjd: float) -> DataFrame:
        return forced_before(self._history("diaForcedSource", objects, mjd), objects, mjd)

    def load(self, region: Polygon, mjd: float, padding: float = LOAD_PADDING, forced: bool = True) -> Loaded:
        """Objects of the padded region, and their sources and forced sources of the window before ``mjd``."""
        objects = self.load_objects(region.padded(padding))
        return Loaded(objects, self.load_sources(objects, mjd), self.load_forced(objects, mjd) if forced else empty_forced(self.spark))

    def refreshed(self, preloaded: DataFrame, region: Polygon, warn=print) -> DataFrame:
        """Preloaded objects with those loaded anew in their place; if the load fails, a warning and the preloaded ones."""
        from ..operators.lifecycle import refresh

        try:
            fresh = self.load_objects(region.padded(REFRESH_PADDING))
            fresh.count()  # the load happens here
        except Exception as error:
            warn(f"objects were not refreshed: {error}")
            return preloaded
        return refresh(preloaded, fresh)

    def _cells_before(self, objects: DataFrame, before: DataFrame | None) -> DataFrame:
        """diaObjectId and cells of objects that are stored: as loaded (``before``), or looked up by id where that does not say."""
        stored = lambda ids: latest_objects(self.read("diaObject").drop("cell").join(ids, "diaObjectId", "left_semi")).select("diaObjectId", "cells")
        if before is None or "cells" not in before.columns:
            return stored((objects if before is None else objects.select("diaObjectId").unionByName(before.select("diaObjectId"))).select("diaObjectId").distinct())
        told = before.select("diaObjectId", "cells")
        return told.where("cells is not null").unionByName(stored(told.where("cells is null").select("diaObjectId")))

    def write(self, visit: int, detector: int, processed_mjd: float, objects: DataFrame, sources: DataFrame, forced: DataFrame, before: DataFrame | None = None, drop_empty: bool = False) -> float:
        """Commit a visit's rows: all tables become visible at once, and the visit is WRITTEN. A visit that was written before is an error.

        ``before``: the objects as they were loaded, with their cells, which saves looking them up. ``drop_empty``: columns without any value are not stored; they read as null.
        """
        if self.version is not None:
            raise ValueError(f"version {self.version} is there to be read alone")
        if self.status(visit, detector):
            raise RuntimeError(f"visit {visit} detector {detector} was already written")
        own = F.coalesce(sky_cell(F.col("ra"), F.col("dec"), self.cell_degrees), F.lit(NOWHERE).cast("long"))
        past = self._cells_before(objects, before).withColumnRenamed("cells", "_past")
        now = conform(objects.withColumn("validityStartMjdTai", F.lit(processed_mjd)), "diaObject").join(past, "diaObjectId", "left")
        now = now.withColumn("cells", F.array_union(F.array(own), F.coalesce("_past", F.array().cast("array<bigint>")))).drop("_past")
        # One cell of every object that these rows may name: of its new version, else of the one before.
        home = now.select("diaObjectId", "cells").unionByName(past.join(now, "diaObjectId", "left_anti").withColumnRenamed("_past", "cells"))
        home = home.groupBy(F.col("diaObjectId").alias("_id")).agg(F.min(F.col("cells")[0]).alias("_home"))

        def placed(df: DataFrame, table: str) -> DataFrame:
            rows = conform(df, table).join(home, F.col("diaObjectId") == F.col("_id"), "left")
            return rows.withColumns({"cell": F.coalesce("_home", own), "period": period(F.col("midpointMjdTai"))}).drop("_id", "_home")

        tables = {
            "diaObject": now.withColumn("cell", F.explode("cells")),
            "diaSource": placed(nullify_ids(conform(sources, "diaSource"), "diaObjectId", "ssObjectId", "parentDiaSourceId"), "diaSource"),
            "diaForcedSource": placed(forced, "diaForcedSource"),
        }
        side = self._side(tables)
        folder = self._named(f"{visit}-{detector}", side)
        for table, df in tables.items():
            self._put(table, folder, self._in_blocks(table, df, 1, side), drop_empty)
        self.log(visit, detector, WRITTEN, folder)
        return processed_mjd

    @staticmethod
    def _parts(table: str) -> list[str]:
        return ["cell"] if table == "diaObject" else ["cell", "period"]

    @staticmethod
    def _named(what: str, side: int) -> str:
        """A new name for a commit."""
        return f"{what}-{uuid.uuid4().hex}" + (f"-side{side}" if side > 1 else "")

    def _in_blocks(self, table: str, df: DataFrame, before: int, side: int) -> DataFrame:
        """Rows of folders of one side moved to those of a larger one. Of a version that several of them hold, a block takes one row."""
        if side == before:
            return df
        block = lambda c, n=side: block_of(c, n, self.cell_degrees)
        if table == "diaObject":
            near = F.filter(F.transform("cells", lambda c: block(c, before)), lambda c: block(c) == block(F.col("cell")))
            df = df.where(F.col("cell") == F.array_min(near))
        return df.withColumn("cell", block(F.col("cell")))

    def _put(self, table: str, folder: str, df: DataFrame, drop_empty: bool = False) -> None:
        parts = self._parts(table)
        if drop_empty:
            df = df.drop(*[c for c in all_null_columns(df) if c not in (*parts, "cells", f"{table}Id")])
        # Few files a cell: rows are brought together by cell and period, small ones share a task, and a crowded one is split over several.
        df.hint("rebalance", *[F.col(c) for c in parts]).write.mode("overwrite").partitionBy(*parts).parquet(f"{self.path}/{table}/commit={folder}")

    def log(self, visit: int, detector: int, status: str, folder: str | None = None) -> None:
        """Say what became of a visit; with the folder of its rows this makes them visible."""
        kind = {"kind": "status", "status": status} if folder is None else {"kind": "commit", "folder": folder}
        self.entries.append(kind | {"visit": visit, "detector": detector})

    def status(self, visit: int, detector: int) -> str | None:
        """WRITTEN or DONE of a visit, or nothing."""
        return self.state().status.get((visit, detector))

    def merge_commits(self, fan_in: int = FAN_IN) -> list[str]:
        """Where ``fan_in`` commits of one level are live, write their rows as one commit of the next level, cell by cell; the folders that this replaces.

        A row is rewritten once a level, so the work per row grows with the logarithm of the number of visits. Commits made meanwhile stay. Versions from before read the replaced folders until they are vacuumed.
        """
        replaced: list[str] = []
        while True:
            state = self.state()
            levels = sorted(set(state.live.values()))
            level = next((n for n in levels if sum(x == n for x in state.live.values()) >= fan_in), None)
            if level is None:
                self.entries.checkpoint()
                return replaced
            old = [f for f, n in state.live.items() if n == level]
            side = self._side({t: self._read(t, old) for t in TABLES}, max(map(side_of, old)))
            folder = self._named(f"merged-{level + 1}", side)
            for table in TABLES:
                rows = [self._in_blocks(table, self._read(table, fs), n, side) for n, fs in self._by_side(old).items()]
                self._put(table, folder, reduce(DataFrame.unionByName, rows).drop("commit"))
            self.entries.append({"kind": "merge", "folder": folder, "level": level + 1, "replaces": old})
            replaced += old

    def vacuum(self, keep_versions: int = 0) -> list[str]:
        """Delete folders that neither the newest version nor the ``keep_versions`` before it read, left by merges or by writes that failed. No write may be under way."""
        newest = self.state().version
        live = {f for v in range(max(0, newest - keep_versions), newest + 1) for f in (self.entries.state(v) if v else self.entries.state()).live}
        gone = set()
        for table in TABLES:
            for name in self.files.names(table):
                if name.startswith("commit=") and name.removeprefix("commit=") not in live:
                    self.files.delete(f"{table}/{name}")
                    gone.add(name.removeprefix("commit="))
        return sorted(gone)

    def export(self, region: Polygon, path: str, mjd: float, tract: int, patch: int) -> None:
        """Objects of a patch of sky, with their sources and forced sources of the window before ``mjd``, in a folder of each table that a repeated export replaces."""
        loaded = self.load(region, mjd, padding=REFRESH_PADDING)
        for name, df in (("diaObject", loaded.objects), ("diaSource", loaded.sources), ("diaForcedSource", loaded.forced)):
            df.write.mode("overwrite").parquet(f"{path}/{name}/tract={tract}/patch={patch}")


def all_null_columns(df: DataFrame) -> list[str]:
    """Columns without any value, found in one pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first().asDict()
    return [c for c, n in counts.items() if not n]


TABLES = tuple(SCHEMAS)
