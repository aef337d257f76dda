"""Visits as a stream: each micro-batch is associated with the catalogs, updates them, and is logged, visit by visit in time order."""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import Polygon, unit_vector
from ..operators import alerts, assign, forced, lifecycle, solarsystem, stats
from ..operators.delivery import Delivery, deliver
from ..operators.crossmatch import MatchConfig, drop_unplaced
from ..operators.filters import QualityConfig, check_bands
from ..operators.forced import Exposure
from ..operators.stamps import alert_stamps
from ..operators.metrics import NOT_PRODUCED, visit_counts
from ..sources.schemas import BANDS, conform, empty_forced
from ..sources.store import DONE, WRITTEN, AfterWriteError, Catalog, Loaded
from .rounds import plan_rounds


@dataclass(frozen=True)
class Steps:
    """The parts of a visit that can be exchanged, each for a function that takes and returns what its default does."""

    solar: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]] = solarsystem.associate
    associate: Callable[[DataFrame, DataFrame, MatchConfig], assign.Association] = assign.associate
    summarize: Callable[[DataFrame, DataFrame, DataFrame, list[str]], DataFrame] = stats.summarize
    measure: Callable[[DataFrame, DataFrame, Exposure, float, int], DataFrame] = forced.measure
    package: Callable[..., DataFrame] = alerts.assemble


@dataclass(frozen=True)
class VisitConfig:
    match: MatchConfig = field(default_factory=MatchConfig)
    most_new_objects: int = 0
    filter_quality: bool = False
    quality: QualityConfig = field(default_factory=QualityConfig)
    statistics: tuple[str, ...] = tuple(stats.STATISTICS)
    #: Bands that sources may have; none means any.
    bands: tuple[str, ...] = BANDS
    #: Visits that may run at once, where their fields are apart.
    side_by_side: int = 1
    #: How the alerts among the outputs are sent; without it they lie in their table alone.
    delivery: Delivery | None = None
    #: Columns of a visit's rows without any value are not stored.
    drop_empty: bool = False
    #: Pixels around the image within which objects take part; sources that an object needs to be measured on later images.
    image_buffer: int = 10
    history_threshold: int = 2
    #: Names of the tables that a visit leaves under ``outputs``, of those in OUTPUTS.
    outputs: tuple[str, ...] = ()
    steps: Steps = field(default_factory=Steps)


#: Tables of a visit in the order in which they come to be.
OUTPUTS = ("solarSystemSources", "marginalSources", "associatedSources", "updatedObjects", "forcedSources", "alerts", "counts")


@dataclass(frozen=True)
class VisitInput:
    """What a visit may have besides its sources: its exposure, solar-system positions, and catalogs loaded ahead of it."""

    exposure: Exposure | None = None
    ephemerides: DataFrame | None = None
    preloaded: Loaded | None = None


@dataclass
class VisitResult:
    visit: int
    detector: int
    counts: dict[str, float]
    #: Seconds that each table of the visit took to be worked out and written, and ``catalog`` for the commit.
    steps: dict[str, float] = field(default_factory=dict)


class Outputs:
    """Tables that a visit makes. Each is written as soon as it exists and read back, so no step works out again what came before it.

    Those asked for lie in the folder of outputs, where they stay even if a later step fails; the others lie in a working folder
    beside the catalogs, which goes at the end. A repeated run replaces both.
    """

    def __init__(self, catalog: Catalog, path: str | None, names: tuple[str, ...], visit: int, detector: int):
        if unknown := [n for n in names if n not in OUTPUTS]:
            raise ValueError(f"a visit has no outputs {unknown}")
        if names and path is None:
            raise ValueError("outputs need a folder")
        self.seconds: dict[str, float] = {}
        self.catalog, self.path, self.names, self.run = catalog, path, names, f"run={visit}_{detector}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        at = f"{self.path}/{name}/{self.run}" if name in self.names else f"{self.catalog.path}/_work/{self.run}/{name}"
        began = time.time()
        df.write.mode("overwrite").parquet(at)
        self.seconds[name] = time.time() - began
        return df.sparkSession.read.schema(df.schema).parquet(at)

    def clear(self) -> None:
        self.catalog.remove(f"_work/{self.run}")


def region_of(sources: DataFrame) -> Polygon | None:
    """An octagon around the sources of one visit and detector, from their mean direction and the farthest of them; RA 0 and the poles are like any place."""
    x, y, z = unit_vector(F.col("ra"), F.col("dec"))
    placed = drop_unplaced(sources).select(x.alias("x"), y.alias("y"), z.alias("z"))
    centre = np.array([v or 0.0 for v in placed.agg(F.avg("x"), F.avg("y"), F.avg("z")).first()])
    if not centre.any():
        return None
    centre /= np.linalg.norm(centre)
    chord = placed.agg(F.max(F.sqrt(sum((F.col(c) - float(v)) ** 2 for c, v in zip("xyz", centre, strict=True))))).first()[0]
    angle = math.radians(1e-4) + 2 * math.asin(min(1.0, chord / 2)) / math.cos(math.pi / 8)
    if angle > math.radians(80):
        raise ValueError("the sources of a visit and detector lie all over the sky")
    one = np.cross(centre, np.eye(3)[np.abs(centre).argmin()])
    one /= np.linalg.norm(one)
    two = np.cross(centre, one)
    turns = [k * math.pi / 4 for k in range(8)]
    return Polygon.hull([math.cos(angle) * centre + math.sin(angle) * (math.cos(t) * one + math.sin(t) * two) for t in turns])


def ephemerides_of(ephemerides: DataFrame, visit: int, detector: int, mjd: float, exposure: Exposure | None) -> DataFrame:
    """Solar-system objects of a visit: positions worked out where they come as series, and only those in the image where it is known."""
    found = ephemerides
    for name, value in (("visit", visit), ("detector", detector)):
        if name in found.columns:
            found = found.where(F.col(name) == value).drop(name)
    if "ephRa" not in found.columns:
        found = solarsystem.positions(found, F.lit(mjd))
    if exposure is not None:
        ra, dec, radius = exposure.wcs.corners(exposure.box).bounding_circle()
        found = solarsystem.on_image(solarsystem.in_field(found, ra, dec, radius), exposure.wcs, exposure.box)
    return solarsystem.finished(found)


def process_visit(
    catalog: Catalog,
    sources: DataFrame,
    visit: int,
    detector: int,
    config: VisitConfig = VisitConfig(),
    after: Callable[[DataFrame, DataFrame], None] | None = None,
    given: VisitInput = VisitInput(),
    outputs: str | None = None,
) -> VisitResult | None:
    """One visit and detector: load or refresh the objects, match the solar system and then the objects, create, merge and
    summarise, measure forced fluxes, write; then alerts, counts and ``after(associated, objects)``.

    A visit that is DONE is left alone, so a replayed batch does no harm; one that is only WRITTEN failed after the write and is an error.
    Without an exposure no object is purged and nothing measured, and the region follows from the sources.
    """
    left, exposure, steps = Outputs(catalog, outputs, config.outputs, visit, detector), given.exposure, config.steps
    status = catalog.status(visit, detector)
    if status == DONE:
        return None
    if status == WRITTEN:
        raise AfterWriteError(f"visit {visit} detector {detector} was written but not finished")
    if exposure is not None and (faults := exposure.faults()):
        raise ValueError(f"visit {visit} detector {detector} can't be used: {', '.join(faults)}")
    started = time.time()
    ours = left.put("sources", sources.where((F.col("visit") == visit) & (F.col("detector") == detector)))
    try:
        if config.bands:
            check_bands(ours, config.bands)
        region = exposure.wcs.corners(exposure.box) if exposure is not None else region_of(ours)
        mjd = exposure.midpoint_mjd if exposure is not None else ours.agg(F.max("midpointMjdTai")).first()[0]
        if region is None:
            return None
        loaded = given.preloaded or catalog.load(region, mjd)
        if given.preloaded is not None:
            objects = catalog.refreshed(loaded.objects, region)
            loaded = Loaded(objects, catalog.load_sources(objects, mjd), catalog.load_forced(objects, mjd))
        objects = left.put("objects", loaded.objects if exposure is None else lifecycle.purge_off_image(loaded.objects, exposure.wcs, exposure.box, config.image_buffer))
        history = left.put("history", loaded.sources)

        solar, rest, known = conform(ours, "diaSource").limit(0), ours, None
        if given.ephemerides is not None:
            known = ephemerides_of(given.ephemerides, visit, detector, mjd, exposure)
            solar, rest = steps.solar(drop_unplaced(ours), known)
            solar = left.put("solarSystemSources", conform(solar.drop("diaObjectId").withColumn("diaObjectId", F.lit(0).cast("long")), "diaSource"))
        found = steps.associate(rest, objects, config.match)
        found = replace(found, labelled=left.put("labelled", found.labelled))
        created = lifecycle.create_objects(found.unmatched, config.quality, config.filter_quality)
        lifecycle.too_many_new(created.objects, config.most_new_objects)
        if "marginalSources" in config.outputs:
            left.put("marginalSources", conform(created.marginal, "diaSource"))
        associated = left.put("associatedSources", lifecycle.union_associated(solar, found.matched, created.sources))
        image = (exposure.wcs, exposure.box) if exposure is not None else (None, None)
        merged = lifecycle.merge_visit(history, associated, objects, created.objects, *image)
        # Only this visit's objects are written anew.
        changed = merged.objects.join(merged.updated_ids, "diaObjectId", "left_semi")
        summary = left.put("updatedObjects", conform(steps.summarize(changed, merged.sources, merged.updated_ids, list(config.statistics)), "diaObject"))
        measured = conform(empty_forced(ours.sparkSession), "diaForcedSource")
        if exposure is not None:
            current = lifecycle.refresh(merged.objects, summary)
            measured = left.put("forcedSources", steps.measure(current, merged.updated_ids, exposure, mjd, config.history_threshold))
        began = time.time()
        valid_from = catalog.write(visit, detector, mjd, summary, associated, measured, before=objects, drop_empty=config.drop_empty)
        left.seconds["catalog"] = time.time() - began
        try:
            summary_now = summary.withColumn("validityStartMjdTai", F.lit(valid_from))
            n_alerts = delay = NOT_PRODUCED
            sending: dict[str, int] = {}
            if "alerts" in config.outputs:
                about = None
                if known is not None:
                    about = solar.select("diaSourceId", "ssObjectId").join(known, "ssObjectId")
                past = loaded.forced if "midpointMjdTai" in loaded.forced.columns else conform(loaded.forced, "diaForcedSource")
                seen = None if exposure is None else alert_stamps(associated, exposure)
                packed = steps.package(associated, summary_now, history, past.unionByName(measured), about, threshold=config.history_threshold, stamps=seen)
                packed = left.put("alerts", packed)
                n_alerts = packed.count()
                if config.delivery is not None:
                    sending |= deliver(packed, config.delivery)
                if exposure is not None and exposure.shutter_close is not None:
                    delay = time.time() - exposure.shutter_close
            table = visit_counts(associated, created.sources, found.counts, None if known is None else known.select(F.lit(visit).cast("long").alias("visit"), F.lit(detector).alias("detector")))
            counts = left.put("counts", table).first()
            counts = counts.asDict() if counts is not None else {c: 0 for c in table.columns}
            if after is not None:
                after(associated, summary_now)
        except Exception as error:
            raise AfterWriteError(f"visit {visit} detector {detector}: {error}") from error
        catalog.log(visit, detector, DONE)
        counts = {k: v for k, v in counts.items() if k not in ("visit", "detector")}
        return VisitResult(visit, detector, counts | sending | {"numAlerts": n_alerts, "secondsSinceShutterClose": delay, "seconds": time.time() - started}, left.seconds)
    finally:
        left.clear()


def process_batch(catalog: Catalog, batch: DataFrame, config: VisitConfig = VisitConfig(), after: Callable[[DataFrame, DataFrame], None] | None = None, given: Callable[[int, int], VisitInput] = lambda visit, detector: VisitInput(), outputs: str | None = None) -> list[VisitResult]:
    """All visits of a batch in time order: a visit must see the objects that the one before created there. ``given`` finds what a visit has besides its sources.

    With ``side_by_side`` above one, visits whose fields are apart run at once (``rounds``), each in a thread that only waits for its Spark jobs.
    """

    def run(visit: int, detector: int) -> VisitResult | None:
        return process_visit(catalog, batch, visit, detector, config, after, given(visit, detector), outputs)

    if config.side_by_side > 1:
        results: list[VisitResult | None] = []
        with ThreadPoolExecutor(config.side_by_side) as threads:
            for at_once in plan_rounds(batch):
                started = [threads.submit(inheritable_thread_target(batch.sparkSession)(run), *v) for v in at_once]
                wait(started)  # all of a round end, also where one fails, before the error is raised
                results += [s.result() for s in started]
    else:
        visits = batch.groupBy("visit", "detector").agg(F.min("midpointMjdTai").alias("t")).orderBy("t", "visit", "detector").collect()
        results = [run(v["visit"], v["detector"]) for v in visits]
    catalog.merge_commits()
    return [r for r in results if r is not None]


def run_stream(
    spark: SparkSession,
    source_path: str,
    schema: str,
    catalog: Catalog,
    checkpoint: str,
    config: VisitConfig = VisitConfig(),
    after: Callable[[DataFrame, DataFrame], None] | None = None,
    given: Callable[[int, int], VisitInput] = lambda visit, detector: VisitInput(),
    outputs: str | None = None,
) -> list[VisitResult]:
    """Process every file of detections that has arrived under ``source_path`` and was not processed yet. ``given`` finds the exposure, the ephemerides and
    the preloaded catalogs of each visit."""
    results: list[VisitResult] = []
    stream = spark.readStream.schema(schema).parquet(source_path)
    query = stream.writeStream.foreachBatch(lambda batch, _: results.extend(process_batch(catalog, batch, config, after, given, outputs))).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return results


def match_stream(spark: SparkSession, source_path: str, schema, objects: DataFrame, out: str, checkpoint: str, config: MatchConfig = MatchConfig(), files_a_batch: int = 1) -> DataFrame:
    """Match every arriving file of detections against a fixed table of objects, all its visits at once; returns the matches so far.

    A visit must lie in one file. Batches are written under their number, so one that is run again replaces itself.
    """

    def run(batch: DataFrame, number: int) -> None:
        assign.match(batch, objects, config).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(source_path)
    stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*").drop("batch")
