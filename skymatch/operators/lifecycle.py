"""How objects begin, are updated, merged, purged and counted."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import Box, Wcs
from ..functions.nullsafe import null_if
from ..sources.schemas import KEYS, conform, quoted
from .filters import QualityConfig, quality_split


def first_values(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: in every column the first value that is not null, in the given order."""
    rest = [c for c in df.columns if c not in keys]
    at = f"struct({', '.join(map(quoted, order))})"
    firsts = [F.expr(f"min_by({c}, case when {c} is not null then {at} end) as {c}") for c in map(quoted, rest)]
    return df.groupBy(*keys).agg(*firsts).select(df.columns)


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first row as a whole, in the given order."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, table: str) -> None:
    """Keys that come twice, as after a replay, are an error."""
    if found := duplicate_keys(df, KEYS[table]).limit(5).collect():
        raise RuntimeError(f"{table} has duplicate keys, for example {found}")


def merge_catalogs(original: DataFrame, new: DataFrame, table: str) -> DataFrame:
    """History and the conformed new rows, with the columns of the history."""
    return original.unionByName(conform(new, table), allowMissingColumns=True).select(original.columns)


def refresh(preloaded: DataFrame, refreshed: DataFrame, key: str = "diaObjectId") -> DataFrame:
    """Refreshed objects, and those preloaded that were not refreshed."""
    return refreshed.unionByName(preloaded.join(refreshed.select(key), key, "left_anti"), allowMissingColumns=True)


def union_associated(*parts: DataFrame) -> DataFrame:
    """All associated sources, each part brought to the standard schema first."""
    return reduce(DataFrame.unionByName, (conform(p, "diaSource") for p in parts))


@dataclass
class Created:
    sources: DataFrame
    objects: DataFrame
    marginal: DataFrame


def create_objects(unmatched: DataFrame, config: QualityConfig = QualityConfig(), filter_quality: bool = True) -> Created:
    """Each good unmatched source founds an object that has its id; the others are marginal."""
    good, bad = quality_split(unmatched, config) if filter_quality else (unmatched, unmatched.where(F.lit(False)))
    named = good.withColumn("diaObjectId", F.col("diaSourceId"))
    return Created(named, conform(named, "diaObject").withColumn("nDiaSources", F.lit(1).cast("long")), bad)


def excess_new(created: DataFrame, most: int) -> DataFrame:
    """visit, detector and number of the sources that found objects there (``created``), where they are more than ``most``."""
    return created.groupBy("visit", "detector").agg(F.count("*").alias("n")).where(F.col("n") > most)


def too_many_new(created: DataFrame, most: int) -> None:
    """More new objects than ``most`` is an error, before anything is written; 0 turns the test off."""
    if most > 0 and (n := created.count()) > most:
        raise RuntimeError(f"{n} new objects, at most {most} are allowed")


def nullify_ids(df: DataFrame, *columns: str) -> DataFrame:
    """0, which stands for no id while sources are worked on, becomes null where they are stored."""
    return df.withColumns({c: null_if(F.col(c), 0) for c in columns})


def purge_off_image(objects: DataFrame, wcs: Wcs, box: Box, buffer: int) -> DataFrame:
    """Objects inside the box grown by ``buffer`` pixels (negative: shrunk)."""
    x, y = wcs.sky_to_pixel(F.col("ra"), F.col("dec"))
    return objects.where(F.coalesce(box.grown(buffer).contains(x, y), F.lit(False)))


def remaining_ids(ids: DataFrame, before: DataFrame, after: DataFrame, key: str = "diaObjectId") -> DataFrame:
    """``ids`` without those that a purge took out of ``before``; ids that it never held stay."""
    purged = before.select(key).join(after.select(key), key, "left_anti")
    return ids.join(purged, key, "left_anti")


def count_sources(objects: DataFrame, sources: DataFrame) -> DataFrame:
    """nDiaSources from the full history; null for an object without any."""
    n = sources.groupBy("diaObjectId").agg(F.count("*").alias("nDiaSources"))
    return objects.drop("nDiaSources").join(n, "diaObjectId", "left").select(objects.columns if "nDiaSources" in objects.columns else ["*"])


@dataclass
class Merged:
    sources: DataFrame
    objects: DataFrame
    updated_ids: DataFrame


def merge_visit(history: DataFrame, associated: DataFrame, objects: DataFrame, new_objects: DataFrame, wcs: Wcs | None = None, box: Box | None = None, check: bool = True) -> Merged:
    """One visit's sources and new objects merged into the catalogs: purge by one pixel inside the box, uniqueness, counts."""
    everything = objects.unionByName(new_objects, allowMissingColumns=True)
    ids = associated.where("diaObjectId <> 0").select("diaObjectId").distinct()
    kept = everything
    if wcs is not None and box is not None:
        kept = purge_off_image(everything, wcs, box, -1)
        ids = remaining_ids(ids, everything, kept)
    merged = merge_catalogs(history, associated, "diaSource")
    if check:
        require_unique(kept, "diaObject")
        require_unique(merged, "diaSource")
    return Merged(merged, count_sources(kept, merged), ids)
