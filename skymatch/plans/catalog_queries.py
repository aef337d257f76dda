"""Deduplication, set operations, object lifecycle, statistics, loads, alerts and the stream."""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.sql import functions as F

from ..functions import fits
from ..functions.geometry import Box, Polygon, Wcs
from ..operators import alerts, detections, forced, lifecycle, metrics, solarsystem, stamps, stats
from ..sources import store
from ..sources.schemas import conform, empty
from .fixtures import dia_objects, dia_sources, forced_sources, raw_detections, with_sql
from .match_queries import MATCHES

QUERIES: dict = {}
ORACLES: dict = {}
_SRC, _FORCED, _BOTH = with_sql("dia_object", "dia_source"), with_sql("forced"), with_sql("dia_object", "dia_source", "forced")
ORDER = ["partkey", "suppkey", "psfFlux", "midpointMjdTai", "scienceFlux", "scienceFluxErr", "visit"]
_BY = ", ".join(ORDER)


def _query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def _named(spark, d):
    """Sources with the object that they were made from."""
    return dia_sources(spark, d).withColumnRenamed("trueId", "diaObjectId")


@_query("dedup_first_nonnull", f"{_FORCED} select diaForcedSourceId, first(psfFlux order by {_BY}) as psfFlux, first(psfFluxErr order by {_BY}) filter (where psfFluxErr is not null) as psfFluxErr from forced group by diaForcedSourceId")
def dedup_first_nonnull(spark, d):
    return lifecycle.first_values(forced_sources(spark, d), ["diaForcedSourceId"], ORDER).select("diaForcedSourceId", "psfFlux", "psfFluxErr")


@_query("dedup_first_row", f"{_FORCED} select diaForcedSourceId, psfFlux, psfFluxErr from (select *, row_number() over (partition by diaForcedSourceId order by {_BY}) as n from forced) where n = 1")
def dedup_first_row(spark, d):
    return lifecycle.first_rows(forced_sources(spark, d), ["diaForcedSourceId"], ORDER).select("diaForcedSourceId", "psfFlux", "psfFluxErr")


@_query("duplicate_keys", f"{_FORCED} select diaForcedSourceId, count(*) as n from forced group by diaForcedSourceId having count(*) > 1")
def duplicate_keys(spark, d):
    return lifecycle.duplicate_keys(forced_sources(spark, d), ["diaForcedSourceId"])


@_query("merge_catalogs", f"{_SRC} select diaSourceId, diaObjectId, band, psfFlux, visit from (select diaSourceId, trueId as diaObjectId, band, cast(psfFlux as float) as psfFlux, visit from dia_source)")
def merge_catalogs(spark, d):
    s = _named(spark, d)
    history = conform(s.where("visit <= 15"), "diaSource").select("diaSourceId", "diaObjectId", "band", "psfFlux", "visit")
    return lifecycle.merge_catalogs(history, s.where("visit > 15"), "diaSource")


@_query("refresh_union", "{0} select diaObjectId, case when diaObjectId % 3 = 0 then dec + 1 else dec end as dec from dia_object where diaObjectId % 2 = 0 or diaObjectId % 3 = 0".format(with_sql("dia_object")))
def refresh_union(spark, d):
    o = dia_objects(spark, d).select("diaObjectId", "dec")
    return lifecycle.refresh(o.where("diaObjectId % 2 = 0"), o.where("diaObjectId % 3 = 0").withColumn("dec", F.col("dec") + 1))


@_query("associated_union", f"{_SRC} select diaSourceId, case when diaSourceId % 5 = 0 then null else trueId end as diaObjectId, cast(case when diaSourceId % 5 = 0 then 7 end as bigint) as ssObjectId, visit from dia_source")
def associated_union(spark, d):
    s = _named(spark, d)
    solar = s.where("diaSourceId % 5 = 0").drop("diaObjectId").withColumn("ssObjectId", F.lit(7))
    return lifecycle.union_associated(solar, s.where("diaSourceId % 5 <> 0")).select("diaSourceId", "diaObjectId", "ssObjectId", "visit")


@_query("object_counts", f"{_SRC} select o.diaObjectId, n.n as nDiaSources from dia_object o left join (select trueId, count(*) as n from dia_source group by trueId) n on o.diaObjectId = n.trueId")
def object_counts(spark, d):
    return lifecycle.count_sources(dia_objects(spark, d), _named(spark, d)).select("diaObjectId", "nDiaSources")


@_query("single_source_objects", f"{_SRC} select count(*) as totalUnassociatedDiaObjects from (select trueId from dia_source group by trueId having count(*) = 1)")
def single_source_objects(spark, d):
    return metrics.single_source_objects(lifecycle.count_sources(dia_objects(spark, d), _named(spark, d)))


WCS = Wcs((150.05, 2.03), (500.0, 500.0), ((-1e-4, 0.0), (0.0, 1e-4)))
BOX = Box(0, 0, 999, 799)
_S0, _C0 = math.sin(math.radians(2.03)), math.cos(math.radians(2.03))
_DEPTH = f"({_S0!r} * sin(radians(dec)) + {_C0!r} * cos(radians(dec)) * cos(radians(ra - 150.05e0)))"
_PX = f"(-degrees(cos(radians(dec)) * sin(radians(ra - 150.05e0)) / {_DEPTH}) / 1e-4 + 500e0)"
_PY = f"(degrees(({_C0!r} * sin(radians(dec)) - {_S0!r} * cos(radians(dec)) * cos(radians(ra - 150.05e0))) / {_DEPTH}) / 1e-4 + 500e0)"


@_query("purge_offimage", f"{with_sql('dia_object')} select diaObjectId from dia_object where {_PX} >= -10.5 and {_PX} < 1009.5 and {_PY} >= -10.5 and {_PY} < 809.5")
def purge_offimage(spark, d):
    return lifecycle.purge_off_image(dia_objects(spark, d), WCS, BOX, 10).select("diaObjectId")


@_query("sky_to_pixel", f"{with_sql('dia_object')} select diaObjectId, round({_PX}, 4) as x, round({_PY}, 4) as y from dia_object")
def sky_to_pixel(spark, d):
    x, y = WCS.sky_to_pixel(F.col("ra"), F.col("dec"))
    return dia_objects(spark, d).select("diaObjectId", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"))


@_query(
    "object_band_stats",
    f"""{_SRC} select trueId as diaObjectId, band, round(sum(psfFlux / (psfFluxErr * psfFluxErr)) / sum(1 / (psfFluxErr * psfFluxErr)), 6) as mean,
  round(sqrt(1 / sum(1 / (psfFluxErr * psfFluxErr))), 6) as meanErr, count(*) as n, round(stddev_samp(psfFlux), 5) as sigma, round(min(psfFlux), 6) as low, round(max(psfFlux), 6) as high, round(avg(psfFluxErr), 6) as errMean,
  round(sum(scienceFlux / (scienceFluxErr * scienceFluxErr)) / sum(1 / (scienceFluxErr * scienceFluxErr)), 6) as total from dia_source group by trueId, band""",
)
def object_band_stats(spark, d):
    wide = stats.band_statistics(_named(spark, d), ["meanFlux", "sigmaFlux", "minMaxFlux", "meanErrFlux", "meanTotFlux"])
    names = {"mean": "psfFluxMean", "meanErr": "psfFluxMeanErr", "n": "psfFluxNdata", "sigma": "psfFluxSigma", "low": "psfFluxMin", "high": "psfFluxMax", "errMean": "psfFluxErrMean", "total": "scienceFluxMean"}
    digits = {"sigma": 5}
    rows = F.array(*[F.struct(F.lit(b).alias("band"), *[(F.col(f"{b}_{c}") if o == "n" else F.round(f"{b}_{c}", digits.get(o, 6))).alias(o) for o, c in names.items()]) for b in "ugriz"])
    return wide.select("diaObjectId", F.explode(rows).alias("r")).select("diaObjectId", "r.*").where("n > 0")


@_query(
    "object_mean_position",
    f"""{_SRC}, m as (select trueId, avg(cos(radians(dec)) * cos(radians(ra))) as x, avg(cos(radians(dec)) * sin(radians(ra))) as y, avg(sin(radians(dec))) as z, count(*) as n from dia_source group by trueId)
select trueId as diaObjectId, round(((degrees(atan2(y, x)) % 360) + 360) % 360, 7) as ra, round(degrees(atan2(z, sqrt(x * x + y * y))), 7) as dec, n as nDiaSources from m""",
)
def object_mean_position(spark, d):
    return stats.mean_positions(_named(spark, d)).select("diaObjectId", F.round("ra", 7).alias("ra"), F.round("dec", 7).alias("dec"), "nDiaSources")


@_query(
    "max_slope",
    f"""{_SRC}, s as (select trueId, band, midpointMjdTai - lag(midpointMjdTai) over w as dt, psfFlux - lag(psfFlux) over w as df from dia_source window w as (partition by trueId, band order by midpointMjdTai, diaSourceId))
select trueId as diaObjectId, band, round(max(df / dt), 3) as slope from s where dt > 0 group by trueId, band""",
)
def max_slope(spark, d):
    wide = stats.band_statistics(_named(spark, d), ["maxSlopeFlux"])
    rows = F.array(*[F.struct(F.lit(b).alias("band"), F.round(f"{b}_psfFluxMaxSlope", 3).alias("slope")) for b in "ugriz"])
    return wide.select("diaObjectId", F.explode(rows).alias("r")).select("diaObjectId", "r.*").where("slope is not null")


REGION = Polygon.of_degrees([(150.0, 2.0), (150.06, 2.0), (150.08, 2.05), (150.01, 2.06)])


def _inside(region: Polygon) -> str:
    return " and ".join(f"cos(radians(dec)) * cos(radians(ra)) * ({float(n[0])!r}) + cos(radians(dec)) * sin(radians(ra)) * ({float(n[1])!r}) + sin(radians(dec)) * ({float(n[2])!r}) >= 0" for n in region.normals())


_INSIDE, _INSIDE_SMALL = _inside(REGION.padded(20.0)), _inside(REGION.padded(2.0))


@_query("load_objects_region", f"{with_sql('dia_object')} select diaObjectId from dia_object where {_INSIDE}")
def load_objects_region(spark, d):
    objects = dia_objects(spark, d).withColumn("cell", store.sky_cell(F.col("ra"), F.col("dec")))
    return store.in_region(objects.where(F.col("cell").isin(store.cells_of(REGION.padded(20.0)))), REGION.padded(20.0)).select("diaObjectId")


@_query(
    "load_history_asof",
    f"""{_SRC}, v as (select visit, max(midpointMjdTai) as t from dia_source group by visit)
select v.visit, count(*) as n, count(distinct trueId) as n_objects, round(max(s.midpointMjdTai), 6) as latest from v join dia_source s on s.midpointMjdTai < v.t and s.midpointMjdTai > v.t - 7 group by v.visit""",
)
def load_history_asof(spark, d):
    s = _named(spark, d)
    visits = s.groupBy("visit").agg(F.max("midpointMjdTai").alias("visitMjd"))
    found = store.history_as_of(visits, s.drop("visit"), 7.0)
    return found.groupBy("visit").agg(F.count("*").alias("n"), F.count_distinct("diaObjectId").alias("n_objects"), F.round(F.max("midpointMjdTai"), 6).alias("latest"))


#: A field per night, each elsewhere and 72 arcseconds wide.
_FIELDS = "select visit, max(midpointMjdTai) as visitMjd, 150e0 + (visit % 7) * 0.02e0 as fieldRa, 2e0 + (visit % 3) * 0.01e0 as fieldDec, 0.02e0 as fieldRadius from dia_source group by visit"


@_query(
    "history_in_fields",
    f"""{_SRC}, v as ({_FIELDS}), p as (select *, cos(radians(dec)) * cos(radians(ra)) as x, cos(radians(dec)) * sin(radians(ra)) as y, sin(radians(dec)) as z from dia_source),
w as (select *, cos(radians(fieldDec)) * cos(radians(fieldRa)) as fx, cos(radians(fieldDec)) * sin(radians(fieldRa)) as fy, sin(radians(fieldDec)) as fz from v)
select w.visit, p.diaSourceId, p.trueId as diaObjectId from w join p on p.midpointMjdTai < visitMjd and p.midpointMjdTai > visitMjd - 7
  and sqrt((x - fx) * (x - fx) + (y - fy) * (y - fy) + (z - fz) * (z - fz)) <= 2 * sin(radians(fieldRadius) / 2)""",
)
def history_in_fields(spark, d):
    """The sources of the week before in every night's field: joined by sky cell and week."""
    s = _named(spark, d)
    visits = s.groupBy("visit").agg(F.max("midpointMjdTai").alias("visitMjd"))
    fields = visits.withColumns({"fieldRa": F.lit(150.0) + (F.col("visit") % 7) * 0.02, "fieldDec": F.lit(2.0) + (F.col("visit") % 3) * 0.01, "fieldRadius": F.lit(0.02)})
    return store.history_in_fields(fields, s, 7.0, 0.02).select("visit", "diaSourceId", "diaObjectId")


@_query("catalog_versions", f"{_SRC} select 'third commit' as state, visit, count(*) as n from dia_source where visit < 18 group by visit union all select 'merged', visit, count(*) from dia_source group by visit")
def catalog_versions(spark, d):
    """The sources committed in five parts and merged; an older version is read beside the newest."""
    catalog, s = store.Catalog(spark, _checkpoint(spark), cell_degrees=0.02), _named(spark, d)
    objects, forced_none = dia_objects(spark, d), empty(spark, "diaForcedSource")
    versions = []
    for part in range(5):
        mine = s.where(F.floor(F.col("visit") / 6) == part) if part < 4 else s.where("visit >= 24")
        catalog.write(part, 0, 60000.0 + part, objects if part == 0 else objects.limit(0), mine, forced_none)
        versions.append(catalog.state().version)
    catalog.merge_commits(fan_in=5)
    count = lambda c, name: c.read("diaSource").groupBy("visit").agg(F.count("*").alias("n")).select(F.lit(name).alias("state"), "visit", "n")
    return count(catalog.at(versions[2]), "third commit").unionByName(count(catalog, "merged"))


@_query("load_forced", f"{_BOTH}, k as (select diaForcedSourceId, min(visit) as visit, min(diaObjectId) as oid from forced where midpointMjdTai < 56500 and midpointMjdTai > 56500 - 365 and diaObjectId in (select diaObjectId from dia_object) group by diaForcedSourceId) select count(*) as n, count(distinct oid) as n_objects from k")
def load_forced(spark, d):
    found = store.forced_before(forced_sources(spark, d), dia_objects(spark, d), 56500.0)
    return found.agg(F.count("*").alias("n"), F.count_distinct("diaObjectId").alias("n_objects"))


@_query("load_sources", f"{_SRC}, t as (select max(midpointMjdTai) as t from dia_source) select diaSourceId, trueId as diaObjectId, visit from dia_source, t where midpointMjdTai < t.t and midpointMjdTai > t.t - 365")
def load_sources(spark, d):
    s = _named(spark, d)
    return store.sources_before(s, dia_objects(spark, d), s.agg(F.max("midpointMjdTai")).first()[0]).select("diaSourceId", "diaObjectId", "visit")


def _checkpoint(spark) -> str:
    """A new folder that all executors share."""
    return f"{spark.conf.get('spark.checkpoint.dir', None) or spark.conf.get('spark.sql.warehouse.dir')}/skymatch-{uuid.uuid4().hex}"


@_query(
    "catalog_load",
    f"""{_BOTH}, o as (select diaObjectId from dia_object where {_INSIDE}), t as (select max(midpointMjdTai) as t from dia_source)
select 'diaObject' as stored, diaObjectId as oid, diaObjectId as id from o
union all select 'diaSource', trueId, diaSourceId from dia_source, t where midpointMjdTai < t.t and trueId in (select diaObjectId from o)
union all select distinct 'diaForcedSource', diaObjectId, diaForcedSourceId from forced, t where midpointMjdTai < t.t and midpointMjdTai > t.t - 365 and diaObjectId in (select diaObjectId from o)""",
)
def catalog_load(spark, d):
    """All tables committed to a catalog, and the objects of a region loaded from it with their history: cells and periods are pruned."""
    catalog, s = store.Catalog(spark, _checkpoint(spark), cell_degrees=0.02), _named(spark, d)
    placed = forced_sources(spark, d).withColumns({"ra": F.lit(150.0), "dec": F.lit(2.0)})
    catalog.write(1, 1, 0.0, dia_objects(spark, d), s, placed)
    found = catalog.load(REGION, s.agg(F.max("midpointMjdTai")).first()[0])
    tables = {"diaObject": found.objects, "diaSource": found.sources, "diaForcedSource": found.forced}
    parts = [df.select(F.lit(t).alias("stored"), F.col("diaObjectId").alias("oid"), F.col(f"{t}Id").alias("id")) for t, df in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@_query(
    "catalog_refresh",
    f"{with_sql('dia_object')} select diaObjectId, round(case when {_INSIDE_SMALL} then dec else dec + 1 end, 9) as dec from dia_object where diaObjectId % 2 = 0 or {_INSIDE_SMALL}",
)
def catalog_refresh(spark, d):
    """Half of the objects, loaded before with other declinations; those in the region are loaded anew."""
    catalog, o = store.Catalog(spark, _checkpoint(spark)), dia_objects(spark, d)
    catalog.write(1, 1, 0.0, o, empty(spark, "diaSource"), empty(spark, "diaForcedSource"))
    early = conform(o.where("diaObjectId % 2 = 0").withColumn("dec", F.col("dec") + 1), "diaObject")
    return catalog.refreshed(early, REGION).select("diaObjectId", F.round("dec", 9).alias("dec"))


@_query("exposure_region", f"{with_sql('dia_object')} select diaObjectId from dia_object where {_PX} >= 0 and {_PX} <= 999 and {_PY} >= 0 and {_PY} <= 799")
def exposure_region(spark, d):
    """Objects in the region of an image; great circles are straight lines of a tangent plane, so the box of pixels says the same."""
    return store.in_region(dia_objects(spark, d), WCS.corners(BOX)).select("diaObjectId")


@_query(
    "transform_sources",
    f"""{with_sql('raw')} select id as diaSourceId, visit, 'g' as band, round(degrees(coord_ra), 9) as ra, round(degrees(coord_dec), 9) as dec, cast(null as float) as psfFlux,
  round(cast(cast(ip_diffim_forced_PsfFlux_instFlux * 2e0 as float) as double), 2) as scienceFlux, cast(0 as bigint) as diaObjectId, base_PixelFlags_flag_crCenter as pixelFlags_crCenter, ext_trailedSources_Naive_flag_edge as trail_flag_edge
from raw where not coalesce(sky_source, false)""",
)
def transform_sources(spark, d):
    """Raw detections to standard sources, without those of the empty sky, flags under their standard names."""
    raw = raw_detections(spark, d).withColumns({"base_LocalPhotoCalib": F.lit(2.0), "base_LocalPhotoCalibErr": F.lit(0.1)})
    e = raw.select("visit", "detector").distinct().withColumns({"band": F.lit("g"), "midpointMjdTai": F.lit(60000.0)})
    names = ("base_PixelFlags_flag_crCenter", "ext_trailedSources_Naive_flag_edge")
    out = detections.transform(raw, e, 60100.0, detections.TransformConfig(remove_sky=True, flag_names=names))
    return out.select("diaSourceId", "visit", "band", F.round("ra", 9).alias("ra"), F.round("dec", 9).alias("dec"), "psfFlux", F.round(F.col("scienceFlux").cast("double"), 2).alias("scienceFlux"), "diaObjectId", "pixelFlags_crCenter", "trail_flag_edge")


@_query("forced_trim", f"{_BOTH}, f as (select f.diaForcedSourceId, f.diaObjectId, o.ra, o.dec from forced f join dia_object o on o.diaObjectId = f.diaObjectId), u as (select distinct trueId from dia_source) select diaForcedSourceId, count(*) as n from f where ({_PX} >= -0.5 and {_PX} < 999.5 and {_PY} >= -0.5 and {_PY} < 799.5) or diaObjectId in (select trueId from u) group by diaForcedSourceId")
def forced_trim(spark, d):
    placed = forced_sources(spark, d).join(dia_objects(spark, d).select("diaObjectId", "ra", "dec"), "diaObjectId")
    return forced.trim(placed, _named(spark, d), WCS, BOX).groupBy("diaForcedSourceId").agg(F.count("*").alias("n"))


@_query("ephemerides_on_image", f"{with_sql('dia_object')} select diaObjectId as ssObjectId from dia_object where {_PX} >= -20.5 and {_PX} < 1019.5 and {_PY} >= -20.5 and {_PY} < 819.5")
def ephemerides_on_image(spark, d):
    e = dia_objects(spark, d).select(F.col("diaObjectId").alias("ssObjectId"), F.col("ra").alias("ephRa"), F.col("dec").alias("ephDec"))
    return solarsystem.on_image(e, WCS, BOX, 20).select("ssObjectId")


@_query("enrich_constants", f"{with_sql('raw')} select id, visit, case when visit % 7 = 0 then null when visit % 2 = 0 then 'g' else 'r' end as band, case when visit % 7 <> 0 then 60000e0 + visit end as midpointMjdTai, 60100e0 as timeProcessedMjdTai, cast(0 as bigint) as diaObjectId from raw")
def enrich_constants(spark, d):
    raw = raw_detections(spark, d).withColumns({"band": F.lit("x"), "midpointMjdTai": F.lit(0.0)})
    e = raw.where("visit % 7 <> 0").select("visit", "detector").distinct().withColumns({"band": F.when(F.col("visit") % 2 == 0, "g").otherwise("r"), "midpointMjdTai": F.lit(60000.0) + F.col("visit")})
    return detections.enriched(raw, e, 60100.0).select("id", "visit", "band", "midpointMjdTai", "timeProcessedMjdTai", "diaObjectId")


@_query("peak_significance", f"{with_sql('raw')} select id, case when id % 4 = 0 then -1e0 else cast(id % 50 as double) end as snr from raw")
def peak_significance(spark, d):
    peaks = F.when(F.col("id") % 4 != 0, F.array(F.struct((F.col("id") % 50).cast("double").alias("significance")), F.struct(F.lit(99.0).alias("significance")))).otherwise(F.array().cast("array<struct<significance:double>>"))
    raw = raw_detections(spark, d).withColumn("footprint", F.struct(peaks.alias("peaks")))
    return raw.select("id", F.nanvl(detections.peak_significance(F.col("footprint")), F.lit(-1.0)).alias("snr"))


@_query("counter_text", f"{_SRC} select diaSourceId, case when glint_trail is not null then visit end as n from dia_source")
def counter_text(spark, d):
    return dia_sources(spark, d).select("diaSourceId", metrics.whole(F.when(F.col("glint_trail").isNotNull(), F.col("visit").cast("string"))).alias("n"))


@_query("designation_ids", f"{with_sql('dia_object')} select diaObjectId, 'K' || lpad(cast(diaObjectId % 100000 as varchar), 5, '0') as packed from dia_object")
def designation_ids(spark, d):
    """Packed designations to ids and back."""
    packed = F.concat(F.lit("K"), F.lpad((F.col("diaObjectId") % 100000).cast("string"), 5, "0"))
    return dia_objects(spark, d).select("diaObjectId", solarsystem.id_to_packed(solarsystem.packed_to_id(packed)).alias("packed"))


def _alerts(spark, d):
    """An alert for every source of every visit, with the history before it."""
    s = _named(spark, d)
    now = s.withColumn("diaObjectId", F.when(F.col("diaSourceId") % 6 == 0, F.lit(0).cast("long")).otherwise(F.col("diaObjectId")))
    objects = lifecycle.count_sources(dia_objects(spark, d), s)
    # An id belongs to one object, so rows go to the task of their object once, for their copies and for the lists.
    forced = lifecycle.first_rows(forced_sources(spark, d).repartition("diaObjectId"), ["diaObjectId", "diaForcedSourceId"], ORDER).drop("partkey", "suppkey")
    solar = now.where("diaObjectId = 0").select("diaSourceId", F.lit(5).cast("long").alias("ssObjectId"), F.lit("2015 MK4").alias("MPCORB_unpacked_primary_provisional_designation"), F.lit(1.5).alias("MPCORB_q"))
    return alerts.assemble(now, objects, s, forced, solar, as_of=True)


_ALERT = f"""{_BOTH}, a as (select *, case when diaSourceId % 6 = 0 then 0 else trueId end as oid, rank() over (partition by trueId order by midpointMjdTai) - 1 as past from dia_source),
c as (select trueId, count(*) as n from dia_source group by trueId),
f as (select diaObjectId, count(distinct diaForcedSourceId) as n from forced group by diaObjectId)"""


@_query(
    "alert_history_sizes",
    f"""{_ALERT} select diaSourceId, case when oid <> 0 and c.n > 1 then past else -1 end as n_history, case when oid <> 0 and c.n >= 2 then coalesce(f.n, 0) else 0 end as n_forced
from a left join c on c.trueId = oid left join f on f.diaObjectId = oid""",
)
def alert_history_sizes(spark, d):
    n = lambda c: F.coalesce(F.size(c), F.lit(-1)).cast("long")
    return _alerts(spark, d).select("diaSourceId", F.when(F.col("prvDiaSources").isNull(), F.lit(-1).cast("long")).otherwise(n("prvDiaSources")).alias("n_history"), n("prvDiaForcedSources").alias("n_forced"))


@_query(
    "alert_assembly",
    f"""{_ALERT} select diaSourceId, nullif(oid, 0) as objectId, c.n as nDiaSources, case when oid = 0 then 5 end as ssObjectId, case when oid = 0 then '2015MK4' end as packed, case when oid = 0 then 1.5e0 end as q, round(psfFlux, 6) as psfFlux
from a left join c on c.trueId = oid""",
)
def alert_assembly(spark, d):
    return _alerts(spark, d).select(
        "diaSourceId",
        F.col("diaObject.diaObjectId").alias("objectId"),
        F.col("diaObject.nDiaSources").alias("nDiaSources"),
        F.col("ssSource.ssObjectId").cast("int").alias("ssObjectId"),
        F.col("MPCORB.packed_primary_provisional_designation").alias("packed"),
        F.col("MPCORB.q").alias("q"),
        F.round("diaSource.psfFlux", 6).alias("psfFlux"),
    )


@_query(
    "alert_files",
    f"""{_ALERT} select diaSourceId, visit, detector, 703 as programId, nullif(oid, 0) as objectId, c.n as nDiaSources, case when oid <> 0 and c.n > 1 then past else -1 end as n_history, case when oid = 0 then '2015MK4' end as packed, round(psfFlux, 6) as psfFlux
from a left join c on c.trueId = oid""",
)
def alert_files(spark, d):
    """Every alert, written to an Avro container per visit and detector and read back from the files' bytes."""
    from ..sources import containers

    folder = f"{_checkpoint(spark)}/alerts"
    made = alerts.with_program(_alerts(spark, d), 703)
    containers.write_alert_files(made, folder, counted=dia_sources(spark, d).select("visit", "detector"))
    source, history = F.col("diaSource"), F.col("prvDiaSources")
    read = made.select("diaSourceId", "diaSource", "prvDiaSources", "diaObject", "MPCORB", "programId").schema
    return containers.read_alert_files(spark, folder, read).select(
        "diaSourceId",
        source["visit"].alias("visit"),
        source["detector"].alias("detector"),
        "programId",
        F.col("diaObject.diaObjectId").alias("objectId"),
        F.col("diaObject.nDiaSources").alias("nDiaSources"),
        F.when(history.isNull(), -1).otherwise(F.size(history)).cast("long").alias("n_history"),
        F.col("MPCORB.packed_primary_provisional_designation").alias("packed"),
        F.round("diaSource.psfFlux", 6).alias("psfFlux"),
    )


@_query(
    "solar_match",
    f"""{_SRC}, e as (select diaObjectId as ssObjectId, 1 + diaObjectId % 31 as visit, case when diaObjectId % 50 = 0 then 90e0 else 2e0 end as err, cos(radians(dec)) * cos(radians(ra)) as x, cos(radians(dec)) * sin(radians(ra)) as y, sin(radians(dec)) as z, dec from dia_object),
s as (select visit, diaSourceId, cos(radians(dec)) * cos(radians(ra)) as x, cos(radians(dec)) * sin(radians(ra)) as y, sin(radians(dec)) as z, dec from dia_source),
p as (select ssObjectId, diaSourceId, err, sqrt((s.x - e.x) * (s.x - e.x) + (s.y - e.y) * (s.y - e.y) + (s.z - e.z) * (s.z - e.z)) as c from e join s on s.visit = e.visit and s.dec between e.dec - 0.03 and e.dec + 0.03),
a as (select *, row_number() over (partition by ssObjectId order by c, diaSourceId) as n from p where c <= radians(err / 3600)),
b as (select *, row_number() over (partition by diaSourceId order by c, ssObjectId) as m from a where n = 1)
select diaSourceId, ssObjectId from b where m = 1""",
)
def solar_match(spark, d):
    """Every object in one visit; one in fifty has a position error beyond the width of the common cells."""
    error = F.when(F.col("diaObjectId") % 50 == 0, 90.0).otherwise(2.0)
    visit = (1 + F.col("diaObjectId") % 31).alias("visit")
    ephemerides = dia_objects(spark, d).select(F.col("diaObjectId").alias("ssObjectId"), visit, F.lit(0).alias("detector"), F.col("ra").alias("ephRa"), F.col("dec").alias("ephDec"), error.alias("Err(arcsec)"))
    return solarsystem.match(dia_sources(spark, d), ephemerides).select("diaSourceId", "ssObjectId")


@_query(
    "exposure_faults",
    f"{with_sql('raw')} select visit, case when visit % 3 = 0 and visit % 4 = 0 then 'no band,no rotation' when visit % 3 = 0 then 'no band' else 'no rotation' end as faults from (select distinct visit from raw) where visit % 3 = 0 or visit % 4 = 0",
)
def exposure_faults(spark, d):
    e = raw_detections(spark, d).select("visit", "detector").distinct()
    full = {c: F.lit(1.0) for c in ("calibration", "crval", "min_x", "psf_sigma", "date_mjd", "boresight_ra")}
    e = e.withColumns(full | {"band": F.when(F.col("visit") % 3 != 0, "g"), "rotation": F.when(F.col("visit") % 4 != 0, 1.0)})
    return detections.exposure_faults(e).select("visit", F.array_join("faults", ",").alias("faults"))


@_query(
    "alert_cutouts",
    f"""{with_sql('raw')}, c as (select id, visit, cast(floor(x / 10 + 0.5) as bigint) as a, cast(floor(y / 10 + 0.5) as bigint) as b, 30 + id % 9 as e from raw),
p as (select id, visit, e, a - e // 2 + dx as px, b - e // 2 + dy as py from c, (select unnest(range(0, 38)) as dx), (select unnest(range(0, 38)) as dy) where a <= 99 and b <= 99 and dx < e and dy < e)
select id, cast(any_value(e) as bigint) as side, count(*) as n, cast(sum(2 * ((px * 3 + py * 7 + visit) % 101)) as bigint) as total from p where px between 0 and 99 and py between 0 and 99 group by id""",
)
def alert_cutouts(spark, d):
    """A stamp of every raw detection on an image per visit that is worked out from its number; side, pixels on the image and their sum as read from the FITS bytes."""
    raw = raw_detections(spark, d)
    grid = F.sequence(F.lit(0).cast("long"), F.lit(9999).cast("long"))
    pixels = F.transform(grid, lambda p: ((p % 100 * 3 + F.floor(p / 100) * 7 + F.col("visit")) % 101).cast("double"))
    images = raw.select("visit", "detector").distinct().select("visit", "detector", F.lit(100).alias("width"), pixels.alias("pixels"), F.array_repeat(F.lit(1.0), 10_000).alias("variance"))
    flat = F.array(*map(F.lit, (-1e-4, 0.0, 0.0, 1e-4)))
    at = raw.select("visit", "detector", "id", (F.col("x") / 10).alias("x"), (F.col("y") / 10).alias("y"), (30 + F.col("id") % 9).cast("int").alias("extent"), F.lit(150.0).alias("ra"), F.lit(2.0).alias("dec"), flat.alias("matrix"))
    about = forced.Exposure(0, 0, "g", 60000.0, WCS, Box(0, 0, 99, 99), calibration=2.0)

    def measured(batches):
        for df in batches:
            firsts = [fits.first_pixels(bytes(b)) for b in df["stamp"]]
            yield df[["id"]].assign(side=[len(p) for p in firsts], n=[int(np.isfinite(p).sum()) for p in firsts], total=[int(np.nansum(p)) for p in firsts])

    return stamps.stamps(at, images, about).where("stamp is not null").mapInPandas(measured, "id long, side long, n long, total long")


@_query(
    "visit_conflicts",
    f"""{_SRC}, p as (select visit, (trueId - 1) // 3 % 50 as detector, cos(radians(dec)) * cos(radians(ra)) as x, cos(radians(dec)) * sin(radians(ra)) as y, sin(radians(dec)) as z from dia_source),
m as (select visit, detector, avg(x) as x, avg(y) as y, avg(z) as z from p group by visit, detector),
c as (select visit, detector, x / sqrt(x * x + y * y + z * z) as x, y / sqrt(x * x + y * y + z * z) as y, z / sqrt(x * x + y * y + z * z) as z from m),
f as (select c.visit, c.detector, any_value(c.x) as x, any_value(c.y) as y, any_value(c.z) as z, 2 * asin(max(sqrt((p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y) + (p.z - c.z) * (p.z - c.z))) / 2) as angle
  from c join p on p.visit = c.visit and p.detector = c.detector group by c.visit, c.detector)
select a.visit, a.detector, b.visit as visit2, b.detector as detector2 from f a join f b on (a.visit, a.detector) < (b.visit, b.detector)
where 2 * asin(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) / 2) <= a.angle + b.angle + radians(5 / 3600)""",
)
def visit_conflicts(spark, d):
    """Fields of fifty detectors a night that touch within five arcseconds, which can't be worked on side by side."""
    from ..streaming import rounds

    s = dia_sources(spark, d)
    return rounds.conflicts(rounds.fields_of(s.withColumn("detector", F.expr("(trueId - 1) div 3 % 50"))), margin=5.0)


@_query(
    "stream_statistics",
    f"""{_SRC}, s as (select *, midpointMjdTai - lag(midpointMjdTai) over w as dt, psfFlux - lag(psfFlux) over w as df from dia_source window w as (partition by trueId, band order by midpointMjdTai, diaSourceId))
select trueId as diaObjectId, band, round(sum(psfFlux / (psfFluxErr * psfFluxErr)) / sum(1 / (psfFluxErr * psfFluxErr)), 6) as mean, count(*) as n, round(stddev_samp(psfFlux), 5) as sigma, round(min(psfFlux), 6) as low, round(max(psfFlux), 6) as high,
  round(max(case when dt > 0 then df / dt end), 3) as slope, round(sum(scienceFlux / (scienceFluxErr * scienceFluxErr)) / sum(1 / (scienceFluxErr * scienceFluxErr)), 6) as total from s group by trueId, band""",
)
def stream_statistics(spark, d):
    """All sources as a stream of files that mix early and late visits; the state's statistics at its end."""
    from ..streaming.state import statistics_stream

    root, s = _checkpoint(spark), _named(spark, d)
    s.repartition(4, F.hash("diaSourceId")).write.parquet(f"{root}/in")
    found = statistics_stream(spark, f"{root}/in", s.schema, f"{root}/out", f"{root}/checkpoint", groups=64).where("band is not null")
    named = {"mean": "psfFluxMean", "sigma": "psfFluxSigma", "low": "psfFluxMin", "high": "psfFluxMax", "slope": "psfFluxMaxSlope", "total": "scienceFluxMean"}
    digits = {"sigma": 5, "slope": 3}
    return found.select("diaObjectId", "band", F.col("psfFluxNdata").alias("n"), *[F.round(c, digits.get(o, 6)).alias(o) for o, c in named.items()])


@_query("stream_visits", f"{MATCHES} select m.visit, m.diaSourceId, m.diaObjectId, round(p.score, 3) as score from m join p on p.diaSourceId = m.diaSourceId and p.diaObjectId = m.diaObjectId")
def stream_visits(spark, d):
    """All sources as a stream of files, a visit never split, matched batch by batch against the objects."""
    from ..streaming.visits import match_stream

    root = _checkpoint(spark)
    s = dia_sources(spark, d).drop("trueId")
    s.repartitionByRange(4, "visit").write.parquet(f"{root}/in")
    found = match_stream(spark, f"{root}/in", s.schema, dia_objects(spark, d), f"{root}/out", f"{root}/checkpoint")
    return found.select("visit", "diaSourceId", "diaObjectId", F.round("score", 3).alias("score"))
