"""Sky catalogs worked out from the star-schema tables by arithmetic that Spark and other engines do alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: One row per customer: three objects close together, groups 10 arcseconds apart.
OBJECTS = """select c_custkey + 1 as diaObjectId,
  150.0e0 + ((c_custkey // 3) % 50) * 10e0 / 3600e0 + ((c_custkey % 3) * 0.4e0 - 0.4e0) / 3600e0 as ra,
  2.0e0 + ((c_custkey // 3) // 50) * 10e0 / 3600e0 + ((c_custkey % 2) * 0.3e0) / 3600e0 as dec,
  case when c_custkey % 11 = 0 then null else (0.05e0 + 0.05e0 * (c_custkey % 7)) / 3600e0 end as raErr,
  case when c_custkey % 13 = 0 then null else (0.05e0 + 0.05e0 * (c_custkey % 5)) / 3600e0 end as decErr
from customer"""
#: One row per event, near the object user_id * 10 + event_id % 10 + 1; one in 23 has none.
SOURCES = """select event_id + 1 as diaSourceId, cast(day(ts) as bigint) as visit, cast(0 as integer) as detector, o.diaObjectId as trueId,
  case event_type when 'click' then 'u' when 'view' then 'g' when 'purchase' then 'r' when 'signup' then 'i' else 'z' end as band,
  o.ra + (((event_id * 37) % 101 - 50) / 50e0) * 0.6e0 / 3600e0 as ra,
  o.dec + (((event_id * 53) % 103 - 51) / 51e0) * 0.6e0 / 3600e0 + (case when event_id % 23 = 0 then 5e0 else 0e0 end) / 3600e0 as dec,
  case when event_id % 17 = 0 then null else (0.04e0 + 0.02e0 * (event_id % 6)) / 3600e0 end as raErr,
  case when event_id % 19 = 0 then null else (0.04e0 + 0.02e0 * (event_id % 4)) / 3600e0 end as decErr,
  value * 10e0 as psfFlux, cast(1 + event_id % 9 as double) as psfFluxErr, value * 8e0 as scienceFlux, cast(2 + event_id % 7 as double) as scienceFluxErr,
  EPOCH / 86400e6 + 40587e0 as midpointMjdTai,
  case when event_id % 97 = 0 then null when event_id % 89 = 0 then NOTANUMBER else (event_id * 17 % 100) / 100e0 end as reliability,
  (event_id * 29 % 200) / 100e0 as trailLength,
  case when event_id % 83 = 0 then null else event_id % 7 = 0 end as glint_trail,
  case when event_id % 79 = 0 then null else event_id % 13 = 0 end as isDipole
from events e join dia_object o on o.diaObjectId = e.user_id * 10 + e.event_id % 10 + 1"""
#: Raw detections of one row per event, on a grid of 0.2 arcseconds per pixel.
RAW = """select event_id as id, cast(day(ts) as bigint) as visit, cast(0 as integer) as detector,
  case when event_id % 97 = 0 then null else event_id % 11 = 0 end as sky_source,
  event_id % 13 = 0 as base_PixelFlags_flag_crCenter,
  case when event_id % 59 = 0 then null else event_id % 29 = 0 end as base_PixelFlags_flag_high_varianceCenterAll,
  value * 10e0 - 400e0 as ip_diffim_forced_PsfFlux_instFlux,
  cast(event_id % 5 * 20 as double) as ip_diffim_forced_PsfFlux_instFluxErr,
  case when event_id % 89 = 0 then NOTANUMBER when event_id % 71 = 0 then null else (event_id * 29 % 700) / 10e0 end as ext_trailedSources_Naive_length,
  event_id % 31 = 0 as ext_trailedSources_Naive_flag_off_image,
  case when event_id % 61 = 0 then null else event_id % 7 = 0 end as ext_trailedSources_Naive_flag_suspect_long_trail,
  event_id % 5 = 0 as ext_trailedSources_Naive_flag_edge,
  event_id % 3 = 0 as ext_trailedSources_Naive_flag,
  cast(event_id * 37 % 1000 as double) as x, cast(event_id * 53 % 1000 as double) as y,
  radians(150e0 + (event_id * 37 % 1000) * 0.2e0 / 3600e0) as coord_ra, radians((event_id * 53 % 1000) * 0.2e0 / 3600e0) as coord_dec,
  event_id * 37 % 1000 - event_id % 40 as minX, event_id * 37 % 1000 + event_id % 25 as maxX,
  event_id * 53 % 1000 - event_id % 30 as minY, event_id * 53 % 1000 + event_id % 45 as maxY
from events"""
#: Measurements of one row per line item, with repeated keys.
FORCED = """select l_orderkey * 10 + l_linenumber as diaForcedSourceId, l_orderkey % 1500 + 1 as diaObjectId, l_partkey % 30 + 1 as visit,
  l_quantity as psfFlux, case when l_partkey % 5 = 0 then null else l_extendedprice end as psfFluxErr, l_discount as scienceFlux, l_tax as scienceFluxErr,
  56000e0 + l_suppkey % 700 as midpointMjdTai, l_partkey as partkey, l_suppkey as suppkey
from lineitem"""


def _spark(text: str) -> str:
    return text.replace("//", "div").replace("EPOCH", "unix_micros(cast(ts as timestamp))").replace("NOTANUMBER", "double('NaN')")


def _plain(text: str) -> str:
    return text.replace("EPOCH", "epoch_us(ts)").replace("NOTANUMBER", "'NaN'::double")


#: The same as common table expressions.
SQL = {"dia_object": _plain(OBJECTS), "dia_source": _plain(SOURCES), "raw": _plain(RAW), "forced": _plain(FORCED)}


def with_sql(*names: str, recursive: bool = False) -> str:
    """``with`` clause that defines the named catalogs; sources need objects."""
    return ("with recursive " if recursive else "with ") + ", ".join(f"{n} as ({SQL[n]})" for n in names)


def _view(spark: SparkSession, sf_dir: str, text: str, **frames: DataFrame) -> DataFrame:
    """Run SQL over tables of ``sf_dir`` and the given frames."""
    names = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("customer", "events", "lineitem") if f"from {n}" in text}
    text = _spark(text)
    for n in [*names, *frames]:
        for lead in ("from ", "join "):
            text = text.replace(f"{lead}{n}", f"{lead}{{{n}}}")
    return spark.sql(text, **names, **frames)


def dia_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, OBJECTS)


def dia_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SOURCES, dia_object=dia_objects(spark, sf_dir))


def raw_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, RAW)


def forced_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, FORCED)
