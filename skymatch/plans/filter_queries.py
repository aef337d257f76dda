"""Filters, splits and column functions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import flags, geometry, photometry
from ..functions.nullsafe import ieee_div
from ..operators import alerts, detections, filters, lifecycle, solarsystem
from .fixtures import dia_objects, dia_sources, raw_detections, with_sql

QUERIES: dict = {}
ORACLES: dict = {}
CONFIG = filters.FilterConfig()

_RAW, _SRC = with_sql("raw"), with_sql("dia_object", "dia_source")
_FLAG = "(coalesce(base_PixelFlags_flag_crCenter, false) or coalesce(base_PixelFlags_flag_high_varianceCenterAll, false))"
_FLUX, _ERR, _LEN = "ip_diffim_forced_PsfFlux_instFlux", "ip_diffim_forced_PsfFlux_instFluxErr", "ext_trailedSources_Naive_length"
_SNR = f"coalesce(case when {_ERR} = 0 then {_FLUX} < 0 else {_FLUX} / {_ERR} < -2.0 end, false)"
_TRAIL = f"""(coalesce(not isnan({_LEN}) and {_LEN} >= most, false) or coalesce(ext_trailedSources_Naive_flag_off_image, false)
  or (coalesce(ext_trailedSources_Naive_flag_suspect_long_trail, false) and coalesce(ext_trailedSources_Naive_flag_edge, false)))"""
_FOOT = "(ext_trailedSources_Naive_flag and sqrt(cast((maxX - minX + 1) * (maxX - minX + 1) + (maxY - minY + 1) * (maxY - minY + 1) as double)) >= most)"
#: Per visit the scale by the law of cosines, and the longest trail in pixels; one visit in four has no exposure.
_SCALE = f"""{_RAW}, l as (select visit, arg_min(struct_pack(x := x, y := y, a := coord_ra, d := coord_dec), x * 1e9 + id) as l, count(*) as n from raw group by visit),
q as (select raw.visit, x, y, id, coord_ra, coord_dec, l.l, l.n, sqrt((x - l.l.x) * (x - l.l.x) + (y - l.l.y) * (y - l.l.y)) as px from raw join l on raw.visit = l.visit),
m as (select visit, arg_max(struct_pack(a := coord_ra, d := coord_dec, px := px, l := l, n := n), struct_pack(px := px, id := id)) as f from q group by visit),
s as (select visit, f, degrees(acos(least(greatest(sin(f.d) * sin(f.l.d) + cos(f.d) * cos(f.l.d) * cos(f.a - f.l.a), -1e0), 1e0))) * 3600 as sep from m),
z as (select visit, case when f.n > 1 and f.px > 0 and abs(sep / f.px - 0.2e0) / 0.2e0 <= 0.1e0 then sep / f.px else 0.2e0 end as scale from s)"""
_LIMITED = f"""{_SCALE}, t as (select raw.*, {CONFIG.max_trail_rate!r} * (case when raw.visit % 4 = 0 then {CONFIG.exposure_time!r} else 20.3e0 + raw.visit end) / z.scale as most from raw join z on z.visit = raw.visit)"""


def _query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def _boxed(df):
    return df.withColumn("footprint", F.struct("minX", "minY", "maxX", "maxY"))


@_query("filter_sky", f"{_RAW} select id from raw where not coalesce(sky_source, false)")
def filter_sky(spark, d):
    raw = raw_detections(spark, d)
    return raw.where(~filters.sky_mask(raw)).select("id")


@_query("filter_flags", f"{_RAW} select id from raw where not {_FLAG}")
def filter_flags(spark, d):
    return raw_detections(spark, d).where(~filters.flag_mask(CONFIG.bad_flags)).select("id")


@_query("filter_snr", f"{_RAW} select id from raw where {_SNR}")
def filter_snr(spark, d):
    return raw_detections(spark, d).where(filters.snr_mask(CONFIG.flux, CONFIG.min_snr)).select("id")


def _exposures(raw):
    return raw.where("visit % 4 <> 0").select("visit", "detector", (F.lit(20.3) + F.col("visit")).alias("exposureTime")).distinct()


@_query("filter_trail", f"{_LIMITED} select id from t where {_TRAIL}")
def filter_trail(spark, d):
    raw = raw_detections(spark, d)
    return filters.with_trail_limit(raw, CONFIG, _exposures(raw)).where(filters.trail_mask(F.col("_trail_limit"))).select("id")


@_query("filter_footprint", f"{_LIMITED} select id from t where {_FOOT}")
def filter_footprint(spark, d):
    raw = _boxed(raw_detections(spark, d))
    return filters.with_trail_limit(raw, CONFIG, _exposures(raw)).where(filters.footprint_trail_mask(F.col("_trail_limit"))).select("id")


@_query(
    "filter_three_way",
    f"""{_LIMITED}, c as (select id, {_FLAG} or {_SNR} as rejected, {_TRAIL} or {_FOOT} as long from t)
select id, 'kept' as part from c where not rejected and not long union all select id, 'rejected' from c where rejected union all select id, 'long' from c where long""",
)
def filter_three_way(spark, d):
    raw = _boxed(raw_detections(spark, d))
    t = filters.three_way(raw, exposures=_exposures(raw))
    part = lambda df, name: df.select("id", F.lit(name).alias("part"))
    return part(t.kept, "kept").unionByName(part(t.rejected, "rejected")).unionByName(part(t.long_trailed, "long"))


@_query(
    "filter_attribution",
    f"""{_LIMITED} select reason, count(*) as n from (select case when coalesce(sky_source, false) then 'sky' when {_FLAG} then 'flags' when {_SNR} then 'snr' when {_TRAIL} or {_FOOT} then 'trail' end as reason from t)
where reason is not null group by reason""",
)
def filter_attribution(spark, d):
    raw = _boxed(raw_detections(spark, d))
    return filters.attribution(raw, filters.FilterConfig(remove_sky=True), _exposures(raw))


@_query(
    "pixel_scale",
    f"{_SCALE} select visit, round(scale, 5) as pixel_scale from z",
)
def pixel_scale(spark, d):
    return filters.catalog_pixel_scale(raw_detections(spark, d)).select("visit", F.round("pixel_scale", 5).alias("pixel_scale"))


_LOW = "coalesce(not isnan(reliability) and reliability < 0.3, false)"


@_query("reliability_split", f"{_SRC} select diaSourceId, {_LOW} as low from dia_source")
def reliability_split(spark, d):
    kept, low = filters.reliability_split(dia_sources(spark, d), 0.3)
    return kept.select("diaSourceId", F.lit(False).alias("low")).unionByName(low.select("diaSourceId", F.lit(True).alias("low")))


QUALITY = filters.QualityConfig(bad_flags=("glint_trail",), snr=20.0, low_reliability_snr=60.0, reliability=0.1, low_snr_reliability=0.4, flux="psfFlux")


@_query(
    "quality_split",
    f"""{_SRC} select diaSourceId, coalesce(glint_trail, false) or coalesce(abs(psfFlux / psfFluxErr) < 20, false) or coalesce(not isnan(reliability) and reliability < 0.1, false)
  or (coalesce(abs(psfFlux / psfFluxErr) < 60, false) and coalesce(not isnan(reliability) and reliability < 0.4, false)) as marginal from dia_source""",
)
def quality_split(spark, d):
    good, bad = filters.quality_split(dia_sources(spark, d), QUALITY)
    return good.select("diaSourceId", F.lit(False).alias("marginal")).unionByName(bad.select("diaSourceId", F.lit(True).alias("marginal")))


@_query(
    "good_objects",
    f"""{_SRC} select o.diaObjectId from dia_object o where diaObjectId in (select trueId from dia_source
  where not isnan(reliability) and reliability >= 0.5 and trailLength <= 1.4 and not coalesce(glint_trail, true) and not coalesce(isDipole, true) group by trueId having count(*) >= 2)""",
)
def good_objects(spark, d):
    return filters.good_objects(dia_objects(spark, d), dia_sources(spark, d).withColumnRenamed("trueId", "diaObjectId")).select("diaObjectId")


@_query("null_position_drop", f"{_SRC} select diaSourceId from (select diaSourceId, case when diaSourceId % 5 = 0 then null when diaSourceId % 7 = 0 then 'NaN'::double else ra end as ra from dia_source) where ra is not null and not isnan(ra)")
def null_position_drop(spark, d):
    from ..operators.crossmatch import drop_unplaced

    holed = dia_sources(spark, d).withColumn("ra", F.when(F.col("diaSourceId") % 5 == 0, None).when(F.col("diaSourceId") % 7 == 0, float("nan")).otherwise(F.col("ra")))
    return drop_unplaced(holed).select("diaSourceId")


def _flagged(df):
    return df.select("id", *[(F.col("id") % (b + 2) == 0).alias(n) for n, b in flags.FLAG_BITS.items()])


_PACKED = " + ".join(f"(case when id % {b + 2} = 0 then {1 << b} else 0 end)" for b in flags.FLAG_BITS.values())


@_query("flag_pack", f"{_RAW} select id, cast({_PACKED} as bigint) as flags from raw")
def flag_pack(spark, d):
    return _flagged(raw_detections(spark, d)).select("id", flags.pack().alias("flags"))


@_query("flag_unpack", f"{_RAW} select id, id % 4 = 0 as edge, id % 38 = 0 as trail from raw")
def flag_unpack(spark, d):
    packed = _flagged(raw_detections(spark, d)).select("id", flags.pack().alias("flags"))
    return flags.PackedFlags().unpack(packed).select("id", F.col("base_PixelFlags_flag_edge").alias("edge"), F.col("ext_trailedSources_Naive_flag").alias("trail"))


@_query("flag_mask", f"{_RAW} select id from raw where id % 7 = 0 or id % 14 = 0 or id % 19 = 0")
def flag_mask(spark, d):
    mask = flags.PackedFlags().mask(["base_PixelFlags_flag_cr", "slot_Centroid_flag", "slot_PsfFlux_flag"])
    return _flagged(raw_detections(spark, d)).select("id", flags.pack().alias("flags")).where(F.col("flags").bitwiseAND(F.lit(mask)) != 0).select("id")


_SIZE = """least(cast(ceil(2 * greatest(abs(maxX - x), abs(minX - x), abs(maxY - y), abs(minY - y))) as bigint), 2 * greatest(maxX - minX + 1, maxY - minY + 1))"""


@_query("bbox_size", f"{_RAW} select id, cast({_SIZE} as bigint) as bboxSize from raw")
def bbox_size(spark, d):
    return _boxed(raw_detections(spark, d)).select("id", detections.bbox_size(F.col("x"), F.col("y"), F.col("footprint")).cast("long").alias("bboxSize"))


@_query("cutout_extent", f"{_RAW} select id, cast(least(greatest({_SIZE}, 30), 102) as bigint) as extent from raw")
def cutout_extent(spark, d):
    size = detections.bbox_size(F.col("x"), F.col("y"), F.col("footprint")).cast("long")
    return _boxed(raw_detections(spark, d)).select("id", alerts.cutout_extent(size).cast("long").alias("extent"))


@_query("flux_calibrate", f"{_RAW} select id, round({_FLUX} * 1.5e0, 6) as flux, round(sqrt(pow({_ERR} * 1.5e0, 2) + pow({_FLUX} * 0.1e0, 2)), 6) as fluxErr from raw")
def flux_calibrate(spark, d):
    raw = raw_detections(spark, d).withColumns({photometry.CALIB: F.lit(1.5), photometry.CALIB_ERR: F.lit(0.1)})
    return raw.select("id", F.round(photometry.flux(_FLUX), 6).alias("flux"), F.round(photometry.flux_error(_ERR, _FLUX), 6).alias("fluxErr"))


_CD = (5.1e-05, 1.8e-07, -8.2e-07, -5.1e-05)


def _with_cd(df):
    return df.withColumns({n: F.lit(v) for n, v in zip(photometry.CD, _CD, strict=True)})


_PX = f"(sqrt(abs({_CD[0]!r} * {_CD[3]!r} - {_CD[1]!r} * {_CD[2]!r})) * 3600e0)".replace("- -", "+ ")


@_query("pixel_to_arcsec", f"{_RAW} select id, round(x * {_PX}, 6) as length, round(y * {_PX} * {_PX}, 6) as moment from raw")
def pixel_to_arcsec(spark, d):
    f = photometry.FUNCTORS
    return _with_cd(raw_detections(spark, d)).select("id", F.round(f["ConvertPixelToArcseconds"]("x"), 6).alias("length"), F.round(f["ConvertPixelSqToArcsecondsSq"]("y"), 6).alias("moment"))


@_query(
    "position_angle",
    f"""{_RAW} select id, round(((degrees(atan2(({_CD[0]!r}) * cos(x / 150) + ({_CD[1]!r}) * sin(x / 150), ({_CD[2]!r}) * cos(x / 150) + ({_CD[3]!r}) * sin(x / 150))) % 360) + 360) % 360, 5) as angle from raw""",
)
def position_angle(spark, d):
    df = _with_cd(raw_detections(spark, d).withColumn("a", F.col("x") / 150))
    return df.select("id", F.round(photometry.FUNCTORS["ConvertDetectorAngleToPositionAngle"]("a"), 5).alias("angle"))


@_query("dipole_flux", f"{_RAW} select id, round((abs(x) + abs(-y)) * 2e0 / 2, 6) as mean, round((abs(x) - abs(-y)) * 2e0, 6) as diff, round(sqrt(x * x + y * y) * 2e0 / 2, 6) as meanErr from raw")
def dipole_flux(spark, d):
    f = photometry.FUNCTORS
    df = raw_detections(spark, d).withColumns({"p_pos_instFlux": F.col("x"), "p_neg_instFlux": -F.col("y"), "p_pos_instFluxErr": F.col("x"), "p_neg_instFluxErr": F.col("y"), photometry.CALIB: F.lit(2.0)})
    return df.select("id", F.round(f["LocalDipoleMeanFlux"]("p"), 6).alias("mean"), F.round(f["LocalDipoleDiffFlux"]("p"), 6).alias("diff"), F.round(f["LocalDipoleMeanFluxErr"]("p"), 6).alias("meanErr"))


@_query("ieee_division", f"{_RAW} select id, case when {_ERR} = 0 then (case when {_FLUX} > 0 then 'inf' when {_FLUX} < 0 then '-inf' else 'nan' end) else 'finite' end as kind from raw")
def ieee_division(spark, d):
    q = ieee_div(F.col(_FLUX), F.col(_ERR))
    kind = F.when(F.isnan(q), "nan").when(q == float("inf"), "inf").when(q == float("-inf"), "-inf").otherwise("finite")
    return raw_detections(spark, d).select("id", kind.alias("kind"))


@_query("timespan_midpoint", f"{_RAW} select id, round(case when id % 3 = 0 then x else x + (x + y - x) / 2 end, 6) as mid from raw")
def timespan_midpoint(spark, d):
    end = F.when(F.col("id") % 3 == 0, None).otherwise(F.col("x") + F.col("y"))
    return raw_detections(spark, d).select("id", F.round(detections.midpoint(F.col("x"), end, allow_unbounded=True), 6).alias("mid"))


@_query("id_nullify", f"{_RAW} select id, nullif(id % 4, 0) as a, nullif(id % 5, 0) as b from raw")
def id_nullify(spark, d):
    return lifecycle.nullify_ids(raw_detections(spark, d).select("id", (F.col("id") % 4).alias("a"), (F.col("id") % 5).alias("b")), "a", "b")


_T = "((id % 201 - 100) / 100e0)"


@_query("chebyshev_eval", f"{_RAW} select id, round(1 + 2 * {_T} + x / 100 * (2 * {_T} * {_T} - 1) - 0.5e0 * (4 * {_T} * {_T} * {_T} - 3 * {_T}), 6) as v from raw")
def chebyshev_eval(spark, d):
    t = (F.col("id") % 201 - 100) / F.lit(100.0)
    return raw_detections(spark, d).select("id", F.round(solarsystem.chebyshev(F.array(F.lit(1.0), F.lit(2.0), F.col("x") / 100, F.lit(-0.5)), t), 6).alias("v"))


@_query("confluent_header", f"{_RAW} select id, '00' || lpad(hex(id), 8, '0') || hex(cast(id as varchar)) as message from raw")
def confluent_header(spark, d):
    return raw_detections(spark, d).select("id", F.hex(alerts.confluent(F.col("id"), F.col("id").cast("string").cast("binary"))).alias("message"))


_CONE = (150.05, 2.01, 0.03)
_C = geometry.vector(*_CONE[:2])


@_query("cone_filter", f"{_SRC} select diaSourceId from dia_source where cos(radians(dec)) * cos(radians(ra)) * {float(_C[0])!r} + cos(radians(dec)) * sin(radians(ra)) * {float(_C[1])!r} + sin(radians(dec)) * {float(_C[2])!r} >= {math.cos(math.radians(_CONE[2]))!r}")
def cone_filter(spark, d):
    return dia_sources(spark, d).where(geometry.in_cone(F.col("ra"), F.col("dec"), *_CONE)).select("diaSourceId")
