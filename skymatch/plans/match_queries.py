"""Range join, scores, assignment and counts."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import assign, crossmatch, filters, lifecycle, metrics
from ..sources.schemas import conform, empty
from .fixtures import dia_objects, dia_sources, with_sql

QUERIES: dict = {}
ORACLES: dict = {}
R = math.radians(1 / 3600)
FLOOR, FALLBACK = (0.05 / 3600) ** 2, 0.2 / 3600

_VECTORS = """sv as (select *, cos(radians(dec)) * cos(radians(ra)) as x, cos(radians(dec)) * sin(radians(ra)) as y, sin(radians(dec)) as z from dia_source),
ov as (select *, cos(radians(dec)) * cos(radians(ra)) as x, cos(radians(dec)) * sin(radians(ra)) as y, sin(radians(dec)) as z from dia_object)"""
_CHORD = "sqrt((s.x - o.x) * (s.x - o.x) + (s.y - o.y) * (s.y - o.y) + (s.z - o.z) * (s.z - o.z))"


def _use(c: str) -> str:
    return f"(case when {c} is not null and not isnan({c}) and {c} > 0 then {c} else {FALLBACK!r} end)"


def _var(c: str) -> str:
    return f"greatest({_use(f's.{c}')} * {_use(f's.{c}')} + {_use(f'o.{c}')} * {_use(f'o.{c}')}, {FLOOR!r})"


_DRA = "((((s.ra - o.ra + 180) % 360) + 360) % 360 - 180)"
_NLL = f"0.5 * ({_DRA} * {_DRA} / {_var('raErr')} + (s.dec - o.dec) * (s.dec - o.dec) / {_var('decErr')}) + 0.5 * ln({_var('raErr')} * {_var('decErr')})"
PAIRS = f"""{with_sql("dia_object", "dia_source", recursive=True)}, {_VECTORS},
p as (select s.visit, s.diaSourceId, o.diaObjectId, {_CHORD} as chord, {_NLL} as score
  from sv s join ov o on s.dec between o.dec - 0.001 and o.dec + 0.001 and {_CHORD} <= {R!r})"""


def _query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def _catalogs(spark, d):
    return dia_sources(spark, d), dia_objects(spark, d)


@_query("xmatch_candidates", f"{PAIRS} select visit, diaSourceId, diaObjectId, round(chord * 1e6, 4) as chord_urad from p")
def xmatch_candidates(spark, d):
    return crossmatch.candidates(*_catalogs(spark, d)).select("visit", "diaSourceId", "diaObjectId", F.round(F.col("chord") * 1e6, 4).alias("chord_urad"))


@_query("xmatch_nll", f"{PAIRS} select visit, diaSourceId, diaObjectId, round(score, 3) as score from p")
def xmatch_nll(spark, d):
    return crossmatch.scored(*_catalogs(spark, d)).select("visit", "diaSourceId", "diaObjectId", F.round("score", 3).alias("score"))


@_query("xmatch_chord", f"{PAIRS} select visit, diaSourceId, diaObjectId, round(chord * 1e6, 4) as score from p")
def xmatch_chord(spark, d):
    sources, objects = _catalogs(spark, d)
    return crossmatch.scored(sources, objects.drop("raErr")).select("visit", "diaSourceId", "diaObjectId", F.round(F.col("score") * 1e6, 4).alias("score"))


@_query(
    "xmatch_error_mode",
    f"""{with_sql("dia_object", "dia_source")}, o as (select coalesce(bool_or(raErr > 0), false) and coalesce(bool_or(decErr > 0), false) as ok from dia_object)
select visit, coalesce(bool_or(raErr > 0), false) and coalesce(bool_or(decErr > 0), false) and any_value(o.ok) as by_likelihood from dia_source, o group by visit""",
)
def xmatch_error_mode(spark, d):
    return crossmatch.error_modes(*_catalogs(spark, d)).select("visit", "by_likelihood")


@_query("xmatch_unmatched_cost", f"{PAIRS} select visit, round(max(score) + 1, 3) as unmatched from p group by visit")
def xmatch_unmatched_cost(spark, d):
    return crossmatch.unmatched_cost(crossmatch.scored(*_catalogs(spark, d))).select("visit", F.round("unmatched", 3).alias("unmatched"))


#: Every order of taking or leaving the sources of a group of objects; the cheapest wins. Groups never share a pair.
MATCHES = f"""{PAIRS},
u as (select visit, max(score) + 1 as u from p group by visit),
s as (select visit, (diaObjectId - 1) // 3 as cell, diaSourceId, diaObjectId, score, dense_rank() over (partition by visit, (diaObjectId - 1) // 3 order by diaSourceId) as k from p),
n as (select visit, cell, max(k) as n from s group by visit, cell),
choice as (
  select visit, cell, k, diaObjectId as o, score as cost, diaSourceId as src from s
  union all
  select distinct s.visit, cell, k, cast(null as bigint), u.u, diaSourceId from s join u on s.visit = u.visit
),
walk as (
  select visit, cell, cast(0 as bigint) as k, cast([] as bigint[]) as used, cast([] as bigint[]) as picked, cast(0 as double) as cost from n
  union all
  select w.visit, w.cell, w.k + 1, case when c.o is null then w.used else list_append(w.used, c.o) end,
    case when c.o is null then w.picked else list_append(w.picked, c.src) end, w.cost + c.cost
  from walk w join choice c on c.visit = w.visit and c.cell = w.cell and c.k = w.k + 1 where c.o is null or not list_contains(w.used, c.o)
),
best as (select w.visit, w.cell, arg_min(used, cost) as used, arg_min(picked, cost) as picked from walk w join n on n.visit = w.visit and n.cell = w.cell and n.n = w.k group by w.visit, w.cell),
m as (select visit, unnest(picked) as diaSourceId, unnest(used) as diaObjectId from best)"""


@_query("assign_matches", f"{MATCHES} select m.visit, m.diaSourceId, m.diaObjectId, round(p.score, 3) as score from m join p on p.diaSourceId = m.diaSourceId and p.diaObjectId = m.diaObjectId")
def assign_matches(spark, d):
    return assign.match(*_catalogs(spark, d)).select("visit", "diaSourceId", "diaObjectId", F.round("score", 3).alias("score"))


#: The same with a week's nights as one visit: components of many sources, and four visits for all of them.
_WEEK = "cast((day(ts) - 1) // 8 + 1 as bigint) as visit"


@_query("assign_crowded", f"{MATCHES.replace('cast(day(ts) as bigint) as visit', _WEEK)} select m.visit, m.diaSourceId, m.diaObjectId, round(p.score, 3) as score from m join p on p.diaSourceId = m.diaSourceId and p.diaObjectId = m.diaObjectId")
def assign_crowded(spark, d):
    sources, objects = _catalogs(spark, d)
    crowded = sources.withColumn("visit", F.floor((F.col("visit") - 1) / 8) + 1)
    return assign.match(crowded, objects).select("visit", "diaSourceId", "diaObjectId", F.round("score", 3).alias("score"))


@_query(
    "assign_counts",
    f"""{MATCHES}, t as (select visit, count(*) as n from dia_source group by visit), mm as (select visit, count(*) as n from m group by visit)
select t.visit, coalesce(mm.n, 0) as n_updated, t.n - coalesce(mm.n, 0) as n_unmatched, (select count(*) from dia_object) - coalesce(mm.n, 0) as n_unassociated
from t left join mm on t.visit = mm.visit""",
)
def assign_counts(spark, d):
    c = assign.associate(*_catalogs(spark, d)).counts
    return c.select("visit", F.col("nUpdatedDiaObjects").alias("n_updated"), F.col("nUnmatchedDiaSources").alias("n_unmatched"), F.col("nUnassociatedDiaObjects").alias("n_unassociated"))


@_query("assign_unmatched", f"{MATCHES} select visit, diaSourceId from dia_source where diaSourceId not in (select diaSourceId from m)")
def assign_unmatched(spark, d):
    return assign.associate(*_catalogs(spark, d)).unmatched.select("visit", "diaSourceId")


#: Good sources that no object was matched with found new objects.
GOOD = "not coalesce(glint_trail, false) and not coalesce(not isnan(reliability) and reliability < 0.1, false)"
QUALITY = filters.QualityConfig(bad_flags=("glint_trail",), reliability=0.1, flux="psfFlux")
NEW = f"{MATCHES}, new as (select * from dia_source where diaSourceId not in (select diaSourceId from m) and {GOOD})"
_COUNTS = f"""{NEW}, c as (select t.visit, coalesce(u.n, 0) as numUpdatedDiaObjects, (select count(*) from dia_object) - coalesce(u.n, 0) as numUnassociatedDiaObjects,
  coalesce(k.n, 0) as numNewDiaObjects, coalesce(e.n, 0) as numTotalSolarSystemObjects, coalesce(a.n, 0) as numAssociatedSsObjects
  from (select distinct visit from dia_source) t left join (select visit, count(*) as n from m group by visit) u on u.visit = t.visit
  left join (select visit, count(*) as n from new group by visit) k on k.visit = t.visit left join (select 1 + diaObjectId % 31 as visit, count(*) as n from dia_object group by all) e on e.visit = t.visit
  left join (select visit, count(*) as n from m where diaSourceId % 5 = 0 group by visit) a on a.visit = t.visit)"""


def _counts(spark, d):
    """Counts of all visits from the association, the new objects, and made-up ids of the solar system."""
    sources, objects = _catalogs(spark, d)
    found = assign.associate(sources, objects)
    made = lifecycle.create_objects(found.unmatched.drop("trueId"), QUALITY)
    associated = found.matched.withColumn("ssObjectId", F.when(F.col("diaSourceId") % 5 == 0, F.lit(7)).otherwise(F.lit(0)))
    ephemerides = objects.select((1 + F.col("diaObjectId") % 31).alias("visit"), F.lit(0).alias("detector"))
    return metrics.visit_counts(associated, made.sources, found.counts, ephemerides)


@_query("frac_updated", f"{_COUNTS} select visit, round(case when numUpdatedDiaObjects > 0 or numUnassociatedDiaObjects > 0 then numUpdatedDiaObjects / (numUpdatedDiaObjects + numUnassociatedDiaObjects) end, 9) as frac from c")
def frac_updated(spark, d):
    return _counts(spark, d).select("visit", F.round(metrics.fraction_updated(), 9).alias("frac"))


@_query(
    "visit_metrics",
    f"""{_COUNTS} select visit, metric, round(value, 9) as value from (
  select visit, 'numNewDiaObjects' as metric, cast(numNewDiaObjects as double) as value from c union all
  select visit, 'numUnassociatedDiaObjects', cast(numUnassociatedDiaObjects as double) from c union all
  select visit, 'fracUpdatedDiaObjects', numUpdatedDiaObjects / (numUpdatedDiaObjects + numUnassociatedDiaObjects) from c union all
  select visit, 'numTotalSolarSystemObjects', cast(numTotalSolarSystemObjects as double) from c union all select visit, 'numAssociatedSsObjects', cast(numAssociatedSsObjects as double) from c)""",
)
def visit_metrics(spark, d):
    return metrics.metrics(_counts(spark, d)).select("visit", "metric", F.round("value", 9).alias("value"))


@_query("create_objects", f"{NEW} select diaSourceId as diaObjectId, round(ra, 9) as ra, round(dec, 9) as dec, cast(1 as bigint) as nDiaSources from new")
def create_objects(spark, d):
    made = lifecycle.create_objects(assign.associate(*_catalogs(spark, d)).unmatched.drop("trueId"), QUALITY)
    return made.objects.select("diaObjectId", F.round("ra", 9).alias("ra"), F.round("dec", 9).alias("dec"), "nDiaSources")


@_query("new_object_guard", f"{NEW} select visit, count(*) as n from new group by visit having count(*) > 3")
def new_object_guard(spark, d):
    made = lifecycle.create_objects(assign.associate(*_catalogs(spark, d)).unmatched.drop("trueId"), QUALITY)
    return lifecycle.excess_new(made.sources, 3).select("visit", "n")


@_query(
    "merge_visit",
    f"""{NEW}, a as (select diaSourceId, diaObjectId from m union all select diaSourceId, diaSourceId from new), o as (select diaObjectId from dia_object union select diaSourceId from new)
select o.diaObjectId, count(a.diaSourceId) as nDiaSources, count(a.diaSourceId) > 0 as updated from o left join a on a.diaObjectId = o.diaObjectId group by o.diaObjectId""",
)
def merge_visit(spark, d):
    """All sources and new objects merged into an empty history and all objects. A made-up id that both a source and an object have is one object."""
    sources, objects = _catalogs(spark, d)
    found = assign.associate(sources, objects)
    made = lifecycle.create_objects(found.unmatched.drop("trueId"), QUALITY)
    associated = lifecycle.union_associated(found.matched, made.sources)
    merged = lifecycle.merge_visit(empty(spark, "diaSource"), associated, conform(objects, "diaObject"), made.objects.join(objects.select("diaObjectId"), "diaObjectId", "left_anti"))
    updated = merged.updated_ids.withColumn("updated", F.lit(True))
    return merged.objects.join(updated, "diaObjectId", "left").select("diaObjectId", F.coalesce("nDiaSources", F.lit(0)).alias("nDiaSources"), F.coalesce("updated", F.lit(False)).alias("updated"))
