"""The registered queries of this subpackage, each on its whole table, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import collocations, decontam, filter_audit, license_scan, mixing, near_dedup, quality, secret_scan, sharding, substring_dedup, token_codec, topk, toxicity
from .common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), shards=16)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The targets alone, which SQL can say."""
    docs = table(spark, sf_dir, "documents").select("source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.source_targets(docs.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumn("target", F.round("target", 4))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.report(table(spark, sf_dir, "documents"), k=2, threshold=80)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_codec.report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(table(spark, sf_dir, "documents"), width=35)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, share=50, top=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_sharding": op2_sharding,
    "op3_mixing": op3_mixing,
    "mixing_targets": mixing_targets,
    "op4_near_dedup": op4_near_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_quality": op6_quality,
    "op7_top_k": op7_top_k,
    "op8_toxicity": op8_toxicity,
    "op9_token_codec": op9_token_codec,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_secret_scan": op12_secret_scan,
    "op13_collocations": op13_collocations,
    "pipeline": corpus_pipeline.run,
}

_WORDS7 = """with q as (
  select row_number() over () as key, vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
)"""
OP3_SQL = """with recursive d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size from documents
), s as (
  select source, sum(size) as source_size, row_number() over (order by source nulls last) - 1 as i from d group by source
), w as (
  select source, cast(source_size as double) as cap0, 2.0e0 * source_size as cap, [3.0e0, 1.0e0, 2.0e0][1 + i % 3] as weight from s
), o as (
  select *, row_number() over (order by cap / weight, source nulls last) as k from w
), l as (
  select *, (1.5e0 * sum(cap0) over () - coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0))
    / (sum(weight) over () - coalesce(sum(weight) over (order by k rows between unbounded preceding and 1 preceding), 0)) as level from o
), f as (
  select arg_min(level, k) as level from l where level <= cap / weight
)
select o.source, cast(o.cap0 as bigint) as source_size, round(least(o.cap, f.level * o.weight), 4) as target from o, f"""
OP7_SQL = _WORDS7 + """, s as (
  select a.key, a.vec_id as query_id, b.vec_id, cast(list_inner_product(a.v, b.v) as bigint) as score
  from q a join q b on a.key <> b.key where a.vec_id % 100 = 0
), r as (
  select query_id, cast(row_number() over (partition by key order by score desc, vec_id) as integer) as rank, vec_id, score from s
)
select query_id, rank, vec_id, score from r where rank <= 10"""
OP10_SQL = """with w as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words from documents
), g as (
  select doc_id, p, list_slice(words, p, p + 34) as win from (select doc_id, words, unnest(range(1, len(words) - 33)) as p from w where len(words) >= 35)
), r as (
  select doc_id, p from (select doc_id, p, count(*) over (partition by win) as n from g) where n > 1
), c as (
  select distinct doc_id, unnest(range(p, p + 35)) as pos from r
), n as (
  select doc_id, count(*) as n, list(pos) as ats from c group by doc_id
)
select w.doc_id, cast(len(words) as bigint) as n_words, coalesce(n.n, 0) as n_removed,
  sha256(array_to_string(case when n.ats is null then words else list_transform(list_filter(range(1, len(words) + 1), lambda i: not list_contains(n.ats, i)), lambda i: words[i]) end, ' ')) as kept_sha256
from w left join n using (doc_id)"""
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _op1_sql() -> str:
    rows = ", ".join(f"({i}, '{label}', {str(base).lower()}, '{phrase}')" for i, (phrase, label, base) in enumerate([(p, x, True) for p, x in license_scan.BASE_PHRASES.items()] + [(p, x, False) for p, x in license_scan.NOTICES.items()]))
    return f"""with d as (select doc_id, {_ALNUM} as w from documents),
t as (select template, label, base, string_split(phrase, ' ') as w from (values {rows}) v(template, label, base, phrase)),
tp as (select template, label, base, len(w) as length, p - 1 as t_pos, w[p] as a, w[p + 1] as b from (select *, unnest(range(1, len(w))) as p from t)),
g as (select doc_id, p - 1 as pos, w[p] as a, w[p + 1] as b from (select doc_id, w, unnest(range(1, len(w))) as p from d where len(w) > 1)),
h as (select doc_id, template, label, base, length, t_pos, pos from g join tp on g.a = tp.a and g.b = tp.b),
n as (select *, unnest(case when base then [pos - t_pos] else range(pos - t_pos - {license_scan.MAX_SHIFT}, pos - t_pos + 1) end) as anchor from h),
c as (select doc_id, template, label, base, length, anchor, min(pos) as first, count(distinct word) as covered from (select *, unnest([t_pos, t_pos + 1]) as word from n) group by all),
f as (select * from c where case when base then covered = length else 100 * covered >= {round(100 * license_scan.MIN_COVER)} * length end),
o as (select *, case when base or (anchor - lag(anchor) over (partition by doc_id, template order by anchor) <= {license_scan.MAX_SHIFT}) is not true then 1 else 0 end as begins from f),
q as (select *, sum(begins) over (partition by doc_id, template order by anchor) as place from o),
r as (select doc_id, template, label, base, covered, first as start, length, row_number() over (partition by doc_id, template, place order by covered desc, anchor) as nth from q),
k as (select doc_id, label, base, start, covered / length as cover from (select *, max(case when not base then covered end) over (partition by doc_id, start) as most from r where nth = 1) where base or covered = most)
select d.doc_id, cast(len(any_value(d.w)) as bigint) as n_words, count(case when base then 1 end) as n_base, cast(min(case when base then start end) as bigint) as first_word, cast(max(case when base then start end) as bigint) as last_word,
  coalesce(array_to_string(list_sort(list(distinct case when base then label end) filter (where base)), ','), '') as base_labels, coalesce(array_to_string(list_sort(list(distinct label) filter (where label is not null)), ','), '') as labels,
  coalesce(max(cover), 0e0) as score from d left join k on d.doc_id = k.doc_id group by d.doc_id"""


OP4_SQL = f"""with recursive w as (
  select doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents
), s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) = 1 then [w[1]] else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as g from w
), n as (
  select doc_id, count(*) as n from s group by doc_id
), p as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all
), e as (
  select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)
), r as (
  select a, b from e union select r.a, e.b from r join e on r.b = e.a
), m as (
  select a, min(b) as b from r group by a
)
select w.doc_id, coalesce(n.n, 0) as n_shingles, least(w.doc_id, coalesce(m.b, w.doc_id)) as component_id, w.doc_id = least(w.doc_id, coalesce(m.b, w.doc_id)) as kept
from w left join n on n.doc_id = w.doc_id left join m on m.a = w.doc_id"""
OP5_SQL = f"""with w as (select doc_id, {_ALNUM} as w from documents), v as (select item_id, {_ALNUM} as w from benchmark),
i as (select item_id, w, least(len(w), 5) as k from v where len(w) > 0),
s as (select distinct doc_id, list_slice(w, p, p + k - 1) as g from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as p from w, (select distinct k from i) where len(w) >= k)),
t as (select distinct item_id, list_slice(w, p, p + k - 1) as g from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as p from i)),
n as (select item_id, count(*) as n from t group by item_id),
c as (select doc_id, item_id, count(*) as c from s join t on s.g = t.g group by doc_id, item_id)
select doc_id, c.item_id, n as n_shingles, c as n_common, c / n as containment from c join n on n.item_id = c.item_id where 100 * c >= 80 * n"""
OP11_SQL = """with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
    coalesce(min(doc_id) over (partition by coalesce(text, '')) < doc_id, false) as e from documents
), f as (
  select doc_id, part, case when len(w) < 100 then 'A' else '' end || case when 100 * len(list_distinct(w)) < 80 * len(w) then 'B' else '' end
    || case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) then 'C' else '' end || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end || case when e then 'E' else '' end as fails from d
), l as (
  select doc_id, bool_or(coalesce(quality = 1, false)) as good, bool_or(coalesce(toxic = 1, false)) as toxic from labels group by doc_id
), g as (
  select part, fails, coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n from f left join l using (doc_id) group by all
), x as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as c
), o as (
  select a.c || b.c || p.c || q.c || r.c as filter_order from x a, x b, x p, x q, x r where len(list_distinct([a.c, b.c, p.c, q.c, r.c])) = 5
), m as (
  select *, coalesce(list_min(list_transform(string_split(nullif(fails, ''), ''), lambda y: instr(filter_order, y))), 6) as gone from g, o
), s as (
  select part, filter_order, step, filter_order[step] as c, sum(case when gone > step then n else 0 end) as kept, sum(case when gone = step then n else 0 end) as removed,
    sum(case when gone < step and contains(fails, filter_order[step]) then n else 0 end) as redundant, sum(case when fails = filter_order[step] then n else 0 end) as unique_fails,
    sum(case when gone = step and good then n else 0 end) as good_lost, sum(case when gone = step and toxic then n else 0 end) as toxic_lost
  from m, (select unnest([1, 2, 3, 4, 5]) as step) group by all
)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, c) as bigint) as shapley from s"""
OP13_SQL = f"""with p as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents
), w as (
  select lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w from p
), f as (
  select lang, k, g, count(*) as f from (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_slice(w, i, i + k - 1))) as g from w, (select unnest([1, 2, 3]) as k)) group by all
), n as (
  select lang, sum(f) as n from f where k = 1 group by lang
), c as (
  select lang, k, g, f as a from f where k > 1 and f >= 10
), u as (
  select *, unnest(range(1, k)) as cut from c
), s as (
  select u.lang, u.g, u.k, a, cut, l.f as l, r.f as r, cast(1000000 as hugeint) * a * a // (cast(l.f as hugeint) * r.f) as score
  from u join f l on l.lang = u.lang and l.g = list_slice(u.g, 1, cut) join f r on r.lang = u.lang and r.g = list_slice(u.g, cut + 1, u.k)
), b as (
  select * from (select *, row_number() over (partition by lang, g order by score, cut) as nth from s) where nth = 1
), h as (
  select lang, g, max(a) as most from (select lang, a, unnest([list_slice(g, 1, 2), list_slice(g, 2, 3)]) as g from c where k = 3) group by all
), t as (
  select lang, array_to_string(g, ' ') as phrase, a, l, r, score from b left join h using (lang, g) where (100 * most >= 50 * a) is not true
), o as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from t
)
select o.lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score from o join n using (lang) where rank <= 2000"""
ORACLES: dict[str, str] = {
    "op1_license_scan": _op1_sql(),
    "op4_near_dedup": OP4_SQL,
    "op5_decontamination": OP5_SQL,
    "op7_top_k": OP7_SQL,
    "op10_substring_dedup": OP10_SQL,
    "op11_filter_audit": OP11_SQL,
    "op13_collocations": OP13_SQL,
    "mixing_targets": OP3_SQL,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
