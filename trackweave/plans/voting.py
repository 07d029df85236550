"""Registered queries: answers, votes, decisions, selectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as sc
from ..operators import votes as vt
from .fixtures import ctes, relation
from .registry import query

V, O, L = ctes("votes"), ctes("obs"), ctes("layers")  # noqa: E741

_A02 = """lv as (select clip_id, tid, label, sum(w) lw, count(*) ln from votes where w > 0 and label is not null and verdict <> 'not_person' group by 1, 2, 3),
  lt as (select clip_id, tid, sum(lw) weight, sum(ln)::bigint n from lv group by 1, 2),
  a02 as (select clip_id, tid, label, (lw / weight + ln / n) / 2 share, weight, n from lv join lt using (clip_id, tid) qualify row_number() over (partition by clip_id, tid order by (lw / weight + ln / n) / 2 desc, label) = 1)"""
_A03 = """a03 as (select clip_id, tid, count(*) judged, count(verdict) valid, avg(case when verdict = 'not_person' then 1.0::double when verdict is not null then 0.0::double end) not_person,
  avg(case when verdict = 'depiction' then 1.0::double when verdict is not null then 0.0::double end) depiction, avg(case when verdict = 'real_person' then 1.0::double when verdict is not null then 0.0::double end) real_person from votes group by 1, 2)"""
_A04 = """a04 as (select clip_id, tid, sum(case when age_group = 'child' then w else 0.0 end) / sum(w) child_share, quantile_cont(age, 0.5) median_age from votes where w > 0 and verdict <> 'not_person' and age_group is not null group by 1, 2)"""
_A05 = f"""{_A02}, {_A03}, {_A04},
  d0 as (select *, case when valid = 0 then 'no_valid_answers' when not_person >= 0.5 then 'not_person' when depiction >= 0.5 then 'depiction' end dropped, case when child_share is not null then child_share >= 0.5 and median_age <= 12 end child
    from a03 left join a02 using (clip_id, tid) left join a04 using (clip_id, tid)),
  a05 as (select clip_id, tid, judged, valid, dropped, case when dropped is null then label end as label, share, weight, child,
    case when dropped is not null then '' else array_to_string(list_filter([case when real_person < 0.75 then 'person_margin' end, case when label is null then 'no_label' end, case when share < 0.75 then 'label_margin' end, case when weight < 2.0 then 'low_weight' end,
      case when not child and (child_share >= 0.3 or median_age <= 15) then 'age_split' end], lambda x: x is not null), ',') end reasons from d0)"""


@query("p10_crop_weight", f"""{O} select clip_id, tid, f, case when eid%10/10.0::double < 0.25 or y2 - y1 < 110 then 0.0::double else (case when eid%3=0 then 2.0 else 1.0 end)::double * (case when eid%10/10.0::double < 0.5 then 0.5 else 1.0 end)::double * (case when y2 - y1 < 150 then 0.5 else 1.0 end)::double end w from obs""")
def _(spark, d):
    return relation(spark, d, "obs").select("clip_id", "tid", "f", sc.crop_weight((F.col("eid") % 10) / F.lit(10.0), F.col("y2") - F.col("y1"), F.col("eid") % 3 == 0, 0.25, 110.0).alias("w"))


_TEXT = """'Sure: ' || case when event_id % 7 = 0 then 'no object' else replace(
  '{"verdict": "' || case event_id % 4 when 0 then ' Real_Person' when 1 then 'depiction' when 2 then 'unknown' else 'not_person ' end || '", "label": "' || case when event_id % 3 = 0 then 'A' else 'b' end || '", "age": "' || case when event_id % 11 = 0 then 'n/a' else cast(event_id % 90 as varchar) end || '"}',
  case when event_id % 5 = 0 then '"' else '~' end, case when event_id % 5 = 0 then chr(39) else '~' end) end || ' Thanks {'"""
_RAW = f"raw as (select event_id, {_TEXT} as text from events)"


def _raw(spark, d):
    """Free-text answers around an object; some with single quotes, some without any object."""
    return relation(spark, d, "events").selectExpr("event_id", _TEXT.replace("varchar", "string") + " as text")


_P15 = """b as (select event_id, regexp_extract(text, '(?s)\\{.*?\\}') body from raw), j as (select event_id, case when json_valid(body) then body when json_valid(replace(body, chr(39), '"')) then replace(body, chr(39), '"') end j from b),
  p as (select event_id, lower(trim(j->>'$.verdict')) verdict, lower(trim(j->>'$.label')) as label, try_cast(j->>'$.age' as double) age from j)"""


@query("p15_json_answers", "with " + _RAW + ", " + _P15 + " select event_id, case when ok then verdict end verdict, case when ok then label end as label, case when ok then age end age from (select *, verdict in ('real_person', 'depiction', 'not_person') ok from p)")
def _(spark, d):
    a = sc.json_answer(F.col("text"), ("real_person", "depiction", "not_person"), ("a", "b"))
    return _raw(spark, d).select("event_id", a.alias("v")).select("event_id", "v.*")


@query("p16_json_answers_greedy", "with " + _RAW + ", " + _P15.replace("*?", "*") + " select event_id, verdict is not null found from p")
def _(spark, d):
    a = sc.json_answer(F.concat("text", F.lit("")), ("real_person", "depiction", "not_person", "unknown"), ("a", "b"), greedy=True)
    return _raw(spark, d).select("event_id", a.isNotNull().alias("found"))


@query("p17_answer_to_attr", f"""{O}, i as (select *, case when eid%6 = 0 then null else eid%2 = 0 end side, eid%120/100.0::double conf, eid%13 <> 0 person, case eid%3 when 0 then 'face' when 1 then 'back' else 'side' end as view_, case when eid%7 = 0 then 'child' else 'adult' end grp, (eid%60)::double age from obs)
  select clip_id, tid, f, case when side is null then 0.5::double when side then 0.5 + 0.5 * least(1.0::double, greatest(0.0::double, conf)) else 0.5 - 0.5 * least(1.0::double, greatest(0.0::double, conf)) end p,
   case when not person then 0.0::double else (case when side is null then 0.3 else 1.0 end)::double * (case when view_ = 'face' then 1.0 else 0.4 end)::double * (case when view_ = 'back' then 0.7 else 1.0 end)::double end w,
   case when grp = 'child' then least(age, 12.0::double) else age end age_mean, case when view_ = 'face' then 6.0::double else 12.0::double end age_std from i""")
def _(spark, d):
    eid = F.col("eid")
    view = F.when(eid % 3 == 0, "face").when(eid % 3 == 1, "back").otherwise("side")
    a = sc.answer_to_attr(F.when(eid % 6 != 0, eid % 2 == 0), (eid % 120) / F.lit(100.0), eid % 13 != 0, view, F.when(eid % 7 == 0, "child").otherwise("adult"), (eid % 60).cast("double"))
    return relation(spark, d, "obs").select("clip_id", "tid", "f", a.alias("a")).select("clip_id", "tid", "f", "a.*")


@query("a02_label_vote", f"{V}, {_A02} select * from a02")
def _(spark, d):
    return vt.label_vote(relation(spark, d, "votes"))


@query("a03_verdict_shares", f"{V}, {_A03} select * from a03")
def _(spark, d):
    return vt.verdict_shares(relation(spark, d, "votes"))


@query("a04_age_vote", f"{V}, {_A04} select * from a04")
def _(spark, d):
    return vt.age_vote(relation(spark, d, "votes"))


@query("a05_decide", f"{V}, {_A05} select * from a05")
def _(spark, d):
    return vt.decide(relation(spark, d, "votes"))


_DEC = "dec as (select *, dropped is null and label is not null and not (reasons like '%no_label%' or reasons like '%label_margin%' or reasons like '%low_weight%' or reasons like '%age_split%') decided from a05)"


@query("a05_decided", f"{V}, {_A05}, {_DEC} select clip_id, tid, decided from dec")
def _(spark, d):
    return vt.decided(vt.decide(relation(spark, d, "votes"))).select("clip_id", "tid", "decided")


_SCORES = "sc as (select clip_id, tid, 'a' as label, eid % 100 score from layers where has_a union all select clip_id, tid, 'b' as label, eid % 60 score from layers where has_b)"


@query("a06_prompt_vote", f"{L}, {_SCORES}, s as (select clip_id, tid, label, sum(score)::double s from sc group by 1, 2, 3), t as (select clip_id, tid, sum(s) total, sum(case when label = 'b' then s else 0 end) t, arg_max(label, row(s, case label when 'a' then 1 else 0 end)) top from s group by 1, 2) select clip_id, tid, case when t / total >= 0.4 then 'b' else top end as label, t / total target_share from t")
def _(spark, d):
    lay = relation(spark, d, "layers")
    one = lambda n, m: lay.filter(f"has_{n}").select("clip_id", "tid", F.lit(n).alias("label"), (F.col("eid") % m).cast("double").alias("score"))
    return vt.prompt_vote(one("a", 100).unionByName(one("b", 60)), "b", 0.4)


@query("a07_probability_label", f"{O}, v as (select clip_id, tid, (eid%64)/64.0::double p_a, (eid%32)/128.0::double p_b, (eid%16)/64.0::double p_c from obs), m as (select clip_id, tid, avg(p_a) p_a, avg(p_b) p_b, avg(p_c) p_c from v group by 1, 2) select clip_id, tid, round(p_a, 9) p_a, round(p_b, 9) p_b, round(p_c, 9) p_c, 0.0 + p_a + p_b >= 0.62 is_target from m")
def _(spark, d):
    e = F.col("eid")
    v = relation(spark, d, "obs").select("clip_id", "tid", ((e % 64) / F.lit(64.0)).alias("p_a"), ((e % 32) / F.lit(128.0)).alias("p_b"), ((e % 16) / F.lit(64.0)).alias("p_c"))
    out = vt.probability_label(v, ["a", "b"], 0.62)
    return out.select("clip_id", "tid", *[F.round(c, 9).alias(c) for c in ("p_a", "p_b", "p_c")], "is_target")


_NF = "nf as (select clip_id, tid, count(*) n_frames from obs group by 1, 2)"


@query("l01_selected", f"""{V}, {_A05}, {_NF}, s as (select *, case when dropped is not null then 'dropped' when label is null or label <> 'a' then 'other_class'
  when (reasons like '%no_label%' or reasons like '%label_margin%' or reasons like '%low_weight%') and not (n_frames / 25.0 >= 0.5 and share >= 0.6 and weight >= 2.0) then 'doubtful' end skipped from a05 join nf using (clip_id, tid)) select clip_id, tid, skipped, skipped is null selected from s""")
def _(spark, d):
    n = relation(spark, d, "obs").groupBy("clip_id", "tid").agg(F.count(F.lit(1)).alias("n_frames"))
    dec = vt.decide(relation(spark, d, "votes")).join(n, ["clip_id", "tid"])
    return vt.selectable(dec, "a", 25.0).select("clip_id", "tid", "skipped", "selected")


@query("a28_class_counters", f"{V}, {_A05}, {_NF} select clip_id, coalesce(label, '-') as label, coalesce(dropped, '-') dropped, least(floor(n_frames / 5.0), 10)::bigint as \"seconds\", count(*) tracks from a05 join nf using (clip_id, tid) group by all")
def _(spark, d):
    n = relation(spark, d, "obs").groupBy("clip_id", "tid").agg(F.count(F.lit(1)).alias("n_frames"))
    return vt.class_counters(vt.decide(relation(spark, d, "votes")).join(n, ["clip_id", "tid"]), F.col("n_frames") / 5.0)


@query("t01_review_order", f"{V}, {_A05}, {_NF} select clip_id, tid, dropped is not null is_dropped, reasons <> '' uncertain, n_frames, row_number() over (partition by clip_id order by dropped is not null, reasons <> '', n_frames desc, tid) place from a05 join nf using (clip_id, tid)")
def _(spark, d):
    from pyspark.sql import Window

    n = relation(spark, d, "obs").groupBy("clip_id", "tid").agg(F.count(F.lit(1)).alias("n_frames"))
    df = vt.decide(relation(spark, d, "votes")).join(n, ["clip_id", "tid"]).select("clip_id", "tid", F.col("dropped").isNotNull().alias("is_dropped"), (F.col("reasons") != "").alias("uncertain"), "n_frames")
    return df.withColumn("place", F.row_number().over(Window.partitionBy("clip_id").orderBy("is_dropped", "uncertain", F.desc("n_frames"), "tid")).cast("long"))


@query("p23_compatible_classes", f"{V}, {_A05} select a.clip_id, a.tid, b.tid other, (a.label is null or b.label is null or a.label = b.label) compatible from a05 a join a05 b on a.clip_id = b.clip_id and a.tid < b.tid")
def _(spark, d):
    return _compatible_classes(vt.decide(relation(spark, d, "votes")))


@query("p23_compatible_classes_all", f"{V}, {_A05} select a.clip_id, a.tid, b.tid other, (a.label is null or b.label is null or a.label = b.label) compatible from a05 a join a05 b on a.clip_id = b.clip_id and a.tid < b.tid")
def _(spark, d):
    return _compatible_classes(vt.decide(relation(spark, d, "votes")))


def _compatible_classes(dec):
    """All pairs of a clip's tracks."""
    a, b = dec.select("clip_id", "tid", "label"), dec.select("clip_id", F.col("tid").alias("other"), F.col("label").alias("other_label"))
    return a.join(b, "clip_id").filter("tid < other").select("clip_id", "tid", "other", sc.compatible(F.col("label"), F.col("other_label")).alias("compatible"))
