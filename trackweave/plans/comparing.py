"""Registered queries: comparing runs and hand labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import association as asc
from ..operators import comparing as cm
from ..operators import greedy as gr
from ..operators import pairs as pr
from ..operators import sequences as seq
from . import sqltext as q
from .coverage import _CROSS
from .fixtures import ctes, relation
from .registry import query
from .sequences import _ENDS, _FRAG, _LAG, _SWAPS

O, B, LB = ctes("obs"), ctes("run_b", "obs"), ctes("run_b", "obs", "layers")  # noqa: E741
_ARGMAX = f"{_CROSS}, m as (select clip_id, f, tid tid_a, other tid_b from p where iou >= 0.5 qualify row_number() over (partition by clip_id, f, tid order by iou desc, other) = 1)"
_ONE = f"{_CROSS}, near_ as (select clip_id, f, tid tid_a, other tid_b, iou from p where iou >= 0.5)"
_MATCH = f"{_ONE}, m as ({q.greedy_pairs('near_')})"
_BACK = f"{_ONE}, flipped as (select clip_id, f, tid_b tid_a, tid_a tid_b, iou from near_), m as ({q.greedy_pairs('flipped')})"
_GT = "gt as (select clip_id, tid, case when has_a then 'a' else 'b' end as label from layers where (has_a or has_b) and tid % 4 <> 0 qualify row_number() over (partition by clip_id, tid order by f) = 1)"


def _best(spark, d):
    m = pr.best_match(relation(spark, d, "obs"), relation(spark, d, "run_b"))
    return m.select("clip_id", "f", F.col("tid").alias("tid_a"), F.col("match").alias("tid_b"))


def _matches(spark, d, a="obs", b="run_b"):
    """One to one in each frame, greatest overlap first."""
    return gr.greedy_match(relation(spark, d, a), relation(spark, d, b))


def _labels(spark, d):
    lay = relation(spark, d, "layers").filter("(has_a or has_b) and tid % 4 <> 0").withColumn("label", F.when(F.col("has_a"), "a").otherwise("b"))
    return lay.groupBy("clip_id", "tid").agg(F.min_by("label", "f").alias("label"))


@query("j19_carry_labels", f"{LB}, {_ARGMAX}, {_GT} select m.clip_id, m.tid_b tid, min(gt.label) as label, count(*) votes from m join gt on gt.clip_id = m.clip_id and gt.tid = m.tid_a group by 1, 2 having count(distinct gt.label) = 1")
def _(spark, d):
    m = _best(spark, d).select("clip_id", F.col("tid_b").alias("tid"), F.col("tid_a").alias("match"))
    return cm.carry_labels(m, _labels(spark, d))


@query("j20_differing_rows", f"{B}, x as (select clip_id, tid, f from obs), y as (select clip_id, tid, f from run_b) select *, 'a' only_in from (select * from x except all select * from y) union all select *, 'b' only_in from (select * from y except all select * from x)")
def _(spark, d):
    cols = ("clip_id", "tid", "f")
    return cm.differing_rows(relation(spark, d, "obs").select(*cols), relation(spark, d, "run_b").select(*cols))


@query("j22_frame_union", f"{B} select clip_id, f from obs where f % 2 = 0 union select clip_id, f from run_b where f % 3 = 0")
def _(spark, d):
    a, b = relation(spark, d, "obs").filter("f % 2 = 0"), relation(spark, d, "run_b").filter("f % 3 = 0")
    return a.select("clip_id", "f").union(b.select("clip_id", "f")).distinct()


@query("g10_id_sets", f"{B}, a as (select distinct clip_id, tid from obs), b as (select distinct clip_id, tid from run_b) select *, 'both' side from (select * from a intersect select * from b) union all select *, 'only_b' side from (select * from b except select * from a)")
def _(spark, d):
    a, b = (relation(spark, d, n).select("clip_id", "tid").distinct() for n in ("obs", "run_b"))
    return a.intersect(b).withColumn("side", F.lit("both")).unionByName(b.subtract(a).withColumn("side", F.lit("only_b")))


_S = "s as (select clip_id, tid, (min(eid) % 97)::double score, tid % 3 = 0 positive, count(*) frames from obs group by clip_id, tid)"


def _scores(spark, d):
    o = relation(spark, d, "obs").groupBy("clip_id", "tid").agg((F.min("eid") % 97).cast("double").alias("score"), F.count(F.lit(1)).alias("frames"))
    return o.withColumn("positive", F.col("tid") % 3 == 0)


@query("a18_auc", f"{O}, {_S}, pr as (select a.clip_id, avg(case when a.score > b.score then 1.0 when a.score = b.score then 0.5 else 0.0 end)::double auc from s a join s b on a.clip_id = b.clip_id and a.positive and not b.positive group by 1) select clip_id, round(auc, 9) auc, count(*) filter (positive) pos, count(*) filter (not positive) neg from s left join pr using (clip_id) group by clip_id, auc")
def _(spark, d):
    return cm.auc(_scores(spark, d)).withColumn("auc", F.round("auc", 9))


_ERR = f"{_S}, e as (select clip_id, t, sum(case when (score >= t) <> positive then frames else 0 end)::bigint errors, sum(frames)::bigint frames from s, (select unnest([10.0, 25.0, 40.0, 55.0, 70.0, 85.0]::double[]) t) group by 1, 2)"
_TS = [10, 25, 40, 55, 70, 85]


@query("a19_threshold_errors", f"{O}, {_ERR} select * from e")
def _(spark, d):
    return cm.threshold_errors(_scores(spark, d), _TS)


@query("a19_best_threshold", f"{O}, {_ERR}, b as (select clip_id, t best_t, errors from e qualify row_number() over (partition by clip_id order by errors, abs(t - 40), t) = 1) select b.clip_id, best_t, b.errors, min(t) low, max(t) high, max(t) - min(t) margin from b join e on e.clip_id = b.clip_id and e.errors = b.errors group by 1, 2, 3")
def _(spark, d):
    return cm.best_threshold(cm.threshold_errors(_scores(spark, d), _TS), 40.0)


_LAB = "la as (select clip_id, tid, case when min(eid) % 2 = 0 then 'a' else 'b' end as label, count(*) frames from obs group by 1, 2), lb as (select clip_id, tid, case when max(eid) % 3 = 0 then 'a' else 'b' end as label from obs where tid % 7 <> 0 group by 1, 2), j as (select la.*, lb.label label_b from la join lb using (clip_id, tid))"


def _two_labels(spark, d):
    o = relation(spark, d, "obs")
    a = o.groupBy("clip_id", "tid").agg(F.when(F.min("eid") % 2 == 0, "a").otherwise("b").alias("label"), F.count(F.lit(1)).alias("frames"))
    b = o.filter("tid % 7 <> 0").groupBy("clip_id", "tid").agg(F.when(F.max("eid") % 3 == 0, "a").otherwise("b").alias("label"))
    return a, b


@query("j21_label_flips", f"{O}, {_LAB} select clip_id, tid, label, frames, label_b from j where label <> label_b")
def _(spark, d):
    return cm.label_flips(*_two_labels(spark, d))


@query("a20_label_agreement", f"{O}, {_LAB} select clip_id, count(*) tracks, avg(case when label = label_b then 1.0 else 0.0 end)::double agreement, sum(case when label <> label_b then frames else 0 end) / sum(frames) flipped_frames from j group by 1")
def _(spark, d):
    return cm.label_agreement(*_two_labels(spark, d))


_PAIRS = f"{_MATCH}, pairs as (select clip_id, tid_a, tid_b, count(*) frames from m group by 1, 2, 3 having count(*) >= 3)"


@query("a21_supported_pairs", f"{B}, {_PAIRS} select * from pairs")
def _(spark, d):
    return cm.supported_pairs(_matches(spark, d))


@query("a21_splits", f"{B}, {_PAIRS} select clip_id, tid_a, array_to_string(list_sort(list(distinct tid_b)), ',') parts from pairs group by 1, 2 having count(distinct tid_b) > 1")
def _(spark, d):
    return cm.splits(cm.supported_pairs(_matches(spark, d))).withColumn("parts", F.array_join(F.col("parts").cast("array<string>"), ","))


@query("a21_merges", f"{B}, {_PAIRS.replace(_MATCH, _BACK)} select clip_id, tid_b, array_to_string(list_sort(list(distinct tid_a)), ',') parts from pairs group by 1, 2 having count(distinct tid_a) > 1")
def _(spark, d):
    """Seen from the run whose tracks are cut in two: two of its tracks are one of the other run's."""
    return cm.merges(cm.supported_pairs(_matches(spark, d, "run_b", "obs"))).withColumn("parts", F.array_join(F.col("parts").cast("array<string>"), ","))


@query("a21_orphans", f"{B}, {_PAIRS} select distinct clip_id, tid tid_a from obs where (clip_id, tid) not in (select clip_id, tid_a from pairs where frames >= 43)")
def _(spark, d):
    return cm.orphans(relation(spark, d, "obs"), cm.supported_pairs(_matches(spark, d), 43))


_SWITCH = "split as (select clip_id, tid_a from pairs group by 1, 2 having count(distinct tid_b) > 1), sw as (select * from (select clip_id, tid_a, f, lag(tid_b) over (partition by clip_id, tid_a order by f) before, tid_b from m where (clip_id, tid_a) in (select clip_id, tid_a from split)) where before <> tid_b)"


def _switches(spark, d):
    """Of split tracks only, but over all their matches."""
    return cm.split_switches(_matches(spark, d))


@query("w12_switches", f"{B}, {_PAIRS}, {_SWITCH} select * from sw")
def _(spark, d):
    return _switches(spark, d)


@query("a22_switch_lags", f"{B}, {_PAIRS}, {_SWITCH} select lag, count(*) switches from (select f - (select max(b) from (select unnest([24, 43, 62, 81]) b) where b <= f) as lag from sw) group by 1")
def _(spark, d):
    return cm.switch_lags(_switches(spark, d), cm.boundaries(100, 24, 5))


@query("j16_unmatched_recent", f"{B}, l as (select *, least(coalesce(lead(f) over (partition by clip_id, tid order by f) - 1, 2147483647), f + 4) until from obs) select clip_id, f, tid from run_b d where not exists (select 1 from l o where o.clip_id = d.clip_id and d.f between o.f and o.until and {q.iou('d.', 'o.')} > 0.9)")
def _(spark, d):
    return cm.unmatched_recent(relation(spark, d, "run_b"), relation(spark, d, "obs"), 5, 0.9)


_SETTINGS = [(1, 20), (2, 40), (3, 60), (4, 140)]  # the last one is no share of 100 and is left out
_REPLAYED = O.replace("with recursive obs as", "with recursive whole as") + f""", st as (select unnest({[x[0] for x in _SETTINGS]}) setting_id, unnest({[x[1] for x in _SETTINGS]}) least),
  obs as (select clip_id * 10 + setting_id clip_id, tid + 1000 * (f // 25) tid, f, eid, x1, y1, x2, y2, score from whole, st where least <= 100 and score * 100 >= least)"""


@query("t04_setting_order", f"""{_REPLAYED}, {_LAG}, {_SWAPS}, {_ENDS}, {_FRAG.replace("<= 60", "<= 100")}, h as (select clip_id, tid, max(f)-min(f)+1 life, count(*) n from obs group by 1, 2),
  r as (select clip_id, count(*) tracks, sum(life - n)::bigint holes, (select count(*) from swaps s where s.clip_id = h.clip_id) swaps, (select count(*) from frags g where g.clip_id = h.clip_id) fragments from h group by clip_id)
  select clip_id % 10 setting_id, clip_id // 10 as clip_id, tracks, holes, swaps, fragments, row_number() over (partition by clip_id // 10 order by fragments + 2 * swaps, tracks, clip_id % 10) place from r""")
def _(spark, d):
    settings = spark.createDataFrame(_SETTINGS, "setting_id int, least int")
    replay = lambda df: df.filter(F.col("score") * 100 >= F.col("least")).withColumn("tid", (F.col("tid") + 1000 * F.floor(F.col("f") / 25)).cast("int"))
    out = cm.sweep(relation(spark, d, "obs"), settings, replay, lambda tracks: seq.stability(tracks, window=100), F.col("least").between(0, 100))
    return cm.rank_settings(out).select("setting_id", "clip_id", "tracks", "holes", "swaps", "fragments", F.col("place").cast("long").alias("place"))


@query("g11_t04_sweep")
def _(spark, d):
    """Detections without their tracks, replayed under six settings, of which the last is none."""
    settings = {1: {}, 2: {"match_iou": 0.5}, 3: {"match_iou": 0.5, "motion": 1.0}, 4: {"new_score": 0.8, "lost_frames": 10}, 5: {"dup_iou": 0.3, "cover": 0.9}, 6: {"match_iou": 1.5}}
    return asc.sweep(relation(spark, d, "obs").select("clip_id", "f", F.col("eid").alias("det"), "x1", "y1", "x2", "y2", "score"), settings)
