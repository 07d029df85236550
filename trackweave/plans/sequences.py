"""Registered queries: sequence operators and stability measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..operators import sequences as seq
from . import sqltext as q
from .fixtures import ctes, relation
from .registry import query

O = ctes("obs")  # noqa: E741
_W = "(partition by clip_id, tid order by f)"
_RUNS = "runs as (select clip_id, tid, min(f) first_f, max(f) last_f, count(*) n from (select clip_id, tid, f, f - row_number() over (partition by clip_id, tid order by f) g from obs) group by clip_id, tid, g)"


@query("w01_runs", f"{O}, {_RUNS} select * from runs")
def _(spark, d):
    return seq.runs(relation(spark, d, "obs"))


@query("w03_min_runs", f"{O}, {_RUNS} select * from runs where n >= 2")
def _(spark, d):
    return seq.at_least(seq.runs(relation(spark, d, "obs")), 2)


@query("a01_spans", f"{O} select clip_id, tid, min(f) first_f, max(f) last_f, count(*) n from obs group by 1, 2")
def _(spark, d):
    return seq.spans(relation(spark, d, "obs"))


@query("w14_holes", f"{O}, s as (select clip_id, tid, max(f)-min(f)+1 life, count(*) n from obs group by 1, 2) select clip_id, tid, life, life - n holes, life > n has_gap from s")
def _(spark, d):
    return seq.holes(relation(spark, d, "obs"))


@query("w06_velocity", f"""{O}, c as (select *, (x1+x2)/2 cx, (y1+y2)/2 cy from obs),
  v as (select *, first_value(cx) over w ax, first_value(cy) over w ay, first_value(f) over w af from c window w as (partition by clip_id, tid order by f rows between 4 preceding and current row))
  select clip_id, tid, f, (cx - ax) / greatest(1, f - af) vx, (cy - ay) / greatest(1, f - af) vy from v""")
def _(spark, d):
    return seq.velocity(relation(spark, d, "obs")).select("clip_id", "tid", "f", "vx", "vy")


@query("w07_fill_holes", f"""{O}, l as (select clip_id, tid, f, x1, y1, x2, y2, lead(f) over w nf, lead(x1) over w nx1, lead(y1) over w ny1, lead(x2) over w nx2, lead(y2) over w ny2 from obs window w as {_W}),
  g as (select *, unnest(range(f + 1, nf)) g from l where nf - f > 1 and nf - f - 1 <= 5)
  select clip_id, tid, f, x1, y1, x2, y2, false filled from obs union all
  select clip_id, tid, g::int, x1 + (nx1 - x1) * ((g - f) / (nf - f)), y1 + (ny1 - y1) * ((g - f) / (nf - f)), x2 + (nx2 - x2) * ((g - f) / (nf - f)), y2 + (ny2 - y2) * ((g - f) / (nf - f)), true from g""")
def _(spark, d):
    return seq.fill_holes(relation(spark, d, "obs"), 5)


_LAG = f"lagged as (select *, {q.lag_box(_W)} from obs)"
_SWAPS = f"swaps as (select clip_id, tid, pf, f from lagged where f - pf <= 3 and {q.iou('p', '')} < 0.1 and {q.dist('p', '')} > 0.75 * greatest(py2 - py1, y2 - y1, 1))"


@query("w13_suspect_swaps", f"{O}, {_LAG}, {_SWAPS} select * from swaps")
def _(spark, d):
    return seq.suspect_swaps(relation(spark, d, "obs"))


@query("w02_hops", f"{O}, {_LAG}, cuts as (select clip_id, tid, f from lagged where f - pf = 1 and {q.dist('p', '')} > greatest(py2 - py1, 1)) select o.clip_id, o.tid, o.f, (select count(*) from cuts c where c.clip_id = o.clip_id and c.tid = o.tid and c.f <= o.f) part from obs o")
def _(spark, d):
    obs = relation(spark, d, "obs")
    return seq.cut_at(obs, seq.hops(obs)).select("clip_id", "tid", "f", "part")


@query("w09_pick_spread", f"""{O}, i as (select *, row_number() over {_W} - 1 i, count(*) over (partition by clip_id, tid) n from obs),
  b as (select *, case when n <= 8 then i else (select max(k) from range(0, 8) t(k) where floor(k * n / 8) <= i) end b from i)
  select clip_id, tid, f, score from b qualify row_number() over (partition by clip_id, tid, b order by score desc, f) = 1""")
def _(spark, d):
    return seq.pick_spread(relation(spark, d, "obs"), 8, "score").select("clip_id", "tid", "f", "score")


@query("w10_best_windows", f"""{O}, v as (select clip_id, tid, f, score * sqrt(greatest(1, {q.area('')})) * case when x1 <= 2 or y1 <= 2 or x2 >= 1298 or y2 >= 798 then 0.5 else 1.0::double end quality from obs),
  b as (select * from v qualify row_number() over (partition by clip_id, tid, f // 5 order by quality desc, f) = 1)
  select clip_id, tid, f, quality from b qualify row_number() over (partition by clip_id, tid order by quality desc, f) <= 4""")
def _(spark, d):
    views = relation(spark, d, "obs").withColumn("quality", geo.view_quality(F.col("score"), geo.box(), 1300, 800))
    return seq.best_windows(views, "quality", 5, 4).select("clip_id", "tid", "f", "quality")


@query("w16_strip", f"""{O}, r as (select *, {q.area('')} area, row_number() over (partition by clip_id, tid order by {q.area('')} desc, f) r from obs),
  i as (select *, row_number() over {_W} - 1 i, count(*) over (partition by clip_id, tid) m from r where r <= 12)
  select clip_id, tid, f, area from i where exists (select 1 from range(0, 5) t(j) where floor(j * (m - 1) / 4) = i)""")
def _(spark, d):
    return seq.strip(relation(spark, d, "obs"), 12, 5).select("clip_id", "tid", "f", "area")


@query("w19_every_nth", f"{O}, i as (select *, row_number() over {_W} - 1 i, greatest(1, count(*) over (partition by clip_id, tid) // 6) step from obs) select clip_id, tid, f from i where i % step = 0 and i // step < 6")
def _(spark, d):
    return seq.every_nth(relation(spark, d, "obs"), 6).select("clip_id", "tid", "f")


@query("w17_best_observation", f"{O} select clip_id, tid, f, x1, y1, x2, y2, score from obs qualify row_number() over (partition by clip_id, tid order by score desc, f) = 1")
def _(spark, d):
    return seq.best_observation(relation(spark, d, "obs"))


@query("w18_taller_box", f"{O} select clip_id, (tid // 24)::bigint identity, f, tid, x1, y1, x2, y2 from obs qualify row_number() over (partition by clip_id, tid // 24, f order by y2 - y1 desc, tid) = 1")
def _(spark, d):
    return seq.taller_box(relation(spark, d, "obs").withColumn("identity", F.floor(F.col("tid") / 24)))


@query("t06_number_by_appearance", f"{O}, s as (select clip_id, tid, min(f) first_f from obs group by 1, 2) select clip_id, tid, first_f, row_number() over (partition by clip_id order by first_f, tid) identity from s")
def _(spark, d):
    return seq.number_by_appearance(seq.spans(relation(spark, d, "obs")).select("clip_id", "tid", "first_f"))


_STEPS = f"{_LAG}, steps as (select clip_id, tid, pf, f, {q.iou('p', '')} step_iou from lagged where pf is not null)"


@query("w04_appearance_split", f"""{O}, {_STEPS}, views as (select clip_id, tid, f, eid % 100 / 100.0::double similarity, lead(f) over {_W} nf from obs where eid % 4 = 0),
  p as (select clip_id, tid, f a, nf b from views where nf is not null and similarity < 0.35)
  select p.clip_id, p.tid, a, b, arg_min(f, row(step_iou, f)) cut_f, min(step_iou) cut_iou from p join steps s on p.clip_id = s.clip_id and p.tid = s.tid and s.pf >= a and s.f <= b group by all""")
def _(spark, d):
    obs = relation(spark, d, "obs")
    views = obs.filter("eid % 4 = 0").withColumn("similarity", (F.col("eid") % 100) / F.lit(100.0))
    return seq.appearance_cuts(obs, views)


_FLIP = """v as (select clip_id, tid, f, case when label = 'a' then 1 else 0 end one from votes where w > 0 and label is not null),
  c as (select *, row_number() over w - 1 i, coalesce(sum(one) over (partition by clip_id, tid order by f rows between unbounded preceding and 1 preceding), 0) lo, count(*) over (partition by clip_id, tid) n, sum(one) over (partition by clip_id, tid) ones, lag(f) over w a from v window w as (partition by clip_id, tid order by f)),
  s as (select *, greatest(lo, i - lo)::double / i lp, greatest(ones - lo, n - i - (ones - lo))::double / (n - i) rp from c where n >= 6 and i >= 3 and i <= n - 3)
  select clip_id, tid, i, a, f b, lp + rp purity from s where (lo * 2 > i) <> ((ones - lo) * 2 > n - i) and lp >= 0.55 and rp >= 0.55 qualify row_number() over (partition by clip_id, tid order by lp + rp desc, i) = 1"""


@query("w05_vote_flip", f"{ctes('votes')}, {_FLIP}")
def _(spark, d):
    return seq.vote_flip(relation(spark, d, "votes"), purity=0.55)


@query("w05_vote_split", f"""{ctes('votes')}, {_STEPS}, flips as ({_FLIP.replace('v as (', 'select * from (with v as (', 1)}))
  select p.clip_id, p.tid, a, b, arg_min(f, row(step_iou, f)) cut_f, min(step_iou) cut_iou from flips p join steps s on p.clip_id = s.clip_id and p.tid = s.tid and s.pf >= a and s.f <= b group by all having min(step_iou) < 0.9""")
def _(spark, d):
    flips = seq.vote_flip(relation(spark, d, "votes"), purity=0.55)
    return seq.worst_step(relation(spark, d, "obs"), flips.select("clip_id", "tid", "a", "b")).filter("cut_iou < 0.9")


@query("w15_run_overlap", f"{O}, {_RUNS} select a.clip_id, a.tid tid_a, b.tid tid_b, sum(least(a.last_f, b.last_f) - greatest(a.first_f, b.first_f) + 1)::bigint frames from runs a join runs b on a.clip_id = b.clip_id and a.tid < b.tid and a.first_f <= b.last_f and b.first_f <= a.last_f group by 1, 2, 3")
def _(spark, d):
    r = seq.runs(relation(spark, d, "obs"))
    return seq.run_overlap(r, r)


_ENDS = "starts as (select * from obs qualify row_number() over (partition by clip_id, tid order by f) = 1), ends_ as (select * from obs qualify row_number() over (partition by clip_id, tid order by f desc) = 1)"
_FRAG = f"frags as (select clip_id, tid, f from starts s where f > (select min(f) from starts z where z.clip_id = s.clip_id) and exists (select 1 from ends_ e where e.clip_id = s.clip_id and e.tid <> s.tid and s.f - e.f > 0 and s.f - e.f <= 60 and {q.near('e.', 's.')}))"


_PIECES = O.replace("with recursive obs as", "with recursive whole as") + ", obs as (select clip_id, tid + 1000 * (f // 25) tid, f, eid, x1, y1, x2, y2, score from whole)"


def _pieces(spark, d):
    """Tracks cut every 25 frames, so that births follow deaths."""
    return relation(spark, d, "obs").withColumn("tid", (F.col("tid") + 1000 * F.floor(F.col("f") / 25)).cast("int"))


@query("j13_rebirths", f"{_PIECES}, {_ENDS}, {_FRAG} select * from frags")
def _(spark, d):
    return seq.fragments(_pieces(spark, d))


@query("a16_stability", f"""{_PIECES}, {_LAG}, {_SWAPS}, {_ENDS}, {_FRAG}, h as (select clip_id, tid, max(f)-min(f)+1 life, count(*) n from obs group by 1, 2)
  select clip_id, count(*) tracks, sum(life)::bigint life, sum(life - n)::bigint holes, sum(life - n)::double / sum(life) hole_share, count(*) filter (life < 25) short_tracks,
    (select count(*) from swaps s where s.clip_id = h.clip_id) swaps, (select count(*) from frags g where g.clip_id = h.clip_id) fragments from h group by clip_id""")
def _(spark, d):
    return seq.stability(_pieces(spark, d))


@query("a15_continuity", f"""{O}, t as (select clip_id, tid, min(f) first_f, max(f)-min(f)+1 life, count(*) n from obs group by 1, 2),
  live as (select clip_id, f, count(distinct tid) live from obs where f < 100 group by 1, 2), m as (select clip_id, max(live) max_live, sum(live) / 100.0::double mean_live from live group by 1)
  select t.clip_id, count(*) tracks, quantile_cont(life, 0.5) median_life, quantile_cont(life, 0.9) p90_life, avg(case when life < 12.5 then 1.0 else 0.0 end)::double short_share,
    count(*) filter (first_f > 5 and first_f < 95) late_births, count(*) filter (life > n) with_gaps, any_value(max_live) max_live, any_value(mean_live) mean_live from t left join m using (clip_id) group by 1""")
def _(spark, d):
    return seq.continuity(relation(spark, d, "obs"), 25.0, 100)
