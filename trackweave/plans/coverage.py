"""Registered queries: geometry, same-frame pairs, label coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..operators import masks as mk
from ..operators import pairs as pr
from . import sqltext as q
from .fixtures import ctes, relation
from .masks import CELL, COLUMNS
from .registry import query

O, L, B = ctes("obs"), ctes("layers"), ctes("run_b", "obs")  # noqa: E741
_TOUCH = "a.x1 < b.x2 and b.x1 < a.x2 and a.y1 < b.y2 and b.y1 < a.y2"
_SELF = f"p as (select a.clip_id, a.f, a.tid, b.tid other, a.y2 ay2, b.y2 by2, {q.iou('a.', 'b.')} iou, {q.cover('a.', 'b.')} cover from obs a join obs b on a.clip_id = b.clip_id and a.f = b.f and a.tid <> b.tid and {_TOUCH})"
_CROSS = f"p as (select a.clip_id, a.f, a.tid, b.tid other, {q.iou('a.', 'b.')} iou from obs a join run_b b on a.clip_id = b.clip_id and a.f = b.f and {_TOUCH})"


@query("p01_p04_pair_geometry", f"""{O} select a.clip_id, a.f, a.tid, b.tid other, {q.iou('a.', 'b.')} iou, {q.cover('a.', 'b.')} cover, {q.dist('a.', 'b.')} dist, {q.near('a.', 'b.')} near
  from obs a join obs b on a.clip_id = b.clip_id and a.f = b.f and a.tid < b.tid """)
def _(spark, d):
    return _pair_geometry(relation(spark, d, "obs"))


@query("p01_p04_pair_geometry_all", f"""{O} select a.clip_id, a.f, a.tid, b.tid other, {q.iou('a.', 'b.')} iou, {q.cover('a.', 'b.')} cover, {q.dist('a.', 'b.')} dist, {q.near('a.', 'b.')} near
  from obs a join obs b on a.clip_id = b.clip_id and a.f = b.f and a.tid < b.tid""")
def _(spark, d):
    return _pair_geometry(relation(spark, d, "obs"))


def _pair_geometry(obs):
    """All pairs of a frame."""
    a, b = geo.box("a_"), geo.box("b_")
    p = pr.side(obs, "a_").join(pr.side(obs, "b_"), pr.FRAME).filter("a_tid < b_tid")
    return p.select("clip_id", "f", F.col("a_tid").alias("tid"), F.col("b_tid").alias("other"), geo.iou(a, b).alias("iou"), geo.coverage(a, b).alias("cover"), geo.distance(a, b).alias("dist"), geo.near(a, b).alias("near"))


@query("p11_view_quality", f"{O} select clip_id, tid, f, score * sqrt(greatest(1, {q.area('')})) * case when x1 <= 2 or y1 <= 2 or x2 >= 1298 or y2 >= 798 then 0.5 else 1.0::double end quality from obs")
def _(spark, d):
    return relation(spark, d, "obs").select("clip_id", "tid", "f", geo.view_quality(F.col("score"), geo.box(), 1300, 800).alias("quality"))


@query("p20_grid_cells", f"{O} select clip_id, tid, f, floor(x1/40)::bigint c1, floor(y1/40)::bigint r1, ceil(x2/40)::bigint c2, ceil(y2/40)::bigint r2 from obs")
def _(spark, d):
    g = geo.to_grid(geo.box(), 40.0)
    return relation(spark, d, "obs").select("clip_id", "tid", "f", *[x.cast("long").alias(n) for x, n in zip(g, ("c1", "r1", "c2", "r2"), strict=True)])


@query("p18_occlusion", f"{O}, {_SELF}, m as (select clip_id, f, tid, max(cover) c from p where by2 > ay2 group by 1, 2, 3) select clip_id, f, tid, coalesce(c, 0.0::double) occ from obs left join m using (clip_id, f, tid)")
def _(spark, d):
    return pr.occlusion(relation(spark, d, "obs"))


@query("j01_overlap_hosts", f"{O}, {_SELF} select clip_id, f, tid, other as host, cover from p where cover >= 0.5 qualify row_number() over (partition by clip_id, f, tid order by cover desc, other) = 1")
def _(spark, d):
    return pr.hosts(relation(spark, d, "obs"))


@query("j05_covered", f"{B}, {_CROSS}, m as (select clip_id, f, tid, max(iou) best from p group by 1, 2, 3) select clip_id, f, tid, coalesce(best, 0.0::double) best, coalesce(best >= 0.5, false) covered from obs left join m using (clip_id, f, tid)")
def _(spark, d):
    return pr.covered(relation(spark, d, "obs"), relation(spark, d, "run_b"))


@query("j07_argmax_match", f"{B}, {_CROSS} select clip_id, f, tid, other as \"match\", iou from p where iou >= 0.5 qualify row_number() over (partition by clip_id, f, tid order by iou desc, other) = 1")
def _(spark, d):
    return pr.best_match(relation(spark, d, "obs"), relation(spark, d, "run_b"))


@query("j17_box_to_instance", f"{B}, {_CROSS}, m as (select clip_id, f, tid, other as instance from p where iou > 0.4 qualify row_number() over (partition by clip_id, f, tid order by iou desc, other) = 1) select clip_id, f, tid, instance, instance is null fallback from obs left join m using (clip_id, f, tid)")
def _(spark, d):
    return pr.box_to_instance(relation(spark, d, "obs"), relation(spark, d, "run_b"))


@query("j18_duplicate_hosts", f"""{O}, {_SELF}, ev as (select clip_id, tid, count(*)::double evidence, tid % 2 = 0 locked from obs group by 1, 2),
  t as (select clip_id, tid, other as host, sum(cover) s from p group by 1, 2, 3), top as (select * from t qualify row_number() over (partition by clip_id, tid order by s desc, host) = 1),
  n as (select clip_id, tid, count(*) as n_rows from obs group by 1, 2)
  select top.clip_id, top.tid, top.host, round(s / n_rows, 6) mean_cover from top join n using (clip_id, tid) join ev o on o.clip_id = top.clip_id and o.tid = top.tid join ev h on h.clip_id = top.clip_id and h.tid = top.host
  where s / n_rows >= 0.02 and h.locked and h.evidence >= 0.5 * greatest(1, o.evidence)""")
def _(spark, d):
    obs = relation(spark, d, "obs")
    evidence = obs.groupBy("clip_id", "tid").agg(F.count(F.lit(1)).cast("double").alias("evidence")).withColumn("locked", F.col("tid") % 2 == 0)
    return pr.duplicate_hosts(obs, evidence, 0.02, 0.5).withColumn("mean_cover", F.round("mean_cover", 6))


_MASKS = "c as (select clip_id, f, tid, r * 64 + k as cell from obs, range(floor(y1/40)::bigint, ceil(y2/40)::bigint) rr(r), range(floor(x1/40)::bigint, ceil(x2/40)::bigint) cc(k)), mi as (select a.clip_id, a.f, a.tid, b.tid other, count(*) inter from c a join c b using (clip_id, f, cell) where a.tid <> b.tid group by all), ma as (select clip_id, f, tid, count(*) area from c group by all)"


@query("a26_duplicate_of", f"""{O}, {_SELF}, {_MASKS}, x as (select p.clip_id, p.f, p.tid, p.other as host, cover, coalesce(inter, 0) / greatest(1, area) frac from p join ma using (clip_id, f, tid) left join mi using (clip_id, f, tid, other)),
  best as (select * from x qualify row_number() over (partition by clip_id, f, tid order by greatest(frac, cover) desc, host) = 1),
  l as (select clip_id, tid, host, 'mask' how from best where frac >= 0.25 union all select clip_id, tid, host, 'box' from best where cover >= 0.15),
  n as (select clip_id, tid, count(*) as n_views from obs group by 1, 2), v as (select clip_id, tid, how, host, count(*) votes from l group by all),
  m as (select * from v qualify row_number() over (partition by clip_id, tid, how order by votes desc, host) = 1)
  select clip_id, tid, host dup_of, how, votes, n_views as views from m join n using (clip_id, tid) where votes * 2 > n_views qualify row_number() over (partition by clip_id, tid order by how desc) = 1""")
def _(spark, d):
    return _duplicates(spark, d)


@query("j01_mask_hosts", f"""{O}, {_SELF}, {_MASKS}, x as (select p.clip_id, p.f, p.tid, p.other as host, coalesce(inter, 0) / greatest(1, area) frac, cover box_frac from p join ma using (clip_id, f, tid) left join mi using (clip_id, f, tid, other))
  select * from x qualify row_number() over (partition by clip_id, f, tid order by greatest(frac, box_frac) desc, host) = 1""")
def _(spark, d):
    return mk.insides(_views(spark, d))


def _duplicates(spark, d):
    """Mask and box shares are low, as the fixture's tracks lie beside each other."""
    return pr.duplicate_of(relation(spark, d, "obs"), mk.insides(_views(spark, d)), 0.25, 0.15)


def _views(spark, d):
    """Views with their masks."""
    return relation(spark, d, "obs").withColumn("intervals", mk.rectangle_intervals(geo.box(), CELL, COLUMNS))


_COV = "cov as (select clip_id, tid, count(*) seen, sum(a)::bigint frames_a, sum(b)::bigint frames_b, sum(a) / count(*) share_a, sum(b) / count(*) share_b from (select clip_id, tid, f, max(has_a::int) a, max(has_b::int) b from layers group by 1, 2, 3) group by 1, 2)"
_VER = "ver as (select *, case when share_a >= 0.65 and share_b >= 0.65 then 'conflict' when share_a >= 0.65 then 'a' when share_b >= 0.65 then 'b' when share_a > 0 or share_b > 0 then 'flicker' else 'none' end verdict from cov)"


def _coverage(spark, d):
    return pr.label_coverage(relation(spark, d, "layers"), {"a": F.col("has_a"), "b": F.col("has_b")})


@query("coverage_verdict", f"{L}, {_COV}, {_VER} select * from ver")
def _(spark, d):
    """A11, the flagship: per identity the share of frames that each label covers, and the verdict."""
    return pr.verdicts(_coverage(spark, d), "a", "b", 0.65)


_LB = ctes("layers", "run_b")


@query("a12_verdict_rates", f"""{_LB}, {_COV}, {_VER}, t as (select * from layers where has_a), o as (select * from run_b where tid % 3 = 0), hit as (select distinct a.clip_id, a.f, a.tid from t a join o b on a.clip_id = b.clip_id and a.f = b.f where {q.iou('a.', 'b.')} >= 0.5),
  i as (select clip_id, count(*) identities, count(*) filter (verdict in ('flicker', 'none')) escapes, count(*) filter (verdict = 'conflict') conflicts, quantile_cont(seen, 0.5) median_seen from ver group by 1),
  n as (select clip_id, count(*) target_obs from t group by 1), c as (select clip_id, count(*) conflict_obs from hit group by 1)
  select clip_id, coalesce(identities, 0) identities, coalesce(escapes, 0) escapes, coalesce(conflicts, 0) conflicts, median_seen, coalesce(target_obs, 0) target_obs, coalesce(conflict_obs, 0) conflict_obs, escapes / nullif(identities, 0) escape_rate, coalesce(conflict_obs, 0) / nullif(target_obs, 0) conflict_rate from i full join n using (clip_id) left join c using (clip_id)""")
def _(spark, d):
    return pr.verdict_rates(pr.verdicts(_coverage(spark, d), "a", "b", 0.65), relation(spark, d, "layers").filter("has_a"), relation(spark, d, "run_b").filter("tid % 3 = 0"))


@query("a12_label_summary", f"""{L}, p as (select clip_id, tid, f, 'a' as label from layers where has_a union all select clip_id, tid, f, 'b' from layers where has_b), t as (select clip_id, label, tid, count(*) n, max(f) - min(f) + 1 span from p group by all), nf as (select clip_id, max(f) + 1 n_frames from obs group by 1)
  select clip_id, label, count(*) tracks, sum(n)::bigint obs, sum(n) / greatest(1, any_value(n_frames)) obs_per_frame, quantile_cont(span, 0.5) median_span from t join nf using (clip_id) group by all""")
def _(spark, d):
    lay = relation(spark, d, "layers")
    of = lambda x: lay.filter(f"has_{x}").select("clip_id", "tid", "f", F.lit(x).alias("label"))
    return pr.label_summary(of("a").unionByName(of("b")), relation(spark, d, "obs").groupBy("clip_id").agg((F.max("f") + 1).alias("n_frames")))


_COVX = "covx as (select clip_id, tid, count(*) seen, sum(a) / count(*) share_a, sum(b) / count(*) share_b, sum(x) / count(*) share_x, sum(y) / count(*) share_y from (select clip_id, tid, f, max(has_a::int) a, max(has_b::int) b, max((eid % 3 > 0)::int) x, max((eid % 2 > 0)::int) y from layers group by 1, 2, 3) group by 1, 2)"


@query("a11_explained_escapes", f"""{L}, {_COVX}, {_VER.replace("from cov", "from covx").replace("0.65", "0.6")} select clip_id, tid, verdict, case when verdict in ('flicker', 'none') then nullif(concat_ws(',', case when share_x >= 0.65 then 'x' end, case when share_y >= 0.65 then 'y' end), '') end explained_by from ver""")
def _(spark, d):
    c = pr.label_coverage(relation(spark, d, "layers"), {"a": F.col("has_a"), "b": F.col("has_b"), "x": F.col("eid") % 3 > 0, "y": F.col("eid") % 2 > 0})
    return pr.explained(pr.verdicts(c, "a", "b", 0.6), ["x", "y"], 0.65).select("clip_id", "tid", "verdict", "explained_by")


@query("a13_share_histogram", f"{L}, {_COV} select clip_id, count(*) filter (share_b = 0) zero, count(*) filter (share_b > 0 and share_b < 0.25) q1, count(*) filter (share_b >= 0.25 and share_b < 0.5) q2, count(*) filter (share_b >= 0.5 and share_b < 0.75) q3, count(*) filter (share_b >= 0.75) q4 from cov group by 1")
def _(spark, d):
    return pr.share_histogram(_coverage(spark, d), "share_b")


@query("l06_escapes", f"{L}, {_COV}, {_VER} select clip_id, tid, verdict from ver where verdict in ('none', 'flicker')")
def _(spark, d):
    return pr.verdicts(_coverage(spark, d), "a", "b", 0.65).filter(F.col("verdict").isin("none", "flicker")).select("clip_id", "tid", "verdict")


@query("l03_coverage_selector", f"{L}, {_COV} select clip_id, tid, unnest(list_filter([case when share_a >= 0.6 then 'a' end, case when share_b >= 0.6 then 'b' end], lambda x: x is not null)) as label from cov")
def _(spark, d):
    shares = F.create_map(F.lit("a"), F.col("share_a"), F.lit("b"), F.col("share_b"))
    return _coverage(spark, d).select("clip_id", "tid", F.explode(F.map_keys(F.map_filter(shares, lambda k, v: v >= 0.6))).alias("label"))
