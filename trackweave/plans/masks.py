"""Registered queries: masks on a grid of 40-pixel cells, 64 to a row.  The oracles count single cells."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..operators import chunks as ch
from ..operators import masks as mk
from ..session import shared_folder
from ..sources import bundle
from .fixtures import ctes, relation
from .registry import query

CELL, COLUMNS, CELLS = 40.0, 64, 64 * 40
O, B = ctes("obs"), ctes("run_b", "obs")  # noqa: E741


def _masks(spark, d, name="obs", tid="tid"):
    obs = relation(spark, d, name)
    return obs.select("clip_id", "f", F.col("tid").alias(tid), mk.rectangle_intervals(geo.box(), CELL, COLUMNS).alias("intervals"))


def _cells(name: str) -> str:
    return f"(select clip_id, f, tid, r * 64 + c as cell from {name}, range(floor(y1/40)::bigint, ceil(y2/40)::bigint) rr(r), range(floor(x1/40)::bigint, ceil(x2/40)::bigint) cc(c))"


_CA, _CB = f"ca as {_cells('obs')}", f"cb as {_cells('run_b')}"


@query("p05_p06_mask_measures", f"{O}, {_CA}, lag_ as (select *, lag(cell) over (partition by clip_id, f, tid order by cell) prev from ca) select clip_id, f, tid, count(*) area, min(cell % 64)::int c1, min(cell // 64)::int r1, (max(cell % 64) + 1)::int c2, (max(cell // 64) + 1)::int r2, (2 * count(*) filter (prev is null or cell - prev > 1) + 1)::int n_runs from lag_ group by 1, 2, 3")
def _(spark, d):
    m = _masks(spark, d).withColumn("b", mk.bounds(F.col("intervals"), COLUMNS)).withColumn("counts", mk.to_runs(F.col("intervals"), CELLS))
    back = m.withColumn("intervals", mk.from_runs(F.col("counts")))
    return back.select("clip_id", "f", "tid", mk.area(F.col("intervals")).alias("area"), "b.*", F.size("counts").alias("n_runs"))


@query("p06_mask_iou", f"{B}, {_CA}, {_CB}, i as (select a.clip_id, a.f, a.tid tid_a, b.tid tid_b, count(*) inter from ca a join cb b using (clip_id, f, cell) group by all), na as (select clip_id, f, tid tid_a, count(*) area_a from ca group by all), nb as (select clip_id, f, tid tid_b, count(*) area_b from cb group by all) select clip_id, f, tid_a, tid_b, inter, area_a, area_b, inter / (area_a + area_b - inter) iou from i join na using (clip_id, f, tid_a) join nb using (clip_id, f, tid_b)")
def _(spark, d):
    return mk.mask_iou(_masks(spark, d, "obs", "tid_a"), _masks(spark, d, "run_b", "tid_b"), ["clip_id", "f"], ["tid_a"], ["tid_b"])


_BOUNDARY = f"""{B}, {_CA}, {_CB}, n as (select clip_id, max(f) + 1 n from obs group by 1), bd as (select clip_id, k::int boundary, unnest(range((k + 1) * 25, (k + 1) * 25 + 5)) f from n, range(0, 1000) t(k) where (k + 1) * 25 + 5 < n),
  x as (select * from ca join bd using (clip_id, f)), y as (select * from cb join bd using (clip_id, f)), i as (select a.clip_id, a.boundary, a.tid tid_a, b.tid tid_b, count(*) inter from x a join y b using (clip_id, f, cell) group by all),
  na as (select clip_id, boundary, tid tid_a, count(*) area_a from x group by all), nb as (select clip_id, boundary, tid tid_b, count(*) area_b from y group by all)
  select clip_id, boundary, tid_a, tid_b, inter, area_a, area_b, inter / (area_a + area_b - inter) iou from i join na using (clip_id, boundary, tid_a) join nb using (clip_id, boundary, tid_b)"""


def _boundary(spark, d):
    """Over every overlap of a schedule of chunks of 30 frames that share 5."""
    at = ch.boundaries(ch.schedule(relation(spark, d, "obs").groupBy("clip_id").agg((F.max("f") + 1).alias("n_frames")), 30, 5))
    return mk.boundary_iou(_masks(spark, d, "obs", "tid_a").join(at, ["clip_id", "f"]), _masks(spark, d, "run_b", "tid_b").join(at, ["clip_id", "f"]), "boundary")


@query("j10_boundary_iou", _BOUNDARY)
def _(spark, d):
    return _boundary(spark, d)


@query("j10_boundary_iou_all", _BOUNDARY)
def _(spark, d):
    return _boundary(spark, d)


@query("w08_temporal_union", f"{O}, {_CA}, s as (select distinct clip_id, cell, g from ca, range(greatest(0, f - 2), least(99, f + 2) + 1) t(g)) select clip_id, g::int f, count(*) area from s group by 1, 2")
def _(spark, d):
    return mk.temporal_union(_masks(spark, d), 2, 100)


@query("a14_veiled_share", f"{B}, {_CA}, {_CB}, u as (select distinct clip_id, f, cell, true hit from cb where tid % 2 = 0), p as (select clip_id, f, tid, count(hit) / count(*) share from ca left join u using (clip_id, f, cell) group by 1, 2, 3) select clip_id, tid, count(*) frames, avg(case when share >= 0.5 then 1.0 else 0.0 end)::double veiled from p group by 1, 2")
def _(spark, d):
    return mk.covered_share(_masks(spark, d), _masks(spark, d, "run_b").filter("tid % 2 = 0"))


_VEILED = f"{B}, {_CA}, {_CB}, u as (select distinct clip_id, f, cell, true hit from cb where tid % 2 = 0), p as (select clip_id, f, tid, count(hit) / count(*) share from ca left join u using (clip_id, f, cell) group by 1, 2, 3), w as (select clip_id, tid, avg(case when share >= 0.5 then 1.0 else 0.0 end)::double veiled from p group by 1, 2)"


@query("a14_veiled_summary", f"{_VEILED} select clip_id, case when tid % 2 = 0 then 'a' else 'b' end as label, count(*) persons, round(avg(veiled), 9) mean_veiled, count(*) filter (veiled < 0.5) below_half, count(*) filter (veiled >= 0.5) half_or_more, count(*) filter (veiled = 0) never from w group by 1, 2")
def _(spark, d):
    shares = mk.covered_share(_masks(spark, d), _masks(spark, d, "run_b").filter("tid % 2 = 0"))
    labels = relation(spark, d, "obs").select("clip_id", "tid", F.when(F.col("tid") % 2 == 0, "a").otherwise("b").alias("label")).distinct()
    return mk.veiled_summary(shares, labels).withColumn("mean_veiled", F.round("mean_veiled", 9))


@query("r14_union_masks", f"{O}, {_CA}, u as (select distinct clip_id, f, cell from ca), g as (select *, cell - row_number() over (partition by clip_id, f order by cell) g from u) select clip_id, f, min(cell)::int s, (max(cell) + 1)::int e from g group by clip_id, f, g.g")
def _(spark, d):
    return mk.union(_masks(spark, d), ["clip_id", "f"])


_AGREE = f"{B}, {_CA}, {_CB}, ua as (select distinct clip_id, f, cell, 1 a from ca where f % 3 <> 0), ub as (select distinct clip_id, f, cell, 1 b from cb where f % 4 <> 0), fr as (select clip_id, f, count(a) area_a, count(b) area_b, count(case when a = 1 and b = 1 then 1 end) as n_both, count(*) as n_any from ua full join ub using (clip_id, f, cell) group by 1, 2)"


def _agreement(spark, d):
    return mk.pixel_agreement(_masks(spark, d).filter("f % 3 <> 0"), _masks(spark, d, "run_b").filter("f % 4 <> 0"))


@query("a17_pixel_agreement", f"{_AGREE} select clip_id, sum(n_both) / sum(n_any) iou, sum(n_both) / sum(area_a) recall, sum(n_both) / sum(area_b) as \"precision\", count(*) filter (area_b = 0) only_a, count(*) filter (area_a = 0) only_b from fr group by 1")
def _(spark, d):
    return mk.agreement_summary(_agreement(spark, d))


@query("t03_worst_frames", f"{_AGREE} select clip_id, f, n_both / n_any iou from fr qualify row_number() over (partition by clip_id order by n_both / n_any, f) <= 8")
def _(spark, d):
    return mk.worst_frames(_agreement(spark, d))


@query("r16_identity_masks", f"{O} select o.clip_id, o.f, o.tid, (tid // 8)::bigint identity, tid % 3 = 1 veiled from obs o where tid % 5 <> 0")
def _(spark, d):
    """J02: rows of tracks without an identity are left out."""
    bridge = relation(spark, d, "obs").select("clip_id", "tid").distinct().filter("tid % 5 <> 0").select("clip_id", "tid", F.floor(F.col("tid") / 8).alias("identity"), (F.col("tid") % 3 == 1).alias("veiled"))
    return _masks(spark, d).join(bridge, ["clip_id", "tid"]).select("clip_id", "f", "tid", "identity", "veiled")


@query("s23_bundle_round_trip", f"{O}, {_CA} select clip_id, f, tid, count(*) area from ca group by 1, 2, 3")
def _(spark, d):
    runs = _masks(spark, d).select("clip_id", "f", "tid", mk.to_runs(F.col("intervals"), CELLS).alias("counts"))
    back = mk.decode_bundle(mk.encode_bundle(runs))
    return back.select("clip_id", "f", "tid", mk.area(mk.from_runs(F.col("counts"))).alias("area"))


@query("p06_mask_intersect", f"{B}, {_CA}, {_CB}, i as (select a.clip_id, a.f, a.tid tid_a, b.tid tid_b, cell from ca a join cb b using (clip_id, f, cell)), g as (select *, cell - row_number() over (partition by clip_id, f, tid_a, tid_b order by cell) g from i) select clip_id, f, tid_a, tid_b, min(cell)::int s, (max(cell) + 1)::int e from g group by clip_id, f, tid_a, tid_b, g.g")
def _(spark, d):
    both = mk.intersections(_masks(spark, d, "obs", "tid_a"), _masks(spark, d, "run_b", "tid_b"), ["clip_id", "f"], ["tid_a"], ["tid_b"])
    return mk.exploded(both, "clip_id", "f", "tid_a", "tid_b")


_PARTS = "parts as (select clip_id, f, tid, x1 + k * 30 x1, y1 + (eid % 4) * 40 y1, x1 + k * 30 + 20 x2, y1 + (eid % 4) * 40 + 15 + eid % 20 y2, (40 + (eid * (k + 1)) % 60) / 100.0::double score from obs, range(0, 3) t(k))"


@query("p06_accepted_parts", f"{O}, {_CA}, {_PARTS}, ok as (select p.* from parts p join ca c on c.clip_id = p.clip_id and c.f = p.f and c.tid = p.tid and c.cell = floor(floor((y1 + y2) / 2) / 40)::bigint * 64 + floor(floor((x1 + x2) / 2) / 40)::bigint where y2 - y1 >= 24 and score >= 0.6 and x1 + x2 >= 0 and x1 + x2 < 2 * 64 * 40) select * from ok qualify row_number() over (partition by clip_id, f, tid order by score desc, x1, y1) = 1")
def _(spark, d):
    """Three parts a box, some of them beside it."""
    o = relation(spark, d, "obs").withColumn("k", F.explode(F.array(*map(F.lit, range(3)))))
    top, left = F.col("y1") + (F.col("eid") % 4) * 40, F.col("x1") + F.col("k") * 30
    parts = o.select("clip_id", "f", "tid", left.alias("x1"), top.alias("y1"), (left + 20).alias("x2"), (top + 15 + F.col("eid") % 20).alias("y2"), ((40 + (F.col("eid") * (F.col("k") + 1)) % 60) / F.lit(100.0)).alias("score"))
    return mk.accepted_parts(parts, _masks(spark, d), CELL, COLUMNS)


@query("m07_mask_segments", f"{O} select clip_id, f // 50 segment, min(f) from_f, max(f) to_f, count(distinct f) frames from obs group by 1, 2")
def _(spark, d):
    return ch.mask_segments(relation(spark, d, "obs"), 25.0, 2.0)


@query("s23_bundle_files", f"{O}, {_CA} select clip_id, f, tid, count(*) area from ca group by 1, 2, 3")
def _(spark, d):
    """The same through files: written as a bundle of two seconds a file, and read again."""
    path = f"{shared_folder(spark)}/bundle-{uuid.uuid4().hex}"
    bundle.write_bundle(_masks(spark, d).select("clip_id", "f", "tid", mk.to_runs(F.col("intervals"), CELLS).alias("counts")), path, seconds=2.0, wide=True)
    return bundle.read_bundle(spark, path).select("clip_id", "f", "tid", mk.area(mk.from_runs(F.col("counts"))).alias("area"))
