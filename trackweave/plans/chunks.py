"""Registered queries: chunked work."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chunks as ch
from .fixtures import ctes, relation
from .registry import query

O = ctes("obs")  # noqa: E741
_CLIPS = "clips as (select clip_id, (max(f) + 1 + clip_id)::int n_frames from obs group by 1)"


def _clips(spark, d):
    return relation(spark, d, "obs").groupBy("clip_id").agg((F.max("f") + 1).alias("m")).select("clip_id", (F.col("m") + F.col("clip_id")).cast("int").alias("n_frames"))


_EDGE = lambda i: f"round_even({i} * n_frames / 8.0::double, 0)::int"
_BOUNDS = f"b as (select clip_id, c::int chunk, {_EDGE('c')} start, {_EDGE('(c + 1)')} stop from clips, range(0, 8) t(c))"
_SCHED = "s as (select clip_id, c::int chunk, (c * 25)::int start, least(c * 25 + 30, n_frames)::int stop from clips, range(0, 8) t(c) where c < greatest(1, ceil((n_frames - 5) / 25.0)))"


@query("m01_chunk_bounds", f"{O}, {_CLIPS}, {_BOUNDS} select * from b")
def _(spark, d):
    return ch.chunk_bounds(_clips(spark, d), 8)


@query("m03_schedule", f"{O}, {_CLIPS}, {_SCHED} select * from s")
def _(spark, d):
    return ch.schedule(_clips(spark, d), 30, 5)


@query("m02_halo", f"{O}, {_CLIPS}, {_BOUNDS} select o.clip_id, o.f, o.tid, b.chunk, o.f < b.start warm_up from obs o join b on o.clip_id = b.clip_id and o.f >= greatest(0, b.start - 4) and o.f < b.stop")
def _(spark, d):
    return ch.with_halo(relation(spark, d, "obs"), ch.chunk_bounds(_clips(spark, d), 8), 4).select("clip_id", "f", "tid", "chunk", "warm_up")


@query("m04_owned", f"{O}, {_CLIPS}, {_SCHED} select o.clip_id, o.f, o.tid, min(s.chunk) chunk from obs o join s on o.clip_id = s.clip_id and o.f >= s.start and o.f < s.stop group by o.clip_id, o.f, o.tid, o.eid")
def _(spark, d):
    read = ch.with_halo(relation(spark, d, "obs"), ch.schedule(_clips(spark, d), 30, 5), 0)
    return ch.owned(read).select("clip_id", "f", "tid", "chunk")


@query("s06_local_frames", f"{O} select clip_id, tid, f, f - 40 local_f from obs where f >= 40")
def _(spark, d):
    return ch.local_frames(relation(spark, d, "obs"), 40).select("clip_id", "tid", "f", "local_f")


@query("m07_stride", f"{O} select distinct o.clip_id, o.tid, o.f, (o.f // 4 * 4)::int shown from obs o")
def _(spark, d):
    return relation(spark, d, "obs").select("clip_id", "tid", "f", ch.strided(F.col("f"), 4).alias("shown")).distinct()
