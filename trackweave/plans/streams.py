"""Registered queries: the batch side of the streaming operators (streams must give the same rows)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import shared_folder
from ..streaming import pieces as pc
from ..streaming import tracks as st
from .fixtures import ctes, relation
from .identity import OVERLAP, STEP, chunked_masks
from .masks import CELLS, _masks
from .registry import query

O = ctes("obs")  # noqa: E741
_EV = "e as (select (user_id % 8)::int clip_id, user_id::int tid, (event_id % 100)::int f, epoch_us(ts) us, ts, value score from events)"


def timed(spark, d):
    e = relation(spark, d, "events")
    return e.select((F.col("user_id") % 8).cast("int").alias("clip_id"), F.col("user_id").cast("int").alias("tid"), (F.col("event_id") % 100).cast("int").alias("f"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("score"))


@query("st1_track_sessions", f"with {_EV}, l as (select *, us - lag(us) over (partition by clip_id, tid order by us) > 3600000000 or lag(us) over (partition by clip_id, tid order by us) is null new_ from e), s as (select *, sum(new_::int) over (partition by clip_id, tid order by us rows unbounded preceding) k from l) select clip_id, tid, min(us)::bigint begin_us, (max(us) + 3600000000)::bigint end_us, count(*) n, min(f) first_f, max(f) last_f, max(score) best from s group by clip_id, tid, k")
def _(spark, d):
    s = st.track_sessions(timed(spark, d), "1 hour")
    return s.select("clip_id", "tid", F.unix_micros("begin").alias("begin_us"), F.unix_micros("end").alias("end_us"), "n", "first_f", "last_f", "best")


@query("st6_window_best", f"with {_EV} select clip_id, tid, (us // 3600000000 * 3600000000)::bigint begin_us, arg_max(score, row(score, -f)) score, -max(row(score, -f))[2] f, count(*) n from e group by clip_id, tid, us // 3600000000".replace("-max(row(score, -f))[2] f", "arg_max(f, row(score, -f)) f"))
def _(spark, d):
    b = st.window_best(timed(spark, d), "1 hour")
    return b.select("clip_id", "tid", F.unix_micros("begin").alias("begin_us"), "score", "f", "n")


_LIVES = "l as (select *, coalesce(f - lag(f) over (partition by clip_id, tid order by f) > 6, true)::int begins from obs), s as (select *, sum(begins) over (partition by clip_id, tid order by f) life from l)"


@query("st1_lost_tracks", f"{O}, {_LIVES} select clip_id, tid, min(f) first_f, max(f) last_f, count(*) n from s group by clip_id, tid, life")
def _(spark, d):
    return st.lost_tracks(relation(spark, d, "obs"), 6)


def drained(stream, schema: str | None = None, mode: str = "append"):
    """What a stream gives of all that is there now: run to its end, each micro-batch into a table, with its number as `batch`."""
    spark = stream.sparkSession
    path = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    keep = lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("append").parquet(f"{path}/rows")
    stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.withColumn("batch", F.lit(0).cast("long")).schema).parquet(f"{path}/rows")


def replayed(spark, df, files: int = 8):
    """A table as a stream of files, a few at a time, that come in order of `order`."""
    path = f"{shared_folder(spark)}/input-{uuid.uuid4().hex}"
    df.repartitionByRange(files, "order").drop("order").write.parquet(path)
    return spark.readStream.schema(df.drop("order").schema).option("maxFilesPerTrigger", 2).parquet(path)


@query("st8_append_stitch")
def _(spark, d):
    """Pieces in order of their number; the same ids as j11_m05_stitch."""
    pieces = pc.as_pieces(chunked_masks(spark, d), STEP, OVERLAP, CELLS)
    return drained(pc.stitch_pieces(replayed(spark, pieces.withColumn("order", F.col("chunk"))))).drop("batch")


@query("st5_look_ahead_union", f"{O}, ca as (select clip_id, f, r * 64 + c as cell from obs, range(floor(y1/40)::bigint, ceil(y2/40)::bigint) rr(r), range(floor(x1/40)::bigint, ceil(x2/40)::bigint) cc(c)), s as (select distinct clip_id, cell, g from ca, range(greatest(0, f - 2), f + 3) t(g)) select clip_id, g::int f, count(*) area from s group by 1, 2")
def _(spark, d):
    """The batch side: w08's rule without an end of the clip, as a stream does not know it."""
    return st.look_ahead_union(_masks(spark, d), 2)
