"""Track state over streams of observations: sessions, lost-track timeouts, windowed tops, locked profiles.

The batch result is the truth; a stream emits the same rows once its watermark has passed them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import masks as mk

OBS = "clip_id int, tid int, f int, ts timestamp, score double"


def read_observations(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Parquet files of (clip_id, tid, f, ts, score) as a stream."""
    return spark.readStream.schema(OBS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def lost_buffer(fps: float, buffer_at_30: int) -> int:
    """A buffer counted in frames of 30 a second, in frames of this clip."""
    return math.ceil(fps / 30.0 * buffer_at_30)


def track_sessions(obs: DataFrame, gap: str = "4 seconds", late: str = "10 seconds") -> DataFrame:
    """One row per life of a track: a life ends when nothing is seen for `gap`.  Works on batches and streams."""
    if obs.isStreaming:
        obs = obs.withWatermark("ts", late)
    s = obs.groupBy("clip_id", "tid", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.min("f").alias("first_f"), F.max("f").alias("last_f"), F.max("score").alias("best"))
    return s.select("clip_id", "tid", F.col("w.start").alias("begin"), F.col("w.end").alias("end"), "n", "first_f", "last_f", "best")


def window_best(obs: DataFrame, width: str = "5 seconds", late: str = "10 seconds") -> DataFrame:
    """The best score of each track and window: the state is one number per open window, pruned by the watermark."""
    if obs.isStreaming:
        obs = obs.withWatermark("ts", late)
    b = obs.groupBy("clip_id", "tid", F.window("ts", width).alias("w")).agg(F.max(F.struct("score", (-F.col("f")).alias("nf"))).alias("b"), F.count(F.lit(1)).alias("n"))
    return b.select("clip_id", "tid", F.col("w.start").alias("begin"), F.col("b.score").alias("score"), (-F.col("b.nf")).alias("f"), "n")


LOST = "clip_id int, tid int, first_f int, last_f int, n long"
OPEN = "firsts array<int>, lasts array<int>, counts array<int>, ends array<long>"


def _joined(lives: list[tuple[int, int, int, int]], lost_frames: int) -> list[tuple[int, int, int, int]]:
    """Lives (first frame, last frame, count, time of the last frame), those at most lost_frames apart made one."""
    out: list[tuple[int, int, int, int]] = []
    for first, last, n, end in sorted(lives):
        if out and first - out[-1][1] <= lost_frames:
            begin, before, m, until = out.pop()
            first, last, n, end = begin, max(last, before), n + m, max(end, until)
        out.append((first, last, n, end))
    return out


def lost_tracks(obs: DataFrame, lost_frames: int, fps: float = 25.0, late: str = "10 seconds") -> DataFrame:
    """Lives of tracks by frame number: a track not seen for more than lost_frames is lost, and the next observation begins
    another life.  A batch gives all lives.  A stream gives a life once its watermark says that no row can prolong it, which
    a timer notices even if the track is never seen again; the state of a track is its lives not given yet and goes with
    the last of them."""
    if not obs.isStreaming:
        w = Window.partitionBy("clip_id", "tid").orderBy("f")
        begins = F.coalesce(F.col("f") - F.lag("f").over(w) > lost_frames, F.lit(True))
        lives = obs.select("clip_id", "tid", "f", begins.cast("int").alias("begins")).withColumn("life", F.sum("begins").over(w))
        return lives.groupBy("clip_id", "tid", "life").agg(F.min("f").alias("first_f"), F.max("f").alias("last_f"), F.count(F.lit(1)).alias("n")).drop("life")
    patience = math.ceil(lost_frames / fps * 1000)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        lives = list(zip(*state.get, strict=True)) if state.exists else []
        for rows in frames:
            lives += [(f, f, 1, ms) for f, ms in zip(rows["f"].tolist(), rows["ms"].tolist(), strict=True)]
        lives, now = _joined(lives, lost_frames), state.getCurrentWatermarkMs()
        over = [(*key, first, last, n) for first, last, n, end in lives if end + patience < now]
        kept = [x for x in lives if x[3] + patience >= now]
        if kept:
            state.update(tuple(list(c) for c in zip(*kept, strict=True)))
            state.setTimeoutTimestamp(min(x[3] for x in kept) + patience + 1)
        elif state.exists:
            state.remove()
        if over:
            yield pd.DataFrame(over, columns=["clip_id", "tid", "first_f", "last_f", "n"])

    timed = obs.withWatermark("ts", late).select("clip_id", "tid", "f", "ts", F.unix_millis("ts").alias("ms"))
    return timed.groupBy("clip_id", "tid").applyInPandasWithState(step, LOST, OPEN, "append", GroupStateTimeout.EventTimeTimeout)


PROFILE = "clip_id int, tid int, alpha double, beta double, side int"


def locked_profiles(attrs: DataFrame, lock_evidence: float = 8.0, lock_share: float = 0.9, damp: float = 0.2, clear: float = 0.8) -> DataFrame:
    """Running Beta profile of each track with its lock, updated per micro-batch.  attrs: clip_id, tid, f, p, w."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        alpha, beta, side = state.get if state.exists else (1.0, 1.0, 0)
        rows = pd.concat(list(frames)).sort_values("f", kind="stable")
        for p, w in zip(rows["p"], rows["w"], strict=True):
            if side and (1 if p >= 0.5 else 2) != side and w < clear:
                w *= damp
            alpha, beta = alpha + w * p, beta + w * (1 - p)
            if not side and alpha + beta - 2 >= lock_evidence:
                share = alpha / (alpha + beta)
                side = 1 if share >= lock_share else 2 if share <= 1 - lock_share else 0
        state.update((float(alpha), float(beta), int(side)))
        yield pd.DataFrame([(*key, alpha, beta, side)], columns=["clip_id", "tid", "alpha", "beta", "side"])

    return attrs.groupBy("clip_id", "tid").applyInPandasWithState(step, PROFILE, "alpha double, beta double, side int", "update", GroupStateTimeout.NoTimeout)


WINDOWS = "clip_id int, tid int, wins array<int>, fs array<int>, qualities array<double>"


def kept_windows(views: DataFrame, min_gap: int = 5, keep: int = 20) -> DataFrame:
    """The best view of each window of min_gap frames, of a stream, with at most `keep` windows of a track as its state: a
    new window drives out the worst one if it is better; a view replaces its window's if it is better.  Each micro-batch
    gives the state of the tracks it touched.  views: clip_id, tid, f, quality.

    What stays equals `sequences.best_windows` of the whole track, unless a window that was driven out, or not let in, would later
    have got a view good enough to stay: that view then begins the window anew, and its earlier frames are forgotten."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        wins = {w: (q, f) for w, f, q in zip(*state.get, strict=True)} if state.exists else {}
        rows = pd.concat(list(batches)).sort_values("f", kind="stable")
        for f, q in zip(rows["f"].tolist(), rows["quality"].tolist(), strict=True):
            w = f // min_gap
            if w in wins:
                if q > wins[w][0]:
                    wins[w] = (q, f)
            elif len(wins) < keep or q > min(wins.values())[0]:
                wins[w] = (q, f)
                if len(wins) > keep:
                    del wins[min(wins, key=lambda k: (wins[k][0], -wins[k][1]))]
        columns = [list(c) for c in zip(*((w, f, q) for w, (q, f) in sorted(wins.items())), strict=True)]
        state.update(tuple(columns))
        yield pd.DataFrame({"clip_id": [key[0]], "tid": [key[1]], "wins": [columns[0]], "fs": [columns[1]], "qualities": [columns[2]]})

    return views.groupBy("clip_id", "tid").applyInPandasWithState(step, WINDOWS, "wins array<int>, fs array<int>, qualities array<double>", "update", GroupStateTimeout.NoTimeout)


def look_ahead_union(masks: DataFrame, reach: int, frame_ms: int = 40) -> DataFrame:
    """Per clip and frame how many cells the masks at most `reach` frames away cover: clip_id, f, area.  masks: clip_id, f, intervals.

    A stream gives a frame once nothing before frame f + reach can come any more: every mask is sent to the frames it
    reaches, whose time is f * frame_ms, and the watermark follows the latest frame by twice the reach.  Rows that come later
    than that are late.  The state holds the masks of at most 2 * reach + 1 frames."""
    target = F.explode(F.sequence(F.greatest(F.lit(0), F.col("f") - reach), F.col("f") + reach))
    sent = masks.select("clip_id", "intervals", target.alias("g")).withColumn("at", F.timestamp_millis(F.col("g").cast("long") * frame_ms))
    if masks.isStreaming:
        sent = sent.withWatermark("at", f"{(2 * reach + 1) * frame_ms} milliseconds")
    frames = sent.groupBy("clip_id", F.window("at", f"{frame_ms} milliseconds").alias("w")).agg(F.flatten(F.collect_list("intervals")).alias("every"))
    return frames.select("clip_id", (F.unix_millis("w.start") / frame_ms).cast("int").alias("f"), mk.union_size(F.col("every")).alias("area"))
