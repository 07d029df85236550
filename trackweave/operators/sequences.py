"""Per-track sequence operators on observations (clip_id, tid, f, x1, y1, x2, y2, score, ...).

All windows are partitioned by (clip_id, tid); the only wider ones rank tracks, or frames, of one clip.
Ties go to the lower frame, then to the lower id, unless an operator says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import spans as sp
from .intervals import overlapping

TRACK = ("clip_id", "tid")


def per_track(*order: str):
    return Window.partitionBy(*TRACK).orderBy(*(order or ("f",)))


def runs(frames: DataFrame, keys: tuple[str, ...] = TRACK) -> DataFrame:
    """Gaps and islands: inclusive [first_f, last_f] of consecutive frames; repeated frames count once."""
    w = Window.partitionBy(*keys).orderBy("f")
    islands = frames.select(*keys, "f").distinct().withColumn("island", F.col("f") - F.row_number().over(w))
    return islands.groupBy(*keys, "island").agg(F.min("f").alias("first_f"), F.max("f").alias("last_f"), F.count(F.lit(1)).alias("n")).drop("island")


def at_least(segments: DataFrame, least: int = 3) -> DataFrame:
    return segments.filter(F.col("n") >= least)


def spans(obs: DataFrame) -> DataFrame:
    return obs.groupBy(*TRACK).agg(F.min("f").alias("first_f"), F.max("f").alias("last_f"), F.count(F.lit(1)).alias("n"))


def holes(obs: DataFrame) -> DataFrame:
    """Life, missing frames and whether there are any."""
    life = F.col("last_f") - F.col("first_f") + 1
    return spans(obs).select(*TRACK, life.alias("life"), (life - F.col("n")).alias("holes"), (life > F.col("n")).alias("has_gap"))


def velocity(obs: DataFrame, n: int = 5) -> DataFrame:
    """Centre movement per frame over the last n observations (0 for a first one)."""
    w = per_track().rowsBetween(-(n - 1), 0)
    cx, cy = geo.center(geo.box())
    df = obs.withColumn("cx", cx).withColumn("cy", cy)
    dt = F.greatest(F.lit(1), F.col("f") - F.first("f").over(w))
    return df.withColumn("vx", (F.col("cx") - F.first("cx").over(w)) / dt).withColumn("vy", (F.col("cy") - F.first("cy").over(w)) / dt).drop("cx", "cy")


def fill_holes(obs: DataFrame, max_gap: int) -> DataFrame:
    """Adds linearly interpolated rows (filled = true) where at most max_gap frames are missing."""
    w = per_track()
    cols = ("x1", "y1", "x2", "y2")
    df = obs.select(*TRACK, "f", *cols).withColumn("nf", F.lead("f").over(w))
    for c in cols:
        df = df.withColumn(f"n{c}", F.lead(c).over(w))
    gaps = df.filter((F.col("nf") - F.col("f") > 1) & (F.col("nf") - F.col("f") - 1 <= max_gap)).withColumn("g", F.explode(F.sequence(F.col("f") + 1, F.col("nf") - 1)))
    t = (F.col("g") - F.col("f")) / (F.col("nf") - F.col("f"))
    filled = gaps.select(*TRACK, F.col("g").alias("f"), *[(F.col(c) + (F.col(f"n{c}") - F.col(c)) * t).alias(c) for c in cols], F.lit(True).alias("filled"))
    return obs.select(*TRACK, "f", *cols, F.lit(False).alias("filled")).unionByName(filled)


def with_previous(obs: DataFrame) -> DataFrame:
    """Adds pf and px1..py2, the track's observation before."""
    w = per_track()
    out = obs.withColumn("pf", F.lag("f").over(w))
    for c in ("x1", "y1", "x2", "y2"):
        out = out.withColumn(f"p{c}", F.lag(c).over(w))
    return out


def suspect_swaps(obs: DataFrame, filled: Column | None = None) -> DataFrame:
    """Consecutive observations at most 3 frames apart whose boxes hardly overlap and are far from each other."""
    df = with_previous(obs)
    a, b = geo.box("p"), geo.box()
    far = geo.distance(a, b) > 0.75 * F.greatest(geo.height(a), geo.height(b), F.lit(1.0))
    ok = (F.col("f") - F.col("pf") <= 3) & (geo.iou(a, b) < 0.1) & far
    return df.filter(ok if filled is None else ok & ~filled).select(*TRACK, "pf", "f")


def hops(obs: DataFrame) -> DataFrame:
    """The non-recursive part of the gap split: one-frame moves of the centre by more than the box's own height."""
    df = with_previous(obs)
    a, b = geo.box("p"), geo.box()
    return df.filter((F.col("f") - F.col("pf") == 1) & (geo.distance(a, b) > F.greatest(geo.height(a), F.lit(1.0)))).select(*TRACK, "f")


def cut_at(obs: DataFrame, cuts: DataFrame) -> DataFrame:
    """Adds `part`, the number of cut frames at or before each row."""
    marked = obs.join(cuts.select(*TRACK, "f").distinct().withColumn("cut", F.lit(1)), [*TRACK, "f"], "left")
    return marked.withColumn("part", F.coalesce(F.sum("cut").over(per_track().rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))).drop("cut")


def pick_spread(items: DataFrame, k: int, by: str, keys: tuple[str, ...] = TRACK) -> DataFrame:
    """The best item of each of k equal stretches, the first of equals; all items if k <= 0 or there are no more than k."""
    w = Window.partitionBy(*keys).orderBy("f")
    df = items.withColumn("i", F.row_number().over(w) - 1).withColumn("total", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    if k <= 0:
        return df.drop("i", "total")
    # index i lies in the bucket b with int(b * n / k) <= i; the last such b
    df = df.withColumn("b", F.when(F.col("total") <= k, F.col("i")).otherwise(F.ceil((F.col("i") + 1) * F.lit(k) / F.col("total")) - 1))
    best = Window.partitionBy(*keys, "b").orderBy(F.col(by).desc(), "f")
    return df.withColumn("r", F.row_number().over(best)).filter("r = 1").drop("i", "total", "b", "r")


def best_windows(views: DataFrame, by: str, min_gap: int = 5, keep: int = 20) -> DataFrame:
    """The best view of each window of min_gap frames, then the `keep` best windows of a track."""
    df = views.withColumn("win", F.floor(F.col("f") / min_gap))
    df = df.withColumn("r", F.row_number().over(Window.partitionBy(*TRACK, "win").orderBy(F.col(by).desc(), "f"))).filter("r = 1")
    return df.withColumn("r", F.row_number().over(Window.partitionBy(*TRACK).orderBy(F.col(by).desc(), "f"))).filter(F.col("r") <= keep).drop("r", "win")


def strip(obs: DataFrame, largest: int = 40, n: int = 8) -> DataFrame:
    """n views evenly spread in time among a track's largest ones."""
    area = geo.area(geo.box())
    df = obs.withColumn("area", area).withColumn("r", F.row_number().over(Window.partitionBy(*TRACK).orderBy(F.col("area").desc(), "f"))).filter(F.col("r") <= largest)
    df = df.withColumn("i", F.row_number().over(per_track()) - 1).withColumn("m", F.count(F.lit(1)).over(Window.partitionBy(*TRACK)))
    spots = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.floor(j * (F.col("m") - 1) / (n - 1)))
    return df.filter(F.array_contains(spots, F.col("i").cast("long"))).drop("r", "i", "m")


def every_nth(items: DataFrame, m: int) -> DataFrame:
    """Every step-th item, step = max(1, count // m), and of these the first m."""
    df = items.withColumn("i", F.row_number().over(per_track()) - 1).withColumn("step", F.greatest(F.lit(1), F.floor(F.count(F.lit(1)).over(Window.partitionBy(*TRACK)) / m)))
    return df.filter((F.col("i") % F.col("step") == 0) & (F.col("i") / F.col("step") < m)).drop("i", "step")


def best_observation(obs: DataFrame, by: str = "score") -> DataFrame:
    """A track's best row; the earliest of equals."""
    best = F.max_by(F.struct("f", "x1", "y1", "x2", "y2", by), F.struct(F.col(by), -F.col("f")))
    return obs.groupBy(*TRACK).agg(best.alias("b")).select(*TRACK, "b.*")


def taller_box(members: DataFrame, identity: str = "identity") -> DataFrame:
    """One box per identity and frame: the taller, then that of the lower track id."""
    key = F.struct(geo.height(geo.box()).alias("h"), (-F.col("tid")).alias("t"))
    return members.groupBy("clip_id", identity, "f").agg(F.max_by(F.struct("tid", "x1", "y1", "x2", "y2"), key).alias("b")).select("clip_id", identity, "f", "b.*")


def number_by_appearance(groups: DataFrame, start: int = 1) -> DataFrame:
    """Dense numbers per clip in order of first frame, then id; `groups` has one row per track."""
    return groups.withColumn("identity", F.row_number().over(Window.partitionBy("clip_id").orderBy("first_f", "tid")).cast("long") + (start - 1))


def worst_step(obs: DataFrame, windows: DataFrame) -> DataFrame:
    """For windows (clip_id, tid, a, b): the frame after the step of least overlap within [a, b], first of equals, and that overlap."""
    steps = with_previous(obs).filter("pf is not null").select(*TRACK, "pf", "f", geo.iou(geo.box("p"), geo.box()).alias("step_iou"))
    joined = windows.join(steps, list(TRACK)).filter("pf >= a and f <= b")
    return joined.groupBy(*TRACK, "a", "b").agg(F.min_by("f", F.struct("step_iou", "f")).alias("cut_f"), F.min("step_iou").alias("cut_iou"))


def appearance_cuts(obs: DataFrame, views: DataFrame, least: float = 0.35) -> DataFrame:
    """Where consecutive views (clip_id, tid, f, similarity to the next one) are unlike, the track is cut at the worst step between."""
    w = per_track()
    pairs = views.select(*TRACK, F.col("f").alias("a"), F.lead("f").over(w).alias("b"), "similarity").filter((F.col("b").isNotNull()) & (F.col("similarity") < least))
    return worst_step(obs, pairs.select(*TRACK, "a", "b"))


def vote_flip(votes: DataFrame, least: int = 6, side: int = 3, purity: float = 0.75) -> DataFrame:
    """The place where a track's votes flip from one label to the other: votes with weight, at least `least`, at least
    `side` on either side, both sides `purity` pure with different majorities; the purest split, first of equals."""
    w = per_track()
    v = votes.filter("w > 0 and label is not null").withColumn("one", F.when(F.col("label") == "a", 1).otherwise(0))
    v = v.withColumn("i", F.row_number().over(w) - 1).withColumn("left_one", F.coalesce(F.sum("one").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    v = v.withColumn("total", F.count(F.lit(1)).over(Window.partitionBy(*TRACK))).withColumn("ones", F.sum("one").over(Window.partitionBy(*TRACK))).withColumn("before_f", F.lag("f").over(w))
    left, right_n, right = F.col("i"), F.col("total") - F.col("i"), F.col("ones") - F.col("left_one")
    left_p = F.greatest(F.col("left_one"), left - F.col("left_one")) / left
    right_p = F.greatest(right, right_n - right) / right_n
    ok = (F.col("total") >= least) & (F.col("i") >= side) & (F.col("i") <= F.col("total") - side)
    v = v.filter(ok).withColumn("left_a", F.col("left_one") * 2 > left).withColumn("right_a", right * 2 > right_n).withColumn("lp", left_p).withColumn("rp", right_p)
    v = v.filter((F.col("left_a") != F.col("right_a")) & (F.col("lp") >= purity) & (F.col("rp") >= purity)).withColumn("purity", F.col("lp") + F.col("rp"))
    return v.groupBy(*TRACK).agg(F.max_by(F.struct("i", "before_f", "f"), F.struct("purity", (-F.col("i")).alias("first"))).alias("b"), F.max("purity").alias("purity")).select(*TRACK, F.col("b.i").cast("long").alias("i"), F.col("b.before_f").alias("a"), F.col("b.f").alias("b"), "purity")


#: Groups that a clip's tracks are dealt into where all of them meet.
PARTS = 8


def run_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Frames that two tracks of a clip share, from their runs; only pairs that share any.  A group holds part of a clip's left tracks
    and all right ones, and multiplies blocks of them: runs are shuffled, pairs are not."""
    part = F.pmod(F.xxhash64("tid"), F.lit(PARTS)).cast("int")
    a = left.select("clip_id", part.alias("_part"), F.col("tid").alias("tid_a"), "first_f", "last_f")
    b = right.select("clip_id", F.explode(F.array(*map(F.lit, range(PARTS)))).alias("_part"), F.col("tid").alias("tid_b"), "first_f", "last_f")
    both = a.withColumn("tid_b", F.lit(None).cast(dict(b.dtypes)["tid_b"])).unionByName(b.withColumn("tid_a", F.lit(None).cast(dict(a.dtypes)["tid_a"])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)).combine_chunks()
        (ids_a, x), (ids_b, y) = (_tracks(t.filter(pc.is_valid(t[c])), c) for c in ("tid_a", "tid_b"))
        for i, j, frames in sp.shared_blocks(x, y):
            k = np.flatnonzero(ids_a[i] < ids_b[j])
            if len(k):
                yield pa.RecordBatch.from_pydict({"clip_id": pa.repeat(t["clip_id"][0], len(k)), "tid_a": pa.array(ids_a[i[k]], t["tid_a"].type), "tid_b": pa.array(ids_b[j[k]], t["tid_b"].type), "frames": pa.array(frames[k])})

    kinds = dict(both.dtypes)
    return both.groupBy("clip_id", "_part").applyInArrow(run, f"clip_id {kinds['clip_id']}, tid_a {kinds['tid_a']}, tid_b {kinds['tid_b']}, frames long")


def _tracks(side: pa.Table, tid: str) -> tuple[np.ndarray, sp.Rows]:
    """Different tracks and their runs as intervals."""
    ids, of = np.unique(side[tid].to_numpy(), return_inverse=True)
    return ids, sp.Rows(of, side["first_f"].to_numpy(), side["last_f"].to_numpy().astype(np.int64) + 1, len(ids))


def fragments(obs: DataFrame, window: int = 60) -> DataFrame:
    """Track starts (after the clip's first) close in time and place to the end of another track."""
    w = per_track()
    df = obs.withColumn("r", F.row_number().over(w)).withColumn("q", F.row_number().over(per_track(F.col("f").desc())))
    cols = lambda p: [F.col(c).alias(f"{p}{c}") for c in ("tid", "f", "x1", "y1", "x2", "y2")]
    starts, ends = df.filter("r = 1").select("clip_id", *cols("s")), df.filter("q = 1").select("clip_id", *cols("e"))
    first = starts.groupBy("clip_id").agg(F.min("sf").alias("clip_first"))
    later = starts.join(first, "clip_id").filter("sf > clip_first")
    gap = F.col("sf") - F.col("ef")
    # an end lies in the stretch of `window` frames before a start
    met = overlapping(later.withColumn("from_f", F.col("sf") - window), ends, ["clip_id"], ("from_f", "sf"), ("ef", "ef"))
    met = met.filter((F.col("stid") != F.col("etid")) & (gap > 0) & (gap <= window) & geo.near(geo.box("e"), geo.box("s")))
    return met.select("clip_id", F.col("stid").alias("tid"), F.col("sf").alias("f")).distinct()


def continuity(obs: DataFrame, fps: float, n_frames: int) -> DataFrame:
    """Per clip: tracks, median and p90 span, share shorter than half a second, late births, tracks with gaps, and the
    largest and mean number of simultaneous tracks over all n_frames frames, empty ones included."""
    t = spans(obs).withColumn("life", F.col("last_f") - F.col("first_f") + 1)
    per_track_stats = t.groupBy("clip_id").agg(
        F.count(F.lit(1)).alias("tracks"), F.percentile("life", F.lit(0.5)).alias("median_life"), F.percentile("life", F.lit(0.9)).alias("p90_life"), F.avg(F.when(F.col("life") < 0.5 * fps, 1.0).otherwise(0.0)).alias("short_share"),
        F.sum(F.when((F.col("first_f") > 5) & (F.col("first_f") < n_frames - 5), 1).otherwise(0)).alias("late_births"), F.sum(F.when(F.col("life") > F.col("n"), 1).otherwise(0)).alias("with_gaps"),
    )
    per_frame = obs.filter(F.col("f") < n_frames).groupBy("clip_id", "f").agg(F.countDistinct("tid").alias("live"))
    load = per_frame.groupBy("clip_id").agg(F.max("live").alias("max_live"), (F.sum("live") / F.lit(float(n_frames))).alias("mean_live"))
    return per_track_stats.join(load, "clip_id", "left")


def stability(obs: DataFrame, short: int = 25, window: int = 60) -> DataFrame:
    """Per clip: tracks, life frames, holes and their share, short tracks, suspect swaps, likely fragments."""
    h = holes(obs).groupBy("clip_id").agg(F.count(F.lit(1)).alias("tracks"), F.sum("life").alias("life"), F.sum("holes").alias("holes"), F.sum(F.when(F.col("life") < short, 1).otherwise(0)).alias("short_tracks"))
    count = lambda df, name: df.groupBy("clip_id").agg(F.count(F.lit(1)).alias(name))
    out = h.join(count(suspect_swaps(obs), "swaps"), "clip_id", "left").join(count(fragments(obs, window), "fragments"), "clip_id", "left")
    return out.select("clip_id", "tracks", "life", "holes", (F.col("holes") / F.col("life")).alias("hole_share"), "short_tracks", F.coalesce("swaps", F.lit(0)).cast("long").alias("swaps"), F.coalesce("fragments", F.lit(0)).cast("long").alias("fragments"))
