"""Same-frame pair operators and joins on observations.

Every pair join has the equality (clip_id, f) to hash on; boxes are compared as a residual condition, so a pair
costs nothing beyond its frame's own pairs.  Where only a choice among a frame's pairs is wanted, the frame is a group and its
pairs stay there (`touching`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo

FRAME = ["clip_id", "f"]
_BOX = ("x1", "y1", "x2", "y2")


def side(df: DataFrame, prefix: str, *more: str) -> DataFrame:
    """(clip_id, f) and prefixed tid, box and further columns."""
    return df.select(*FRAME, *[F.col(c).alias(f"{prefix}{c}") for c in ("tid", *_BOX, *more)])


def pairs(left: DataFrame, right: DataFrame, *more: str) -> DataFrame:
    """All same-frame pairs with a_ and b_ columns and their iou, where the boxes overlap at all."""
    a, b = geo.box("a_"), geo.box("b_")
    touch = (F.col("a_x1") < F.col("b_x2")) & (F.col("b_x1") < F.col("a_x2")) & (F.col("a_y1") < F.col("b_y2")) & (F.col("b_y1") < F.col("a_y2"))
    return side(left, "a_", *more).join(side(right, "b_", *more), FRAME).filter(touch).withColumn("iou", geo.iou(a, b))


def touching(a: np.ndarray, b: np.ndarray, block: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in a, places in b) of boxes (rows x1, y1, x2, y2) that overlap, a pair of blocks at a time, by place in a and then in b.
    Blocks hold boxes that begin near each other, so most pairs of blocks are left out as wholes."""
    cut = lambda x: [np.sort(o[k : k + block]) for o in [np.argsort(x[:, 0], kind="stable")] for k in range(0, len(x), block)]
    right = cut(b)
    for i in cut(a):
        p = a[i]
        for j in right:
            q = b[j]
            if p[:, 0].min() < q[:, 2].max() and q[:, 0].min() < p[:, 2].max():
                met = (p[:, 0, None] < q[:, 2]) & (q[:, 0] < p[:, 2, None]) & (p[:, 1, None] < q[:, 3]) & (q[:, 1] < p[:, 3, None])
                u, v = np.nonzero(met)
                if len(u):
                    yield i[u], j[v]


def shared_area(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What boxes of equal place share."""
    side = lambda k: np.maximum(np.minimum(a[:, k + 2], b[:, k + 2]) - np.maximum(a[:, k], b[:, k]), 0)
    return side(0) * side(1)


def box_areas(a: np.ndarray) -> np.ndarray:
    return (a[:, 2] - a[:, 0]) * (a[:, 3] - a[:, 1])


def box_rows(side: pa.Table) -> np.ndarray:
    return np.stack([side[c].to_numpy() for c in _BOX], axis=1).astype(float)


def hosts(obs: DataFrame, least: float = 0.5) -> DataFrame:
    """Per observation the other box of its frame that covers most of it, if at least `least`; ties to the lower id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)).sort_by("tid").combine_chunks()
        tid, boxes = t["tid"].to_numpy(), box_rows(t)
        size, most, host = np.maximum(box_areas(boxes), 1e-6), np.full(len(tid), -np.inf), np.full(len(tid), -1)
        for u, v in touching(boxes, boxes):
            cover = shared_area(boxes[u], boxes[v]) / size[u]
            k = np.flatnonzero((tid[u] != tid[v]) & (cover >= least))
            if not len(k):
                continue
            u, v, cover = u[k], v[k], cover[k]
            start = np.flatnonzero(np.r_[True, u[1:] != u[:-1]])
            top = np.repeat(np.maximum.reduceat(cover, start), np.diff(np.r_[start, len(u)]))
            k = np.minimum.reduceat(np.where(cover == top, np.arange(len(u)), len(u)), start)  # of equal hosts the lowest
            k = k[(cover[k] > most[u[k]]) | ((cover[k] == most[u[k]]) & (v[k] < host[u[k]]))]
            most[u[k]], host[u[k]] = cover[k], v[k]
        k = np.flatnonzero(host >= 0)
        own = t.select([*FRAME, "tid"]).take(k)
        yield pa.RecordBatch.from_pydict({c: own[c].combine_chunks() for c in own.column_names} | {"host": t["tid"].take(host[k]).combine_chunks(), "cover": pa.array(most[k])})

    own = obs.select(*FRAME, "tid", *_BOX)
    kinds = dict(own.dtypes)
    return own.groupBy(*FRAME).applyInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in (*FRAME, "tid")) + f", host {kinds['tid']}, cover double")


def occlusion(obs: DataFrame) -> DataFrame:
    """Largest share of a box that is covered by one whose bottom edge is lower in the picture; 0 without any."""
    p = pairs(obs, obs).filter("a_tid <> b_tid and b_y2 > a_y2").withColumn("cover", geo.coverage(geo.box("a_"), geo.box("b_")))
    most = p.groupBy(*FRAME, F.col("a_tid").alias("tid")).agg(F.max("cover").alias("cover"))
    return obs.join(most, [*FRAME, "tid"], "left").select(*FRAME, "tid", F.coalesce("cover", F.lit(0.0)).alias("occ"))


def covered(left: DataFrame, right: DataFrame, least: float = 0.5) -> DataFrame:
    """Per observation of `left` the best overlap with any of `right` and whether it reaches `least`."""
    best = pairs(left, right).groupBy(*FRAME, F.col("a_tid").alias("tid")).agg(F.max("iou").alias("best"))
    return left.select(*FRAME, "tid").join(best, [*FRAME, "tid"], "left").select(*FRAME, "tid", F.coalesce("best", F.lit(0.0)).alias("best"), F.coalesce(F.col("best") >= least, F.lit(False)).alias("covered"))


def best_match(left: DataFrame, right: DataFrame, least: float = 0.5) -> DataFrame:
    """Many-to-one: for each of `left` the right track with the greatest overlap >= least, the lowest id of equals."""
    p = pairs(left, right).filter(F.col("iou") >= least)
    return p.groupBy(*FRAME, F.col("a_tid").alias("tid")).agg(F.max_by("b_tid", F.struct("iou", (-F.col("b_tid")).alias("t"))).alias("match"), F.max("iou").alias("iou"))


def box_to_instance(boxes: DataFrame, instances: DataFrame, least: float = 0.4) -> DataFrame:
    """Each box with its best instance above `least`, or none: then the box itself serves (fallback)."""
    m = pairs(boxes, instances).filter(F.col("iou") > least).groupBy(*FRAME, F.col("a_tid").alias("tid")).agg(F.max_by("b_tid", F.struct("iou", (-F.col("b_tid")).alias("t"))).alias("instance"))
    return boxes.select(*FRAME, "tid").join(m, [*FRAME, "tid"], "left").withColumn("fallback", F.col("instance").isNull())


def duplicate_hosts(obs: DataFrame, evidence: DataFrame, mean_cover: float = 0.9, times: float = 5.0) -> DataFrame:
    """Identities that another one covers: the host of the greatest summed coverage over the identity's own rows, if the
    mean reaches mean_cover, the host is locked and has `times` the evidence; of equal hosts the lowest id.  Coverage is added up in
    whole units of 1e-12, so that sums do not depend on the order of rows and equal ones are equal.
    evidence: clip_id, tid, evidence, locked."""
    p = pairs(obs, obs).filter("a_tid <> b_tid").withColumn("cover", F.rint(geo.coverage(geo.box("a_"), geo.box("b_")) * 1e12).cast("long"))
    total = p.groupBy("clip_id", F.col("a_tid").alias("tid"), F.col("b_tid").alias("host")).agg((F.sum("cover") / F.lit(1e12)).alias("sum_cover"))
    top = total.groupBy("clip_id", "tid").agg(F.max_by("host", F.struct("sum_cover", (-F.col("host")).alias("t"))).alias("host"), F.max("sum_cover").alias("sum_cover"))
    rows = obs.groupBy("clip_id", "tid").agg(F.count(F.lit(1)).alias("rows"))
    own = evidence.select("clip_id", "tid", F.col("evidence").alias("own_evidence"))
    host = evidence.select("clip_id", F.col("tid").alias("host"), F.col("evidence").alias("host_evidence"), F.col("locked").alias("host_locked"))
    df = top.join(rows, ["clip_id", "tid"]).join(own, ["clip_id", "tid"]).join(host, ["clip_id", "host"]).withColumn("mean_cover", F.col("sum_cover") / F.col("rows"))
    return df.filter((F.col("mean_cover") >= mean_cover) & F.col("host_locked") & (F.col("host_evidence") >= times * F.greatest(F.lit(1.0), F.col("own_evidence")))).select("clip_id", "tid", "host", "mean_cover")


def insides(obs: DataFrame, inter: DataFrame) -> DataFrame:
    """Per view the other track of its frame that it lies inside most, by mask or by box: clip_id, f, tid, host, frac, box_frac.

    obs: clip_id, f, tid, box, area (of the mask); inter: clip_id, f, tid, host, inter, cells that two masks share.  Only
    hosts whose box meets the view's count; of equal ones the lowest id."""
    p = pairs(obs, obs).filter("a_tid <> b_tid").select(*FRAME, F.col("a_tid").alias("tid"), F.col("b_tid").alias("host"), geo.coverage(geo.box("a_"), geo.box("b_")).alias("box_frac"))
    both = p.join(inter, [*FRAME, "tid", "host"], "left").join(obs.select(*FRAME, "tid", "area"), [*FRAME, "tid"])
    frac = F.coalesce("inter", F.lit(0)) / F.greatest(F.lit(1), F.col("area"))
    most = F.max_by(F.struct("host", "frac", "box_frac"), F.struct(F.greatest("frac", "box_frac").alias("m"), (-F.col("host")).alias("t")))
    best = both.withColumn("frac", frac).groupBy(*FRAME, "tid").agg(most.alias("b"))
    return best.select(*FRAME, "tid", "b.*")


def duplicate_of(views: DataFrame, inside: DataFrame, by_mask: float = 0.5, by_box: float = 0.85) -> DataFrame:
    """The track in which more than half of a track's views lie, all its views counting: by mask (at least `by_mask` of the view's
    mask), or else by box (`by_box` of its box).  The most frequent one, lowest id of equals: clip_id, tid, dup_of, how, votes, views."""
    n = views.groupBy("clip_id", "tid").agg(F.count(F.lit(1)).alias("views"))
    lists = inside.select("clip_id", "tid", "host", F.explode(F.array_compact(F.array(F.when(F.col("frac") >= by_mask, "mask"), F.when(F.col("box_frac") >= by_box, "box")))).alias("how"))
    c = lists.groupBy("clip_id", "tid", "how", "host").agg(F.count(F.lit(1)).alias("votes"))
    top = c.groupBy("clip_id", "tid", "how").agg(F.max_by(F.struct("host", "votes"), F.struct("votes", (-F.col("host")).alias("t"))).alias("b"))
    most = top.join(n, ["clip_id", "tid"]).filter(F.col("b.votes") * 2 > F.col("views"))
    first = most.groupBy("clip_id", "tid").agg(F.max_by(F.struct("b.host", "how", "b.votes", "views"), "how").alias("d"))  # "mask" goes before "box"
    return first.select("clip_id", "tid", F.col("d.host").alias("dup_of"), "d.how", "d.votes", "d.views")


def canonical_identities(objects: DataFrame, control: DataFrame, least: float = 0.5) -> DataFrame:
    """Identity of every labelled object: the control track that it overlaps by `least` in most of its frames (lowest id of
    equals), or an identity of its own, numbered after the control tracks of its clip by id.
    Both: clip_id, f, tid, box.  Returns clip_id, tid, identity."""
    met = best_match(objects, control, least).groupBy("clip_id", "tid", "match").agg(F.count(F.lit(1)).alias("frames"))
    host = met.groupBy("clip_id", "tid").agg(F.max_by("match", F.struct("frames", (-F.col("match")).alias("t"))).alias("host"))
    last = control.groupBy("clip_id").agg(F.max("tid").alias("last"))
    own = objects.select("clip_id", "tid").distinct().join(host, ["clip_id", "tid"], "left").join(last, "clip_id", "left")
    place = F.row_number().over(Window.partitionBy("clip_id", F.col("host").isNull()).orderBy("tid"))
    return own.select("clip_id", "tid", F.coalesce("host", F.coalesce("last", F.lit(0)) + place).cast("long").alias("identity"))


def label_coverage(layers: DataFrame, labels: dict[str, Column]) -> DataFrame:
    """Per control identity: frames seen and, per label, frames in which the label covers it and their share."""
    per_frame = layers.groupBy("clip_id", "tid", "f").agg(*[F.max(c.cast("int")).alias(f"is_{n}") for n, c in labels.items()])
    aggs = [F.sum(f"is_{n}").alias(f"frames_{n}") for n in labels]
    seen = per_frame.groupBy("clip_id", "tid").agg(F.count(F.lit(1)).alias("seen"), *aggs)
    return seen.select("*", *[(F.col(f"frames_{n}") / F.col("seen")).alias(f"share_{n}") for n in labels])


def verdicts(coverage: DataFrame, target: str, other: str, min_share: float = 0.5) -> DataFrame:
    """conflict, then the target, the other label, flicker (any frame at all), none."""
    t, o = F.col(f"share_{target}"), F.col(f"share_{other}")
    v = F.when((t >= min_share) & (o >= min_share), "conflict").when(t >= min_share, target).when(o >= min_share, other).when((t > 0) | (o > 0), "flicker").otherwise("none")
    return coverage.withColumn("verdict", v)


def explained(verdict: DataFrame, extra: list[str], min_share: float = 0.5) -> DataFrame:
    """Adds `explained_by`: for escapes (flicker or none) the extra labels that cover them by `min_share`, comma-joined, or null."""
    names = F.array_join(F.array_compact(F.array(*[F.when(F.col(f"share_{x}") >= min_share, x) for x in sorted(extra)])), ",")
    return verdict.withColumn("explained_by", F.when(F.col("verdict").isin("flicker", "none"), F.nullif(names, F.lit(""))))


def verdict_rates(verdict: DataFrame, target: DataFrame, other: DataFrame, conflict_iou: float = 0.5) -> DataFrame:
    """Per clip: identities, escapes (flicker or none) and their rate; observations of the target label, those that an observation
    of the other label overlaps by `conflict_iou` in the same frame, and their rate.  Rates are null without anything to count."""
    one = lambda *v: F.sum(F.when(F.col("verdict").isin(*v), 1).otherwise(0))
    ids = verdict.groupBy("clip_id").agg(F.count(F.lit(1)).alias("identities"), one("flicker", "none").alias("escapes"), one("conflict").alias("conflicts"), F.percentile("seen", F.lit(0.5)).alias("median_seen"))
    obs = covered(target, other, conflict_iou).groupBy("clip_id").agg(F.count(F.lit(1)).alias("target_obs"), F.count_if("covered").alias("conflict_obs"))
    out = ids.join(obs, "clip_id", "full_outer").fillna(0, ["identities", "escapes", "conflicts", "target_obs", "conflict_obs"])
    rate = lambda x, y: F.col(x) / F.nullif(F.col(y), F.lit(0))
    return out.select("*", rate("escapes", "identities").alias("escape_rate"), rate("conflict_obs", "target_obs").alias("conflict_rate"))


def label_summary(obs: DataFrame, n_frames: DataFrame) -> DataFrame:
    """Per clip and label: tracks, observations, observations a frame of the clip, median span.
    obs: clip_id, label, tid, f; n_frames: clip_id, n_frames."""
    tracks = obs.groupBy("clip_id", "label", "tid").agg(F.count(F.lit(1)).alias("n"), (F.max("f") - F.min("f") + 1).alias("span"))
    s = tracks.groupBy("clip_id", "label").agg(F.count(F.lit(1)).alias("tracks"), F.sum("n").alias("obs"), F.percentile("span", F.lit(0.5)).alias("median_span"))
    return s.join(n_frames, "clip_id").select("clip_id", "label", "tracks", "obs", (F.col("obs") / F.greatest(F.lit(1), F.col("n_frames"))).alias("obs_per_frame"), "median_span")


def share_histogram(coverage: DataFrame, column: str) -> DataFrame:
    """Per clip, identities by coverage: 0, (0, .25), [.25, .5), [.5, .75), [.75, 1]."""
    c = F.col(column)
    bins = {"zero": c == 0, "q1": (c > 0) & (c < 0.25), "q2": (c >= 0.25) & (c < 0.5), "q3": (c >= 0.5) & (c < 0.75), "q4": c >= 0.75}
    return coverage.groupBy("clip_id").agg(*[F.sum(F.when(x, 1).otherwise(0)).alias(n) for n, x in bins.items()])
