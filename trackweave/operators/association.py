"""Online association: detections become tracks frame by frame, and the same detections are replayed under many settings.

Every (setting, clip) is a fold of its own.  Spark deals the detections out by setting and clip and sorts them by frame; a fold
reads its rows as they come and holds the live tracks only, never a clip.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .greedy import iou_matrix
from .sequences import stability

BOX = ["x1", "y1", "x2", "y2"]
MOST_SETTINGS = 10_000
RUN = "setting_id int, clip_id int, f int, tid int, x1 double, y1 double, x2 double, y2 double, score double, error string"


def covered_share(box: np.ndarray, others: np.ndarray) -> float:
    """The share of a box that the union of other boxes covers."""
    low, high = np.maximum(others[:, :2], box[:2]), np.minimum(others[:, 2:], box[2:])
    inside = (low < high).all(axis=1)
    size = np.prod(box[2:] - box[:2])
    if not inside.any() or size <= 0:
        return 0.0
    low, high = low[inside], high[inside]
    xs, ys = (np.unique(np.concatenate([low[:, k], high[:, k]])) for k in (0, 1))
    x, y = xs[:-1], ys[:-1]
    hit = ((low[:, 0, None] <= x) & (x < high[:, 0, None]))[:, :, None] & ((low[:, 1, None] <= y) & (y < high[:, 1, None]))[:, None, :]
    return float((hit.any(axis=0) * np.diff(xs)[:, None] * np.diff(ys)).sum() / size)


def _overlapping(boxes: np.ndarray, others: np.ndarray, least: float, rows: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """(box, other) of pairs that overlap by `least`, in order, and their IoU; some rows at a time."""
    met, iou = [np.zeros((0, 2), np.int64)], [np.zeros(0)]
    for k in range(0, len(boxes), rows):
        part = iou_matrix(boxes[k : k + rows], others)
        at = np.argwhere(part >= least)
        iou.append(part[at[:, 0], at[:, 1]])
        met.append(at + [k, 0])
    return np.concatenate(met), np.concatenate(iou)


def largest_share(boxes: np.ndarray, others: np.ndarray, rows: int = 2048) -> np.ndarray:
    """The largest share of each box that a single other box covers."""
    out = np.zeros(len(boxes))
    for k in range(0, len(boxes), rows) if len(others) else ():
        a = boxes[k : k + rows]
        side = [np.clip(np.minimum(a[:, x + 2, None], others[:, x + 2]) - np.maximum(a[:, x, None], others[:, x]), 0, None) for x in (0, 1)]
        out[k : k + rows] = (side[0] * side[1]).max(axis=1)
    size = np.prod(boxes[:, 2:] - boxes[:, :2], axis=1)
    return np.where(size > 0, out / np.where(size > 0, size, 1), 0.0)


class Associator:
    """Tracks of one clip.  In each frame, in this order:

    1. of two tracks that overlap by `dup_iou` the one that began later ends (pairs in order of their beginning);
    2. detections above `low_score` and tracks that overlap by `match_iou` are matched one to one, greatest overlap first (ties:
       the earlier detection, then the earlier track);
    3. of the rest, those of at least `new_score` begin tracks, best score first, unless tracks, new ones included, cover
       them by `cover`;
    4. tracks that nothing confirmed for more than `lost_frames` frames end.

    A track stands where it was last seen, moved on by its last velocity times `motion`."""

    def __init__(self, match_iou: float = 0.3, new_score: float = 0.5, low_score: float = 0.15, dup_iou: float = 0.7, cover: float = 0.5, lost_frames: int = 100, motion: float = 0.0):
        for name, value in (("match_iou", match_iou), ("dup_iou", dup_iou), ("cover", cover)):
            if not 0 < value <= 1:
                raise ValueError(f"{name} is a share, not {value}")
        if lost_frames < 0:
            raise ValueError(f"lost_frames is a number of frames, not {lost_frames}")
        self.match_iou, self.new_score, self.low_score, self.dup_iou, self.cover, self.lost_frames, self.motion = match_iou, new_score, low_score, dup_iou, cover, lost_frames, motion
        self.ids, self.last = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.boxes, self.speed = np.zeros((0, 4)), np.zeros((0, 4))
        self.begun = 0

    def _keep(self, which: np.ndarray) -> None:
        self.ids, self.last, self.boxes, self.speed = self.ids[which], self.last[which], self.boxes[which], self.speed[which]

    def step(self, f: int, boxes: np.ndarray, scores: np.ndarray) -> list[tuple[int, int]]:
        """(tid, place of the detection) of what this frame's detections, given in order, confirm or begin."""
        self._keep(f - 1 - self.last <= self.lost_frames)
        here = self.boxes + self.motion * self.speed * (f - self.last)[:, None]
        stay = np.ones(len(here), bool)
        for i, j in np.argwhere(np.triu(iou_matrix(here, here) >= self.dup_iou, 1)).tolist():
            if stay[i] and stay[j]:
                stay[j] = False
        self._keep(stay)
        here = here[stay]
        met, iou = _overlapping(boxes, here, self.match_iou)
        sure = scores[met[:, 0]] > self.low_score
        met = met[sure][np.argsort(-iou[sure], kind="stable")]
        of_track: dict[int, int] = {}
        used: set[int] = set()
        for d, t in met.tolist():
            if d not in used and t not in of_track:
                of_track[t] = d
                used.add(d)
        out = []
        for t, d in sorted(of_track.items()):
            self.speed[t] = (boxes[d] - self.boxes[t]) / max(1, f - self.last[t])
            self.boxes[t], here[t], self.last[t] = boxes[d], boxes[d], f
            out.append((int(self.ids[t]), d))
        order = np.argsort(-scores, kind="stable")
        order = order[(scores[order] >= self.new_score) & ~np.isin(order, np.fromiter(used, np.int64, len(used)))]
        share = largest_share(boxes[order], here)
        for k, d in enumerate(order.tolist()):
            # what one track covers by far needs no look at all of them
            if share[k] > self.cover + 1e-9 or covered_share(boxes[d], here) >= self.cover:
                continue
            share[k + 1 :] = np.maximum(share[k + 1 :], largest_share(boxes[order[k + 1 :]], boxes[d : d + 1]))
            here = np.concatenate([here, boxes[d : d + 1]])
            self.ids, self.last = np.append(self.ids, self.begun), np.append(self.last, f)
            self.boxes, self.speed = np.concatenate([self.boxes, boxes[d : d + 1]]), np.concatenate([self.speed, np.zeros((1, 4))])
            out.append((self.begun, d))
            self.begun += 1
        return out


def _frames(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, int, pd.DataFrame]]:
    """((setting, clip), frame, its rows) of a sorted partition; a frame that batches cut is put together."""
    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(rows):
            continue
        key = rows[["setting_id", "clip_id", "f"]].to_numpy()
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist()]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            yield (int(key[s, 0]), int(key[s, 1])), int(key[s, 2]), rows.iloc[s:e]
        held = rows.iloc[cuts[-1] :]
    if held is not None:
        yield (int(held["setting_id"].iloc[0]), int(held["clip_id"].iloc[0])), int(held["f"].iloc[0]), held


def replay(detections: DataFrame, settings: dict[int, dict], tracker: Callable = Associator, flush: int = 20_000) -> DataFrame:
    """The tracks of every clip under every setting: setting_id, clip_id, f, tid, box, score, error.

    `settings` holds the keyword arguments that make a tracker, by number; a tracker is anything with `step` as Associator's.
    Where making or stepping it fails, what it gave before stands, the rest of that clip is skipped under that setting, and a
    row with the error alone says so; other settings go on.  detections: clip_id, f, det, box, score; a frame's detections
    are given in order of det.  The detections are multiplied by the settings, of which there are at most MOST_SETTINGS."""
    if len(settings) > MOST_SETTINGS:
        raise ValueError(f"more than {MOST_SETTINGS} settings")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, live, out = None, None, []
        for key, f, rows in _frames(batches):
            try:
                if key != current:
                    current, live = key, None
                    live = tracker(**settings[key[0]])
                if live is not None:
                    boxes, scores = rows[BOX].to_numpy(float), rows["score"].to_numpy(float)
                    out += [(*key, f, t, *boxes[d].tolist(), float(scores[d]), None) for t, d in live.step(f, boxes, scores)]
            except Exception as e:  # whatever a tracker refuses is that setting's result
                live = None
                out.append((*key, *[None] * 7, str(e)))
            if len(out) >= flush:
                yield _run_rows(out)
                out = []
        yield _run_rows(out)

    numbers = F.explode(F.array(*[F.lit(k) for k in sorted(settings)]))
    dealt = detections.select(numbers.alias("setting_id"), "clip_id", "f", "det", *BOX, "score")
    return dealt.repartition("setting_id", "clip_id").sortWithinPartitions("setting_id", "clip_id", "f", "det").mapInPandas(run, RUN)


def _run_rows(rows: list[tuple]) -> pd.DataFrame:
    names = ["setting_id", "clip_id", "f", "tid", *BOX, "score", "error"]
    return pd.DataFrame(rows, columns=names).astype({"f": "Int32", "tid": "Int32"})


def sweep(detections: DataFrame, settings: dict[int, dict], window: int = 100, tracker: Callable = Associator) -> DataFrame:
    """Every setting's stability in every clip, and its place: fewest fragments and twice the swaps first, then fewest tracks,
    then by number.  Settings that fail in a clip have their error and neither measures nor a place.
    Returns clip_id, setting_id, tracks, holes, swaps, fragments, tracked (rows), error, place."""
    runs = replay(detections, settings, tracker)
    failed = runs.filter("error is not null").select("setting_id", "clip_id", "error").distinct()
    good = runs.join(failed, ["setting_id", "clip_id"], "left_anti").drop("error")
    # while measured, a setting's clip is a clip of its own
    own = good.withColumn("clip_id", F.struct("setting_id", "clip_id"))
    measured = stability(own, window=window).join(own.groupBy("clip_id").agg(F.count(F.lit(1)).alias("tracked")), "clip_id")
    measured = measured.select("clip_id.*", "tracks", "holes", "swaps", "fragments", "tracked")
    cost = F.col("fragments") + 2 * F.col("swaps")
    ranked = measured.withColumn("place", F.row_number().over(Window.partitionBy("clip_id").orderBy(cost, "tracks", "setting_id")))
    both = ranked.withColumn("error", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True)
    return both.select("clip_id", "setting_id", "tracks", "holes", "swaps", "fragments", "tracked", "error", "place")
