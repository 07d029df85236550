"""Order-dependent operators: matching, suppression, clustering, linking, stitching, association, gap splits.

Candidates come from Spark joins; only the sequential choice runs in grouped pandas functions, whose groups are one
frame, one track, or one connected component of candidates, never a whole run.  Each group's rows are sorted by an
explicit key first, so results do not depend on the order of rows or partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import scalars as sc
from . import pairs as pr


def iou_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Boxes as rows x1, y1, x2, y2."""
    side = lambda k: np.maximum(np.minimum(a[:, k + 2, None], b[:, k + 2]) - np.maximum(a[:, k, None], b[:, k]), 0)
    inter = side(0) * side(1)
    size = lambda x: (x[:, 2] - x[:, 0]) * (x[:, 3] - x[:, 1])
    union = size(a)[:, None] + size(b)[None, :] - inter
    return np.divide(inter, union, out=np.zeros(inter.shape), where=(inter > 0) & (union > 0))


def one_to_one(candidates: pd.DataFrame, left: str, right: str, by: str) -> pd.DataFrame:
    """Best first; ties by the larger left, then the larger right id, as a reversed sort of tuples has it."""
    taken_l, taken_r, keep = set(), set(), []
    for k, a, b in candidates.sort_values([by, left, right], ascending=False)[[left, right]].itertuples():
        if a not in taken_l and b not in taken_r:
            taken_l.add(a)
            taken_r.add(b)
            keep.append(k)
    return candidates.loc[keep]


def greedy_match(a: DataFrame, b: DataFrame, least: float = 0.5) -> DataFrame:
    """One-to-one matches of a frame's boxes in two runs, the greatest overlap first; ties by the larger left, then the larger right id.
    A frame of both runs is a group: its pairs stay there and only the matches leave it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        left, right = (t.filter(pc.is_valid(t[c])).combine_chunks() for c in ("tid_a", "tid_b"))
        x, y = pr.box_rows(left), pr.box_rows(right)
        size_x, size_y, found = pr.box_areas(x), pr.box_areas(y), []
        for u, v in pr.touching(x, y):
            inter = pr.shared_area(x[u], y[v])
            union = size_x[u] + size_y[v] - inter
            iou = np.divide(inter, union, out=np.zeros(len(u)), where=(inter > 0) & (union > 0))
            k = np.flatnonzero(iou >= least)
            found.append((u[k], v[k], iou[k]))
        if not found:
            return
        u, v, iou = (np.concatenate(c) for c in zip(*found, strict=True))
        ids = left["tid_a"].to_numpy(), right["tid_b"].to_numpy()
        taken, used, keep = set(), set(), []
        order = np.lexsort((ids[1][v], ids[0][u], iou))[::-1]
        for k, i, j in zip(order.tolist(), ids[0][u[order]].tolist(), ids[1][v[order]].tolist(), strict=True):
            if i not in taken and j not in used:
                taken.add(i)
                used.add(j)
                keep.append(k)
        own, other = left.select(["clip_id", "f", "tid_a"]).take(u[keep]), right["tid_b"].take(v[keep])
        yield pa.RecordBatch.from_pydict({c: own[c].combine_chunks() for c in own.column_names} | {"tid_b": other.combine_chunks(), "iou": pa.array(iou[keep])})

    box = ["x1", "y1", "x2", "y2"]
    none = lambda df: F.lit(None).cast(dict(df.dtypes)["tid"])
    rows = a.select("clip_id", "f", F.col("tid").alias("tid_a"), none(b).alias("tid_b"), *box).unionByName(b.select("clip_id", "f", none(a).alias("tid_a"), F.col("tid").alias("tid_b"), *box))
    return rows.groupBy("clip_id", "f").applyInArrow(run, ", ".join(f"{c} {t}" for c, t in rows.dtypes[:4]) + ", iou double")


def nms(detections: DataFrame, least: float = 0.5) -> DataFrame:
    """Per frame, best score first: a detection stays if its overlap with every kept one is below `least`."""

    def keep(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["score", "tid"], ascending=[False, True], kind="stable").reset_index(drop=True)
        boxes, rest = rows[["x1", "y1", "x2", "y2"]].to_numpy(), np.arange(len(rows))
        kept: list[int] = []
        while len(rest):
            first, rest = rest[0], rest[1:]
            kept.append(first)
            rest = rest[iou_matrix(boxes[first : first + 1], boxes[rest])[0] < least]
        return rows.loc[kept]

    return detections.groupBy("clip_id", "f").applyInPandas(keep, detections.schema)


def cluster_labels(detections: DataFrame, least: float = 0.5) -> DataFrame:
    """Detections of several labels in a frame, best score first, join the best cluster representative that overlaps by
    `least`, else found a cluster; per cluster and label the best score.  detections: clip_id, f, det, label, score, box."""

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["score", "det"], ascending=[False, True], kind="stable").reset_index(drop=True)
        boxes, of, best = rows[["x1", "y1", "x2", "y2"]].to_numpy(), np.arange(len(rows)), np.full(len(rows), -1.0)
        for k in range(len(rows)):
            if best[k] < least:  # no representative before it overlaps enough: it is one for all that come later
                of[k] = k
                iou = iou_matrix(boxes[k : k + 1], boxes[k + 1 :])[0]
                closer = k + 1 + np.flatnonzero(iou > best[k + 1 :])
                best[closer], of[closer] = iou[closer - k - 1], k
        rows["cluster"] = rows["det"].to_numpy()[of]
        return rows.groupby(["clip_id", "f", "cluster", "label"], as_index=False)["score"].max()

    return detections.groupBy("clip_id", "f").applyInPandas(cluster, "clip_id int, f int, cluster long, label string, score double")


def drop_duplicates_by_age(obs: DataFrame, least: float = 0.7) -> DataFrame:
    """Per frame, pairs in order of ids: of two that overlap by `least` and are both still there, the larger id goes."""
    c = pr.pairs(obs, obs).filter((F.col("a_tid") < F.col("b_tid")) & (F.col("iou") >= least)).select("clip_id", "f", F.col("a_tid").alias("tid_a"), F.col("b_tid").alias("tid_b"))

    def gone(rows: pd.DataFrame) -> pd.DataFrame:
        out: set[int] = set()
        for a, b in rows.sort_values(["tid_a", "tid_b"])[["tid_a", "tid_b"]].itertuples(index=False):
            if a not in out and b not in out:
                out.add(b)
        return pd.DataFrame({"clip_id": rows["clip_id"].iloc[0], "f": rows["f"].iloc[0], "tid": sorted(out)}, columns=["clip_id", "f", "tid"])

    dropped = c.groupBy("clip_id", "f").applyInPandas(gone, "clip_id int, f int, tid int")
    return obs.join(dropped, ["clip_id", "f", "tid"], "left_anti")


def new_tracks(detections: DataFrame, tracked: DataFrame, least_score: float = 0.5, covered: float = 0.5, cells: int = 40) -> DataFrame:
    """Detections that found tracks: best score first, those of which less than `covered` lies under the union of what
    is tracked and what was just founded, on a grid of `cells` pixels."""
    cols = ("x1", "y1", "x2", "y2")
    both = tracked.select("clip_id", "f", F.col("tid").cast("int").alias("tid"), *cols, F.lit(None).cast("double").alias("score")).unionByName(detections.filter(F.col("score") >= least_score).select("clip_id", "f", F.col("tid").cast("int").alias("tid"), *cols, "score"))

    def found(rows: pd.DataFrame) -> pd.DataFrame:
        def area(r) -> set[tuple[int, int]]:
            return {(x, y) for x in range(int(r.x1 // cells), int(-(-r.x2 // cells))) for y in range(int(r.y1 // cells), int(-(-r.y2 // cells)))}

        union: set[tuple[int, int]] = set()
        for r in rows[rows["score"].isna()].itertuples():
            union |= area(r)
        new = []
        for r in rows[rows["score"].notna()].sort_values(["score", "tid"], ascending=[False, True], kind="stable").itertuples():
            own = area(r)
            if not own or len(own & union) / len(own) < covered:
                new.append(r.tid)
                union |= own
        return pd.DataFrame({"clip_id": rows["clip_id"].iloc[0], "f": rows["f"].iloc[0], "tid": new}, columns=["clip_id", "f", "tid"])

    return both.groupBy("clip_id", "f").applyInPandas(found, "clip_id int, f int, tid int")


def spaced_best(views: DataFrame, by: str, min_gap: int = 5, most: int = 10) -> DataFrame:
    """Per track, best first, views at least min_gap frames from all chosen ones, `most` at most.  Feed it with
    sequences.best_windows, so that a group has a few dozen rows."""

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        chosen: list[int] = []
        keep = []
        for k, f in rows.sort_values([by, "f"], ascending=[False, True], kind="stable")["f"].items():
            if len(chosen) < most and all(abs(f - c) >= min_gap for c in chosen):
                chosen.append(f)
                keep.append(k)
        return rows.loc[keep]

    return views.groupBy("clip_id", "tid").applyInPandas(choose, views.schema)


def gap_split(obs: DataFrame, fps: float, width: float, tail: int = 6, least: int = 3) -> DataFrame:
    """Cuts tracks at hops and at jumps off the motion prediction; the velocity starts anew after every cut.  Returns the
    observations of segments of at least `least` rows with their number."""

    def split(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("f", kind="stable").reset_index(drop=True)
        f = rows["f"].to_numpy()
        cx, cy = ((rows["x1"] + rows["x2"]) / 2).to_numpy(), ((rows["y1"] + rows["y2"]) / 2).to_numpy()
        h = (rows["y2"] - rows["y1"]).to_numpy()
        part, begin, number = np.zeros(len(rows), int), 0, 0
        for k in range(1, len(rows)):
            gap = f[k] - f[k - 1]
            if gap == 1:
                cut = np.hypot(cx[k] - cx[k - 1], cy[k] - cy[k - 1]) > max(h[k - 1], 1)
            else:
                first = max(begin, k - tail)
                span = max(1, f[k - 1] - f[first])
                vx, vy = ((cx[k - 1] - cx[first]) / span, (cy[k - 1] - cy[first]) / span) if k - 1 > first else (0.0, 0.0)
                off = np.hypot(cx[k - 1] + vx * gap - cx[k], cy[k - 1] + vy * gap - cy[k])
                ratio = h[k] / max(h[k - 1], 1e-6)
                cut = off > 0.75 * h[k - 1] + 0.05 * width * gap / fps or not 0.5 <= ratio <= 2.0
            if cut:
                number, begin = number + 1, k
            part[k] = number
        rows["part"] = part
        return rows[rows.groupby("part")["f"].transform("size") >= least]

    schema = ", ".join(f"{c} {t}" for c, t in obs.dtypes) + ", part int"
    return obs.groupBy("clip_id", "tid").applyInPandas(split, schema)


# linking


def components(edges: DataFrame) -> DataFrame:
    """(clip_id, node, component): least node reachable in a clip.  Labels spread with shortcuts until nothing changes;
    each round's table is checkpointed where the session has a checkpoint folder, else kept in the cache until the next is there."""
    both = edges.select("clip_id", "a", "b").unionByName(edges.select("clip_id", F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    keep: Callable[[DataFrame], DataFrame] = (lambda df: df.checkpoint()) if edges.sparkSession.sparkContext.getCheckpointDir() else (lambda df: df.persist())
    both = keep(both)
    labels = keep(both.groupBy("clip_id", F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")))
    former = labels
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), ["clip_id", "b"]).groupBy("clip_id", F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(near, ["clip_id", "node"]).select("clip_id", "node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        roots = labels.select("clip_id", F.col("node").alias("component"), F.col("component").alias("up"))
        new = keep(step.join(roots, ["clip_id", "component"], "left").select("clip_id", "node", "old", F.least("component", F.coalesce("up", "component")).alias("component")))
        same = new.filter("old <> component").isEmpty()
        former.unpersist()
        former, labels = new, new.select("clip_id", "node", "component")
        if same:
            both.unpersist()
            return labels


class _Groups:
    """Union-find with members, for one component."""

    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}
        self.members = {n: [n] for n in nodes}

    def root(self, n):
        while self.parent[n] != n:
            self.parent[n] = n = self.parent[self.parent[n]]
        return n

    def union(self, a, b) -> None:
        a, b = sorted((self.root(a), self.root(b)))
        if a != b:
            self.parent[b] = a
            self.members[a] += self.members.pop(b)


def _shared(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> int:
    """Frames that two sorted lists of inclusive runs share."""
    i = j = total = 0
    while i < len(a) and j < len(b):
        total += max(0, min(a[i][1], b[j][1]) - max(a[i][0], b[j][0]) + 1)
        if a[i][1] < b[j][1]:
            i += 1
        else:
            j += 1
    return total


def _runs(value) -> list[tuple[int, int]]:
    return sorted((int(r["start"]), int(r["end"])) for r in value)


def _span(first: str, last: str):
    """A whole span as a list of one run."""
    return F.array(F.struct(F.col(first).alias("start"), F.col(last).alias("end")))


def link(segments: DataFrame, candidates: DataFrame, duplicates: DataFrame | None = None, strong: float = 1.60, strong_faces: int = 3) -> DataFrame:
    """Constrained linking per component of candidates.  Duplicates are joined first without a check; then pairs, best
    score first (ties to larger ids): not if the groups share a frame, nor if their decided classes or leanings
    differ, unless the pair is a strong face match of segments with enough faces.  Groups may lie in each other's holes.
    segments: clip_id, sid, runs (array of inclusive start, end; or first_f, last_f, if the whole span counts), cls (decided or
    null), lean (or null), n_face; candidates: clip_id, sid_a, sid_b, how, score.  Returns clip_id, sid, identity_sid (least sid of the group)."""
    segments = segments if "runs" in segments.columns else segments.withColumn("runs", _span("first_f", "last_f"))
    pairs_ = candidates.filter("how <> 'near_miss'").select("clip_id", "sid_a", "sid_b", "how", "score")
    if duplicates is not None:
        pairs_ = pairs_.unionByName(duplicates.select("clip_id", "sid_a", "sid_b", F.lit("duplicate").alias("how"), F.lit(1e9).alias("score")))
    comp = components(pairs_.select("clip_id", F.col("sid_a").alias("a"), F.col("sid_b").alias("b")))
    left = segments.join(comp.withColumnRenamed("node", "sid"), ["clip_id", "sid"]).select("clip_id", "component", "sid", "runs", "cls", "lean", "n_face")
    right = pairs_.join(comp.withColumnRenamed("node", "sid_a"), ["clip_id", "sid_a"]).select(F.col("clip_id").alias("clip"), F.col("component").alias("part"), "sid_a", "sid_b", "how", "score")

    def run(key, seg: pd.DataFrame, cand: pd.DataFrame) -> pd.DataFrame:
        groups = _Groups(seg["sid"].tolist())
        faces = dict(zip(seg["sid"], seg["n_face"], strict=True))
        held = {r.sid: {"runs": _runs(r.runs), "cls": {r.cls} if isinstance(r.cls, str) else set(), "lean": {r.lean} if isinstance(r.lean, str) else set()} for r in seg.itertuples()}
        for r in cand.sort_values(["score", "sid_a", "sid_b"], ascending=False).itertuples():
            a, b = sorted((groups.root(r.sid_a), groups.root(r.sid_b)))
            if a == b:
                continue
            x, y = held[a], held[b]
            if r.how != "duplicate":
                if _shared(x["runs"], y["runs"]):
                    continue
                differ = any(x[what] and y[what] and x[what] != y[what] for what in ("cls", "lean"))
                if differ and not (r.how == "face" and r.score >= strong and min(faces[r.sid_a], faces[r.sid_b]) >= strong_faces):
                    continue
            groups.union(a, b)
            held[a] = {"runs": _joined(x["runs"] + y["runs"]), "cls": x["cls"] | y["cls"], "lean": x["lean"] | y["lean"]}
            del held[b]
        return pd.DataFrame({"clip_id": key[0], "sid": seg["sid"], "identity_sid": [groups.root(s) for s in seg["sid"]]})

    linked = left.groupBy("clip_id", "component").cogroup(right.groupBy("clip", "part")).applyInPandas(run, "clip_id int, sid int, identity_sid int")
    alone = segments.join(linked, ["clip_id", "sid"], "left_anti").select("clip_id", "sid", F.col("sid").alias("identity_sid"))
    return linked.unionByName(alone)


def _joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same frames as sorted runs that do not meet."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(runs):
        if out and s <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def relink(tracks: DataFrame, candidates: DataFrame) -> DataFrame:
    """Merges by similarity, best first, only while all merged spans stay disjoint: `link` without classes or faces."""
    plain = tracks.select("clip_id", F.col("tid").alias("sid"), _span("first_f", "last_f").alias("runs"), F.lit(None).cast("string").alias("cls"), F.lit(None).cast("string").alias("lean"), F.lit(0).alias("n_face"))
    return link(plain, candidates.withColumn("how", F.lit("body"))).select("clip_id", F.col("sid").alias("tid"), F.col("identity_sid").alias("identity"))


def relink_candidates(tracks: DataFrame, least: float, max_gap: int) -> DataFrame:
    """Pairs of a clip's tracks (clip_id, tid, first_f, last_f, vec), the earlier as sid_a, that share no frame, lie at most
    `max_gap` frames apart and whose vectors have at least this cosine, as score.  Joined on buckets of max_gap frames, so
    the pairs grow with the tracks that begin soon after one ends and not with all tracks of a clip."""
    if max_gap < 1:
        raise ValueError("max_gap is at least one frame")
    a, b = (tracks.select("clip_id", F.col("tid").alias(f"sid_{x}"), F.col(f).alias(f"{x}_f"), F.col("vec").alias(f"{x}_vec")) for x, f in (("a", "last_f"), ("b", "first_f")))
    a = a.withColumn("_bucket", F.explode(F.sequence(F.floor((F.col("a_f") + 1) / max_gap), F.floor((F.col("a_f") + max_gap) / max_gap))))
    met = a.join(b.withColumn("_bucket", F.floor(F.col("b_f") / max_gap)), ["clip_id", "_bucket"]).filter((F.col("b_f") - F.col("a_f")).between(1, max_gap))
    return met.withColumn("score", sc.dot(F.col("a_vec"), F.col("b_vec"))).filter(F.col("score") >= least).select("clip_id", "sid_a", "sid_b", "score")


def handoff(groups: DataFrame, fps: float, short_s: float = 2.0, least_iou: float = 0.3, slack: int = 3) -> DataFrame:
    """Short groups without any leaning are handed to a longer one that ends where they begin or begins where they end;
    repeated, best overlap first, until none is left.  No member of one may share more than `slack` frames with a member of the
    other.  groups: clip_id, identity, first_f, last_f, frames, lean, first box (a1..a4) and last box (b1..b4), and runs (or else
    the whole span counts); heights and overlap are those of the two boxes that touch.

    A merged group's ends are the ends of two of its members, so two groups can only ever be joined where a short member
    without leaning touches another member in time and place.  Those pairs come from two joins on buckets of frames, and
    each component of them is settled alone."""
    gap = round(0.3 * fps)
    width = gap + slack + 1
    box = lambda c: [F.col(f"{c}{k}") for k in range(1, 5)]
    end = lambda f, b, who: groups.select("clip_id", F.col("identity").alias(f"{who}_id"), F.col(f).alias(f"{who}_f"), *[c.alias(f"{who}_{x}") for c, x in zip(box(b), ("x1", "y1", "x2", "y2"), strict=True)], *(["frames", "lean"] if who == "g" else []))

    def touching(g_end: tuple[str, str], p_end: tuple[str, str], before: int, after: int) -> DataFrame:
        g = end(*g_end, "g").filter((F.col("frames") / fps <= short_s) & F.col("lean").isNull()).drop("frames", "lean").withColumn("_bucket", F.floor(F.col("g_f") / width))
        p = end(*p_end, "p").withColumn("_bucket", F.explode(F.sequence(F.floor((F.col("p_f") - before) / width), F.floor((F.col("p_f") + after) / width))))
        met = g.join(p, ["clip_id", "_bucket"]).filter((F.col("g_id") != F.col("p_id")) & (F.col("g_f") - F.col("p_f")).between(-before, after))
        ratio = (F.col("g_y2") - F.col("g_y1")) / F.greatest(F.col("p_y2") - F.col("p_y1"), F.lit(1e-6))
        return met.filter(ratio.between(0.39, 2.51) & (geo.iou(geo.box("g_"), geo.box("p_")) >= 0.99 * least_iou)).select("clip_id", F.col("g_id").alias("a"), F.col("p_id").alias("b"))

    comp = components(touching(("first_f", "a"), ("last_f", "b"), slack, gap).unionByName(touching(("last_f", "b"), ("first_f", "a"), gap, slack)))
    held = groups if "runs" in groups.columns else groups.withColumn("runs", _span("first_f", "last_f"))
    rows = held.join(comp.withColumnRenamed("node", "identity"), ["clip_id", "identity"], "left").withColumn("component", F.coalesce("component", "identity"))

    def settle(df: pd.DataFrame) -> pd.DataFrame:
        live = {r.identity: {"members": [_runs(r.runs)], "frames": r.frames, "lean": r.lean if isinstance(r.lean, str) else None, "first": (r.first_f, (r.a1, r.a2, r.a3, r.a4)), "last": (r.last_f, (r.b1, r.b2, r.b3, r.b4))} for r in df.sort_values("identity").itertuples()}
        into = {k: k for k in live}

        def score(x, y):
            if x["frames"] / fps > short_s or y["frames"] <= x["frames"] or x["lean"]:
                return None
            (xf, xb), (xl, xe), (yf, yb), (yl, ye) = x["first"], x["last"], y["first"], y["last"]
            if yl - slack <= xf <= yl + gap:
                a, b = ye, xb
            elif yf - gap <= xl <= yf + slack:
                a, b = yb, xe
            else:
                return None
            ratio = (b[3] - b[1]) / max(1e-6, a[3] - a[1])
            iou = float(iou_matrix(np.array([a], float), np.array([b], float))[0, 0])
            apart = 0.4 <= ratio <= 2.5 and iou >= least_iou and all(_shared(m, n) <= slack for m in x["members"] for n in y["members"])
            return iou if apart else None

        scores = {(i, j): s for i, x in live.items() for j, y in live.items() if i != j and (s := score(x, y)) is not None}
        while scores:
            _, i, j = max((s, i, j) for (i, j), s in scores.items())
            x, y = live.pop(i), live[j]
            y["members"] += x["members"]
            y["frames"] += x["frames"]
            y["lean"] = y["lean"] or x["lean"]
            y["first"], y["last"] = min(x["first"], y["first"]), max(x["last"], y["last"])
            into = {k: j if v == i else v for k, v in into.items()}
            # only pairs of the merged group change
            scores = {k: s for k, s in scores.items() if not {i, j} & set(k)}
            for other, z in live.items():
                for k, pair in (((j, other), (y, z)), ((other, j), (z, y))):
                    if other != j and (s := score(*pair)) is not None:
                        scores[k] = s
        return pd.DataFrame({"clip_id": df["clip_id"].iloc[0], "identity": list(into), "merged": list(into.values())})

    return rows.groupBy("clip_id", "component").applyInPandas(settle, "clip_id int, identity int, merged int")


# chunks


def shared_frame_iou(overlap: DataFrame) -> DataFrame:
    """Mean overlap over frames that both chunks' tracks have, within one label: overlap: clip_id, label, f, chunk, tid_a, tid_b, iou."""
    return overlap.groupBy("clip_id", "chunk", "label", "tid_a", "tid_b").agg(F.avg("iou").alias("iou"))


def stitch_labels(overlap: DataFrame, least: float = 0.5) -> DataFrame:
    """Objects of one chunk matched to those of the chunk before, within one label: mean overlap over all shared frames of
    at least `least`, then one to one, best first.  overlap as in `shared_frame_iou`, with a row for every shared frame,
    those without overlap too.  Every boundary of a label is settled alone."""
    mean = shared_frame_iou(overlap).filter(F.col("iou") >= least)
    return mean.groupBy("clip_id", "chunk", "label").applyInPandas(lambda rows: one_to_one(rows, "tid_a", "tid_b", "iou"), mean.schema)
