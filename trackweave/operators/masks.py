"""Masks as alternating skip, fill, skip, fill ... runs over a grid read row by row, and as filled intervals.

Areas and overlaps are sums over intervals, so no mask is expanded to pixels.  Two masks meet in a group of a frame, where overlaps
are products of blocks of masks (`functions.spans`): what is shuffled are masks, not pairs.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import geometry as geo
from ..functions import spans

SPAN = "array<struct<s:int,e:int>>"
MAX_RUN = 65535


def rectangle_intervals(box: geo.Box, cell: float, columns: int) -> Column:
    """Half-open filled intervals of the cells that a box touches."""
    c1, r1, c2, r2 = (x.cast("int") for x in geo.to_grid(box, cell))
    return F.transform(F.sequence(r1, r2 - 1), lambda r: F.struct((r * columns + c1).alias("s"), (r * columns + c2).alias("e")))


def to_runs(intervals: Column, cells: int) -> Column:
    """Sorted disjoint intervals to run lengths that sum to `cells`; a run of 0 comes first where the first cell is filled."""
    ends = F.concat(F.array(F.lit(0)), F.transform(intervals, lambda x: x["e"]))
    starts = F.concat(F.transform(intervals, lambda x: x["s"]), F.array(F.lit(cells)))
    skips = F.zip_with(starts, ends, lambda s, e: s - e)
    fills = F.concat(F.transform(intervals, lambda x: x["e"] - x["s"]), F.array(F.lit(None).cast("int")))
    return F.array_compact(F.flatten(F.zip_with(skips, fills, lambda a, b: F.array(a, b))))


def from_runs(counts: Column) -> Column:
    """Run lengths to filled intervals, empty ones left out."""
    sums = F.aggregate(counts, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    odd = F.filter(F.sequence(F.lit(1), F.size(counts)), lambda i: i % 2 == 0)
    made = F.when(F.size(counts) < 2, F.array().cast(SPAN)).otherwise(F.transform(odd, lambda i: F.struct(F.get(sums, i - 1).alias("s"), F.get(sums, i).alias("e"))))
    return F.filter(made, lambda x: x["e"] > x["s"])


def area(intervals: Column) -> Column:
    return F.aggregate(intervals, F.lit(0).cast("long"), lambda acc, x: acc + (x["e"] - x["s"]))


def bounds(intervals: Column, columns: int) -> Column:
    """Tight half-open box (c1, r1, c2, r2) of a mask whose intervals do not wrap around rows; null for an empty one."""
    col = lambda f, part: f(F.transform(intervals, part))
    box = F.struct(col(F.array_min, lambda x: x["s"] % columns).alias("c1"), col(F.array_min, lambda x: F.floor(x["s"] / columns)).cast("int").alias("r1"), col(F.array_max, lambda x: (x["e"] - 1) % columns + 1).alias("c2"), col(F.array_max, lambda x: F.floor((x["e"] - 1) / columns) + 1).cast("int").alias("r2"))
    return F.when(F.size(intervals) > 0, box)


def exploded(masks: DataFrame, *keys: str) -> DataFrame:
    return masks.select(*keys, F.explode("intervals").alias("i")).select(*keys, F.col("i.s").alias("s"), F.col("i.e").alias("e"))


def union(masks: DataFrame, keys: list[str]) -> DataFrame:
    """The union of all masks with equal keys, as sorted disjoint rows (keys, s, e)."""
    w = Window.partitionBy(*keys).orderBy("s", "e")
    df = exploded(masks, *keys).withColumn("reach", F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    df = df.withColumn("island", F.sum(F.when(F.col("reach").isNull() | (F.col("s") > F.col("reach")), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return df.groupBy(*keys, "island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("island")


def union_area(masks: DataFrame, keys: list[str]) -> DataFrame:
    return union(masks, keys).groupBy(*keys).agg(F.sum(F.col("e") - F.col("s")).cast("long").alias("area"))


def meets(a: DataFrame, b: DataFrame, keys: list[str], a_ids: list[str], b_ids: list[str], width: int = 64, where: Column | None = None) -> DataFrame:
    """What every two intervals share, once: (keys, ids, s, e); both sides are rows (keys, ids, s, e) of disjoint intervals.
    `where` says which pairs of ids may meet."""
    deal = lambda df, s, e: df.withColumn("_b", F.explode(F.sequence(F.floor(F.col(s) / width), F.floor((F.col(e) - 1) / width))))
    left = deal(a.withColumnsRenamed({"s": "as", "e": "ae"}), "as", "ae")
    right = deal(b.withColumnsRenamed({"s": "bs", "e": "be"}), "bs", "be")
    met = left.join(right, [*keys, "_b"]).filter((F.col("as") < F.col("be")) & (F.col("bs") < F.col("ae")) & (F.col("_b") == F.floor(F.greatest("as", "bs") / width)))
    met = met if where is None else met.filter(where)
    return met.select(*keys, *a_ids, *b_ids, F.greatest("as", "bs").alias("s"), F.least("ae", "be").alias("e"))


def overlaps(a: DataFrame, b: DataFrame, keys: list[str], a_ids: list[str], b_ids: list[str], width: int = 64, where: Column | None = None) -> DataFrame:
    """Shared cells of every meeting pair of masks; arguments as in `meets`."""
    return meets(a, b, keys, a_ids, b_ids, width, where).groupBy(*keys, *a_ids, *b_ids).agg(F.sum(F.col("e") - F.col("s")).cast("long").alias("inter"))


def intersections(a: DataFrame, b: DataFrame, keys: list[str], a_ids: list[str], b_ids: list[str], where: Column | None = None) -> DataFrame:
    """The mask that every meeting pair of masks shares: (keys, ids, intervals).  a and b: keys, ids, intervals."""
    rows = meets(exploded(a, *keys, *a_ids), exploded(b, *keys, *b_ids), keys, a_ids, b_ids, where=where)
    return rows.groupBy(*keys, *a_ids, *b_ids).agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("intervals"))


def holds(intervals: Column, cell: Column) -> Column:
    """Whether a mask holds a cell."""
    return F.exists(intervals, lambda x: (x["s"] <= cell) & (cell < x["e"]))


def accepted_parts(parts: DataFrame, masks: DataFrame, cell: float, columns: int, least_height: float = 24.0, least_score: float = 0.6) -> DataFrame:
    """Detected parts (faces, say) that belong to a track: the centre lies in the track's mask, the part is high and sure enough; of
    a track's parts in a frame the best, of equal ones the leftmost.  parts: clip_id, f, tid, box, score; masks: clip_id, f,
    tid, intervals over a grid of `columns` cells of `cell` pixels.  Returns the part's row."""
    cx, cy = geo.center(geo.box())
    inside = (F.floor(F.floor(cy) / cell) * columns + F.floor(F.floor(cx) / cell)).cast("int")
    sure = parts.filter((geo.height(geo.box()) >= least_height) & (F.col("score") >= least_score)).withColumn("_cell", F.when((cx >= 0) & (cy >= 0) & (cx < columns * cell), inside))
    met = sure.join(masks.select("clip_id", "f", "tid", "intervals"), ["clip_id", "f", "tid"]).filter(holds(F.col("intervals"), F.col("_cell")))
    row = F.struct("x1", "y1", "x2", "y2", "score")
    best = met.groupBy("clip_id", "f", "tid").agg(F.max_by(row, F.struct("score", (-F.col("x1")).alias("l"), (-F.col("y1")).alias("t"))).alias("p"))
    return best.select("clip_id", "f", "tid", "p.*")


def union_size(intervals: Column) -> Column:
    """Cells that a list of intervals, in any order and overlapping, covers."""
    start = F.struct(F.lit(-1).cast("long").alias("reach"), F.lit(0).cast("long").alias("total"))
    step = lambda acc, x: F.struct(F.greatest(acc["reach"], x["e"].cast("long")).alias("reach"), (acc["total"] + F.greatest(F.lit(0), x["e"] - F.greatest(acc["reach"], x["s"].cast("long")))).alias("total"))
    return F.aggregate(F.array_sort(intervals), start, step, lambda acc: acc["total"])


def grouped(a: DataFrame, b: DataFrame, keys: list[str]):
    """Rows of two sides dealt into groups by `keys`; `_a` says whether a row is of the first side, whose columns are null in the second."""
    both = a.withColumn("_a", F.lit(True)).unionByName(b.withColumn("_a", F.lit(False)), allowMissingColumns=True)
    return both.groupBy(*keys)


def halves(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Table, pa.Table]:
    """The two sides of a group."""
    held = pa.Table.from_batches(list(batches)).combine_chunks()
    return held.filter(held["_a"]), held.filter(pc.invert(held["_a"]))


def interval_rows(side: pa.Table, mask: np.ndarray | None = None, n: int | None = None) -> spans.Rows:
    """The intervals of a side; `mask` says which of n masks a row belongs to, or every row is a mask."""
    column = side["intervals"].combine_chunks()
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    s, e = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    return spans.Rows(np.repeat(np.arange(len(size)) if mask is None else mask, size), s, e, len(size) if n is None else n)


def areas(rows: spans.Rows) -> np.ndarray:
    return np.bincount(rows.mask, weights=rows.e - rows.s, minlength=rows.n).astype(np.int64)


def _schema(a: DataFrame, b: DataFrame, keys: list[str], a_ids: list[str], b_ids: list[str], more: str) -> StructType:
    fields = [*(a.schema[c] for c in (*keys, *a_ids)), *(b.schema[c] for c in b_ids)]
    return StructType([*fields, *StructType.fromDDL(more).fields])


_SHARED = "inter long, area_a long, area_b long, iou double"


def _shared(keys: list[str], a_ids: list[str], b_ids: list[str], left: pa.Table, right: pa.Table, i: np.ndarray, j: np.ndarray, more: dict) -> pa.RecordBatch:
    """Rows of pairs: left's keys and ids at i, right's ids at j, and more columns."""
    x, y = left.select([*keys, *a_ids]).take(i), right.select(b_ids).take(j) if b_ids else None
    columns = {c: x[c] for c in (*keys, *a_ids)} | ({c: y[c] for c in b_ids} if b_ids else {})
    return pa.RecordBatch.from_pydict({c: v.combine_chunks() for c, v in columns.items()} | {c: pa.array(v) for c, v in more.items()})


def mask_iou(a: DataFrame, b: DataFrame, keys: list[str], a_ids: list[str], b_ids: list[str], where: Column | None = None, least: float = 0.0) -> DataFrame:
    """inter, both areas and IoU of meeting pairs (those that `where` allows and that overlap by `least`).  a and b: keys, ids, intervals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = halves(batches)
        x, y = interval_rows(left), interval_rows(right)
        area_a, area_b = areas(x), areas(y)
        for i, j, inter in spans.shared_blocks(x, y):
            iou = inter / (area_a[i] + area_b[j] - inter)
            k = np.flatnonzero(iou >= least)
            if len(k):
                i, j = i[k], j[k]
                yield _shared(keys, a_ids, b_ids, left, right, i, j, {"inter": inter[k], "area_a": area_a[i], "area_b": area_b[j], "iou": iou[k]})

    met = grouped(a.select(*keys, *a_ids, "intervals"), b.select(*keys, *b_ids, "intervals"), keys).applyInArrow(run, _schema(a, b, keys, a_ids, b_ids, _SHARED))
    return met if where is None else met.filter(where)


def _numbered(side: pa.Table, ids: list[str]) -> tuple[pa.Table, np.ndarray]:
    """The different ids of a side, a row each with the keys it came with, and the place of each row's."""
    place = np.arange(side.num_rows)
    first = side.append_column("_k", pa.array(place)).group_by(ids).aggregate([("_k", "min")]).sort_by("_k_min")
    known = first.append_column("_n", pa.array(np.arange(first.num_rows)))
    of = side.select(ids).append_column("_k", pa.array(place)).join(known.drop_columns("_k_min"), ids).sort_by("_k")["_n"].to_numpy()
    return side.take(first["_k_min"]), of


def _frames(left: pa.Table, right: pa.Table, a_ids: list[str], b_ids: list[str]):
    """Both sides' ids, their areas by frame of those that both sides have, and a generator of blocks of pairs with what they share in
    each such frame."""
    (who_a, of_a), (who_b, of_b) = _numbered(left, a_ids), _numbered(right, b_ids)
    f_a, f_b = left["f"].to_numpy(), right["f"].to_numpy()
    frames = np.intersect1d(f_a, f_b)
    part = lambda side, of, f, k, n: interval_rows(side.filter(pa.array(f == k)), of[f == k], n)
    x, y = ([part(side, of, f, k, who.num_rows) for k in frames.tolist()] for side, of, f, who in ((left, of_a, f_a, who_a), (right, of_b, f_b, who_b)))
    return who_a, who_b, of_a, of_b, x, y


def boundary_iou(a: DataFrame, b: DataFrame, *more: str, least: float = 0.0) -> DataFrame:
    """Per pair of tracks of a clip (and of `more` columns): sum of intersections over sum of unions, over frames in which
    EITHER has a mask; pairs of at least `least`."""
    keys = ["clip_id", *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = halves(batches)
        if not left.num_rows or not right.num_rows:
            return
        who_a, who_b, of_a, of_b, x, y = _frames(left, right, ["tid_a"], ["tid_b"])
        area_a, area_b = areas(interval_rows(left, of_a, who_a.num_rows)), areas(interval_rows(right, of_b, who_b.num_rows))
        for i, j, inter in _summed(x, y, who_a.num_rows, who_b.num_rows):
            p, q = np.nonzero(inter)
            i, j, inter = i[p], j[q], inter[p, q].astype(np.int64)
            iou = inter / (area_a[i] + area_b[j] - inter)
            k = np.flatnonzero(iou >= least)
            if len(k):
                i, j = i[k], j[k]
                yield _shared(keys, ["tid_a"], ["tid_b"], who_a, who_b, i, j, {"inter": inter[k], "area_a": area_a[i], "area_b": area_b[j], "iou": iou[k]})

    sides = (a.select(*keys, "f", "tid_a", "intervals"), b.select(*keys, "f", "tid_b", "intervals"))
    return grouped(*sides, keys).applyInArrow(run, _schema(a, b, keys, ["tid_a"], ["tid_b"], _SHARED))


def _near_blocks(rows: list[spans.Rows], n: int) -> list[np.ndarray]:
    """Ids in blocks of those that begin near each other in the first frame in which they are."""
    first = np.full(n, np.iinfo(np.int64).max)
    for r in reversed(rows):
        seen = np.flatnonzero(np.diff(r.at))
        first[seen] = r.ends[0, seen]
    order = np.argsort(first, kind="stable")
    return [np.sort(order[k : k + spans.BLOCK]) for k in range(0, n, spans.BLOCK)]


def _seen(r: spans.Rows, which: np.ndarray) -> np.ndarray:
    """Places in `which` of the masks that have intervals."""
    return np.flatnonzero(r.at[which + 1] > r.at[which])


def _summed(x: list[spans.Rows], y: list[spans.Rows], n_a: int, n_b: int, each=None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of ids of both sides and the sum over frames of what they share, or of what `each` makes of it and of the places."""
    right = _near_blocks(y, n_b)
    for i in _near_blocks(x, n_a):
        for j in right:
            total = None
            for p, q in zip(x, y, strict=True):
                u, v = _seen(p, i), _seen(q, j)
                if (inter := spans.shared_cells(p, i[u], q, j[v])) is not None:
                    total = np.zeros((len(i), len(j))) if total is None else total
                    total[np.ix_(u, v)] += inter if each is None else each(p, i[u], q, j[v], inter)
            if total is not None:
                yield i, j, total


def mean_iou(a: DataFrame, b: DataFrame, keys: list[str], least: float) -> DataFrame:
    """Per pair of tracks (keys, tid_a, tid_b) the mean IoU over the frames in which both have a row, those in which they do not touch
    counting as 0, as `score`; pairs of at least `least` that touch at all.  a and b: keys, f, tid_a or tid_b, intervals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = halves(batches)
        if not left.num_rows or not right.num_rows:
            return
        who_a, who_b, of_a, of_b, x, y = _frames(left, right, ["tid_a"], ["tid_b"])
        frames, size = np.intersect1d(left["f"].to_numpy(), right["f"].to_numpy()), {id(r): areas(r) for r in (*x, *y)}
        there = []
        for side, of, who in ((left, of_a, who_a), (right, of_b, who_b)):
            f, held = side["f"].to_numpy(), np.zeros((who.num_rows, len(frames)), np.float32)
            k = np.flatnonzero(np.isin(f, frames))
            np.add.at(held, (of[k], np.searchsorted(frames, f[k])), 1)
            there.append(held)
        each = lambda p, i, q, j, inter: inter / np.maximum(size[id(p)][i][:, None] + size[id(q)][j][None, :] - inter.astype(np.float64), 1)
        for i, j, total in _summed(x, y, who_a.num_rows, who_b.num_rows, each):
            p, q = np.nonzero(total)
            score = total[p, q] / (there[0][i] @ there[1][j].T)[p, q].astype(np.float64)
            k = np.flatnonzero(score >= least)
            if len(k):
                yield _shared(keys, ["tid_a"], ["tid_b"], who_a, who_b, i[p[k]], j[q[k]], {"score": score[k]})

    sides = (a.select(*keys, "f", "tid_a", "intervals"), b.select(*keys, "f", "tid_b", "intervals"))
    return grouped(*sides, keys).applyInArrow(run, _schema(a, b, keys, ["tid_a"], ["tid_b"], "score double"))


def insides(views: DataFrame) -> DataFrame:
    """`pairs.insides` from the masks themselves: per view the other track of its frame that it lies inside most, by mask or by box.  A
    frame is a group; its pairs stay in blocks and only each view's best host leaves it.
    views: clip_id, f, tid, box, intervals.  Returns clip_id, f, tid, host, frac, box_frac."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)).sort_by("tid").combine_chunks()
        rows, tid = interval_rows(t), t["tid"].to_numpy()
        size, (x1, y1, x2, y2) = np.maximum(1, areas(rows)), (t[c].to_numpy() for c in ("x1", "y1", "x2", "y2"))
        box_size = np.maximum((x2 - x1) * (y2 - y1), 1e-6)
        most, host, frac, box = np.full(len(tid), -1.0), np.full(len(tid), -1), np.zeros(len(tid)), np.zeros(len(tid))
        blocks, product = rows.blocks(), spans.Product(rows, rows)
        for i in blocks:
            for j in blocks:
                if x1[i].min() >= x2[j].max() or x1[j].min() >= x2[i].max() or y1[i].min() >= y2[j].max() or y1[j].min() >= y2[i].max():
                    continue
                touch = (x1[i][:, None] < x2[j]) & (x1[j] < x2[i][:, None]) & (y1[i][:, None] < y2[j]) & (y1[j] < y2[i][:, None]) & (tid[i][:, None] != tid[j])
                p, q = np.nonzero(touch)
                if not len(p):
                    continue
                u, v = i[p], j[q]
                cover = (np.minimum(x2[u], x2[v]) - np.maximum(x1[u], x1[v])) * (np.minimum(y2[u], y2[v]) - np.maximum(y1[u], y1[v])) / box_size[u]
                inter = product.shared(i, j)
                part = (inter[p, q] if inter is not None else np.zeros(len(p))) / size[u].astype(float)
                value = np.maximum(part, cover)
                start = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
                top = np.repeat(np.maximum.reduceat(value, start), np.diff(np.r_[start, len(p)]))
                k = np.minimum.reduceat(np.where(value == top, np.arange(len(p)), len(p)), start)  # of equal hosts the lowest
                k = k[(value[k] > most[u[k]]) | ((value[k] == most[u[k]]) & (v[k] < host[u[k]]))]
                most[u[k]], host[u[k]], frac[u[k]], box[u[k]] = value[k], v[k], part[k], cover[k]
        k = np.flatnonzero(host >= 0)
        found = t.select(["clip_id", "f", "tid"]).take(k).combine_chunks()
        columns = {c: found[c].combine_chunks() for c in found.column_names} | {"host": t["tid"].take(host[k]).combine_chunks(), "frac": pa.array(frac[k]), "box_frac": pa.array(box[k])}
        yield pa.RecordBatch.from_pydict(columns)

    own = views.select("clip_id", "f", "tid", "x1", "y1", "x2", "y2", "intervals")
    return own.groupBy("clip_id", "f").applyInArrow(run, _schema(own, own, ["clip_id", "f"], ["tid"], [], f"host {dict(own.dtypes)['tid']}, frac double, box_frac double"))


def temporal_union(masks: DataFrame, reach: int, n_frames: int) -> DataFrame:
    """Per clip and frame the union of all masks at most `reach` frames away (within the clip), as area."""
    spread = masks.withColumn("f", F.explode(F.sequence(F.greatest(F.lit(0), F.col("f") - reach), F.least(F.lit(n_frames - 1), F.col("f") + reach))))
    return union_area(spread, ["clip_id", "f"])


def covered_share(persons: DataFrame, veil: DataFrame, least: float = 0.5) -> DataFrame:
    """Per person and frame, whether the union of the veil's masks covers at least `least` of the person's mask."""
    flat = union(veil, ["clip_id", "f"])
    inter = overlaps(exploded(persons, "clip_id", "f", "tid"), flat, ["clip_id", "f"], ["tid"], [])
    sized = persons.select("clip_id", "f", "tid", area(F.col("intervals")).alias("area"))
    df = sized.join(inter, ["clip_id", "f", "tid"], "left").withColumn("share", F.coalesce(F.col("inter"), F.lit(0)) / F.greatest(F.col("area"), F.lit(1)))
    return df.groupBy("clip_id", "tid").agg(F.count(F.lit(1)).alias("frames"), F.avg(F.when(F.col("share") >= least, 1.0).otherwise(0.0)).alias("veiled"))


def veiled_summary(shares: DataFrame, labels: DataFrame) -> DataFrame:
    """Per clip and label (clip_id, tid, label): persons, mean veiled share, how many are veiled in less than half of their
    frames, in half or more, and never."""
    known = shares.join(labels, ["clip_id", "tid"])
    return known.groupBy("clip_id", "label").agg(F.count(F.lit(1)).alias("persons"), F.avg("veiled").alias("mean_veiled"), F.count_if(F.col("veiled") < 0.5).alias("below_half"), F.count_if(F.col("veiled") >= 0.5).alias("half_or_more"), F.count_if(F.col("veiled") == 0).alias("never"))


def pixel_agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per clip and frame: intersection and union of everything masked in either run; a missing frame counts as empty."""
    ua, ub = union(a, ["clip_id", "f"]), union(b, ["clip_id", "f"])
    size = lambda df, n: df.groupBy("clip_id", "f").agg(F.sum(F.col("e") - F.col("s")).cast("long").alias(n))
    inter = overlaps(ua, ub, ["clip_id", "f"], [], [])
    df = size(ua, "area_a").join(size(ub, "area_b"), ["clip_id", "f"], "full_outer").join(inter, ["clip_id", "f"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    df = df.select("clip_id", "f", zero("area_a").alias("area_a"), zero("area_b").alias("area_b"), zero("inter").alias("inter"))
    return df.withColumn("union", F.col("area_a") + F.col("area_b") - F.col("inter"))


def agreement_summary(frames: DataFrame) -> DataFrame:
    s = frames.groupBy("clip_id").agg(*[F.sum(c).alias(c) for c in ("inter", "union", "area_a", "area_b")], F.sum(F.when(F.col("area_b") == 0, 1).otherwise(0)).alias("only_a"), F.sum(F.when(F.col("area_a") == 0, 1).otherwise(0)).alias("only_b"))
    ratio = lambda x, y: F.col(x) / F.nullif(F.col(y), F.lit(0))
    return s.select("clip_id", ratio("inter", "union").alias("iou"), ratio("inter", "area_a").alias("recall"), ratio("inter", "area_b").alias("precision"), "only_a", "only_b")


def worst_frames(frames: DataFrame, n: int = 8) -> DataFrame:
    w = Window.partitionBy("clip_id").orderBy("iou", "f")
    return frames.withColumn("iou", F.col("inter") / F.col("union")).withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n).select("clip_id", "f", "iou")


# The binary bundle: per frame u32 frame, u16 objects; per object u16 id, u32 number of stored runs, u16 runs.  A run longer than
# 65,534 is stored as 65,535 pieces, each continued by the next value.  A wide frame, for ids or numbers of objects beyond 16
# bits, has u32 for both.
NARROW, WIDE = ("<IH", "<HI"), ("<II", "<II")


def needs_wide(objects: list[tuple[int, list[int]]]) -> bool:
    return len(objects) > 0xFFFF or any(ident > 0xFFFF for ident, _ in objects)


def pack_frame(f: int, objects: list[tuple[int, list[int]]], wide: bool = False) -> bytes:
    head, each = WIDE if wide else NARROW
    out = [struct.pack(head, f, len(objects))]
    for ident, runs in objects:
        stored = []
        for r in runs:
            stored += [MAX_RUN] * (r // MAX_RUN) + [r % MAX_RUN]
        out.append(struct.pack(f"{each}{len(stored)}H", ident, len(stored), *stored))
    return b"".join(out)


def unpack_frame(data: bytes, wide: bool = False) -> tuple[int, list[tuple[int, list[int]]]]:
    head, each = WIDE if wide else NARROW
    size = struct.calcsize(each)
    f, n = struct.unpack_from(head, data)
    at, objects = struct.calcsize(head), []
    for _ in range(n):
        ident, count = struct.unpack_from(each, data, at)
        stored = struct.unpack_from(f"<{count}H", data, at + size)
        at += size + 2 * count
        runs, held = [], 0
        for v in stored:
            held += v
            if v != MAX_RUN:
                runs.append(held)
                held = 0
        objects.append((ident, runs))
    return f, objects


def encode_bundle(masks: DataFrame) -> DataFrame:
    """(clip_id, f, tid, counts) to one binary record per frame, and whether that is a wide one; objects in order of id."""
    frames = masks.groupBy("clip_id", "f").agg(F.array_sort(F.collect_list(F.struct("tid", "counts"))).alias("objects"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            frame = [[(o["tid"], list(o["counts"])) for o in objects] for objects in b["objects"]]
            wide = [needs_wide(objects) for objects in frame]
            yield pd.DataFrame({"clip_id": b["clip_id"], "f": b["f"], "record": [pack_frame(f, objects, w) for f, objects, w in zip(b["f"], frame, wide, strict=True)], "wide": wide})

    return frames.mapInPandas(run, "clip_id int, f int, record binary, wide boolean")


def decode_bundle(records: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(clip, f, tid, runs) for clip, record, wide in zip(b["clip_id"], b["record"], b["wide"], strict=True) for f, objects in [unpack_frame(bytes(record), wide)] for tid, runs in objects]
            yield pd.DataFrame(rows, columns=["clip_id", "f", "tid", "counts"])

    return records.mapInPandas(run, "clip_id int, f int, tid int, counts array<int>")
