"""Append-only stitching: a recording comes in pieces, and ids of finished pieces never change.

A piece is a chunk: it reads the last frames of the piece before, and what both have seen there carries the ids over.  The
state of a clip is the tail of its last settled piece and the pieces that came too early; it does not grow with the clip.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import spans
from ..operators.identity import settle

PIECE = "clip_id int, chunk int, tids array<int>, own array<int>, heads array<array<long>>, tails array<array<long>>"
IDS = "clip_id int, chunk int, tid int, global_id long"


def as_pieces(rows: DataFrame, step: int, overlap: int, cells: int) -> DataFrame:
    """One row per clip and chunk of what stitching needs: its tracks, how many frames each owns, and their masks in the frames
    shared with the chunk before (heads) and after (tails), as flat lists of ends of intervals; frame f begins at f * cells.
    rows: clip_id, chunk, oid, f, intervals."""

    def flat(wanted: Column) -> Column:
        base = F.col("f").cast("long") * cells
        row = F.transform("intervals", lambda x: F.struct((base + x["s"]).alias("s"), (base + x["e"]).alias("e")))
        every = F.array_sort(F.flatten(F.collect_list(F.when(wanted, row))))
        return F.flatten(F.transform(every, lambda x: F.array(x["s"], x["e"])))

    start = F.col("chunk") * step
    head = (F.col("chunk") > 0) & (F.col("f") < start + overlap)
    own = F.count_if((F.col("chunk") == 0) | (F.col("f") >= start + overlap)).cast("int")
    tracks = rows.groupBy("clip_id", "chunk", "oid").agg(own.alias("own"), flat(head).alias("head"), flat(F.col("f") >= start + step).alias("tail"))
    one = tracks.groupBy("clip_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("oid", "own", "head", "tail"))).alias("t"))
    return one.select("clip_id", "chunk", F.col("t.oid").alias("tids"), F.col("t.own").alias("own"), F.col("t.head").alias("heads"), F.col("t.tail").alias("tails"))


def _rows(flat: list[list[int]]) -> spans.Rows:
    """Flat lists of ends of intervals, one a mask."""
    ends = np.fromiter((x for one in flat for x in one), np.int64).reshape(-1, 2)
    return spans.Rows(np.repeat(np.arange(len(flat)), [len(one) // 2 for one in flat]), ends[:, 0], ends[:, 1], len(flat))


def _pairs(heads: list[list[int]], tails: list[list[int]], after: list[int], before: list[int], least: float) -> list[tuple[float, int, int]]:
    """(IoU, track, track before) of those whose masks overlap by `least`."""
    x, y = _rows(heads), _rows(tails)
    size_x, size_y = (np.bincount(r.mask, weights=r.e - r.s, minlength=r.n).astype(np.int64) for r in (x, y))
    out = []
    for i, j, inter in spans.shared_blocks(x, y):
        iou = inter / (size_x[i] + size_y[j] - inter)
        k = np.flatnonzero(iou >= least)
        out += zip(iou[k].tolist(), [after[n] for n in i[k]], [before[n] for n in j[k]], strict=True)
    return out


def stitch_pieces(pieces: DataFrame, least: float = 0.5) -> DataFrame:
    """Ids of a stream of pieces (PIECE): the same as `identity.stitch_in_order` gives for all at once.  A clip's pieces are
    settled in order, each as soon as it and all before it are there: a piece that comes before its turn waits, one that comes
    again is ignored; a piece is given out once and never changed."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {"chunk": -1, "tail": [], "waiting": {}}
        waiting = held["waiting"]
        for rows in batches:
            for r in rows.itertuples():
                if r.chunk > held["chunk"]:  # a piece that comes again says nothing new
                    tracks = zip(r.tids, r.own, r.heads, r.tails, strict=True)
                    waiting[str(r.chunk)] = [(int(t), int(own), list(map(int, head)), list(map(int, tail))) for t, own, head, tail in tracks]
        out = []
        while (following := str(held["chunk"] + 1)) in waiting:
            tracks, chunk = waiting.pop(following), int(following)
            pairs = _pairs([head for _, _, head, _ in tracks], [tail for *_, tail in held["tail"]], [t for t, *_ in tracks], [a for a, *_ in held["tail"]], least)
            before = {a: number for a, number, _ in held["tail"]}
            found = settle(pairs, {t: own for t, own, _, _ in tracks}, before, chunk)
            out += [(key[0], chunk, t, found.get(t)) for t, *_ in tracks]
            held["chunk"], held["tail"] = chunk, [(t, found[t], tail) for t, _, _, tail in tracks if t in found]
        state.update((json.dumps(held),))
        if out:
            yield pd.DataFrame(out, columns=["clip_id", "chunk", "tid", "global_id"]).astype({"global_id": "Int64"})

    return pieces.groupBy("clip_id").applyInPandasWithState(step, IDS, "held string", "append", GroupStateTimeout.NoTimeout)
