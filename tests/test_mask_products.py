"""Overlaps of masks as products of blocks: the same as by cells, and no pair is shuffled."""

import random

import numpy as np

from trackweave.functions import geometry as geo
from trackweave.functions import spans
from trackweave.operators import comparing as cm
from trackweave.operators import greedy as gr
from trackweave.operators import masks as mk
from trackweave.operators import pairs as pr
from trackweave.operators import sequences as seq
from trackweave.streaming import pieces


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def drawn(rng, n, frames, top=600):
    """(f, tid, cells as intervals): one to four stretches each, some none."""
    rows = []
    for t in range(n):
        for f in rng.sample(range(frames), rng.randint(1, frames)):
            cuts = sorted(rng.sample(range(top), 2 * rng.randint(0, 4)))
            rows.append((1, f, t, list(zip(cuts[::2], cuts[1::2], strict=True))))
    return rows


def cells(spans_):
    return {c for s, e in spans_ for c in range(s, e)}


def frames_of(spark, rows, tid):
    return spark.createDataFrame(rows, f"clip_id int, f int, {tid} int, intervals array<struct<s:int,e:int>>")


def test_against_cells_and_without_shuffled_pairs(spark, monkeypatch):
    rng = random.Random(3)
    a, b = drawn(rng, 40, 3), drawn(rng, 30, 3)
    x, y = frames_of(spark, a, "tid_a"), frames_of(spark, b, "tid_b")
    held = lambda rows: {(f, t): cells(i) for _, f, t, i in rows}
    p, q = held(a), held(b)
    inter = {(f, s, t): len(p[f, s] & q[g, t]) for f, s in p for g, t in q if f == g}
    want = {(f, s, t): (n, len(p[f, s]), len(q[f, t])) for (f, s, t), n in inter.items() if n}
    found = mk.mask_iou(x, y, ["clip_id", "f"], ["tid_a"], ["tid_b"])
    assert {(r.f, r.tid_a, r.tid_b): (r.inter, r.area_a, r.area_b) for r in found.collect()} == want
    half = {k for k, (n, s, t) in want.items() if n / (s + t - n) >= 0.3}
    assert half and {(r.f, r.tid_a, r.tid_b) for r in mk.mask_iou(x, y, ["clip_id", "f"], ["tid_a"], ["tid_b"], least=0.3).collect()} == half
    mean = {}
    for (f, s, t), n in inter.items():
        mean.setdefault((s, t), []).append(n / max(1, len(p[f, s] | q[f, t])))
    scores = mk.mean_iou(x, y, ["clip_id"], 0.2)
    assert {(r.tid_a, r.tid_b): round(r.score, 9) for r in scores.collect()} == {k: round(sum(v) / len(v), 9) for k, v in mean.items() if sum(v) / len(v) >= 0.2}
    sums = {}
    for (_, s, t), n in inter.items():
        sums[s, t] = sums.get((s, t), 0) + n
    size = lambda h, t: sum(len(v) for (_, k), v in h.items() if k == t)
    both = mk.boundary_iou(x, y)
    assert {(r.tid_a, r.tid_b): (r.inter, r.area_a, r.area_b) for r in both.collect()} == {(s, t): (n, size(p, s), size(q, t)) for (s, t), n in sums.items() if n}
    for df in (found, scores, both):  # one exchange: of masks, before any pair is formed
        final = plan(df).split("Initial Plan")[0]
        assert "Join" not in final and final.count("Exchange hashpartitioning") == 1


def test_blocks_of_any_size(monkeypatch):
    rng = np.random.default_rng(2)
    make = lambda n: (np.repeat(np.arange(n), 2), np.tile([0, 500], n) + rng.integers(0, 200, 2 * n))
    (m, s), (k, t) = make(37), make(23)
    e, u = s + rng.integers(1, 90, len(s)), t + rng.integers(1, 90, len(t))
    a, b = spans.Rows(m, s, e, 37), spans.Rows(k, t, u, 23)
    want = {(int(i), int(j)): n for i in range(37) for j in range(23) if (n := sum(max(0, min(e[2 * i + x], u[2 * j + y]) - max(s[2 * i + x], t[2 * j + y])) for x in (0, 1) for y in (0, 1)))}
    for block, most, kept in ((4, 40, 0), (512, 1 << 22, 0), (4, 40, 1 << 25), (512, 40, 1 << 25)):
        monkeypatch.setattr(spans, "KEPT", kept)
        monkeypatch.setattr(spans, "BLOCK", block)
        monkeypatch.setattr(spans, "CELLS", most)
        assert {(i, j): n for p, q, v in spans.shared_blocks(a, b) for i, j, n in zip(p.tolist(), q.tolist(), v.tolist(), strict=True)} == want


def test_hosts_by_mask_and_box(spark):
    """The same as with all pairs joined, and no join."""
    rng = random.Random(8)
    rows = []
    for f in range(2):
        for t in rng.sample(range(100), 60):
            x, y = rng.randint(0, 200), rng.randint(0, 100)
            rows.append((1, f, t, float(x), float(y), float(x + rng.randint(10, 90)), float(y + rng.randint(10, 90))))
    obs = spark.createDataFrame(rows, "clip_id int, f int, tid int, x1 double, y1 double, x2 double, y2 double")
    views = obs.withColumn("intervals", mk.rectangle_intervals(geo.box(), 40.0, 64))
    masks = views.select("clip_id", "f", "tid", "intervals")
    e = mk.exploded(masks, "clip_id", "f", "tid")
    inter = mk.overlaps(e, e.withColumnRenamed("tid", "host"), ["clip_id", "f"], ["tid"], ["host"])
    sized = views.withColumn("area", mk.area(views["intervals"]))
    key = lambda df: sorted((r.f, r.tid, r.host, round(r.frac, 9), round(r.box_frac, 9)) for r in df.collect())
    got = mk.insides(views)
    assert key(got) == key(pr.insides(sized, inter)) and len(key(got)) > 90
    assert "Join" not in plan(got)


def test_piece_pairs_take_blocks(spark):
    """Overlaps of a piece's tracks with the tail of the piece before are what single comparisons give."""
    rng = random.Random(6)
    flat = lambda: [x for k in range(rng.randint(0, 4)) for x in (100 * k + rng.randint(0, 40), 100 * k + rng.randint(41, 90))]
    heads, tails = [flat() for _ in range(25)], [flat() for _ in range(20)]
    one = lambda v: np.asarray(v, np.int64).reshape(-1, 2)
    want = set()
    for b, h in enumerate(heads):
        for a, t in enumerate(tails):
            n = spans.shared(one(h), one(t))
            if n and n / (spans.size(one(h)) + spans.size(one(t)) - n) >= 0.4:
                want.add((round(n / (spans.size(one(h)) + spans.size(one(t)) - n), 9), b + 100, a))
    got = pieces._pairs(heads, tails, [k + 100 for k in range(25)], list(range(20)), 0.4)
    assert {(round(v, 9), b, a) for v, b, a in got} == want and len(got) == len(want) > 5


def test_run_overlap_of_all_tracks(spark):
    """The same as by frames, with tracks that only one side has, and no join."""
    rng = random.Random(4)
    rows = lambda tids: [(c, t, s, s + rng.randint(0, 9)) for c in (1, 2) for t in tids for s in (rng.randint(0, 20), 40 + rng.randint(0, 20))]
    left, right = rows(range(0, 30)), rows(range(10, 45))
    frames = lambda side, c, t: {f for k, n, s, e in side if (k, n) == (c, t) for f in range(s, e + 1)}
    want = {(c, a, b): n for c in (1, 2) for a in range(30) for b in range(10, 45) if a < b and (n := len(frames(left, c, a) & frames(right, c, b)))}
    found = seq.run_overlap(*(spark.createDataFrame(x, "clip_id int, tid int, first_f int, last_f int") for x in (left, right)))
    assert {(r.clip_id, r.tid_a, r.tid_b): r.frames for r in found.collect()} == want and "Join" not in plan(found)


def test_hosts_and_matches_form_no_join(spark):
    """Choices among a frame's pairs equal those from all pairs, and its pairs stay in its group."""
    rng = random.Random(9)
    made = lambda: [(1, f, t, float(x), float(y), float(x + rng.randint(20, 60)), float(y + rng.randint(20, 60))) for f in range(2) for t in range(700) for x, y in [(rng.randint(0, 900), rng.randint(0, 60))]]
    a, b = made(), made()
    x, y = (spark.createDataFrame(r, "clip_id int, f int, tid int, x1 double, y1 double, x2 double, y2 double") for r in (a, b))
    joined = pr.pairs(x, x).filter("a_tid <> b_tid").toPandas()
    joined["cover"] = [max(0, min(r.a_x2, r.b_x2) - max(r.a_x1, r.b_x1)) * max(0, min(r.a_y2, r.b_y2) - max(r.a_y1, r.b_y1)) / ((r.a_x2 - r.a_x1) * (r.a_y2 - r.a_y1)) for r in joined.itertuples()]
    best = joined[joined["cover"] >= 0.5].sort_values(["cover", "b_tid"], ascending=[False, True]).groupby(["f", "a_tid"]).first()
    found = pr.hosts(x)
    assert {(r.f, r.tid): (r.host, r.cover) for r in found.collect()} == {k: (int(h), c) for k, h, c in zip(best.index, best["b_tid"], best["cover"], strict=True)}
    c = pr.pairs(x, y).filter("iou >= 0.5").select("clip_id", "f", "a_tid", "b_tid", "iou").toPandas()
    want = {(int(r.f), int(r.a_tid), int(r.b_tid), r.iou) for _, g in c.groupby("f") for r in gr.one_to_one(g, "a_tid", "b_tid", "iou").itertuples()}
    matched = gr.greedy_match(x, y)
    assert {(r.f, r.tid_a, r.tid_b, r.iou) for r in matched.collect()} == want and len(want) > 200
    assert "Join" not in plan(found) and "Join" not in plan(matched)


def test_switches_work_out_matches_once(spark):
    rng = random.Random(2)
    m = spark.createDataFrame([(1, f, a, rng.choice([a, a, a + 50])) for a in range(20) for f in range(12)], "clip_id int, f int, tid_a int, tid_b int")
    want = cm.switches(m, cm.splits(cm.supported_pairs(m)))
    got = cm.split_switches(m)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 5
    assert "Join" not in plan(got)
