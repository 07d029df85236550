"""Candidates, links and hand-overs on runs and two vectors, against plain Python over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackweave.functions import scalars as sc
from trackweave.operators import greedy as gr
from trackweave.operators import pooling as pl
from trackweave.operators import vectors as vx

SEGMENT = "clip_id int, sid int, first_f int, last_f int, runs array<struct<start:int,end:int>>, face_vec array<double>, body_vec array<double>, n_face int, cls string, cx1 double, cy1 double, cx2 double, cy2 double, h2 double, vx double, vy double"


def unit(rng, dims=3):
    v = [rng.gauss(0, 1) for _ in range(dims)]
    n = math.sqrt(sum(x * x for x in v))
    return [x / n for x in v]


def runs_of(frames):
    out = []
    for f in sorted(frames):
        if out and out[-1][1] == f - 1:
            out[-1] = (out[-1][0], f)
        else:
            out.append((f, f))
    return out


def scene(rng, n=70, clips=2):
    rows = []
    for sid in range(n):
        start = rng.randint(0, 300)
        frames = {f for f in range(start, start + rng.randint(2, 90)) if rng.random() < 0.97 and f // 7 % 3 != sid % 3} or {start}
        at = [float(rng.randint(0, 200)) for _ in range(4)]
        rows.append((sid % clips, sid, min(frames), max(frames), runs_of(frames), None if sid % 6 == 0 else unit(rng), None if sid % 9 == 0 else unit(rng, 2), rng.randint(0, 4), rng.choice([None, "a", "b"]), *at, float(rng.randint(20, 60)), rng.uniform(-2, 2), rng.uniform(-1, 1)))
    return rows


def frames_of(r):
    return {f for s, e in r[4] for f in range(s, e + 1)}


def brute_candidates(rows, fps=25.0, width=300.0):
    dot = lambda a, b: None if a is None or b is None else sum(x * y for x, y in zip(a, b, strict=True))
    out = {}
    for x in rows:
        for y in rows:
            if x[0] != y[0] or x[1] >= y[1] or frames_of(x) & frames_of(y):
                continue
            first, second = (x, y) if x[2] <= y[2] else (y, x)
            gap = max(0, second[2] - first[3])
            face, body = dot(x[5], y[5]), dot(x[6], y[6])
            if face is not None and face >= 0.45 and min(x[7], y[7]) >= 2:
                out[x[0], x[1], y[1]] = ("face", face + 1)
            elif body is not None and body >= 0.75 and gap / fps <= 3:
                moved = math.hypot(first[11] + first[14] * gap - second[9], first[12] + first[15] * gap - second[10])
                fits = body >= 0.85 and moved <= 1.5 * first[13] + 0.1 * width * gap / fps and (x[8] is None or y[8] is None or x[8] == y[8])
                out[x[0], x[1], y[1]] = ("body" if fits else "near_miss", body)
    return out


def brute_links(rows, candidates, strong=1.6):
    """Groups by best pair first; members are compared frame by frame."""
    by = {r[1]: r for r in rows}
    group = {s: {s} for s in by}
    for (_, a, b), (how, score) in sorted(candidates.items(), key=lambda x: (x[1][1], x[0][1], x[0][2]), reverse=True):
        x, y = group[a], group[b]
        if how == "near_miss" or x is y or any(frames_of(by[i]) & frames_of(by[j]) for i in x for j in y):
            continue
        kinds = [{by[m][8] for m in g if by[m][8]} for g in (x, y)]
        if kinds[0] and kinds[1] and kinds[0] != kinds[1] and not (how == "face" and score >= strong and min(by[a][7], by[b][7]) >= 3):
            continue
        x |= y
        for m in y:
            group[m] = x
    return {s: min(g) for s, g in group.items()}


@pytest.mark.parametrize("seed", range(3))
def test_candidates_and_links_on_runs(spark, seed):
    rows = scene(random.Random(seed))
    df = spark.createDataFrame(rows, SEGMENT)
    got = pl.link_candidates(df, 25.0, 300.0)
    want = brute_candidates(rows)
    found = {(r.clip_id, r.sid_a, r.sid_b): (r.how, r.score) for r in got.collect()}
    assert {k: (h, round(s, 9)) for k, (h, s) in found.items()} == {k: (h, round(s, 9)) for k, (h, s) in want.items()}
    assert {h for h, _ in want.values()} == {"face", "body", "near_miss"}
    by = {r[1]: r for r in rows}
    inside = [k for k in want if max(by[k[1]][2], by[k[2]][2]) < min(by[k[1]][3], by[k[2]][3])]
    assert inside  # segments that lie in each other's holes are candidates
    linked = gr.link(df.withColumn("lean", F.col("cls")), got)
    assert {r.sid: r.identity_sid for r in linked.collect()} == brute_links(rows, want)


def test_interleaved_tracks_are_linked(spark):
    rows = [(0, 1, [(0, 9), (40, 49)]), (0, 2, [(20, 29)]), (0, 3, [(45, 60)])]
    seg = spark.createDataFrame([(*r, None, None, 3) for r in rows], "clip_id int, sid int, runs array<struct<start:int,end:int>>, cls string, lean string, n_face int")
    cand = spark.createDataFrame([(0, 1, 2, "body", 0.9), (0, 1, 3, "body", 0.99), (0, 2, 3, "body", 0.8)], "clip_id int, sid_a int, sid_b int, how string, score double")
    assert {r.sid: r.identity_sid for r in gr.link(seg, cand).collect()} == {1: 1, 2: 1, 3: 3}


def test_handoff_counts_runs(spark):
    schema = "clip_id int, identity int, first_f int, last_f int, frames int, lean string, a1 double, a2 double, a3 double, a4 double, b1 double, b2 double, b3 double, b4 double, runs array<struct<start:int,end:int>>"
    box = (0.0, 0.0, 10.0, 10.0)
    # 2 begins where 1 ends, in a hole of 1's last frames or over them
    rows = [(0, 1, 0, 103, 90, "a", *box, *box, [(0, 88), (103, 103)]), (0, 2, 100, 110, 11, None, *box, *box, [(100, 102), (104, 110)])]
    rows += [(1, 1, 0, 110, 111, "a", *box, *box, [(0, 110)]), (1, 2, 107, 117, 11, None, *box, *box, [(107, 117)])]
    got = {(r.clip_id, r.identity): r.merged for r in gr.handoff(spark.createDataFrame(rows, schema), 25.0).collect()}
    assert got == {(0, 1): 1, (0, 2): 1, (1, 1): 1, (1, 2): 2}


def test_runs_as_columns(spark):
    rng = random.Random(1)
    pairs = [({rng.randint(0, 30) for _ in range(rng.randint(0, 14))}, {rng.randint(0, 30) for _ in range(rng.randint(1, 14))}) for _ in range(200)]
    df = spark.createDataFrame([(k, rng.sample(sorted(a), len(a)), sorted(b)) for k, (a, b) in enumerate(pairs)], "k int, a array<int>, b array<int>")
    df = df.withColumn("ra", sc.runs_of(F.col("a"))).withColumn("rb", sc.runs_of(F.col("b"))).withColumn("n", sc.runs_shared(F.col("ra"), F.col("rb")))
    for r in df.collect():
        a, b = pairs[r.k]
        assert [tuple(x) for x in r.ra or []] == runs_of(a) and (r.n or 0) == len(a & b)


def pairs_of(rows, least, ok=lambda x, y: True):
    return {(x[0], *sorted((x[1], y[1]))) for x in rows for y in rows if x[0] == y[0] and x[1] < y[1] and x[-1] and y[-1] and sum(p * q for p, q in zip(x[-1], y[-1], strict=True)) >= least and ok(x, y)}


@pytest.mark.parametrize("block", [3, 17, 512])
def test_block_pairs(spark, block):
    rng = random.Random(block)
    rows = [(k % 3, k, None if k % 10 == 0 else unit(rng)) for k in range(90)]
    got = vx.block_pairs(spark.createDataFrame(rows, "clip_id int, id int, vec array<double>"), 0.4, block).collect()
    assert len(got) == len({(r.clip_id, r.id_a, r.id_b) for r in got})
    assert {(r.clip_id, r.id_a, r.id_b) for r in got} == pairs_of(rows, 0.4)


@pytest.mark.parametrize("gap", [0, 5, 60])
def test_following_pairs(spark, gap):
    rng = random.Random(gap)
    rows = [(k % 2, k, f, f + rng.randint(0, 120), unit(rng, 2)) for k in range(80) for f in [rng.randint(0, 400)]]

    def ok(x, y):
        a, b = (x, y) if (x[2], x[1]) < (y[2], y[1]) else (y, x)
        return b[2] - a[3] <= gap

    got = vx.following_pairs(spark.createDataFrame(rows, "clip_id int, id int, first_f int, last_f int, vec array<double>"), 0.5, gap).collect()
    assert len(got) == len({(r.clip_id, r.id_a, r.id_b) for r in got})
    assert {(r.clip_id, r.id_a, r.id_b) for r in got} == pairs_of(rows, 0.5, ok)


def test_index_recall_against_all_pairs(spark):
    """Noisy copies of some directions among many others: the index finds nine of ten close pairs, as it says it will."""
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 32))
    all_ = np.concatenate([base + rng.standard_normal(base.shape) * s for s in (0.0, 0.3, 0.45, 0.6)] + [rng.standard_normal((300, 32))])
    all_ /= np.linalg.norm(all_, axis=1, keepdims=True)
    df = spark.createDataFrame([(0, k, v.tolist()) for k, v in enumerate(all_)], "clip_id int, id int, vec array<double>")
    exact = {(r.id_a, r.id_b): r.cos for r in vx.block_pairs(df, 0.8).collect()}
    found = {(r.id_a, r.id_b): r.cos for r in vx.indexed_pairs(df, 0.8).collect()}
    assert found.keys() <= exact.keys() and all(abs(found[k] - exact[k]) < 1e-9 for k in found)
    assert len(exact) > 100 and len(found) >= 0.9 * len(exact)
    assert vx.expected_recall(0.8, 24, 6) > 0.9
