"""Queries over whole inputs, against plain Python."""

from trackweave.plans import registry
from trackweave.plans.fixtures import relation

SF = "/root/testdata/sf0.001"


def cells(r):
    return {(y, x) for y in range(int(r.y1 // 40), int(-(-r.y2 // 40))) for x in range(int(r.x1 // 40), int(-(-r.x2 // 40)))}


def test_boundary_iou_of_every_chunk_overlap(spark):
    got = {(r.clip_id, r.boundary, r.tid_a, r.tid_b): (r.inter, r.area_a, r.area_b) for r in registry.queries()["j10_boundary_iou_all"](spark, SF).collect()}
    runs, last = [], {}
    for name in ("obs", "run_b"):
        run = {}
        for r in relation(spark, SF, name).collect():
            run.setdefault(r.clip_id, []).append((r.f, r.tid, cells(r)))
            if name == "obs":
                last[r.clip_id] = max(last.get(r.clip_id, 0), r.f + 1)
        runs.append(run)
    want = {}
    for clip, n in last.items():
        for k in range(100):
            start = (k + 1) * 25  # chunks of 30 frames, 5 shared
            if start + 5 >= n:
                break
            a, b = ([x for x in run[clip] if start <= x[0] < start + 5] for run in runs)
            for s in {x[1] for x in a}:
                for t in {x[1] for x in b}:
                    inter = sum(len(x[2] & y[2]) for x in a for y in b if x[1] == s and y[1] == t and x[0] == y[0])
                    if inter:
                        want[clip, k, s, t] = (inter, sum(len(x[2]) for x in a if x[1] == s), sum(len(y[2]) for y in b if y[1] == t))
    assert got == want and len({k[1] for k in want}) == 3


def test_all_frames_have_ages_and_tiles(spark):
    obs = relation(spark, SF, "obs").select("clip_id", "f", "tid").collect()
    ages = registry.queries()["p25_p26_age_distribution_all"](spark, SF).select("clip_id", "f", "tid").collect()
    assert sorted(ages) == sorted(obs)
    tiles = registry.queries()["g08_tiles_all"](spark, SF).collect()
    assert len(tiles) == len(set(tiles)) == 8 * len({(r.clip_id, r.f) for r in obs})


def test_pairs_of_distant_ids(spark):
    sf = "/root/testdata/sf0.01"
    tids = {}
    for r in relation(spark, sf, "obs").select("clip_id", "f", "tid").collect():
        tids.setdefault(r.clip_id, {}).setdefault(r.f, set()).add(r.tid)
    got = sorted((r.clip_id, r.f, r.tid, r.other) for r in registry.queries()["p01_p04_pair_geometry_all"](spark, sf).select("clip_id", "f", "tid", "other").collect())
    assert got == sorted((c, f, a, b) for c, frames in tids.items() for f, ids in frames.items() for a in ids for b in ids if a < b)
    assert max(b - a for _, _, a, b in got) > 100
    got = sorted((r.clip_id, r.tid, r.other) for r in registry.queries()["p23_compatible_classes_all"](spark, sf).collect())
    assert got == sorted((c, a, b) for c, frames in tids.items() for all_ids in [set().union(*frames.values())] for a in all_ids for b in all_ids if a < b)
