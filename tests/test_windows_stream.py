"""Streams with bounded state against the batch rules."""

import random

from pyspark.sql import functions as F

from trackweave.operators import masks as mk
from trackweave.operators import sequences as seq
from trackweave.streaming import tracks as st


def run(spark, make, rows, schema, where, mode, files=6):
    """Rows in order, in some files, one a micro-batch; what each batch gave."""
    out = []
    per = -(-len(rows) // files)
    for k in range(files):
        spark.createDataFrame(rows[k * per : (k + 1) * per], schema).coalesce(1).write.mode("append").parquet(str(where / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(where / "in"))
    q = make(stream).writeStream.outputMode(mode).foreachBatch(lambda df, n: out.append((n, df.collect()))).option("checkpointLocation", str(where / "state")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    return [r for _, rows in sorted(out) for r in rows]


def test_kept_windows(spark, tmp_path):
    rng = random.Random(4)
    rows = [(0, t, f, round(rng.random() + (f % 5 == 0) * (t == 1), 6)) for f in range(300) for t in range(3) if rng.random() < 0.6]
    schema = "clip_id int, tid int, f int, quality double"
    got = {r.tid: dict(zip(r.wins, zip(r.fs, r.qualities, strict=True), strict=True)) for r in run(spark, lambda s: st.kept_windows(s, 5, 8), rows, schema, tmp_path, "update")}
    batch = {}
    for r in seq.best_windows(spark.createDataFrame(rows, schema), "quality", 5, 8).collect():
        batch.setdefault(r.tid, {})[r.f // 5] = (r.f, r.quality)
    for t in range(3):
        # one view after another, with the same eviction
        wins, driven = {}, {}
        for _, _, f, q in (r for r in rows if r[1] == t):
            w = f // 5
            if w in wins:
                wins[w] = max(wins[w], (f, q), key=lambda x: (x[1], -x[0]))
            elif len(wins) < 8 or q > min(v[1] for v in wins.values()):
                wins[w] = (f, q)
                if len(wins) > 8:
                    worst = min(wins, key=lambda k: (wins[k][1], -wins[k][0]))
                    driven[worst] = wins.pop(worst)
        assert got[t] == wins and len(wins) == 8
        if not set(driven) & set(wins):
            assert got[t] == batch[t]
    assert any(got[t] == batch[t] for t in range(3))


def test_look_ahead_union(spark, tmp_path):
    rng = random.Random(6)
    rows = []
    for f in range(0, 60):
        for _ in range(rng.randint(0, 3)):
            s = sorted(rng.sample(range(0, 200), 4))
            rows.append((0, f, [(s[0], s[1]), (s[2], s[3])]))
    schema = "clip_id int, f int, intervals array<struct<s:int,e:int>>"
    df = spark.createDataFrame(rows, schema)
    batch = {r.f: r.area for r in mk.temporal_union(df, 3, 60).collect()}
    whole = {r.f: r.area for r in st.look_ahead_union(df, 3).collect()}
    assert {f: a for f, a in whole.items() if f < 60} == batch
    got = run(spark, lambda s: st.look_ahead_union(s, 3), rows, schema, tmp_path, "append")
    assert len(got) == len({r.f for r in got}) and all(batch[r.f] == r.area for r in got)
    assert max(r.f for r in got) >= 50  # given as soon as the last frame that reaches them is there


def test_union_size(spark):
    rng = random.Random(8)
    lists = [[(s, s + rng.randint(0, 9)) for s in (rng.randint(0, 40) for _ in range(rng.randint(0, 7)))] for _ in range(200)]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "k int, i array<struct<s:int,e:int>>").select("k", mk.union_size(F.col("i")).alias("n"))
    assert all(r.n == len({c for s, e in lists[r.k] for c in range(s, e)}) for r in df.collect())
