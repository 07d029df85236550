"""Pieces that come one by one, late, twice and over a restart get the ids of one batch."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_identity import scene, table
from trackweave.functions import spans
from trackweave.operators import identity as idn
from trackweave.streaming import pieces as pc


def batch_ids(df):
    tracks = df.groupBy("clip_id", "chunk", F.col("oid").alias("tid")).agg(F.count_if((F.col("chunk") == 0) | (F.col("f") >= F.col("chunk") * 16 + 4)).cast("int").alias("own_frames"))
    return {tuple(r) for r in idn.stitch_in_order(idn.boundary_pairs(df, 16, 4), tracks).collect()}


def feed(spark, whole, where, order, restart_after=None):
    """Each entry of `order` is a file with some pieces; one file a micro-batch."""
    out = []

    def start():
        stream = spark.readStream.schema(pc.PIECE).option("maxFilesPerTrigger", 1).parquet(str(where / "in"))
        return pc.stitch_pieces(stream).writeStream.foreachBatch(lambda df, _: out.append(df.collect())).option("checkpointLocation", str(where / "state")).trigger(availableNow=True).start()

    for k, wanted in enumerate(order):
        part = whole.filter(" or ".join(f"(clip_id = {c} and chunk = {n})" for c, n in wanted)).coalesce(1)
        part.write.mode("append").parquet(str(where / "in"))
        if k == restart_after or k == len(order) - 1:
            start().awaitTermination(180)
    return [tuple(r) for rows in out for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_pieces_equal_one_batch(spark, tmp_path, seed):
    rng = random.Random(seed)
    df = table(spark, scene(rng, objects=8, present=0.7)).persist()
    whole = pc.as_pieces(df, 16, 4, 64 * 40).persist()
    numbers = [(r.clip_id, r.chunk) for r in whole.select("clip_id", "chunk").collect()]
    rng.shuffle(numbers)
    order = [numbers[i : i + 2] for i in range(0, len(numbers), 2)] + [numbers[:2]]  # out of order, and some again
    got = feed(spark, whole, tmp_path, order, restart_after=len(order) // 2)
    assert len(got) == len(set(got)) and set(got) == batch_ids(df)


def test_ids_are_only_given_forward(spark, tmp_path):
    df = table(spark, scene(random.Random(5), clips=1, objects=6, present=0.8)).persist()
    whole = pc.as_pieces(df, 16, 4, 64 * 40).persist()
    last = whole.agg(F.max("chunk")).first()[0]
    first = feed(spark, whole, tmp_path / "a", [[(0, 0)], [(0, 2)]])
    assert {r[1] for r in first} == {0}  # piece 2 waits for piece 1
    assert set(first) == {r for r in batch_ids(df) if r[1] == 0}
    every = feed(spark, whole, tmp_path / "b", [[(0, n)] for n in range(last + 1)])
    assert set(first) <= set(every) and set(every) == batch_ids(df)


def test_spans():
    rng = random.Random(2)

    def cells():
        return {x for _ in range(rng.randint(0, 6)) for s in [rng.randint(0, 60)] for x in range(s, s + rng.randint(1, 9))}

    def as_spans(c):
        out = []
        for x in sorted(c):
            if out and out[-1][1] == x and rng.random() < 0.8:
                out[-1][1] = x + 1
            else:
                out.append([x, x + 1])  # intervals may touch
        return np.array(out, np.int64).reshape(-1, 2)

    for _ in range(500):
        a, b = cells(), cells()
        sa, sb = as_spans(a), as_spans(b)
        assert spans.shared(sa, sb) == len(a & b) and spans.size(sa) == len(a)
        assert {x for s, e in spans.intersect(sa, sb).tolist() for x in range(s, e)} == a & b
