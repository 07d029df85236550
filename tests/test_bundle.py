"""Mask bundles written as files and read again."""

import gzip
import random

import pytest

from trackweave.operators import masks as mk
from trackweave.sources import bundle


def masks(rng, clips=3, frames=50):
    rows = []
    for c in range(clips):
        for f in range(frames):
            for t in rng.sample(range(0, 65_536), rng.randint(0, 3)):
                counts = [rng.choice([0, 1, 7, 300, 65_534, 65_535, 65_536, 131_070, 200_000]) for _ in range(rng.randint(1, 6))]
                rows.append((c, f, t, counts))
    return rows


def test_files_byte_for_byte(spark, tmp_path):
    rows = masks(random.Random(1))
    df = spark.createDataFrame(random.Random(2).sample(rows, len(rows)), bundle.SCHEMA)
    where = str(tmp_path / "b")
    bundle.write_bundle(df, where, fps=5, seconds=3)
    got = bundle.read_bundle(spark, where)
    assert sorted((r.clip_id, r.f, r.tid, r.counts) for r in got.collect()) == sorted(rows)
    files = sorted((tmp_path / "b").glob("clip_id=*/*.bin"))
    assert len(files) > 9 and not list((tmp_path / "b").rglob("_temporary/*"))
    assert got.rdd.getNumPartitions() == len(files)
    for file in files:
        clip = int(file.parent.name.split("=")[1])
        first, last = map(int, file.stem.split("-"))
        own = sorted(r for r in rows if r[0] == clip and first <= r[1] <= last)
        assert first // 15 == last // 15 and {first, last} <= {r[1] for r in own}
        want = b"".join(mk.pack_frame(f, [(t, c) for _, g, t, c in own if g == f]) for f in sorted({r[1] for r in own}))
        assert gzip.decompress(file.read_bytes()) == want
    # written again it is the same bytes, and nothing of the former is left
    before = {f.name: f.read_bytes() for f in files if f.parent.name == "clip_id=0"}
    bundle.write_bundle(got.filter("clip_id = 0"), str(tmp_path / "c"), fps=5, seconds=3)
    assert {f.name: f.read_bytes() for f in (tmp_path / "c").glob("clip_id=0/*.bin")} == before
    bundle.write_bundle(df.filter("clip_id = 1"), str(tmp_path / "c"), fps=5, seconds=3)
    assert {r.clip_id for r in bundle.read_bundle(spark, str(tmp_path / "c")).collect()} == {1}


def test_uri_append_and_wrong_ids(spark, tmp_path):
    where = f"file://{tmp_path}/b"
    one = spark.createDataFrame([(1, 0, 5, [2, 3])], bundle.SCHEMA)
    bundle.write_bundle(one, where)
    bundle.write_bundle(spark.createDataFrame([(2, 9, 6, [0, 70_000, 1])], bundle.SCHEMA), where, mode="append")
    assert sorted(map(tuple, bundle.read_bundle(spark, where).collect())) == [(1, 0, 5, [2, 3]), (2, 9, 6, [0, 70_000, 1])]
    with pytest.raises(Exception, match="16 bits"):
        bundle.write_bundle(spark.createDataFrame([(3, 0, 70_000, [1])], bundle.SCHEMA), where, mode="append")
    assert bundle.read_bundle(spark, where).count() == 2 and not list(tmp_path.rglob("_temporary/*"))
    assert bundle.read_bundle(spark, f"{tmp_path}/b").filter("clip_id = 2").count() == 1


def test_wide_frames(spark, tmp_path):
    rows = [(1, 0, 5, [2, 3]), (1, 1, 5, [1, 70_000]), (1, 1, 70_000, [0, 4]), (1, 2, 65_535, [9])]
    df = spark.createDataFrame(rows, bundle.SCHEMA)
    bundle.write_bundle(df, str(tmp_path / "b"), wide=True)
    assert sorted(f.name for f in (tmp_path / "b").glob("clip_id=1/*")) == ["00000000-00000000.bin", "00000001-00000001.wide.bin", "00000002-00000002.bin"]
    assert sorted(map(tuple, bundle.read_bundle(spark, str(tmp_path / "b")).collect())) == rows
    records = mk.encode_bundle(df)
    assert sorted((r.f, r.wide) for r in records.collect()) == [(0, False), (1, True), (2, False)]
    assert sorted(map(tuple, mk.decode_bundle(records).collect())) == rows
    assert bytes(records.filter("f = 0").first().record) == mk.pack_frame(0, [(5, [2, 3])])
