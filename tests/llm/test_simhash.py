import random

import pytest
import xxhash

from trackweave.llm import simhash


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = []
    word = ""
    for c in low + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps, radius=3):
    """Least position in `fps` reachable from each, by comparing all pairs."""
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(fps))]


def brute(rows):
    rows = [(d, brute_fingerprint(t)) for d, t in rows]
    comp = brute_components([f for _, f in rows])
    least = {}
    for c, (d, _) in zip(comp, rows, strict=True):
        if d is not None:
            least[c] = min(least.get(c, d), d)
    return sorted(((d, f"{f:016x}", least.get(c)) for c, (d, f) in zip(comp, rows, strict=True)), key=str)


def compare(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, fp int, label string")
    got = [tuple(r) for r in simhash.near_duplicates(spark, df, **kw).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_every_pair_within_the_radius_meets():
    rng = random.Random(1)
    for bits, radius in ((list(range(64)), 3), (rng.sample(range(64), 30), 3), (list(range(64)), 1), (list(range(64)), 5), ([3, 9], 3)):
        masks = simhash.covering(bits, radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            changed = sum(1 << b for b in rng.sample(bits, min(len(bits), rng.randint(0, radius))))
            assert any(not m & changed for m in masks)


def test_cases(spark):
    base = " ".join(f"word{i}" for i in range(400))
    near = base.replace("word7 ", "wort7 ")
    long = "alpha beta gamma delta " * 60_000 + base
    rows = [(4, base), (2, near), (9, base.upper()), (1, None), (3, ""), (None, " \t\n"), (5, "one"), (6, "One  two"), (7, "one two three"), (7, "one two three"), (None, "é è ñ 漢字 ß"), (None, "é è ñ 漢字 ß"), (8, "a\x00b c"), (10, long), (11, base.replace("word300", "x\x85y"))]
    compare(spark, rows)
    assert simhash.near_duplicates(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("small", [1, 512])
def test_links_of_dense_families(spark, small):
    """Families whose members differ in few bits, chains among them, and far members; every bucket is split where small = 1."""
    rng = random.Random(3)
    fps = set()
    for _ in range(4):
        centre, weak = rng.getrandbits(64), rng.sample(range(64), 14)
        for _ in range(80):
            fps.add(centre ^ sum(1 << b for b in rng.sample(weak, rng.randint(0, 6))))
    for _ in range(20):
        at = rng.getrandbits(64)
        for _ in range(5):
            fps.add(at)
            at ^= sum(1 << b for b in rng.sample(range(64), rng.choice((2, 3, 4))))
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    found = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), small=small).collect()
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for r in found:
        a, b = sorted((root(r.a % 2**64), root(r.b % 2**64)))
        label[b] = a
    assert [root(f) for f in fps] == [fps[c] for c in brute_components(fps)]


def test_a_large_group_gives_no_more_links_than_members(spark):
    fps = [(sum(1 << b for b in range(16) if i >> b & 1),) for i in range(3000)]
    found = simhash.links(spark.createDataFrame(fps, "fp long"), small=64)
    assert found.count() < 16 * 15 * len(fps)
    assert simhash.connected(spark, found).select("label").distinct().count() == 1


def test_fixture(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in simhash.query(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got, key=str) == brute(rows)
