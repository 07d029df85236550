import random

import numpy as np
import pytest

from trackweave.llm import near_join as nj


def brute(texts, threshold=0.8):
    """(class number, links, copies) of each text."""
    sets = []
    for t in texts:
        w = [x for x in (t or "").encode().split()]
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    kinds = list(dict.fromkeys(sets))
    label = list(range(len(kinds)))
    links = [0] * len(kinds)

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(kinds):
        for j in range(i):
            b = kinds[j]
            if a and b and len(a & b) / len(a | b) >= threshold:
                links[i] += 1
                links[j] += 1
                label[root(i)] = root(j)
    at = {s: k for k, s in enumerate(kinds)}
    return [(root(at[s]), links[at[s]], sets.count(s) - 1) for s in sets]


def compare(spark, ids, texts, **kw):
    df = spark.createDataFrame(list(zip(ids, texts, [7] * len(ids))), "doc_id long, text string, class_id int")
    got = {}
    for r in nj.near_classes(spark, df, **kw).collect():
        got.setdefault(r.doc_id, []).append((r.class_id, r.n_links, r.n_copies))
    want, least = brute(texts), {}
    for d, (c, _, _) in zip(ids, want):
        if d is not None:
            least[c] = min(d, least.get(c, d))
    expected = {}
    for d, (c, n, m) in zip(ids, want):
        expected.setdefault(d, []).append((least.get(c), n, m))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in expected.items()}


def family(rng, size, n, edits):
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(n)] = f"x{rng.randint(0, 10**6)}"
        out.append(" ".join(w))
    return out


def test_families_copies_and_edges(spark):
    rng = random.Random(2)
    texts = [None, "", "one", "one", "a b c d", "a b c d e", "a b c d e", "  a b c d e ", "x " * 300]
    for _ in range(12):
        texts += family(rng, 6, rng.choice([30, 120, 700]), 3)
    texts += family(rng, 90, 100, 2)
    compare(spark, list(range(len(texts))), texts)


def test_large_buckets_are_split_and_compared_in_blocks(spark):
    rng = random.Random(4)
    texts = family(rng, 60, 90, 2) + family(rng, 5, 60, 1)
    compare(spark, list(range(len(texts))), texts, small=4, block=8)


def test_null_and_repeated_ids_and_empty_table(spark):
    compare(spark, [1, 1, None, None, 5], ["a b c d e f", "a b c d e f", "q r s t u", "a b c d e f", ""])
    df = spark.createDataFrame([], "doc_id long, text string")
    assert nj.near_classes(spark, df).count() == 0


def test_fixture_against_all_pairs(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    compare(spark, [r.doc_id for r in rows], [r.text for r in rows])


def test_sketch_bits_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 900), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.8], rng.integers(0, 2**63, rng.integers(1, 300), dtype=np.uint64)]))
        h = nj._hamming(nj.parity_sketch(a)[None, :], nj.parity_sketch(b)[None, :])[0, 0]
        assert h <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_recall_of_pairs_at_the_threshold(depth):
    """Pairs of similarity exactly 0.8 meet at every level as often as the target recall and `meeting` say."""
    rng = np.random.default_rng(depth)
    runs, met, once, total = nj.runs_for(), 0, 0, 300
    for _ in range(total):
        common = rng.integers(0, 2**63, 400, dtype=np.uint64)
        paths = [nj._SEEDS[:runs], nj._SEEDS[:runs]]
        sets = [np.unique(np.concatenate([common, rng.integers(0, 2**63, 50, dtype=np.uint64)])) for _ in range(2)]
        for _ in range(depth):
            paths = [nj.chosen(x, p, 0.8) for x, p in zip(sets, paths)]
        met += bool(len(np.intersect1d(*paths)))
        paths = [nj._SEEDS[:1], nj._SEEDS[:1]]
        for _ in range(depth):
            paths = [nj.chosen(x, p, 0.8) for x, p in zip(sets, paths)]
        once += bool(len(np.intersect1d(*paths)))
    assert met >= 0.99 * total and once / total >= nj.meeting(depth) - 0.08


def test_runs_follow_the_target_recall():
    assert 0.63 < nj.meeting(1) < 0.64 and 0.37 < nj.meeting(3) < 0.38
    for recall in (0.9, 0.99, 0.999):
        for depth in (1, 2, 3):
            runs = nj.runs_for(recall, depth)
            assert 1 - (1 - nj.meeting(depth)) ** runs >= recall > 1 - (1 - nj.meeting(depth)) ** (runs - 1)


def test_every_bucket_split_to_the_last_level(spark):
    rng = random.Random(6)
    texts = [t for _ in range(10) for t in family(rng, 4, rng.choice([40, 150]), 2)]
    compare(spark, list(range(len(texts))), texts, small=1)


def test_words_that_polynomials_confuse(spark):
    one = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    texts = [f"{w} p q r s" for w in (one, one.translate(str.maketrans("ab", "ba")))]
    compare(spark, [1, 2], texts)


def test_very_long_text_and_many_repeats_of_one_row(spark):
    rng = random.Random(5)
    long = [f"w{rng.randint(0, 10**6)}" for _ in range(150_000)]
    texts = [" ".join(long), " ".join([*long[:-3], "x", "y"]), *["same five words in here"] * 300]
    compare(spark, [1, 2, *[3] * 300], texts)


def test_keep_one_with_null_and_repeated_ids_and_clashing_columns(spark):
    text = lambda k, change="": " ".join(f"t{k}w{i}" for i in range(100)).replace(f"t{k}w50", change or f"t{k}w50")
    rows = [(7, text(1)), (3, text(1, "x")), (None, text(1, "y")), (None, text(2)), (None, text(2, "x")), (5, text(3)), (5, text(3)), (5, text(4)), (None, text(5)), (9, None), (8, "")]
    docs = spark.createDataFrame([(i, t, 1, 2, "a") for i, t in rows], "doc_id long, text string, kept_id int, row_0 int, class_id string")
    kept = nj.keep_one(spark, docs)
    assert kept.schema == docs.schema
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert [i for i, t in got if t and "t1w" in t] == [3]
    assert len([1 for i, t in got if t and "t2w" in t]) == 1 and len([1 for i, t in got if t and "t3w" in t]) == 1
    assert (5, text(4)) in got and (None, text(5)) in got and [i for i, t in got if not t] == [8]
    assert len(got) == 6


def test_rows_without_ids_are_not_joined_with_each_other(spark):
    """Ids that are null or the same do not make rows meet: what is read again grows with the rows."""
    for ids in ([None] * 300, [4] * 300):
        docs = spark.createDataFrame([(i, " ".join(f"w{k // 2}x{j}" for j in range(60)) + f" end{k}") for k, i in enumerate(ids)], "doc_id long, text string")
        rows = nj.near_classes(spark, docs, small=2, depth=2).collect()
        assert len(rows) == 300 and all(r.n_links == 1 for r in rows)
