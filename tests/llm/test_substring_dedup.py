import hashlib
import random

import pytest

from trackweave.llm import substring_dedup as sd


def brute(rows, w=13):
    """(id, n_words, n_removed, digest) of each (id, text), by a dictionary of all windows."""
    low = lambda d: (d is not None, d or 0)
    first = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, words in split:
        for i in range(len(words) - w + 1):
            k = tuple(words[i : i + w])
            first[k] = min(first.get(k, low(d)), low(d))
    out = []
    for d, words in split:
        gone = set()
        for i in range(len(words) - w + 1):
            if first[tuple(words[i : i + w])] < low(d):
                gone.update(range(i, i + w))
        kept = b" ".join(x for i, x in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def compare(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, g int")
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in sd.remove_repeats(df, **kw).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_cases(spark):
    run = "a " * 40
    base = " ".join(f"w{i}" for i in range(60))
    compare(spark, [(5, base), (3, " ".join(f"w{i}" for i in range(20, 33))), (1, None), (2, ""), (7, "x " + run), (8, run + "y " + run), (9, "a " * 13), (10, "b " + "a " * 12), (11, "b " + "a " * 20), (None, base), (12, base), (12, base), (13, " ".join(f"w{i}" for i in range(48, 60))), (14, "é " * 30)], group_mb=0.0002)


def test_random_repeats_of_few_words(spark):
    rng = random.Random(7)
    for words in (2, 3, 30):
        rows, pool = [], [" ".join(f"v{rng.randint(0, words)}" for _ in range(rng.randint(1, 50))) for _ in range(25)]
        for d in range(80):
            rows.append((rng.randint(0, 70), " ".join(rng.choice(pool) if rng.random() < 0.5 else f"u{rng.randint(0, 40)}" for _ in range(rng.randint(0, 9)))))
        compare(spark, rows, group_mb=0.001)


@pytest.mark.parametrize("group_mb", [0.3, 100])
def test_fixture_against_all_windows(spark, group_mb):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    compare(spark, rows, group_mb=group_mb)


def test_empty_table_and_kept_text(spark):
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    r = sd.remove_repeats(spark.createDataFrame([(1, " a  b\n")], "doc_id long, text string"), keep_text=True).collect()
    assert r[0].kept == "a b"
    with pytest.raises(ValueError):
        sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), window=12)


def thue_morse(bits):
    """A word of 2**bits letters a and b, and the same with a and b exchanged: polynomial hashes modulo 2**64 cannot tell them apart."""
    one = "".join("ab"[i.bit_count() % 2] for i in range(1 << bits))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_words_that_polynomials_confuse(spark):
    ends = [" ".join(f"{side}{i}" for i in range(6)) for side in "lr"]
    for bits in (3, 5, 10):
        compare(spark, [(k, f"{ends[0]} {word} {ends[1]}") for k, word in enumerate(thue_morse(bits))])


def test_very_long_text(spark):
    rng = random.Random(3)
    long = " ".join(f"w{rng.randint(0, 5000)}" for _ in range(300_000))
    compare(spark, [(1, "x" * 200_000 + " " + long[:2000]), (2, long), (3, long[1000:3000])], group_mb=0.5)


def test_null_ids_and_repeated_rows(spark):
    base = " ".join(f"w{i}" for i in range(40))
    compare(spark, [(None, base + f" n{i}") for i in range(50)] + [(4, base)] * 30, group_mb=0.0005)
