import random

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from trackweave.llm import edit_counts as e

PATH = P.path(e.VOCABULARY)


@pytest.fixture(scope="module")
def counter():
    return e.counter(open(PATH, "rb").read(), P.PATTERN)


def test_random_edits_equal_counting_anew(counter):
    rng = random.Random(3)
    parts = ["ab", " ", "  ", "\n", "it's", "'", "ll", "12", "!?", "é", "日本", "\t", "x", ",", " the", "'re"]
    text = lambda n: "".join(rng.choice(parts) for _ in range(n))
    for k in range(700):
        tree = e.CountTree(text(rng.choice([0, 1, 5, 40, 400])), counter)
        for _ in range(6):
            a = rng.randint(-2, len(tree.text) + 2)
            expected = tree.text
            b = a + rng.choice([0, 0, 1, 3, 50])
            put = text(rng.choice([0, 1, 2, 8]))
            lo = min(max(a, 0), len(expected))
            hi = min(max(b, lo), len(expected))
            expected = expected[:lo] + put + expected[hi:]
            tree.edit(a, b, put)
            assert tree.text == expected
            assert tree.count == len(counter.encoding.encode_ordinary(expected)), (k, expected)
            assert [p for leaf in tree.leaves for p in leaf] == [(len(w), counter(w)) for w in counter.pattern.findall(expected)]


def test_few_words_are_encoded_again(counter):
    tree = e.CountTree("some words here, and more. " * 2000, counter)
    tree.edit(20_000, 20_005, "new words")
    assert tree.encoded < 10
    tree.edit(5, 6, "big " * 5000)
    assert tree.count == len(counter.encoding.encode_ordinary(tree.text))


def test_table(spark):
    df = spark.createDataFrame([(1, None, 1), (None, "hello big world", 2), (2, "x", 3), (2, "x", 3), (3, " " * 40 + "a" * 500, 4)], "doc_id long, text string, n_tokens int")
    rows = e.count_edits(df, e.sample_edits(F.col("text")), PATH, P.PATTERN).collect()
    assert len(rows) == 5
    none = e.count_edits(df, F.lit(None), PATH, P.PATTERN).collect()
    assert all(r.n_tokens == r.n_tokens_edited and r.n_reencoded == 0 for r in none)
    assert e.count_edits(df.limit(0), e.sample_edits(F.col("text")), PATH, P.PATTERN).count() == 0


def test_query_on_the_fixture_against_counting_anew(spark, counter):
    rows = {r.doc_id: r for r in e.query(spark, "/root/testdata/sf0.001").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for k, text in texts.items():
        n, out = len(text), text
        for a, b, put in ((n / 4, n / 4 + 7, ""), (n / 2, n / 2, text[:20]), (n * 0.9, n * 0.9 + 3, " 2x,\n")):
            a, b = min(int(a), len(out)), min(int(b), len(out))
            out = out[:a] + put + out[b:]
        assert rows[k].n_tokens == len(counter.encoding.encode_ordinary(text))
        assert rows[k].n_tokens_edited == len(counter.encoding.encode_ordinary(out))
