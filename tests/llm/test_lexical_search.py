import math
import random
import re

import pytest

from tests.compare import connect, rows
from trackweave.llm import lexical_search as ls

SF = "/root/testdata/sf0.001"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(ls.TERM, low)


def brute(docs, items, top=10):
    """Every document against every item, one at a time."""
    bags = [(d, terms(t)) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, words = len(bags), sum(len(b) for _, b in bags)
    out = []
    for item_id, text in sorted(set(items), key=str):
        scored = []
        for d, b in bags:
            m = 100 - 75 + (75 * len(b) * n_docs) // words
            score = 0
            for t in terms(text):
                df = sum(t in set(x) for _, x in bags)
                tf = b.count(t)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item_id, k, x[3], -x[0]) for k, x in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=str)


def compare(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 5, "x") for i, t in docs], "doc_id long, text string, score int, item_id string")
    i = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, rank int")
    got = [tuple(r) for r in ls.search(spark, d, i, **kw).collect()]
    assert sorted(got, key=str) == brute(docs, items, kw.get("top", 10))


def test_terms():
    for text in ("Ab-c9_d[e]`f{g}~\x7fh\x80i\x00j", "É ÀB ſ K 漢字。x", "", "\x85a b", "0/9:A@Z"):
        assert ls.term_counts(text.encode()) == {t.encode(): terms(text).count(t) for t in terms(text)}


def test_cases(spark):
    docs = [(5, "red green blue"), (3, "Red GREEN blue"), (9, "blue green red"), (None, "red green blue"), (None, None), (4, ""), (6, "!!! ..."), (7, "red " * 50), (7, "red " * 50), (8, "É漢 red"), (2, "nothing here"), (10, "green " * 200_000 + "blue"), (1, "blue,blue;green")]
    items = [(1, "red"), (1, "red"), (1, "blue red red"), (2, None), (3, ""), (4, "unknown"), (5, "É漢 green"), (None, "nothing nothing"), (6, "green-Blue")]
    compare(spark, docs, items)
    compare(spark, docs, items, top=2)
    compare(spark, docs, items, items_mb=0.00006)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, item_id long, text string")
    some = spark.createDataFrame([(1, 1, "a b")], "doc_id long, item_id long, text string")
    for d, i in ((none, none), (some, none), (none, some)):
        r = ls.search(spark, d, i)
        assert r.count() == 0 and r.columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize(("words", "docs"), [(3, 150), (12, 200), (60, 120)])
def test_many_equal_bags(spark, monkeypatch, words, docs):
    """Few words make large classes, many ties and long lists; small limits make every task cut its lists often."""
    monkeypatch.setattr(ls, "_POSTINGS", 40)
    monkeypatch.setattr(ls, "_HELD", 10)
    rng = random.Random(words)
    text = lambda most: " ".join(f"w{rng.randint(0, words)}" for _ in range(rng.randint(0, most)))
    compare(spark, [(rng.randint(0, 400), text(6)) for _ in range(docs)], [(k, text(5)) for k in range(12)], items_mb=0.0003)


def test_against_sql(spark):
    assert rows(ls.query(spark, SF).toArrow()) == rows(connect(SF).sql(ls.ORACLE_SQL).to_arrow_table())


def test_a_class_brings_few_rows_to_the_shuffle(spark):
    plan = ls.classes(spark.createDataFrame([], "doc_id long, n long, vec binary, m long"), 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
