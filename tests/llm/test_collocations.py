import random
import re
from collections import Counter

import pytest

from tests.compare import connect, rows
from trackweave.llm import collocations as co

SF = "/root/testdata/sf0.001"


def brute(docs, least, most=5, top=2000, within=100):
    """All phrases counted in one pass over everything."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, most + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        longer = [b for (other, q), b in f.items() if other == lang and b >= least and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if any(100 * b >= within * a for b in longer):
            continue
        cuts = [((1000 * a * n[lang]) // (f[lang, p[:c]] * f[lang, p[c:]]), c) for c in range(1, len(p))]
        score, c = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:c]], f[lang, p[c:]]))
    return sorted((lang, k, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items() for k, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1))


def compare(spark, docs, least, top=2000, within=100, **kw):
    df = spark.createDataFrame([(k, lang, text, "x", 3) for k, (lang, text) in enumerate(docs)], "doc_id long, lang string, text string, phrase string, rank int")
    got = [tuple(r) for r in co.collocations(df.repartition(3), least, top=top, within=within, **kw).collect()]
    assert sorted(got) == brute(docs, least, kw.get("most", 5), top, within)
    return got


def test_cases(spark):
    docs = [("en", "New York City, new york city. NEW\tYORK city!"), ("en", "new\nyork"), (None, "a b c"), ("und", "a  b c; a b"), ("en", None), ("en", ""), ("fr", "é è é è é"), ("fr", "É è"), ("en", "a a a a a a a"), ("en", "x\x00y z x\x00y z"), ("en", "?!.,"), ("en", "new york city"), ("en", "new york city"), ("de", "solo")]
    assert compare(spark, docs, 2)
    compare(spark, docs, 2, top=2)
    compare(spark, docs, 1, shards=1)
    compare(spark, docs, 2, most=3, within=60, shards=2)
    assert co.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


@pytest.mark.parametrize(("shards", "slots"), [(1, 1 << 16), (3, 1 << 16), (4, 256), (7, 1 << 16)])
def test_random_texts(spark, shards, slots):
    """However the text is dealt out and however often phrases share slots, all counts are whole."""
    rng = random.Random(shards)
    docs = []
    for _ in range(120):
        run = []
        for _ in range(rng.randint(0, 8)):
            run.append(rng.choice(["tick tack toe", "one two three four five six", "tick tack", f"w{rng.randint(0, 30)}", "two three", "a"]) + rng.choice([" ", ", ", " ", " "]))
        docs.append((rng.choice(["en", "de", None]), "".join(run)))
    compare(spark, docs, 6, shards=shards, slots=slots)


def test_blocks_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(co, "CHUNK", 40)
    rng = random.Random(5)
    docs = [("en", " ".join(rng.choice(["alpha", "beta", "gamma,", "delta", "x" * 90]) for _ in range(600))), ("en", "alpha beta gamma " * 40)]
    counted = Counter()
    import numpy as np

    for _, text in docs:
        reached = np.zeros(1 << 16, np.uint8)
        for counts, _, n in co._Scan("en", 1, 2, 5, reached, {2, 3, 4, 5}).rows([text.encode()]):
            counted.update(counts)
            counted[b""] += n
    want = Counter()
    for _, text in docs:
        for piece in text.split(","):
            words = piece.split()
            want[b""] += len(words)
            for k in range(1, 6):
                want.update(" ".join(words[i : i + k]).encode() for i in range(len(words) - k + 1))
    assert counted == want


def test_a_very_long_text(spark):
    compare(spark, [("en", "the quick brown fox jumps " * 200_000), ("en", "the quick")], 1000)


def test_against_sql(spark):
    assert rows(co.query(spark, SF).toArrow()) == rows(connect(SF).sql(co.ORACLE_SQL).to_arrow_table())
