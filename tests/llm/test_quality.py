import numpy as np

from trackweave.llm import quality as q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    seen, unseen = labels.filter("doc_id % 3 <> 0"), labels.filter("doc_id % 3 = 0")
    rows = q.score(docs, q.train(docs, seen)).join(unseen, "doc_id").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.keep for r in good) >= 0.98 * len(good)
    assert sum(not r.keep for r in bad) >= 0.9 * len(bad)


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    y = (rng.random(6000) < 0.5).astype(float)
    views = [np.column_stack([y[:, None] * 2 + rng.normal(size=(6000, 1)), rng.normal(size=(6000, 5))]) for _ in range(2)]
    known = slice(0, 120)
    model = q.co_train(tuple(v[known] for v in views), y[known], tuple(v[3000:] for v in views), sure=0.9)
    alone = q.co_train(tuple(v[known] for v in views), y[known], tuple(v[:0] for v in views))
    right = lambda m: ((m.score(views[0][120:3000], views[1][120:3000])[2] > 0.5) == (y[120:3000] == 1)).mean()
    assert right(model) >= right(alone) - 0.005 and right(model) > 0.88


def test_nulls_ties_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, None, None, None, 0.5), (None, "x", "en", "s", 1, 0.1), (1, None, None, None, None, 0.5)], "doc_id long, text string, lang string, source string, n_chars long, p_quality double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None)], "doc_id long, quality int")
    assert q.train(docs, labels) is None
    assert [r.keep for r in q.score(docs, None).collect()] == [True] * 3
    assert q.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int")) is None
    some = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = q.train(some, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    rows = q.score(docs, model).collect()
    assert len(rows) == 3 and all(0 <= r.p_quality <= 1 for r in rows)
    assert q.keep_good(docs, model).schema == docs.schema
    assert q.score(docs.limit(0), model).count() == 0 and q.keep_good(docs.limit(0), model).count() == 0


def test_all_unlabelled_documents_teach(spark):
    rng = np.random.default_rng(3)
    y = rng.random(27_000) < 0.5
    texts = [" ".join(rng.choice(["good", "words", "here", "and", "there"] if g else ["BAD", "|||", "###", "99", "x"], 12)) for g in y]
    docs = spark.createDataFrame([(k, t, "en", f"s{int(g) * 3 + k % 3}" if k % 5 else "mixed", len(t)) for k, (t, g) in enumerate(zip(texts, y.tolist(), strict=True))], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, int(y[k])) for k in range(4000)], "doc_id long, quality int")
    model = q.train(docs, labels)
    rows = sorted(docs.collect())
    x = (q.text_features([r.text for r in rows]), q.metadata_features(q.metadata_codes([r.lang for r in rows], [r.source for r in rows], [r.n_chars for r in rows])))
    first = sorted(range(4000), key=lambda k: (q.zlib.crc32(str(k).encode()), k))
    whole = q.co_train(tuple(v[first] for v in x), y[first].astype(float), tuple(v[4000:] for v in x))
    for a, b in zip(model.views, whole.views, strict=True):
        np.testing.assert_allclose(a.model.weights, b.model.weights, atol=1e-5)
    told = q.given_labels([whole.views], q.SURE, tuple(v[4000:] for v in x))
    assert (~np.isnan(told[1])).sum() > 20_000
