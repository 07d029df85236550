import base64
import hashlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import tiktoken

import corpus_pipeline as cp
from tests.llm.test_near_join import brute
from trackweave.llm import source_mix

SF = "/root/testdata/sf0.01"


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = spark.createDataFrame(docs.toPandas().pipe(lambda _: cp.classify(spark, docs, SF).toPandas()), docs.schema)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r["doc_id"] for r in rows(kept)}
    good = [k for k, q in labels.items() if q == 1]
    bad = [k for k, q in labels.items() if q == 0]
    assert sum(k in left for k in good) >= 0.98 * len(good) and sum(k not in left for k in bad) >= 0.9 * len(bad)
    before = rows(kept)

    unique = cp.drop_copies(spark, kept, SF)
    low = {}
    for r in before:
        key = r["text"].translate({c: c + 32 for c in range(65, 91)})
        low[key] = max(r["doc_id"], low.get(key, -1))
    after = rows(unique)
    assert unique.schema == docs.schema
    assert {r["doc_id"] for r in after} == set(low.values()) and len(after) == len(low)

    single = spark.createDataFrame(cp.drop_near_copies(spark, unique, SF).toPandas(), docs.schema)
    least = {}
    for r, (c, _, _) in zip(after, brute([r["text"] for r in after])):
        least[c] = min(r["doc_id"], least.get(c, r["doc_id"]))
    after = rows(single)
    assert sorted(r["doc_id"] for r in after) == sorted(least.values())

    mixed = spark.createDataFrame(cp.mix(spark, single, SF).toPandas(), docs.schema)
    given = pa.Table.from_pylist(after)  # noqa: F841
    expected = {d: c for d, c in duckdb.sql(f"select doc_id, copies from ({source_mix.oracle('given')})").fetchall() if c}
    drawn = rows(mixed)
    assert Counter(r["doc_id"] for r in drawn) == expected
    texts = {r["doc_id"]: r["text"] for r in after}
    assert all(texts[r["doc_id"]] == r["text"] for r in drawn)

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = rows(cp.encode(spark, mixed, SF))
    assert len(coded) == len(drawn)
    for r in coded:
        ids = ref.encode_ordinary(texts[r["doc_id"]])
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_run_and_empty_table(spark):
    assert cp.run(spark, "/root/testdata/sf0.001").count() > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
