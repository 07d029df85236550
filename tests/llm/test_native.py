"""Exact dedup, fingerprints, source mix and archive: defined cases, and the registered SQL on the fixture."""

import hashlib
import random

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from trackweave.llm import exact_dedup, fingerprints, source_mix, warc
from trackweave.llm.common import documents

SF = "/root/testdata/sf0.01"


def lower(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


# exact dedup


def brute_copies(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(lower(t), []).append(d)
    out = []
    for t, ids in groups.items():
        keep = max(ids, key=lambda x: (x is not None, x or 0))
        seen = False
        for d in ids:
            out.append((d, keep, len(ids), d == keep and not seen, hashlib.sha256(t.encode()).hexdigest()))
            seen |= d == keep
    return sorted(out, key=str)


def copies(df, **kw):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(df, **kw).collect()), key=str)


def test_copies_cases(spark):
    rows = [(1, "A b"), (2, "a B"), (3, None), (4, ""), (None, "a b"), (5, "É"), (6, "é"), (7, "x"), (7, "x"), (None, "n"), (8, "y" * 5000), (9, "Y" * 5000), (10, "y" * 5000 + "z")]
    df = spark.createDataFrame([(d, t, True) for d, t in rows], "doc_id long, text string, kept boolean")
    assert copies(df) == brute_copies(rows)
    kept = exact_dedup.keep_largest(df)
    assert kept.schema == df.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(x[0]) for x in brute_copies(rows) if x[3])
    assert copies(df.limit(0)) == [] and exact_dedup.keep_largest(df.limit(0)).count() == 0


def test_hot_text_is_cut_into_runs(spark):
    rows = [(k, "Hot" if k % 3 else "hot") for k in range(3000)] + [(2999, "hot"), (5000, "cold"), (5001, "COLD")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert copies(df, group_rows=200) == brute_copies(rows)
    assert sorted(r.doc_id for r in exact_dedup.keep_largest(df, group_rows=200).collect()) == [2999, 5001]


def test_hot_text_without_ids_is_cut_into_runs(spark):
    rows = [(None, "Hot" if k % 3 else "hot") for k in range(3000)] + [(7, "cold")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = exact_dedup.exact_dedup(df, group_rows=200)
    assert [(r.keep_id, r.group_size) for r in got.filter("kept").orderBy("group_size").collect()] == [(7, 1), (None, 3000)]
    assert got.count() == 3001 and sorted(str(r.doc_id) for r in exact_dedup.keep_largest(df, group_rows=200).collect()) == ["7", "None"]
    runs, _ = exact_dedup._runs(df.select(df.doc_id.alias("key"), exact_dedup.normalise(df.text).alias("norm")), 200)
    assert runs.filter("salts is not null").groupBy("salt").count().agg({"count": "max"}).first()[0] < 400


# source mix


def test_targets_fill_up_to_the_cap(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 500), ("c", 0)], "source string, source_size long")
    got = {r.source: r.target for r in source_mix.source_targets(sizes).collect()}
    # weights: a 5, b 2, c 1, null 5; a stops at 30, c at 0, the rest goes 2 : 5
    assert got["a"] == 30 and got["c"] == 0
    assert abs(got["b"] - 1480 * 2 / 7) < 1e-9 and abs(got[None] - 1480 * 5 / 7) < 1e-9


def test_mix_hits_targets_and_repeats_itself(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = source_mix.mix_sources(df).collect()
    by = {}
    for r in rows:
        x = by.setdefault(r.source, [r.target, 0, 0])
        x[1] += r.taken
        x[2] = max(x[2], r.size)
        assert 0 <= r.taken <= 3 * r.size
    assert all(abs(taken - target) <= 2 * largest for target, taken, largest in by.values())
    again = source_mix.mix_sources(df.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mix_of_ids_that_share_a_divisor_is_spread(spark):
    df = spark.range(2000).selectExpr("id * 64 as doc_id", "'a b' as text", "'s' as source")
    rows = source_mix.mix_sources(df).collect()
    assert sum(r.copies for r in rows) == 2000 and len({r.doc_id for r in rows}) == 2000


def test_mix_cases(spark):
    df = spark.createDataFrame([(1, None, None, 1), (2, "a b", "s", 1), (None, "c", "s", 2), (2, "a b", "s", 1), (3, "", "t", 1)], "doc_id long, text string, source string, size int")
    assert source_mix.mix_sources(df).count() == 5
    assert source_mix.draw(df).schema == df.schema
    assert source_mix.mix_sources(df.limit(0)).count() == 0
    assert [r.taken for r in source_mix.mix_sources(df.filter("doc_id = 3")).collect()] == [0]


# fingerprints


def sketch(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.fp for r in fingerprints.add_fingerprint(documents(df), "text", "fp").collect()}


def test_anchors_depend_on_nothing_outside(spark):
    rng = random.Random(1)
    words = [f"w{rng.randint(0, 999)}" for _ in range(60)]
    whole, part, moved = sketch(spark, [" ".join(words), " ".join(words[10:50]), "x y z " + "\n".join(words)]).values()
    inside = {a.hash for a in whole if 10 <= a.pos <= 45}
    assert inside == {a.hash for a in part}
    assert {a.hash for a in whole} <= {a.hash for a in moved}
    assert {a.hash: a.pos + 3 for a in whole}.items() <= {a.hash: a.pos for a in moved}.items()


def test_likeness_and_positions(spark):
    text = " ".join(f"w{i}" for i in range(100))
    df = spark.createDataFrame([(text, text), (text, ""), ("", ""), ("a b", "a b"), ("a b", "a c"), (text, text.replace("w50", "x"))], "a string, b string")
    df = fingerprints.add_fingerprint(fingerprints.add_fingerprint(df, "a", "fa"), "b", "fb")
    rows = df.select(fingerprints.likeness(F.col("fa"), F.col("fb")).alias("x"), fingerprints.matched_positions(F.col("fa"), F.col("fb")).alias("m")).collect()
    assert [r.x for r in rows[:5]] == [1, 0, 1, 1, 0]
    assert 0.8 < rows[5].x < 1 and all(p.a == p.b for p in rows[5].m)


def test_long_texts_keep_all_anchors(spark, tmp_path):
    rng = random.Random(2)
    words = [[f"{k}w{rng.randint(0, 10**9)}" for _ in range(3000)] for k in range(2)]
    words[0][700:760] = words[1][2100:2160] = [f"s{i}" for i in range(60)]  # a passage that both share
    words[0][2000:2100] = words[0][1000:1100]  # anchors that stand twice
    # any k-mer by itself says whether it is an anchor
    short = spark.createDataFrame([(k, " ".join(w[i : i + 5]), i) for k, w in enumerate(words) for i in range(2996)], "d long, text string, i int")
    want = [set(), set()]
    for r in fingerprints.add_fingerprint(short, "text", "fp").collect():
        want[r.d] |= {(a.hash, r.i) for a in r.fp}
    spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(words)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted(fingerprints.query(spark, str(tmp_path)).collect())
    got = [{(int(h, 16) - (int(h, 16) >> 63 << 64), int(p)) for h, p in (x.split(":") for x in r.fingerprint.split())} for r in rows]
    assert got == want and min(map(len, got)) > 1000
    a, b = ({h for h, _ in x} for x in got)
    assert len(a) < len(got[0]) and len(a & b) > 10
    assert all(abs(r.near_next - 2 * len(a & b) / (len(a) + len(b))) < 1e-12 for r in rows)


def test_edited_texts_of_the_query(spark, tmp_path):
    rows = [(5, "one two three four five six"), (1, "é" * 9), (9, None), (9, "tie"), (None, "null first")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in fingerprints.query(spark, str(tmp_path)).collect())
    order = sorted(((d, t or "") for d, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    want = []
    for k, (d, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        want.append((str(d), len(t), hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()))
    assert got == sorted(want)


def test_next_document_across_buckets(spark):
    df = spark.createDataFrame([(k * 7 - 30, f"text {k} " * 50) for k in range(100)], "doc_id long, text string")
    from pyspark.sql import Window

    rows = fingerprints.with_next(documents(df), bucket_mb=0.002)
    rows = rows.withColumn("next", F.lead("text").over(Window.partitionBy("bucket").orderBy("halo", "key", "text"))).filter("not halo").collect()
    assert len(rows) == 100 and len({r.bucket for r in rows}) > 10
    assert all(r.next == f"text {((r.doc_id + 30) // 7 + 1) % 100} " * 50 for r in rows)
    assert fingerprints.with_next(documents(df.limit(0))).count() == 0


# archive


def test_archive_keeps_records_exactly(spark):
    big, small = "x" * 200, "y" * 99
    rows = [(3, "http://a/\r\nX: y", big), (1, None, big), (2, "u", small), (4, "u", small), (5, "u", None), (None, "n", big), (1, "again", big), (6, "ü", "é" * 60)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    records, payloads = warc.write_archive(spark, df)
    assert payloads.count() == 4 and records.count() == len(rows)
    back = warc.read_archive(records, payloads).collect()
    assert all(r.verified for r in back) and len(back) == len(rows)
    kinds = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in back)
    assert kinds == sorted([("3", "revisit", "1"), ("1", "response", "None"), ("1", "response", "None"), ("2", "response", "None"), ("4", "response", "None"), ("5", "response", "None"), ("None", "revisit", "1"), ("6", "response", "None")])
    for r in back:
        head, body = bytes(r.record).split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and head.count(b"\r\n") == 8 + 2 * (r.refers_to is not None)
        assert body == (bytes(r.payload) if r.record_type == "response" else b"") + b"\r\n\r\n"
        assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest
    empty = warc.write_archive(spark, df.limit(0))
    assert warc.read_archive(*empty).count() == 0


def test_line_ends_in_addresses_forge_nothing(spark):
    ends = ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x85", "\u2028", "\u2029"]
    urls = [f"http://a/{end}{line}" for end in ends for line in ("WARC-Payload-Digest: sha256:" + "0" * 64, "WARC-Refers-To: <urn:page:77>", "WARC-Type: revisit", "WARC-Record-ID: <urn:page:5>")]
    df = spark.createDataFrame([(k, u, f"page {k}" * 20) for k, u in enumerate(urls)], "page_id long, url string, html string")
    back = warc.read_archive(*warc.write_archive(spark, df)).collect()
    assert sorted(r.page_id for r in back) == list(range(len(urls)))
    assert all(r.verified and r.refers_to is None and r.record_type == "response" for r in back)
    assert all(len(r.url.splitlines()) == 1 and r.url.startswith("http://a/%") for r in back)


def test_exported_files_are_records_one_after_another(spark, tmp_path):
    df = spark.createDataFrame([(k, f"http://a/{k}", ("é\r\n\r\n" * 30 + str(k % 4)) if k % 5 else None) for k in range(20)], "page_id long, url string, html string")
    records, payloads = warc.write_archive(spark, df)
    want = sorted(bytes(r.record) for r in warc.read_archive(records, payloads).collect())
    warc.export(records, payloads, f"{tmp_path}/out")
    got = []
    for part in tmp_path.glob("out/part-*"):
        data = part.read_bytes()
        while data:
            head, rest = data.split(b"\r\n\r\n", 1)
            size = int(head.rsplit(b"Content-Length: ", 1)[1])
            assert rest[size : size + 4] == b"\r\n\r\n"
            got.append(head + b"\r\n\r\n" + rest[: size + 4])
            data = rest[size + 4 :]
    assert sorted(got) == want and any(b"WARC-Profile: http" in r for r in got)


def test_query_puts_records_together(spark):
    import contextlib
    import io

    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        warc.query(spark, SF).explain(True)
    joins = said.getvalue().split("Optimized Logical Plan")[1].split("Physical Plan")[0]
    assert "payload#" in joins.split("Join Inner")[0] or "concat(header#" in joins.split("Join Inner")[0]


def test_registered_sql_agrees(spark):
    db = duckdb.connect()
    for t in ("documents", "pages"):
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for module in (exact_dedup, source_mix, warc):
        df = module.query(spark, SF)
        want = db.sql(module.ORACLE_SQL).to_arrow_table()
        cols = sorted(df.columns)
        got = df.select(cols).toArrow()
        norm = lambda t: sorted(map(repr, pa.Table.from_arrays([t[c] for c in cols], names=cols).to_pylist()))
        assert norm(got) == norm(want)
