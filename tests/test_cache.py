"""Cached results: computed once, and again only where the rows changed."""

from pyspark.sql import functions as F

from trackweave.operators import cache


def test_only_what_changed_is_computed(spark, tmp_path):
    path, asked = str(tmp_path / "cache"), []

    def totals(rows):
        asked.append({(r.clip_id, r.chunk) for r in rows.select("clip_id", "chunk").distinct().collect()})
        return rows.groupBy("clip_id", "chunk").agg(F.sum("x").alias("total"))

    def run(rows):
        df = spark.createDataFrame(rows, "clip_id string, chunk int, x long").repartition(3)
        return {(r.clip_id, r.chunk): r.total for r in cache.cached(df, ["clip_id", "chunk"], totals, path).collect()}

    rows = [("007", 0, 1), ("007", 0, 2), ("007", 1, 5), ("b", 0, 7)]
    want = {("007", 0): 3, ("007", 1): 5, ("b", 0): 7}
    assert run(rows) == want and asked == [{("007", 0), ("007", 1), ("b", 0)}]
    assert run(rows[::-1]) == want and len(asked) == 1  # the same rows in another order
    assert run([("007", 0, 1), ("007", 0, 3), *rows[2:]]) == want | {("007", 0): 4} and asked[1:] == [{("007", 0)}]
    assert run([*rows[2:], ("c", 0, 1)]) == {("007", 1): 5, ("b", 0): 7, ("c", 0): 1} and asked[2:] == [{("c", 0)}]
    assert run([*rows[2:], rows[3]]) == {("007", 1): 5, ("b", 0): 14} and asked[3:] == [{("b", 0)}]  # a row more, though equal
    assert run(rows) == want and asked[4:] == [{("007", 0), ("b", 0)}]


def test_content_of_groups(spark):
    rows = [(1, "a", None), (1, "b", 2.0), (2, "b", 2.0), (2, "a", None), (3, "a", 2.0), (3, "b", None), (4, "a", None)]
    df = spark.createDataFrame(rows, "k int, s string, x double")
    of = {r.k: r.content for r in cache.content_hash(df, ["k"]).collect()}
    assert of[1] == of[2] and len({of[1], of[3], of[4]}) == 3
