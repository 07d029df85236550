"""Interval joins with an equality to hash on: intervals are dealt out to buckets of frames, and a pair that meets in
several buckets counts in the one where the later of the two begins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], left_span: tuple[str, str], right_span: tuple[str, str], width: int = 64) -> DataFrame:
    """Pairs whose inclusive intervals meet, with equal `keys`; other columns must differ in name."""
    deal = lambda df, a, b: df.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width))))
    (a1, a2), (b1, b2) = left_span, right_span
    joined = deal(left, a1, a2).join(deal(right, b1, b2), [*keys, "_bucket"])
    owner = F.floor(F.greatest(a1, b1) / width)
    return joined.filter((F.col(a1) <= F.col(b2)) & (F.col(b1) <= F.col(a2)) & (F.col("_bucket") == owner)).drop("_bucket")


def lookup(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, span: tuple[str, str], order: list[str], width: int = 64) -> DataFrame:
    """Each point with the first interval (by `order`) that holds it, or nulls; points carry a unique `_point` for that."""
    from pyspark.sql import Window

    first, last = span
    dealt = intervals.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(first) / width), F.floor(F.col(last) / width))))
    p = points.withColumn("_bucket", F.floor(F.col(at) / width))
    on = [p[k] == dealt[k] for k in [*keys, "_bucket"]] + [F.col(at).between(F.col(first), F.col(last))]
    extra = [c for c in intervals.columns if c not in keys]
    joined = p.join(dealt, on, "left").select(*[p[c] for c in points.columns], *[dealt[c] for c in extra])
    w = Window.partitionBy(*[F.col(c) for c in points.columns]).orderBy(*order)
    return joined.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")
