"""Results that are kept by the content of what they were made of: a second run computes only what changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def content_hash(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, content): a text that stands for all rows of a group, in any order, repeated rows included.  Sums of two 64-bit hashes
    of each row, so groups are added up before anything is shuffled."""
    others = sorted(c for c in rows.columns if c not in keys)
    wide = lambda *first: F.xxhash64(*first, *others).cast("decimal(38,0)")
    sums = [F.sum(wide(F.lit(seed))).cast("string") for seed in ("a", "b")]
    return rows.groupBy(*keys).agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums).alias("content"))


def _table(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame | None:
    """A table in folders by keys, whose types are those of `keys` whatever their folders look like."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(hadoop)
    if not found:
        return None
    out = spark.read.parquet(path)
    return out.withColumns({c: F.col(c).cast(t) for c, t in keys.dtypes})


def cached(rows: DataFrame, keys: list[str], compute: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """`compute(rows)`, from the folder `path` where a group of equal `keys` has been computed from equal rows before.

    `compute` must work on each group by itself and keep the keys as columns.  Results lie in one folder for each group, and
    only those of groups that are new or changed are computed and replaced.  A group counts as done once its
    result is written, so a run that is broken off is only repeated for what it had not finished."""
    spark = rows.sparkSession
    now = content_hash(rows, keys)
    done = _table(spark, f"{path}/done", rows.select(*keys))
    missing = now if done is None else now.join(done, [*keys, "content"], "left_anti")
    todo = missing.select(*keys, "content")
    if not todo.isEmpty():
        made = compute(rows.join(todo.select(*keys), keys, "left_semi")).join(todo, keys)
        into = lambda df, name: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(f"{path}/{name}")
        into(made, "results")
        into(todo, "done")
    results = _table(spark, f"{path}/results", rows.select(*keys))
    return results.join(now, [*keys, "content"], "left_semi").drop("content")
