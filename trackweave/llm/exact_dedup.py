"""Exact dedup by content sort (native: DataFrame functions only).

Rows are range-partitioned on the leading bytes of the normalised text (Spark samples the splitters),
sorted externally on the whole text, and each row is compared with its neighbour in full: the window
below starts a new group where the complete texts differ, so no digest decides what is adjacent and equal.

Scale
* One shuffle of the text.  The sampled splitter keys are 48 characters, a 64-bit hash and a salt, so what the
  driver receives while sampling is bounded whatever the texts' length.
* All rows go through the same sort.  A text held by more than `group_rows` rows (more, if over 65,536 times that many
  rows are given) is salted by id, rows without one by their place, so that ranges may cut its rows into several runs and no task gets them all.
  There are at most 65,536 such texts; each of their runs gives its largest id, its number and its length, these are added up by
  full text, and come back to the rows as a table of at most 65,536 rows of fixed width.

Defined cases: a null text is empty, and all empty texts are one group.  A null id sorts below every id.
Of repeated rows (same id, same text) exactly one is kept; they are one run.  A very long text is one row, compared in
full.  An empty table gives an empty result.  Extra columns, whatever their names, are ignored by `exact_dedup` and
returned untouched by `keep_largest`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GROUP_ROWS, MOST_HOT = 4096, 65_536


def normalise(text: Column) -> Column:
    """Lower-cases A-Z only; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def _runs(rows: DataFrame, group_rows: int) -> tuple[DataFrame, DataFrame]:
    """`rows` (key, norm, ...) in content order with what their run holds (seg_keep, seg_size, place) and `salts`, null for
    texts in one run; and (text_sha256, keep, size) of the texts in several."""
    rows = rows.withColumn("h", F.xxhash64("norm"))
    least = max(group_rows, rows.count() // MOST_HOT)
    hot = rows.groupBy("h").count().filter(F.col("count") > least).select("h", F.ceil(F.col("count") / least).alias("salts"))
    rows = rows.join(F.broadcast(hot), "h", "left")
    # by id, so that the run with the largest id is the same whenever this is computed; rows without one by their place
    salt = F.when(F.col("key").isNotNull(), F.pmod(F.xxhash64("key"), "salts")).otherwise(F.pmod(F.monotonically_increasing_id(), "salts"))
    rows = rows.withColumn("salt", F.coalesce(salt, F.lit(0)))
    by_text = ["prefix", "h", "salt", "salts", "norm"]
    latest = F.col("key").desc_nulls_last()
    run = Window.partitionBy(*by_text).orderBy(latest)
    every = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sort = rows.withColumn("prefix", F.substring("norm", 1, 48)).repartitionByRange("prefix", "h", "salt").sortWithinPartitions(*by_text, latest)
    runs = sort.withColumn("seg_keep", F.first("key").over(every)).withColumn("seg_size", F.count(F.lit(1)).over(every)).withColumn("place", F.row_number().over(run)).withColumn("text_sha256", F.sha2("norm", 256))
    heads = runs.filter("salts is not null and place = 1").groupBy("norm").agg(F.max(F.struct("seg_keep", (-F.col("salt")).alias("first"))).alias("b"), F.sum("seg_size").alias("size"))
    return runs, heads.select(F.sha2("norm", 256).alias("text_sha256"), F.col("b.seg_keep").alias("keep"), (-F.col("b.first")).alias("keep_salt"), "size")


def _chosen() -> Column:
    """Whether a run has the row that stays: a text in one run, or the run that was chosen among several."""
    return F.col("salts").isNull() | (F.col("salt") == F.col("keep_salt"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.  The largest id of equal texts is kept."""
    runs, heads = _runs(documents(docs, id_col, text_col).select(F.col("doc_id").alias("key"), normalise(F.col("text")).alias("norm")), group_rows)
    runs = runs.select("key", "seg_keep", "seg_size", "place", "salt", "salts", "text_sha256").join(F.broadcast(heads), "text_sha256", "left")
    keep = F.when(F.col("salts").isNull(), F.col("seg_keep")).otherwise(F.col("keep"))
    kept = (F.col("place") == 1) & _chosen()
    return runs.select(F.col("key").alias("doc_id"), keep.alias("keep_id"), F.coalesce("size", "seg_size").alias("group_size"), kept.alias("kept"), "text_sha256")


def keep_largest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """The rows that `exact_dedup` keeps, all columns unchanged: they travel with the one shuffle of the text."""
    norm = normalise(F.coalesce(F.col(text_col), F.lit("")))
    runs, heads = _runs(docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("key"), norm.alias("norm")), group_rows)
    kept = runs.filter("place = 1").select("row", "salt", "salts", "text_sha256").join(F.broadcast(heads), "text_sha256", "left")
    return kept.filter(_chosen()).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE_SQL = f"""
with n as (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') norm from documents)
select doc_id, max(doc_id) over g keep_id, count(*) over g group_size, doc_id = max(doc_id) over g kept, sha256(norm) text_sha256
from n window g as (partition by norm)
"""
