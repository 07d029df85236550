"""What the corpus operators share: reading tables, shared scratch tables, sizing by bytes."""

from __future__ import annotations

import ctypes
import gc
import math
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: a word is a run of anything but these ASCII white-space bytes.
WORD = r"[^\x20\x09-\x0D]+"
#: The same for DuckDB's regular expressions.
WORD_SQL = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; where it is unset and all runs on one machine (tests),
    a new local one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-shared-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(spark: SparkSession, df: DataFrame, name: str, *by: str) -> DataFrame:
    """`df` as a table written once to the shared folder, in folders by the columns `by`: later jobs read files and do not
    repeat the work."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def drop(df: DataFrame) -> None:
    """Deletes a table that `written` made, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def give_back() -> None:
    """At a task's end in a Python worker, which later tasks reuse: free memory goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps its free memory
        pass


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id long, text string); a null text counts as empty; other columns are not read."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def groups_for(df: DataFrame, text_col: str, group_mb: float) -> int:
    """How many hash groups of about `group_mb` of text `df` makes; one pass over the text's lengths."""
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(1, math.ceil(size / (group_mb * 1e6)))
