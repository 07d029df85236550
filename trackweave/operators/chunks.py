"""Work on chunks of frames: bounds, halos, ownership, display strides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunk_bounds(clips: DataFrame, k: int) -> DataFrame:
    """Per clip (clip_id, n_frames) k half-open chunks at round(i * n / k), halves to even."""
    edge = lambda i: F.bround(i * F.col("n_frames") / F.lit(float(k)), 0).cast("int")
    return clips.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).select("clip_id", "chunk", edge(F.col("chunk")).alias("start"), edge(F.col("chunk") + 1).alias("stop"))


def schedule(clips: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Overlapping chunks of a sequential run: step = chunk - overlap; the last one ends with the clip."""
    step = chunk - overlap
    n = F.greatest(F.lit(1), F.ceil((F.col("n_frames") - overlap) / F.lit(step)).cast("int"))
    df = clips.withColumn("chunk", F.explode(F.sequence(F.lit(0), n - 1)))
    return df.select("clip_id", "chunk", (F.col("chunk") * step).alias("start"), F.least(F.col("chunk") * step + chunk, F.col("n_frames")).alias("stop"))


def boundaries(bounds: DataFrame) -> DataFrame:
    """(clip_id, f, boundary): every frame that a chunk shares with the next one; `boundary` is the earlier chunk."""
    following = F.lead("start").over(Window.partitionBy("clip_id").orderBy("chunk"))
    b = bounds.withColumn("first", following).filter(F.col("first") < F.col("stop"))
    return b.select("clip_id", F.explode(F.sequence("first", F.col("stop") - 1)).alias("f"), F.col("chunk").alias("boundary"))


def with_halo(frames: DataFrame, bounds: DataFrame, halo: int) -> DataFrame:
    """Each frame in every chunk that reads it; `warm_up` marks frames read before a chunk's start and not emitted."""
    b = bounds.withColumn("first", F.greatest(F.lit(0), F.col("start") - halo)).withColumn("f", F.explode(F.sequence("first", F.col("stop") - 1)))
    return frames.join(b.select("clip_id", "f", "chunk", (F.col("f") < F.col("start")).alias("warm_up")), ["clip_id", "f"])


def owned(rows: DataFrame) -> DataFrame:
    """Of rows that overlapping chunks both have, those of the first chunk: what was written is never rewritten."""
    first = rows.groupBy("clip_id", "f").agg(F.min("chunk").alias("chunk"))
    return rows.join(first, ["clip_id", "f", "chunk"], "left_semi")


def local_frames(frames: DataFrame, start: int) -> DataFrame:
    """A re-indexed suffix."""
    return frames.filter(F.col("f") >= start).withColumn("local_f", F.col("f") - start)


def strided(f: Column, stride: int) -> Column:
    """The nearest processed frame at or before f."""
    return (F.floor(f / stride) * stride).cast("int")


def mask_segments(masks: DataFrame, fps: float, seconds: float = 60.0) -> DataFrame:
    """The files that a clip's masks are written to, one for each stretch of `seconds`: clip_id, segment, from_f, to_f, frames."""
    segment = F.floor(F.col("f") / F.lit(round(fps * seconds))).cast("long")
    return masks.groupBy("clip_id", segment.alias("segment")).agg(F.min("f").alias("from_f"), F.max("f").alias("to_f"), F.count_distinct("f").alias("frames"))
