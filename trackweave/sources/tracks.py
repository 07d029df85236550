"""Reading and writing track relations: JSON lines, tracker text, manifests, logs.  Files are read by Spark only."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import scalars as sc

NESTED = "clip_id int, f int, t double, objs array<struct<tid:int,box:array<double>,conf:double,area:long>>"
FLAT = "clip_id int, f int, tid int, box array<double>, score double, prompt string, scores map<string,double>, src string, filled boolean"
RAW = "clip_id int, f int, boxes array<array<double>>, scores array<double>"


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Blank lines are skipped; optional keys read as null."""
    return spark.read.schema(schema).json(path)


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def _box_columns(box: Column) -> list[Column]:
    return [box[i].alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))]


def flatten_nested(frames: DataFrame) -> DataFrame:
    """One row per object of nested frame records."""
    return frames.select("clip_id", "f", F.explode("objs").alias("o")).select("clip_id", "f", F.col("o.tid").alias("tid"), *_box_columns(F.col("o.box")), F.col("o.conf").alias("score"))


def flatten_detections(frames: DataFrame) -> DataFrame:
    """Parallel arrays of boxes and scores; the number in the frame is a detection id, not an identity."""
    z = frames.select("clip_id", "f", F.posexplode(F.arrays_zip("boxes", "scores")).alias("det", "d"))
    return z.select("clip_id", "f", "det", *_box_columns(F.col("d.boxes")), F.col("d.scores").alias("score"))


def parse_mot(lines: DataFrame, width: float, height: float, base: int = 1) -> DataFrame:
    """Text rows `frame,id,x,y,w,h,...`: rows of fewer than 6 fields are dropped, frames count from 0, boxes are clipped to
    the picture and dropped below one pixel.  lines: clip_id, value."""
    p = F.split("value", ",")
    num = lambda i: F.get(p, F.lit(i)).try_cast("double")
    b = geo.clipped(geo.from_xywh(num(2), num(3), num(4), num(5)), width, height)
    df = lines.filter(F.size(p) >= 6).select("clip_id", (num(0).cast("int") - base).alias("f"), num(1).cast("int").alias("tid"), *[x.alias(c) for x, c in zip(b, ("x1", "y1", "x2", "y2"), strict=True)], F.coalesce(num(6), F.lit(1.0)).alias("score"))
    return df.filter("x2 - x1 >= 1 and y2 - y1 >= 1")


def mot_lines(obs: DataFrame) -> DataFrame:
    """Tracker text of observations, frames counted from 1."""
    t = F.format_string("%d,%d,%.1f,%.1f,%.1f,%.1f,%.4f,-1,-1,-1", F.col("f") + 1, "tid", "x1", "y1", F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), "score")
    return obs.select("clip_id", "f", "tid", t.alias("value"))


def detections_by_frame(obs: DataFrame) -> DataFrame:
    """A frame's detections as one sorted list."""
    return obs.groupBy("clip_id", "f").agg(F.array_sort(F.collect_list(F.struct("tid", "x1", "y1", "x2", "y2", "score"))).alias("detections"))


def proposal_lines(obs: DataFrame, sequence: Column) -> DataFrame:
    """(name of a frame file, lines `l,t,w,h,s`) of a detector's proposal table."""
    line = F.concat_ws(",", *[F.format_string("%.1f", c) for c in (F.col("x1"), F.col("y1"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))], F.format_string("%.2f", "score"))
    rows = obs.withColumn("name", F.concat(sequence, F.lit("/img1/"), F.lpad((F.col("f") + 1).cast("string"), 8, "0"), F.lit(".txt"))).withColumn("line", line)
    return rows.groupBy("name").agg(F.concat_ws(";", F.transform(F.array_sort(F.collect_list(F.struct("tid", "line"))), lambda x: x["line"])).alias("lines"))


def clip_meta(meta: DataFrame) -> DataFrame:
    """Frame rates out of range become 30."""
    return meta.withColumn("fps", sc.clamp_fps(F.col("fps")))


def wanted_frames(frames: DataFrame, wanted: DataFrame) -> DataFrame:
    return frames.join(wanted, ["clip_id", "f"], "left_semi")


def dedup_observations(obs: DataFrame) -> DataFrame:
    """One row per (clip, frame, track), that of the highest score; `repeated` tells of more."""
    cols = [c for c in obs.columns if c not in ("clip_id", "f", "tid")]
    return obs.groupBy("clip_id", "f", "tid").agg(F.max_by(F.struct(*cols), F.struct("score", "x1")).alias("b"), (F.count(F.lit(1)) > 1).alias("repeated")).select("clip_id", "f", "tid", "b.*", "repeated")


# manifests


def manifest(lines: DataFrame) -> DataFrame:
    """`path,age,age_lo,age_hi,label` with -1 for unknown; short rows are dropped."""
    p = F.split("value", ",")
    known = lambda i: F.nullif(F.get(p, F.lit(i)).try_cast("double"), F.lit(-1.0))
    return lines.filter(F.size(p) >= 5).select(F.get(p, F.lit(0)).alias("path"), known(1).alias("age"), known(2).alias("age_lo"), known(3).alias("age_hi"), known(4).cast("int").alias("label"))


def manifest_from_names(names: DataFrame) -> DataFrame:
    """`<age>_<label>_...` file names; unparsable ones are dropped."""
    p = F.split(F.element_at(F.split("path", "/"), -1), "_")
    df = names.select("path", F.get(p, F.lit(0)).try_cast("int").alias("age"), F.get(p, F.lit(1)).try_cast("int").alias("label"))
    return df.filter("age is not null and label in (0, 1)")


def manifest_from_folds(rows: DataFrame, files: DataFrame, groups: dict[str, tuple[int, int]], labels: dict[str, int], patterns: list[str]) -> DataFrame:
    """Rows of fold files (tab-separated, read with their header; all text): `age` is one of `groups` or a number, `label` one of
    `labels`.  A row's path is the first of `patterns`, filled with its columns, that is among `files` (path); rows without a
    path, and rows that say neither a label nor an age, are dropped.  path, age, age_lo, age_hi, label; nulls for what is unknown."""
    fill = lambda pattern: F.concat(*[F.col(x[1:-1]) if x.startswith("{") else F.lit(x) for x in re.split(r"(\{\w+\})", pattern) if x])
    lookup = lambda pairs, key: F.try_element_at(F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]), key)
    exact = F.col("age").try_cast("int")
    low, high = (F.coalesce(lookup({k: v[j] for k, v in groups.items()}, F.col("age")), exact) for j in (0, 1))
    named = rows.withColumn("row", F.monotonically_increasing_id()).select("row", low.alias("age_lo"), high.alias("age_hi"), lookup(labels, F.col("label")).alias("label"), F.posexplode(F.array(*map(fill, patterns))).alias("at", "path"))
    found = named.join(files.select("path").distinct(), "path", "left_semi").filter("age_lo is not null or label is not null")
    best = found.groupBy("row").agg(F.min_by(F.struct("path", "age_lo", "age_hi", "label"), "at").alias("b"))
    return best.select("b.path", F.lit(None).cast("int").alias("age"), "b.age_lo", "b.age_hi", "b.label")


def manifest_from_attributes(lines: DataFrame, files: DataFrame, attribute: str, folder: str) -> DataFrame:
    """A list of attributes: line 0 is a count, line 1 the names, every other line a file and 1 or -1 for each name.  The label is 0
    where the attribute is 1, else 1; short lines and files that are not there are dropped.  lines: line, value."""
    names = (lines.filter("line = 1").select("value").first() or [""])[0].split()
    if attribute not in names:
        raise ValueError(f"no attribute {attribute}")
    p = F.split(F.trim("value"), r"\s+")
    rows = lines.filter(F.col("line") > 1).filter(F.size(p) > names.index(attribute) + 1)
    rows = rows.select(F.concat(F.lit(f"{folder}/"), F.get(p, F.lit(0))).alias("path"), F.when(F.get(p, F.lit(names.index(attribute) + 1)) == "1", 0).otherwise(1).alias("label"))
    unknown = [F.lit(None).cast("int").alias(c) for c in ("age", "age_lo", "age_hi")]
    return rows.join(files.select("path").distinct(), "path", "left_semi").select("path", *unknown, "label")


def all_manifests(spark: SparkSession, folder: str, own: str = "all.csv") -> DataFrame:
    """The lines (value) of all CSV files of a folder but that which they are put together in."""
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return spark.read.text(f"{folder}/*.csv").filter(name != own).select("value")


def age_group(age: Column, edges: tuple[int, ...] = (13, 20, 30, 45, 65)) -> Column:
    """Name of the group an age lies in: `-12`, `13-19`, ..., `65-`."""
    lows, highs = ("", *map(str, edges)), (*(str(e - 1) for e in edges), "")
    out = F.when(age < edges[0], f"{lows[0]}-{highs[0]}")
    for k, e in enumerate(edges[1:], 1):
        out = out.when(age < e, f"{lows[k]}-{highs[k]}")
    return F.when(age.isNotNull(), out.otherwise(f"{lows[-1]}-"))


def first_n_per_group(rows: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """An export cap that is asked for: at most n rows per group in a fixed order."""
    from pyspark.sql import Window

    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")


# logs


def stage_seconds(lines: DataFrame, stages: tuple[str, ...]) -> DataFrame:
    """The last `<stage>: <seconds>s` of each stage in each log; lines: log_id, text."""
    last = lambda s: F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.regexp_extract_all("text", F.lit(rf"{s}: ([0-9.]+)s"), 1)), -1).try_cast("double").alias(s)
    return lines.select("log_id", *[last(s) for s in stages])


def timing(metrics: DataFrame) -> DataFrame:
    """Per run and stage: frames, milliseconds a frame, frames a second."""
    m = metrics.groupBy("run_id", "stage").agg(F.sum("seconds").alias("seconds"), F.sum("frames").alias("frames"))
    return m.select("run_id", "stage", "frames", (F.col("seconds") * 1000 / F.nullif(F.col("frames"), F.lit(0))).alias("ms_per_frame"), (F.col("frames") / F.nullif(F.col("seconds"), F.lit(0.0))).alias("hz"))


def parse_spec(spec: Column) -> Column:
    """`name=..,tracks=..` to a map."""
    return F.str_to_map(spec, F.lit(","), F.lit("="))


def tiles(width: int, height: int, tile: int, overlap: int, frames: DataFrame) -> DataFrame:
    """Overlapping tile origins of each frame, the last ones flush with the far edges."""
    step = tile - overlap

    def starts(size: int) -> list[int]:
        return [*range(0, max(1, size - tile), step), max(0, size - tile)] if size > tile else [0]

    origin = [(x, y) for y in sorted(set(starts(height))) for x in sorted(set(starts(width)))]
    return frames.withColumn("o", F.explode(F.array(*[F.struct(F.lit(x).alias("ox"), F.lit(y).alias("oy")) for x, y in origin]))).select(*frames.columns, "o.ox", "o.oy")


def tile_to_frame(detections: DataFrame) -> DataFrame:
    """Boxes of a tile moved to the frame."""
    move = {"x1": "ox", "x2": "ox", "y1": "oy", "y2": "oy"}
    return detections.withColumns({c: F.col(c) + F.col(o) for c, o in move.items()}).drop("ox", "oy")


def external(df: DataFrame, model: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """The boundary to detectors, trackers and judges: a model sees batches of rows and returns rows of a fixed schema."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield model(b)

    return df.mapInPandas(run, schema)
