"""Comparing runs with each other and with hand labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST_SETTINGS = 10_000


def carry_labels(matches: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels of reference tracks carried to matched tracks by counted votes.  A track matched to references of more than
    one label is left out; matches: clip_id, tid, match; labels: clip_id, tid (of the reference), label."""
    ref = labels.select("clip_id", F.col("tid").alias("match"), "label")
    v = matches.join(ref, ["clip_id", "match"]).groupBy("clip_id", "tid").agg(F.count_distinct("label").alias("kinds"), F.min("label").alias("label"), F.count(F.lit(1)).alias("votes"))
    return v.filter("kinds = 1").drop("kinds")


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one run that the other lacks, repeated rows counted; empty if the runs are identical."""
    return a.exceptAll(b).withColumn("only_in", F.lit("a")).unionByName(b.exceptAll(a).withColumn("only_in", F.lit("b")))


def auc(scores: DataFrame, keys: tuple[str, ...] = ("clip_id",)) -> DataFrame:
    """Area under the ROC curve with ties counted half, from ranks: no pairs are formed; null without both classes.
    scores: keys, score, positive."""
    by = scores.groupBy(*keys, "score").agg(F.sum(F.when(F.col("positive"), 1).otherwise(0)).alias("pos"), F.sum(F.when(F.col("positive"), 0).otherwise(1)).alias("neg"))
    below = F.coalesce(F.sum("neg").over(Window.partitionBy(*keys).orderBy("score").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    s = by.withColumn("below", below).groupBy(*keys).agg(F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return s.select(*keys, (F.col("won") / F.nullif(F.col("pos") * F.col("neg"), F.lit(0))).alias("auc"), "pos", "neg")


def threshold_errors(scores: DataFrame, thresholds: list[float], keys: tuple[str, ...] = ("clip_id",)) -> DataFrame:
    """Frame-weighted errors of `score >= t` per threshold; scores: keys, score, positive, frames."""
    t = scores.withColumn("t", F.explode(F.array(*[F.lit(float(x)) for x in thresholds])))
    wrong = (F.col("score") >= F.col("t")) != F.col("positive")
    return t.groupBy(*keys, "t").agg(F.sum(F.when(wrong, F.col("frames")).otherwise(0)).alias("errors"), F.sum("frames").alias("frames"))


def best_threshold(errors: DataFrame, default: float, keys: tuple[str, ...] = ("clip_id",)) -> DataFrame:
    """Fewest errors, then nearest to the default, then lowest; with the range of thresholds that make as few."""
    best = errors.groupBy(*keys).agg(F.min_by("t", F.struct("errors", F.abs(F.col("t") - default).alias("d"), "t")).alias("best_t"), F.min("errors").alias("least"))
    ties = errors.join(best, list(keys)).filter("errors = least").groupBy(*keys, "best_t", "least").agg(F.min("t").alias("low"), F.max("t").alias("high"))
    return ties.withColumnRenamed("least", "errors").withColumn("margin", F.col("high") - F.col("low"))


def label_flips(a: DataFrame, b: DataFrame) -> DataFrame:
    """Tracks that both runs label, with differing labels; a and b: clip_id, tid, label; a also frames."""
    return a.join(b.select("clip_id", "tid", F.col("label").alias("label_b")), ["clip_id", "tid"]).filter("label <> label_b")


def label_agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    j = a.join(b.select("clip_id", "tid", F.col("label").alias("label_b")), ["clip_id", "tid"])
    same = F.col("label") == F.col("label_b")
    return j.groupBy("clip_id").agg(F.count(F.lit(1)).alias("tracks"), F.avg(F.when(same, 1.0).otherwise(0.0)).alias("agreement"), (F.sum(F.when(~same, F.col("frames")).otherwise(0)) / F.sum("frames")).alias("flipped_frames"))


def supported_pairs(matches: DataFrame, least: int = 3) -> DataFrame:
    """Pairs of a and b tracks matched in at least `least` frames; matches: clip_id, f, tid_a, tid_b."""
    return matches.groupBy("clip_id", "tid_a", "tid_b").agg(F.count(F.lit(1)).alias("frames")).filter(F.col("frames") >= least)


def splits(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("clip_id", "tid_a").agg(F.array_sort(F.collect_set("tid_b")).alias("parts")).filter(F.size("parts") > 1)


def merges(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("clip_id", "tid_b").agg(F.array_sort(F.collect_set("tid_a")).alias("parts")).filter(F.size("parts") > 1)


def orphans(obs: DataFrame, pairs: DataFrame) -> DataFrame:
    return obs.select("clip_id", F.col("tid").alias("tid_a")).distinct().join(pairs, ["clip_id", "tid_a"], "left_anti")


def switches(matches: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """Frames in which an a-track's partner is another than in its match before; `among` restricts the a-tracks."""
    m = matches if among is None else matches.join(among.select("clip_id", "tid_a"), ["clip_id", "tid_a"], "left_semi")
    w = Window.partitionBy("clip_id", "tid_a").orderBy("f")
    return m.withColumn("before", F.lag("tid_b").over(w)).filter("before <> tid_b").select("clip_id", "tid_a", "f", "before", "tid_b")


def split_switches(matches: DataFrame, least: int = 3) -> DataFrame:
    """`switches` of split tracks (`splits` of `supported_pairs`) over all their matches, which are worked out once."""
    dealt = matches.repartition("clip_id", "tid_a")
    held = dealt.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("clip_id", "tid_a", "tid_b")))
    parts = F.size(F.collect_set(F.when(F.col("_n") >= least, F.col("tid_b"))).over(Window.partitionBy("clip_id", "tid_a")))
    return switches(held.withColumn("_parts", parts).filter("_parts > 1").drop("_n", "_parts"))


def boundaries(n_frames: int, chunk: int, overlap: int) -> list[int]:
    """First frames that a later chunk owns."""
    step = chunk - overlap
    n_chunks = max(1, -(-(n_frames - overlap) // step))
    return [c * step + overlap for c in range(1, n_chunks)]


def switch_lags(switch: DataFrame, at: list[int]) -> DataFrame:
    """Switches by frames since the last boundary; null before the first one."""
    last = F.array_max(F.filter(F.array(*map(F.lit, at)), lambda b: b <= F.col("f")))
    return switch.groupBy((F.col("f") - last).alias("lag")).agg(F.count(F.lit(1)).alias("switches"))


def sweep(detections: DataFrame, settings: DataFrame, replay: Callable[[DataFrame], DataFrame], measure: Callable[[DataFrame], DataFrame], valid: Column | None = None) -> DataFrame:
    """Every setting (a row with `setting_id` and parameters) on the same detections: what `measure` says of each clip, per
    setting.  `replay` makes tracks of detections that carry a setting's parameters; settings that are not `valid` are left
    out.  While measured, a setting's clip is a clip of its own, so any measure by clip will do.  The detections are read
    once; settings are broadcast, so there may be at most MOST_SETTINGS."""
    chosen = settings if valid is None else settings.filter(valid)
    if chosen.limit(MOST_SETTINGS + 1).count() > MOST_SETTINGS:
        raise ValueError(f"more than {MOST_SETTINGS} settings")
    tracks = replay(detections.crossJoin(F.broadcast(chosen))).withColumn("clip_id", F.struct("setting_id", "clip_id"))
    return measure(tracks).withColumnRenamed("clip_id", "run").select("run.*", "*").drop("run")


def rank_settings(results: DataFrame) -> DataFrame:
    """Settings of each clip in order of fragments and twice the swaps, then of tracks, then of id."""
    cost = F.col("fragments") + 2 * F.col("swaps")
    return results.withColumn("place", F.row_number().over(Window.partitionBy("clip_id").orderBy(cost, "tracks", "setting_id")))


def unmatched_recent(detections: DataFrame, obs: DataFrame, lookback: int, least: float) -> DataFrame:
    """Detections that overlap no track's latest box of the last `lookback` frames by more than `least`."""
    from ..functions import geometry as geo

    d = detections.select("clip_id", F.col("f").alias("df"), F.col("tid").alias("det"), *[F.col(c).alias(f"d_{c}") for c in ("x1", "y1", "x2", "y2")])
    w = Window.partitionBy("clip_id", "tid").orderBy("f")
    o = obs.withColumn("until", F.coalesce(F.lead("f").over(w) - 1, F.lit(2**31 - 1))).withColumn("until", F.least(F.col("until"), F.col("f") + lookback - 1))
    o = o.withColumn("df", F.explode(F.sequence(F.col("f"), F.col("until")))).select("clip_id", "df", *[F.col(c).alias(f"o_{c}") for c in ("x1", "y1", "x2", "y2")])
    on = (d["clip_id"] == o["clip_id"]) & (d["df"] == o["df"]) & (geo.iou(geo.box("d_"), geo.box("o_")) > least)
    return d.join(o, on, "left_anti").select("clip_id", F.col("df").alias("f"), F.col("det").alias("tid"))
