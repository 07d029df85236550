"""Weights, gates, parsing and small numeric helpers, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp_fps(fps: Column) -> Column:
    """Frame rates outside 1 to 240 are taken as 30."""
    return F.when(~fps.between(1, 240) | fps.isNull(), F.lit(30.0)).otherwise(fps)


def gate(x: Column, low: float, high: float) -> Column:
    """Linear ramp from 0 at `low` to 1 at `high`; a step where high <= low."""
    if high <= low:
        return F.when(x >= high, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (x - low) / (high - low)))


def observation_weight(quality: Column, size: Column, occlusion: Column, sharpness: Column, entropy: Column, boost_at: float = 0.8, boost: float = 3.0) -> tuple[Column, Column]:
    """(weight, boosted): boosted is what the weight counts after clear looks are raised."""
    w = quality * gate(size, 32.0, 96.0) * (1.0 - gate(occlusion, 0.15, 0.6)) * gate(sharpness, 0.05, 0.4) * F.greatest(F.lit(0.0), 1.0 - entropy)
    return w, F.when(w >= boost_at, w * boost).otherwise(w)


def crop_weight(fill: Column, height: Column, face: Column, min_fill: float = 0.25, min_height: float = 72.0) -> Column:
    """0 for small or poorly filled crops; 2 with a face, else 1; halved for fill < .5 and again for height < 150."""
    w = F.when(face, 2.0).otherwise(1.0) * F.when(fill < 0.5, 0.5).otherwise(1.0) * F.when(height < 150, 0.5).otherwise(1.0)
    return F.when((fill < min_fill) | (height < min_height), F.lit(0.0)).otherwise(w)


def sharpness(variance: Column, pixels: Column) -> Column:
    """Variance of a crop's Laplacian as a share of 100, at most 1; 0 for crops of fewer than 64 pixels."""
    return F.when(pixels < 64, F.lit(0.0)).otherwise(F.least(F.lit(1.0), variance / 100.0))


def compatible(a: Column, b: Column) -> Column:
    """A missing class goes with every class."""
    return a.isNull() | b.isNull() | (a == b)


def beta_interval(alpha: Column, beta: Column) -> tuple[Column, Column, Column]:
    """(mean, low, high): 95 % interval by the normal approximation, clamped to 0..1."""
    total = alpha + beta
    mean = alpha / total
    half = 1.96 * F.sqrt(alpha * beta / (total * total * (total + 1)))
    return mean, F.greatest(F.lit(0.0), mean - half), F.least(F.lit(1.0), mean + half)


def json_answer(text: Column, verdicts: tuple[str, ...], labels: tuple[str, ...], greedy: bool = False) -> Column:
    """struct(verdict, label, age) from the first {...} of a free-text answer, or null.  Single quotes are tried as double
    quotes if the object does not parse; values are trimmed and lower-cased; anything outside the domains is null."""
    body = F.regexp_extract(text, r"(?s)\{.*\}" if greedy else r"(?s)\{.*?\}", 0)
    schema = "verdict string, label string, age string"
    strict = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
    first, second = F.from_json(body, schema, strict), F.from_json(F.replace(body, F.lit("'"), F.lit('"')), schema, strict)
    part = lambda name: F.lower(F.trim(F.coalesce(first[name], second[name])))
    age = part("age").try_cast("double")
    ok = part("verdict").isin(*verdicts) & (part("label").isNull() | part("label").isin(*labels))
    return F.when(ok, F.struct(part("verdict").alias("verdict"), part("label").alias("label"), age.alias("age")))


def answer_to_attr(p_side: Column, confidence: Column, person: Column, view: Column, age_group: Column, age: Column) -> Column:
    """struct(p, w, age_mean, age_std) from a judged view: p = .5 +- .5 * confidence, weight by what was visible."""
    conf = F.least(F.lit(1.0), F.greatest(F.lit(0.0), confidence))
    p = F.when(p_side.isNull(), F.lit(0.5)).when(p_side, 0.5 + 0.5 * conf).otherwise(0.5 - 0.5 * conf)
    w = F.when(~person, 0.0).otherwise(F.when(p_side.isNull(), 0.3).otherwise(1.0) * F.when(view == "face", 1.0).otherwise(0.4) * F.when(view == "back", 0.7).otherwise(1.0))
    child = age_group == "child"
    return F.struct(p.alias("p"), w.alias("w"), F.when(child, F.least(age, F.lit(12.0))).otherwise(age).alias("age_mean"), F.when(view == "face", 6.0).otherwise(12.0).alias("age_std"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    """Null for an empty or zero vector."""
    norm = F.sqrt(dot(v, v))
    return F.when(norm > 0, F.transform(v, lambda x: x / norm))


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp(x - top))
    total = F.aggregate(e, F.lit(0.0), lambda s, x: s + x)
    return F.transform(e, lambda x: x / total)


def entropy_share(p: Column) -> Column:
    """Entropy over its maximum, ln n; zero shares add nothing."""
    h = F.aggregate(p, F.lit(0.0), lambda s, x: s - F.when(x > 0, x * F.ln(x)).otherwise(0.0))
    return h / F.ln(F.size(p).cast("double"))


def distribution_stats(p: Column) -> Column:
    """struct(mean, std) of an age distribution over 0, 1, 2, ...; the variance is at least 1."""
    indexed = F.transform(p, lambda x, i: F.struct(x.cast("double").alias("p"), i.cast("double").alias("v")))
    mean = F.aggregate(indexed, F.lit(0.0), lambda s, x: s + x["p"] * x["v"])
    second = F.aggregate(indexed, F.lit(0.0), lambda s, x: s + x["p"] * x["v"] * x["v"])
    return F.struct(mean.alias("mean"), F.sqrt(F.greatest(F.lit(1.0), second - mean * mean)).alias("std"))


def gaussian_target(age: Column, std: Column) -> Column:
    """Normalised weights over ages 0..100."""
    w = F.transform(F.sequence(F.lit(0), F.lit(100)), lambda a: F.exp(-(a - age) * (a - age) / (2 * std * std)))
    return F.aggregate(w, F.lit(0.0), lambda s, x: s + x, lambda total: F.transform(w, lambda x: x / total))  # the sum is taken once


def colour_slot(name: Column, n: int) -> Column:
    """Stable slot of a name: the sum of its character codes modulo n."""
    return F.aggregate(F.transform(F.filter(F.split(name, ""), lambda c: c != ""), F.ascii), F.lit(0), lambda s, x: s + x) % n


def display_frame(t: Column, fps: Column, stride: int) -> Column:
    """The processed frame shown at time t."""
    return (F.floor(F.floor(t * fps) / stride) * stride).cast("int")


def runs_shared(a: Column, b: Column) -> Column:
    """Frames that two lists of inclusive runs (start, end) share."""
    shared = lambda x, y: F.greatest(F.lit(0), F.least(x["end"], y["end"]) - F.greatest(x["start"], y["start"]) + 1).cast("long")
    return F.aggregate(a, F.lit(0).cast("long"), lambda acc, x: acc + F.aggregate(b, F.lit(0).cast("long"), lambda s, y: s + shared(x, y)))


def runs_of(frames: Column) -> Column:
    """An array of frames in any order as inclusive runs (start, end)."""
    f = F.array_sort(F.array_distinct(frames))
    at = lambda i: F.get(f, i)
    begins = F.filter(F.sequence(F.lit(0), F.size(f) - 1), lambda i: (i == 0) | (at(i) != at(i - 1) + 1))
    ends = F.filter(F.sequence(F.lit(0), F.size(f) - 1), lambda i: (i == F.size(f) - 1) | (at(i) + 1 != at(i + 1)))
    return F.when(F.size(f) > 0, F.zip_with(begins, ends, lambda b, e: F.struct(at(b).alias("start"), at(e).alias("end"))))
