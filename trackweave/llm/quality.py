"""Quality classifier by co-training of two views.

One logistic classifier sees the text (character and word shares), the other the page's metadata (language,
source, stated length).  They are fitted on labelled documents; in each round either view's classifier,
calibrated on a held-out fold, labels all documents without a label of which it is sure (a calibrated
probability of at least `sure`) and gives them to the OTHER view's training set, where they stay.  A view hands over nothing that its calibrated probability does not support, so a view
that knows little stays silent.  At the end both views are calibrated once more and combined by a logistic
model on the held-out fold, and every document is scored.

Scale
* Features (22 numbers a document) are written once, after a shuffle of them that adds the labels.  Only
  labelled rows are bounded: at most `max_labelled`, those of the smallest hashes of their ids, come to the driver.
* Each Newton step reads the features of all unlabelled documents.  What they have been labelled follows from
  the models of the rounds before, so no state is kept; partitions (at most `TASKS`) send sums of gradients
  and Hessians, about 60 kB each.
* Scoring covers every row and whole text in one pass, without a shuffle; the model is a few hundred numbers.

Defined cases: a null text is empty, a null language, source or length is a category of its own; labels
that are null or disagree for one id are not used.  Without labels of both classes nothing can be learned:
p_quality is then 1 and all documents are kept.  Repeated rows get equal scores; a null id is scored and
returned as null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

MAX_LABELLED, TASKS = 20_000, 128
ROUNDS, SURE = 4, 0.98
STEPS, NEAR = 40, 1e-4
LANGS, SOURCES = 16, 64

_SETS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "space": b" \t\r\v\f", "line": b"\n", "end": b".,;?", "bang": b"!", "bar": b"|", "mark": b"#$%&*@^~<>{}[]\\_=+/", "other": b"\"'()-:`", "high": bytes(range(128, 256))}
_SUMS = np.zeros((256, len(_SETS)))
for _k, _set in enumerate(_SETS.values()):
    _SUMS[list(_set), _k] = 1


def text_features(texts: list[str | None]) -> np.ndarray:
    """One row per text; shares are taken as square roots, so that small ones count."""
    rows = np.zeros((len(texts), len(_SETS) + 7))
    for i, text in enumerate(texts):
        data = (text or "").encode()
        n = max(1, len(data))
        words = data.split()
        m = max(1, len(words))
        lines = [x for x in data.split(b"\n") if x]
        repeats = sum(map(eq, words, islice(words, 1, None)))
        shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _SUMS / n
        upper_words = sum(map(bytes.isupper, words))
        rows[i] = [*np.sqrt(shares), np.log1p(len(words)) / 8, min(len(data) / m, 40) / 10, len(set(words)) / m, (repeats / m) ** 0.5, 1 - len(set(lines)) / max(1, len(lines)), (upper_words / m) ** 0.5, float(not words)]
    return rows


def metadata_codes(langs: list[str | None], sources: list[str | None], n_chars: list[int | None]) -> np.ndarray:
    rows = [(zlib.crc32((lang or "").encode()) % LANGS, zlib.crc32((source or "").encode()) % SOURCES, np.log1p(max(n or 0, 0)) / 10, n is None) for lang, source, n in zip(langs, sources, n_chars, strict=True)]
    return np.array(rows, float).reshape(-1, 4)


def metadata_features(codes: np.ndarray) -> np.ndarray:
    rows, k = np.zeros((len(codes), LANGS + SOURCES + 2)), np.arange(len(codes))
    rows[k, codes[:, 0].astype(int)] = 1
    rows[k, LANGS + codes[:, 1].astype(int)] = 1
    rows[:, -2:] = codes[:, 2:]
    return rows


@dataclass
class Logistic:
    """Ridge-penalised logistic regression by Newton's method on standardised columns."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Logistic:
        mean, scale = x.mean(0), x.std(0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
        w = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-6
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.weights[0] + (x - self.mean) / self.scale @ self.weights[1:], -30, 30)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class View:
    model: Logistic
    calibration: Logistic

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.calibration.logit(self.model.logit(x)[:, None])


@dataclass
class CoTrained:
    views: tuple[View, View]
    combined: Logistic

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of either view, and of both."""
        logits = [v.logit(x) for v, x in zip(self.views, (text, meta), strict=True)]
        return _sigmoid(logits[0]), _sigmoid(logits[1]), _sigmoid(self.combined.logit(np.column_stack(logits)))


Views = tuple[np.ndarray, np.ndarray]


def _moments(x: Views) -> np.ndarray:
    return np.concatenate([np.concatenate([[len(v)], v.sum(0), (v * v).sum(0)]) for v in x])


def _slopes(x: np.ndarray, y: np.ndarray, model: Logistic) -> np.ndarray:
    """Loss, gradient and Hessian, summed over rows."""
    z = np.column_stack([np.ones(len(x)), (x - model.mean) / model.scale])
    at = np.clip(z @ model.weights, -30, 30)
    p = _sigmoid(at)
    return np.concatenate([[(np.logaddexp(0, at) - y * at).sum()], z.T @ (y - p), ((z * (p * (1 - p))[:, None]).T @ z).ravel()])


def given_labels(history: list[tuple[View, View]], sure: float, x: Views) -> Views:
    """What either view has been told by the other one (nan: nothing), in the first round in which that was sure."""
    told = (np.full(len(x[0]), np.nan), np.full(len(x[0]), np.nan))
    for views in history:
        for v in range(2):
            p, label = _sigmoid(views[v].logit(x[v])), told[1 - v]
            label[:] = np.where(np.isnan(label) & (p >= sure), 1.0, np.where(np.isnan(label) & (1 - p >= sure), 0.0, label))
    return told


def _given_slopes(history: list[tuple[View, View]], sure: float, models: list[Logistic], x: Views) -> np.ndarray:
    told = given_labels(history, sure, x)
    return np.concatenate([_slopes(x[v][~np.isnan(told[v])], told[v][~np.isnan(told[v])], models[v]) for v in range(2)])


def co_train(labelled: Views, y: np.ndarray, pool: Views | Callable[[Callable[[Views], np.ndarray]], np.ndarray], rounds: int = ROUNDS, sure: float = SURE, ridge: float = 1.0) -> CoTrained:
    """Rows of `labelled` are in the order of their ids' hashes: every fourth is held out for calibration.  `pool`: rows
    of both views, or what adds a function of them over blocks of all rows."""
    total = pool if callable(pool) else lambda f: f(pool)
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.ones(len(y), bool)  # too few: calibrate on what is fitted
    fit_rows = ~held if not held.all() else held
    own = tuple(x[fit_rows] for x in labelled)
    sums, models, at = _moments(own) + total(_moments), [], 0
    for x in own:
        n, k = sums[at], x.shape[1]
        mean = sums[at + 1 : at + 1 + k] / n
        scale = np.sqrt(np.maximum(sums[at + 1 + k : at + 1 + 2 * k] / n - mean**2, 0))
        models.append(Logistic(mean, np.where(scale > 1e-6, scale, 1.0), np.zeros(k + 1)))
        at += 1 + 2 * k
    history: list[tuple[View, View]] = []

    def fitted() -> tuple[View, View]:
        """Newton's method for both views at once, from the weights of the round before; halves steps that do not help."""
        best: list[tuple[float, np.ndarray] | None] = [None, None]
        for _ in range(STEPS):
            sums, at, moved = np.concatenate([_slopes(own[v], y[fit_rows], models[v]) for v in range(2)]), 0, 0.0
            if history:
                sums = sums + total(partial(_given_slopes, list(history), sure, list(models)))
            for v, m in enumerate(models):
                k, w = len(m.weights), m.weights
                penalty = np.full(k, ridge)
                penalty[0] = 1e-6
                loss = sums[at] + (penalty * w * w).sum() / 2
                if best[v] and loss > best[v][0] + 1e-9 * abs(best[v][0]):
                    new = (w + best[v][1]) / 2
                else:
                    best[v] = (loss, w)
                    new = w + np.linalg.solve(sums[at + 1 + k : at + 1 + k + k * k].reshape(k, k) + np.diag(penalty), sums[at + 1 : at + 1 + k] - penalty * w)
                moved = max(moved, np.abs(new - w).max())
                models[v] = Logistic(m.mean, m.scale, new)
                at += 1 + k + k * k
            if moved < NEAR:
                break
        return tuple(View(m, Logistic.fit(m.logit(x[held])[:, None], y[held])) for m, x in zip(models, labelled, strict=True))

    views = fitted()
    for _ in range(rounds):
        history.append(views)
        views = fitted()
    logits = np.column_stack([v.logit(x[held]) for v, x in zip(views, labelled, strict=True)])
    return CoTrained(views, Logistic.fit(logits, y[held]))


_INPUT = ("text", "lang", "source", "n_chars")


def _plain(docs: DataFrame, id_col: str, cols: tuple[str, str, str, str]) -> DataFrame:
    kinds = ("string", "string", "string", "long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), *(F.col(c).cast(k).alias(n) for c, k, n in zip(cols, kinds, _INPUT, strict=True)))


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    text, lang, source, n_chars = (batch.column(c).to_pylist() for c in _INPUT)
    return text_features(text), metadata_features(metadata_codes(lang, source, n_chars))


def _unpacked(column: pa.Array | pa.ChunkedArray) -> Views:
    width = len(_SETS) + 7
    rows = np.frombuffer(b"".join(column.to_pylist())).reshape(-1, width + 4)
    return rows[:, :width], metadata_features(rows[:, width:])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_labelled: int = MAX_LABELLED, id_col: str = "doc_id", cols: tuple[str, str, str, str] = _INPUT) -> CoTrained | None:
    """Fits on a bounded sample of labelled and on all other documents; None if the labels do not hold both classes."""
    plain = _plain(docs, id_col, cols)
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("y2")).filter("y = y2").select("doc_id", F.col("y").cast("double"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, *rest = (batch.column(c).to_pylist() for c in _INPUT)
            rows = np.column_stack([text_features(text), metadata_codes(*rest)])
            yield pa.record_batch([batch.column("doc_id"), pa.array([x.tobytes() for x in rows], pa.binary())], names=["doc_id", "x"])

    packed = written(docs.sparkSession, plain.mapInArrow(pack, "doc_id long, x binary").join(known, "doc_id", "left"), "quality-features")
    labelled = packed.filter("y is not null")
    chosen = labelled.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    one = labelled.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("x", "y")).alias("v"))  # of repeated ids one row
    found = one.select("doc_id", "v.*").toArrow()  # at most max_labelled rows
    ids = found["doc_id"].to_pylist()
    order = np.lexsort((np.array(ids, np.int64), np.array([zlib.crc32(str(x).encode()) for x in ids], np.int64)))
    y, x = np.array(found["y"].to_pylist(), float)[order], tuple(v[order] for v in _unpacked(found["x"]))
    if len(set(y)) < 2:
        return None
    others = packed.filter("y is null").select("x").coalesce(TASKS)

    def total(f: Callable[[Views], np.ndarray]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for batch in batches:
                part = f(_unpacked(batch.column("x")))
                sums = part if sums is None else sums + part
            if sums is not None:
                yield pa.record_batch([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

        return sum(map(np.frombuffer, others.mapInArrow(run, "sums binary").toArrow()["sums"].to_pylist()), np.zeros(1))

    return co_train(x, y, total)


def score(docs: DataFrame, model: CoTrained | None, threshold: float = 0.5, id_col: str = "doc_id", cols: tuple[str, str, str, str] = _INPUT) -> DataFrame:
    """doc_id, p_text, p_meta, p_quality, keep of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = [np.ones(batch.num_rows)] * 3 if model is None else model.score(*_features(batch))
            yield pa.record_batch([batch.column("doc_id"), *map(pa.array, p), pa.array(p[2] >= threshold)], names=["doc_id", "p_text", "p_meta", "p_quality", "keep"])

    return _plain(docs, id_col, cols).mapInArrow(run, "doc_id long, p_text double, p_meta double, p_quality double, keep boolean")


def keep_good(docs: DataFrame, model: CoTrained | None, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns unchanged, that the classifier accepts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch if model is None else batch.filter(pa.array(model.score(*_features(batch))[2] >= threshold))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
