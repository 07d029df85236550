"""Ranked lexical search by bag deduplication: the best documents for every item of a query set, in exact integers.

Documents are restricted to the items' vocabulary.  Those whose term frequencies over that vocabulary and whose length
factor m are the same score the same for every item, so they are one class: rows meet by a hash and are one class only if
the whole vectors and m agree.  Every class is scored once; the members of the classes that reach an item's list are
expanded by ascending id.

Scale
* One pass over the texts for each block of `items_mb` of item text (a block is about 35,000 items of 230 bytes; a query
  set of any size is taken in blocks).  A block's vocabulary and postings are the only broadcast, bounded by the block.
* What is kept of a document is 8 bytes for each different word it shares with the vocabulary.
* Classes: before the shuffle every task keeps only the `top` least ids of each class it sees (a rank limit, which Spark
  pushes below the exchange), so a class with a third of all rows brings `top` rows a task.  More members than `top` can never
  be in a list, as the members of a class tie and go by ascending id.
* Scoring emits no pairs: a task keeps the `top` best classes of each item, by (score, least id).  A document in an item's
  list belongs to one of that item's `top` best classes: each class before its own has a member before it.

Defined cases: a null text has no terms, such documents count neither in N nor in L and are never listed.  Equal scores
go by ascending id, null ids last.  Repeated documents are documents of their own and may fill several ranks; items that
repeat id and text are one item, items that share only their id are ranked apart.  An item without terms, or none of
whose terms occur, has no rows.  A very long text is read in blocks and counted whole.  Empty tables give an empty result;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, table, written
from .words import SLICE, blocks

TOP, ITEMS_MB = 10, 8
#: Fixed value: terms are runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TO_TERMS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).translate(bytes(range(256)).lower())
#: Postings scored at a time, and candidates held before a task's lists are cut again.
_POSTINGS, _HELD = 1_000_000, 400_000
_ENTRY = np.dtype([("t", "<u4"), ("tf", "<u4")])


def term_counts(text: bytes) -> Counter:
    """How often each term stands in a text."""
    found: Counter = Counter()
    for block in blocks(text.translate(_TO_TERMS), SLICE):
        found.update(block.split())
    return found


class _Items:
    """A block of items as postings: of term t (a place in `terms`) the items that hold it and how often."""

    def __init__(self, texts: list[str]):
        counts = [term_counts((t or "").encode()) for t in texts]
        self.terms = sorted(set().union(*counts))
        self.place = {t: k for k, t in enumerate(self.terms)}
        rows = sorted((self.place[t], item, n) for item, c in enumerate(counts) for t, n in c.items())
        self.item, self.times = (np.array([r[j] for r in rows], np.int64) for j in (1, 2))
        self.first = np.searchsorted(np.array([r[0] for r in rows], np.int64), np.arange(len(self.terms) + 1))


def vectors(docs: DataFrame, place: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, vec) of documents (doc_id, text) with at least one term: all terms with repeats, and the terms that have
    a `place` as ascending (place, frequency) pairs of unsigned 32-bit numbers."""
    known = docs.sparkSession.sparkContext.broadcast(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = known.value
        for batch in batches:
            ids, ns, vecs = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                counts = term_counts(text.as_py())
                if counts:
                    ids.append(doc_id)
                    ns.append(counts.total())
                    vecs.append(np.array(sorted((places[t], c) for t, c in counts.items() if t in places), _ENTRY).tobytes())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(vecs, pa.binary())], names=["doc_id", "n", "vec"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, n long, vec binary")


def _document_frequencies(rows: DataFrame, terms: int) -> np.ndarray:
    """In how many rows each of the terms occurs; at most one row for each term comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(terms, np.int64)
        for batch in batches:
            seen += np.bincount(np.frombuffer(b"".join(batch.column("vec").to_pylist()), _ENTRY)["t"], minlength=terms)
        at = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(at), pa.array(seen[at])], names=["t", "df"])

    found = rows.select("vec").mapInArrow(run, "t long, df long").groupBy("t").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(terms, np.int64)
    out[found["t"].to_numpy()] = found["df"].to_numpy()
    return out


def classes(rows: DataFrame, top: int) -> DataFrame:
    """(vec, m, members): one row per class of equal vector and m, with its `top` least ids at most."""
    keyed = rows.select(F.xxhash64("vec", "m").alias("h"), "vec", "m", "doc_id")
    by_id = Window.partitionBy("h", "vec", "m").orderBy(F.col("doc_id").asc_nulls_last())
    least = keyed.withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= top)
    # null ids are kept apart from the list: lists drop nulls
    return least.groupBy("h", "vec", "m").agg(F.array_sort(F.collect_list("doc_id")).alias("members"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).drop("h")


class _Best:
    """The `top` best classes of every item that one task has seen: by score, then by least id."""

    def __init__(self, top: int, items: int):
        self.top, self.floor = top, np.zeros(items, np.int64)
        self.rows = np.zeros((0, 4), np.int64)  # item, score, least id, class
        self.members: dict[int, tuple[list[int], int]] = {}

    def add(self, rows: np.ndarray, members: dict) -> None:
        rows = rows[rows[:, 1] >= np.maximum(self.floor[rows[:, 0]], 1)]
        if len(rows):
            self.rows = np.concatenate([self.rows, rows])
            self.members |= {c: members[c] for c in np.unique(rows[:, 3]).tolist()}
            if len(self.rows) > max(_HELD, 4 * self.top * len(self.floor)):
                self.cut()

    def cut(self) -> None:
        rows = self.rows[np.lexsort((self.rows[:, 3], self.rows[:, 2], -self.rows[:, 1], self.rows[:, 0]))]
        place = np.arange(len(rows)) - np.searchsorted(rows[:, 0], rows[:, 0])
        self.rows = rows[place < self.top]
        last = rows[place == self.top - 1]
        self.floor[last[:, 0]] = last[:, 1]
        live = set(self.rows[:, 3].tolist())
        self.members = {c: m for c, m in self.members.items() if c in live}


def _best_classes(found: DataFrame, items: _Items, weights: np.ndarray, top: int, n_items: int) -> DataFrame:
    """(item, score, members, nulls): for each item the best classes of every task, scored once."""
    shared = found.sparkSession.sparkContext.broadcast((items.first, items.item, items.times, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, item, times, w = shared.value
        held = np.diff(first)
        best, number = _Best(top, n_items), 0
        for batch in batches:
            vecs = [np.frombuffer(v, _ENTRY) for v in batch.column("vec").to_pylist()]
            ms, ids, nulls = batch.column("m").to_numpy(), batch.column("members").to_pylist(), batch.column("nulls").to_pylist()
            cost = np.cumsum([int(held[v["t"]].sum()) for v in vecs])
            at = 0
            while at < len(vecs):
                end = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + _POSTINGS)))
                part = np.concatenate(vecs[at:end])
                of = np.repeat(np.arange(at, min(end, len(vecs))), [len(v) for v in vecs[at:end]])
                t, tf = part["t"].astype(np.int64), part["tf"].astype(np.int64)
                gain = w[t] * ((1_000_000_000 * tf) // (1000 * tf + 8 * ms[of]))
                n = held[t]
                # every entry of a class meets the postings of its term
                post = np.repeat(first[t] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                key = np.repeat(of, n) * n_items + item[post]
                order = np.argsort(key, kind="stable")
                key, gains = key[order], (np.repeat(gain, n) * times[post])[order]
                if len(key):
                    starts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
                    score, c = np.add.reduceat(gains, starts), key[starts] // n_items
                    least = np.array([x[0] if x else np.iinfo(np.int64).max for x in ids], np.int64)
                    best.add(np.stack([key[starts] % n_items, score, least[c], c + number], axis=1), {number + c: (ids[c], nulls[c]) for c in range(at, min(end, len(vecs)))})
                at = end
            number += len(vecs)
        best.cut()
        rows = best.rows
        members = [best.members[c] for c in rows[:, 3].tolist()]
        yield pa.record_batch([pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array([m for m, _ in members], pa.list_(pa.int64())), pa.array([n for _, n in members], pa.int64())], names=["item", "score", "members", "nulls"])

    return found.mapInArrow(run, "item long, score long, members array<long>, nulls long")


def _search_block(spark: SparkSession, plain: DataFrame, block: list, top: int) -> DataFrame:
    items = _Items([r.text for r in block])
    rows = written(spark, vectors(plain, items.place), "lexical-vectors")
    total, length = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = _document_frequencies(rows, len(items.terms))
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    m = F.expr(f"100 - 75 + (75 * n * {total}L) div {max(1, length)}L")
    found = classes(rows.filter(F.octet_length("vec") > 0).withColumn("m", m), top)
    best = _best_classes(found, items, weights, top, len(block))
    first = F.coalesce(F.get("members", F.lit(0)), F.lit(2**63 - 1))
    best = best.withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), first, "nulls"))).filter(F.col("place") <= top)
    every = F.concat("members", F.array_repeat(F.lit(None).cast("long"), F.col("nulls").cast("int")))
    listed = best.select("item", "score", F.explode(every).alias("doc_id"))
    listed = listed.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))).filter(F.col("rank") <= top)
    ids = spark.createDataFrame([(k, r.item_id) for k, r in enumerate(block)], "item long, item_id long")
    return listed.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, top: int = TOP, items_mb: float = ITEMS_MB, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's `top` best documents with a score above 0."""
    plain = documents(docs, id_col, text_col)
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    size = asked.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = max(1, math.ceil(size / (items_mb * 1e6)))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count)))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for number in range(count):  # a query set beyond the bound is taken in blocks: each costs one pass over the documents
        block = asked.filter(F.col("block") == number).orderBy("item_id", "text").collect()  # about items_mb
        if block:
            out = out.unionByName(_search_block(spark, plain, block, top))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL = rf"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all({_LOW}, '{TERM}') ts from documents),
i as (select row_number() over () as i, item_id, regexp_extract_all({_LOW}, '{TERM}') ts from (select distinct item_id, text from benchmark)),
asked as (select i, t, count(*) times from (select i, unnest(ts) t from i) group by all),
tf as (select r, t, count(*) tf from (select r, unnest(ts) t from d) where t in (select t from asked) group by all),
total as (select count(*) docs, sum(len(ts))::bigint words from d where len(ts) > 0),
weight as (select t, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint w from tf, total group by t),
factor as (select r, doc_id, 25 + (75 * len(ts) * docs) // words m from d, total where len(ts) > 0),
scored as (select i, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint score from tf join asked using (t) join weight using (t) join factor using (r) group by all),
ranked as (select item_id, doc_id, score, row_number() over (partition by i order by score desc, doc_id) as rank from scored join i using (i) join factor using (r) where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= {TOP}
"""
