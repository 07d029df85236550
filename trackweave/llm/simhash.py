"""SimHash near-dedup by covering locality-sensitive hashing.

A fingerprint has 64 bits; a bit is 1 if more than half of the text's shingle hashes set it.  For radius r every bit gets
one of the 2^(r+1) - 1 non-zero vectors of r + 1 bits, evenly; the mask of a non-zero vector v keeps the bits whose vector
has an odd product with v.  The vectors of any r bits leave some v with even products to all of them, so two fingerprints
that differ in r bits or fewer are equal under some mask: every such pair meets in one of the 15 tables (r = 3), with no
chance involved.  A mask keeps about 34 of 64 bits, so fingerprints meet by accident about once in 2^34 pairs and table.

Scale
* One pass over the texts, in which words are never held but for a block of `SLICE` bytes; what is kept is 16 bytes a document.
* Equal fingerprints are one node (map-side combined), so copies cost nothing in what follows.
* Tables: 15 rows of 20 bytes for each different fingerprint; buckets with one fingerprint are dropped by a count.
* A bucket with more than `small` fingerprints is dealt out again, by covering masks of the bits its own mask leaves open.
  About 14 bits are open then, so a bucket of the second level holds 2^16 fingerprints at most, whatever the data.
* A bucket returns a forest of its links, at most one row a member, and never its pairs.  Components of the forests of all
  buckets are those of all links.

Defined cases: a null text is empty; without words the fingerprint is zero, and such rows link like any others.  One or
two words are one shingle.  Equal fingerprints are in one component; repeated rows are rows of their own with the same
result.  component_id is the least id of the component; null ids count only where there is no other, and then it is null.
A very long text is read in blocks and gives one fingerprint.  An empty table gives an empty result; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, drop, table, written
from .near_join import connected
from .words import SLICE, blocks

SHINGLE, SEED, RADIUS, SMALL = 3, 42, 3, 512


def _ones(hashes: list[int]) -> np.ndarray:
    """How many of the hashes set each of the 64 bits."""
    rows = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, k: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text's shingles, A-Z lower-cased, as an unsigned number."""
    xxh, join = xxhash.xxh64_intdigest, b" ".join
    total, n, held = np.zeros(64, np.int64), 0, []
    for block in blocks(text, SLICE):
        words = held + block.lower().split()
        shingles = zip(*(words[i:] for i in range(k)), strict=False)
        if hashes := [xxh(join(s), seed) for s in shingles]:
            total += _ones(hashes)
            n += len(hashes)
        held = words[-(k - 1) :] if k > 1 else []
    if not n and held:
        total, n = _ones([xxh(join(held), seed)]), 1
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), k) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield pa.record_batch([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    plain = documents(docs, id_col, text_col)
    return plain.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, fp long")


def covering(bits: list[int], radius: int) -> list[int]:
    """Masks over the given bit places such that, wherever two numbers differ in `radius` of these places or fewer, some
    mask keeps none of them."""
    vectors = range(1, 2 ** (radius + 1))
    of = {bit: vectors[j % len(vectors)] for j, bit in enumerate(bits)}
    return [sum(1 << bit for bit, x in of.items() if (x & v).bit_count() % 2) for v in vectors]


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def forest(fps: np.ndarray, radius: int) -> np.ndarray:
    """Rows (root, member) for all but the first member of every component of links among different fingerprints."""
    out, left = [fps[:0]], fps
    roots = [fps[:0]]
    while len(left):
        root, queue, left = left[:1], [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= radius
            if near.any():
                found, left = left[near], left[~near]
                queue += list(found)
                out.append(found)
                roots.append(np.repeat(root, len(found)))
    return np.stack([np.concatenate(roots), np.concatenate(out)], axis=1)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Rows (mask, bits, fp) of a sorted partition, never cut within equal (mask, bits)."""
    held = np.zeros((0, 3), np.int64)
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("mask", "bits", "fp")], axis=1)
        rows = np.concatenate([held, rows])
        same = (rows[:, :2] == rows[-1, :2]).all(axis=1) if len(rows) else np.zeros(0, bool)
        cut = len(rows) - int(np.argmin(same[::-1])) if len(rows) and not same.all() else 0
        if cut:
            yield rows[:cut]
        held = rows[cut:]
    if len(held):
        yield held


def links(nodes: DataFrame, radius: int = RADIUS, small: int = SMALL) -> DataFrame:
    """(a, b): edges that connect exactly the different fingerprints `fp` (one row each) that chains of at most `radius`
    differing bits connect."""
    spark = nodes.sparkSession
    tables = covering(list(range(64)), radius)
    inner = [m | i for m in tables for i in covering([b for b in range(64) if not m >> b & 1], radius)]

    def dealt(df: DataFrame, masks: list[int], first: Column, number: Column) -> DataFrame:
        """Each row under all masks of one family, `first` being the place of that family in `masks`."""
        every = F.sequence(F.lit(0), F.lit(len(tables) - 1))
        lits = F.array(*[F.lit(_signed(m)) for m in masks])
        keys = F.transform(every, lambda u: F.struct((number + u).cast("int").alias("mask"), F.get(lits, first + u).bitwiseAND(F.col("fp")).alias("bits")))
        return df.select("fp", F.explode(keys).alias("k")).select("k.mask", "k.bits", "fp")

    entries = dealt(nodes, tables, F.lit(0), F.lit(0))
    sizes = entries.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    sized = written(spark, entries.join(sizes, ["mask", "bits"]), "simhash-buckets")
    # a large bucket's fingerprints agree on its table's mask: deal them out by that and the masks of the open bits
    family = F.col("mask") * len(tables)
    again = dealt(sized.filter(F.col("size") > small), inner, family, family + len(tables))
    met = sized.filter(F.col("size") <= small).select("mask", "bits", "fp").unionByName(again)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_groups(batches):
            cuts = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
            first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(rows)]])
            fp = rows[:, 2].copy().view(np.uint64)
            two = first[last - first == 2]
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius]
            found = [np.stack([fp[two], fp[two + 1]], axis=1)]
            more = last - first > 2
            found += [forest(fp[s:e], radius) for s, e in zip(first[more].tolist(), last[more].tolist(), strict=True)]
            out = np.concatenate(found).view(np.int64)
            yield pa.record_batch([pa.array(out[:, j]) for j in (0, 1)], names=["a", "b"])

    found = written(spark, met.repartition("mask", "bits").sortWithinPartitions("mask", "bits", "fp").mapInArrow(compare, "a long, b long"), "simhash-links")
    drop(sized)
    return found


def near_duplicates(spark: SparkSession, docs: DataFrame, radius: int = RADIUS, k: int = SHINGLE, small: int = SMALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 lower-case hex digits), component_id."""
    rows = written(spark, fingerprints(docs, k, id_col, text_col), "simhash-rows")
    nodes = written(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    found = links(nodes, radius, small)
    groups = connected(spark, found)
    labels = groups.withColumnRenamed("node", "fp")
    heads = labels.join(nodes, "fp").groupBy("label").agg(F.min("least").alias("head"))
    linked = labels.join(heads, "label").select("fp", "head")
    each = written(spark, nodes.join(linked, "fp", "left").select("fp", F.coalesce("head", "least").alias("component_id")), "simhash-components")
    for used in (found, nodes, groups):
        drop(used)
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(each, "fp").select("doc_id", text.alias("fingerprint"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))
