"""N-gram Jaccard self-join by chosen paths.

A text is its set of 5-word shingles.  In each of the runs every set chooses, from its own tokens and by
a hash all sets share, about 1/threshold of them; each chosen token is a bucket.  Two sets of Jaccard
similarity >= threshold meet in one bucket more per run on average.  A bucket with more than `small`
sets is split again by tokens chosen under a hash of the path so far, up to `depth` levels; what is small, or
left at the last level, is compared within the bucket.  A pair at the threshold meets with probability
>= 0.63, 0.47, 0.37 per run at levels 1, 2, 3; `runs_for` repeats runs until the target recall holds for a pair
that is split all the way down (16 runs and 0.999 at 0.8 and three levels).

Comparing: each set carries a parity sketch (one bit per token hash, about as many bits as tokens).  The
number of bits in which two sketches differ never exceeds the number of tokens in which the sets differ,
so the sketch rejects pairs without losing any; the rest are compared exactly, on their whole sets.

Scale
* Texts with equal shingle sets collapse to one before anything is compared (map-side combined).
* One pass over the texts makes first-level buckets and sketches.  Deeper paths are chosen only for sets in buckets
  that are too large, and whole sets are made again only where a sketch allows a pair.
* Buckets of one set, nearly all, are dropped by a count.  No pairs are emitted: a bucket returns one row per
  member (number of links, label of the linked component inside the bucket), and a pair that meets in
  several buckets counts in the first one they share.
* A bucket left with more than `2 * block` sets is compared in pairs of blocks, each a task of its own, so no group
  is gathered in one task; nothing is capped or dropped.  Inside one family of n different texts that all are near
  copies of each other this takes n * n / 2 comparisons of sketches, as every text's links are counted.
* Classes are connected components of the links, found by label propagation with shortcuts over tables in
  the shared folder; tables that are no longer needed are deleted.

Defined cases: a null text is empty.  Texts of 1 to 4 words have one shingle, all their words; all texts without
words form one class.  class_id is the least id of the class (null ids only count if there is no
other).  n_links counts the different shingle sets linked to the document's own, n_copies the other rows
with the same set.  Repeated rows are copies.  Very long texts are read in blocks and are one set.  An empty table
gives an empty result; other columns, whatever their names, are ignored.  A shingle is a 64-bit hash of its words
that no relation between words makes collide, a set's identity is 128 bits of BLAKE2b over its shingles.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, drop, give_back, table, written
from .words import BASES, SLICE, hash_words, mix, slices, windows

SHINGLE, THRESHOLD, RECALL = 5, 0.8, 0.999
#: Buckets of up to `SMALL` sets are compared as they are: splitting would cost more than comparing sketches.
DEPTH, SMALL, BLOCK = 3, 256, 1024
_SEEDS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def meeting(depth: int) -> float:
    """The least probability that a pair at the threshold meets at this level in one run."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    return p


def runs_for(recall: float = RECALL, depth: int = DEPTH) -> int:
    """How many runs make a pair at the threshold meet with probability `recall`, however deep its buckets are split."""
    return min(200, math.ceil(math.log(1 - recall) / math.log(1 - meeting(depth))))


def shingle_sets(texts: list[str], k: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw = [t.encode() for t in texts]
    for a, b in slices(raw):
        (hashes,), offsets = hash_words(raw[a:b])
        (grams,) = windows(hashes, k)
        for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if e - s >= k:
                yield np.unique(grams[s : e - k + 1])
            elif e > s:
                yield windows(hashes[s:e], e - s, base=BASES[1])[0]
            else:
                yield hashes[:0]


def set_ids(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that only equal sets share."""
    return tuple(np.frombuffer(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest(), "<i8").tolist())


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """Packed bits, a power of two of at least 64 and about as many as tokens."""
    bits = 1 << max(6, (len(tokens) - 1).bit_length())
    counts = np.bincount((mix(tokens ^ _SEEDS[200]) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def chosen(tokens: np.ndarray, paths: np.ndarray, threshold: float) -> np.ndarray:
    """The keys of the children that a set chooses below each of `paths`."""
    if not len(tokens) or not len(paths):
        return tokens[:0]
    limit = np.uint64(min(2**64 - 1, int(2**64 / (threshold * len(tokens)))))
    part = max(1, 100_000 // len(paths))
    found = []
    for at in range(0, len(tokens), part):
        h = mix(tokens[None, at : at + part] ^ paths[:, None])
        i, j = np.nonzero(h <= limit)
        found.append(mix(h[i, j] + paths[i]))
    return np.concatenate(found)


def _batches(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[list[pa.RecordBatch]]:
    """Batches of a partition sorted by `name`, cut so that no group of equal values is split."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(name).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1])) if (keys[:-1] <= keys[1:]).all() else 0
        if cut or (held and held[-1].column(name)[-1].as_py() != keys[0]):
            yield [*held, batch.slice(0, cut)]
            held = []
        held.append(batch.slice(cut))
    if held:
        yield held


def _hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between all rows of two arrays of packed bits; the longer rows are folded to the shorter ones' length."""
    while a.shape[1] > b.shape[1]:
        a = a[:, : a.shape[1] // 2] ^ a[:, a.shape[1] // 2 :]
    while b.shape[1] > a.shape[1]:
        b = b[:, : b.shape[1] // 2] ^ b[:, b.shape[1] // 2 :]
    out = np.zeros((len(a), len(b)), np.int32)
    for w in range(a.shape[1]):
        out += np.bitwise_count(a[:, w][:, None] ^ b[:, w][None, :])
    return out


def _pairs(rows: dict, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (i < j) of one group that no size or sketch rules out and that this bucket owns."""
    n, words = rows["n"], np.array([len(s) for s in rows["sketch"]]) // 8
    most = (1 - threshold) / (1 + threshold)
    out_i, out_j = [], []
    classes = sorted(set(words.tolist()))
    for x, wa in enumerate(classes):
        for wb in classes[x : x + 2]:
            ia, ib = np.flatnonzero(words == wa), np.flatnonzero(words == wb)
            sa, sb = (np.frombuffer(b"".join([rows["sketch"][i] for i in ids]), np.uint64).reshape(len(ids), -1) for ids in (ia, ib))
            for at in range(0, len(ia), 512):
                near = _hamming(sa[at : at + 512], sb) <= most * (n[ia[at : at + 512]][:, None] + n[ib][None, :]) + 1e-9
                i, j = np.nonzero(near)
                i, j = ia[at + i], ib[j]
                ok = i < j if wa == wb else np.ones(len(i), bool)
                out_i.append(np.minimum(i, j)[ok])
                out_j.append(np.maximum(i, j)[ok])
    i, j = np.concatenate(out_i), np.concatenate(out_j)
    ok = (np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]) - 1e-9) & (rows["no"][i] != rows["no"][j])
    if rows["part"] is not None:  # a block pair: only across its two blocks, or within the one
        first, second = rows["pair"]
        ok &= (rows["part"][i] != rows["part"][j]) if first != second else True
    i, j = i[ok], j[ok]
    if not len(i):
        return i, j
    earlier = [frozenset(x for x in b if x < rows["bucket"]) for b in rows["buckets"]]
    if len(i) < 64:
        mine = np.array([earlier[a].isdisjoint(earlier[b]) for a, b in zip(i.tolist(), j.tolist(), strict=True)])
    else:
        ids = {x: k for k, x in enumerate(set().union(*earlier))}
        member = np.zeros((len(earlier), len(ids) + 1), np.float32)
        for k, own in enumerate(earlier):
            member[k, [ids[x] for x in own]] = 1
        mine = np.concatenate([((member[at : at + 512] @ member.T) == 0)[i[s] - at, j[s]] for at in range(0, len(earlier), 512) if len(s := np.flatnonzero((i >= at) & (i < at + 512)))])
        order = np.concatenate([s for at in range(0, len(earlier), 512) if len(s := np.flatnonzero((i >= at) & (i < at + 512)))])
        i, j = i[order], j[order]
    return i[mine], j[mine]


def _verified(tokens: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which candidate pairs reach the threshold, from the whole sets."""
    sizes = np.array([len(t) for t in tokens])
    if len(i) < 8:
        inter = np.array([len(np.intersect1d(tokens[a], tokens[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist(), strict=True)])
    else:
        flat = np.concatenate(tokens)
        owner = np.repeat(np.arange(len(tokens)), sizes)
        _, column, counts = np.unique(flat, return_inverse=True, return_counts=True)
        shared = counts[column] > 1  # a token of one set is in no intersection
        renumber = np.cumsum(counts > 1) - 1
        owner, column, width = owner[shared], renumber[column[shared]], int((counts > 1).sum())
        inter = np.zeros(len(i), np.int64)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for at in range(0, width, 2048):
            lo, hi = np.searchsorted(column, [at, at + 2048])
            block = np.zeros((len(tokens), min(2048, width - at)), np.float32)
            block[owner[lo:hi], column[lo:hi] - at] = 1
            for a in range(0, len(tokens), 1024):
                s = np.flatnonzero((i >= a) & (i < a + 1024))
                if len(s):
                    inter[s] += (block[a : a + 1024] @ block.T)[i[s] - a, j[s]].astype(np.int64)
    return inter / (sizes[i] + sizes[j] - inter) >= threshold


def _components(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    label = np.arange(size)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            return label
        label = low


_GROUP = ["group", "bucket", "first", "second", "part", "no", "n", "sketch", "buckets"]


def _groups(held: list[pa.RecordBatch]) -> Iterator[dict]:
    """One dictionary of columns per value of `group`."""
    t = pa.Table.from_batches(held)
    keys = t["group"].to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
    cols = {c: t[c].to_numpy() for c in ("bucket", "first", "second", "part", "no", "n")}
    lists = {c: t[c].to_pylist() for c in ("sketch", "buckets", *(x for x in ("tokens",) if x in t.column_names))}
    for s, e in zip(cuts[:-1], cuts[1:], strict=True):
        # a 64-bit group number could stand for two groups: take them apart
        names = set(zip(cols["bucket"][s:e].tolist(), cols["first"][s:e].tolist(), cols["second"][s:e].tolist(), strict=True))
        for bucket, first, second in names:
            at = np.arange(s, e)
            if len(names) > 1:
                at = at[(cols["bucket"][s:e] == bucket) & (cols["first"][s:e] == first) & (cols["second"][s:e] == second)]
            _, once = np.unique(cols["no"][at], return_index=True)
            at = at[once]
            yield {c: cols[c][at] for c in ("no", "n")} | {c: [v[x] for x in at] for c, v in lists.items()} | {"bucket": bucket, "pair": (first, second), "part": cols["part"][at] if first >= 0 else None, "rows": at, "table": t}


def _small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most 512 rows and, but for single rows, about `SLICE` bytes of text."""
    for whole in batches:
        sizes = np.cumsum(pc.binary_length(whole.column("text")).to_numpy(zero_copy_only=False))
        at = 0
        while at < whole.num_rows:
            end = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE))
            end = min(max(end, at + 1), at + 512, whole.num_rows)
            yield whole.slice(at, end - at)
            at = end


def near_classes(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE, runs: int | None = None, depth: int = DEPTH, small: int = SMALL, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, n_links, n_copies."""
    return _classed(spark, docs, threshold, k, runs, depth, small, block, id_col, text_col).drop("tkey", "label")


def _classed(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD, k: int = SHINGLE, runs: int | None = None, depth: int = DEPTH, small: int = SMALL, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As `near_classes`, with the hash of the text as `tkey` and a number of the class as `label`."""
    plain = documents(docs, id_col, text_col).withColumn("tkey", F.xxhash64("text"))
    seeds = _SEEDS[: runs or runs_for(depth=depth)]

    # 1. one pass over the texts; those with equal sets are one, numbered in a written table
    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small_batches(batches):
            sets = list(shingle_sets(batch.column("text").to_pylist(), k))
            ids = [set_ids(t) for t in sets]
            keys = [chosen(t, seeds, threshold).view(np.int64) for t in sets]
            columns = [batch.column("doc_id"), batch.column("tkey"), *(pa.array([x[j] for x in ids], pa.int64()) for j in (0, 1)), pa.array([len(t) for t in sets], pa.int64()), pa.array([parity_sketch(t).tobytes() if len(t) else b"" for t in sets], pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, names=["doc_id", "tkey", "sid", "sid2", "n", "sketch", "keys"])
        give_back()

    rows = written(spark, plain.mapInArrow(first_pass, "doc_id long, tkey long, sid long, sid2 long, n long, sketch binary, keys array<long>"), "near-rows")
    # one row stands for a set; its text's hash beside its id finds it again, also where ids are null or repeated
    text_of = F.min_by(F.struct("doc_id", "tkey"), F.struct(F.col("doc_id").isNull(), "doc_id", "tkey"))
    sets = rows.groupBy("sid", "sid2").agg(F.min("doc_id").alias("least"), text_of.alias("text_of"), F.count(F.lit(1)).alias("copies"), *(F.first(c).alias(c) for c in ("n", "sketch", "keys")))
    sets = written(spark, sets.withColumn("no", F.monotonically_increasing_id()), "near-sets")

    def of_sets(wanted: DataFrame, make: Callable[[int, np.ndarray, dict], list[tuple]], extra: list[str], schema: str) -> DataFrame:
        """Rows that `make` gives for the numbered sets in `wanted`, from one text of each."""
        names = [x.split()[0] for x in schema.split(", ")]
        kinds = [{"long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()  # rows that repeat id and text come to one partition
            for batch in _small_batches(batches):
                cols = {c: batch.column(c).to_pylist() for c in ("no", "sid", "sid2", *extra)}
                out: list[tuple] = []
                for i, tokens in enumerate(shingle_sets(batch.column("text").to_pylist(), k)):
                    no = cols["no"][i]
                    if no not in seen and set_ids(tokens) == (cols["sid"][i], cols["sid2"][i]):
                        seen.add(no)
                        out += make(no, tokens, {c: cols[c][i] for c in extra})
                yield _record(out, names, kinds)
            give_back()

        own = wanted.join(sets.select("no", "text_of.*", "sid", "sid2").withColumnsRenamed({"doc_id": "of_id", "tkey": "of_text"}), "no")
        return own.join(plain, own["of_id"].eqNullSafe(plain["doc_id"]) & (own["of_text"] == plain["tkey"])).select("no", "sid", "sid2", *extra, "text").mapInArrow(run, schema)

    # 2. buckets, level by level; only those that are too large are split again
    nodes, closed, scratch = sets.select("no", F.explode("keys").alias("bucket")), [], []
    for level in range(1, depth + 1):
        sizes = nodes.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        sized = written(spark, nodes.join(sizes, "bucket"), f"near-level{level}")
        scratch.append(sized)
        large = sized.filter(F.col("size") > small)
        if level == depth or large.isEmpty():
            closed.append(sized)
            break
        closed.append(sized.filter(F.col("size") <= small))
        paths = large.groupBy("no").agg(F.collect_list("bucket").alias("paths"))  # about 5/4 per run and level
        split = lambda no, tokens, row: [(no, key) for key in chosen(tokens, np.array(row["paths"], np.int64).view(np.uint64), threshold).view(np.int64).tolist()]
        nodes = written(spark, of_sets(paths, split, ["paths"], "no long, bucket long"), f"near-paths{level + 1}")
        scratch.append(nodes)
    entries = closed[0].select("bucket", "no", "size")
    for more in closed[1:]:
        entries = entries.unionByName(more.select("bucket", "no", "size"))

    # 3. what is compared: each member with its sketch and the list of its buckets (at most a few per run)
    lists = entries.groupBy("no").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))
    known = written(spark, lists.join(sets.select("no", "n", "sketch"), "no").select("no", "n", "sketch", "buckets"), "near-sketches")
    parts = F.ceil(F.col("size") / block).cast("int")
    whole = entries.filter(F.col("size") <= 2 * block).select("bucket", F.lit(-1).alias("first"), F.lit(-1).alias("second"), F.lit(-1).alias("part"), "no")
    cut = entries.filter(F.col("size") > 2 * block).withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("no"), F.col("parts")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("bucket", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"), "part", "no")
    grouped = whole.unionByName(cut).join(known, "no").withColumn("group", F.xxhash64("bucket", "first", "second")).select(*_GROUP)

    # 4. in each bucket: the members with a pair that it owns and that the sketches allow
    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _batches(batches, "group"):
            take, t = [], None
            for group in _groups(held):
                i, j = _pairs(group, threshold)
                t = group["table"]
                take += group["rows"][np.union1d(i, j)].tolist()
            if take:
                yield from t.take(pa.array(take)).combine_chunks().to_batches()
        give_back()

    by_group = lambda df: df.repartition("group").sortWithinPartitions("group")
    wanted = written(spark, by_group(grouped).mapInArrow(filtered, grouped.schema), "near-wanted")

    # 5. their whole sets; exact comparison; one row per member
    tokens = of_sets(wanted.select("no").distinct(), lambda no, tokens, _: [(no, tokens.tobytes())], [], "no long, tokens binary")
    full = by_group(wanted.join(tokens, "no"))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _batches(batches, "group"):
            out = []
            for group in _groups(held):
                i, j = _pairs(group, threshold)
                if len(i):
                    ok = _verified([np.frombuffer(x, np.uint64) for x in group["tokens"]], i, j, threshold)
                    i, j = i[ok], j[ok]
                if len(i):
                    no = group["no"]
                    degree = np.bincount(np.concatenate([i, j]), minlength=len(no))
                    label = _components(len(no), i, j)
                    out += [(int(no[x]), int(no[label[x]]), int(degree[x])) for x in np.flatnonzero(degree)]
            yield _record(out, ["no", "hub", "links"], [pa.int64()] * 3)
        give_back()

    found = written(spark, full.mapInArrow(linked, "no long, hub long, links long"), "near-links")
    for used in (*scratch, known, wanted):
        drop(used)

    # 6. classes
    labels = connected(spark, found.select(F.col("no").alias("a"), F.col("hub").alias("b")))
    links = found.groupBy("no").agg(F.sum("links").alias("n_links"))
    classed = sets.select("no", "sid", "sid2", "least", "copies").join(labels.withColumnRenamed("node", "no"), "no", "left").join(links, "no", "left").select("sid", "sid2", "least", "copies", F.coalesce("label", "no").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    heads = classed.groupBy("label").agg(F.min("least").alias("class_id"))
    per_set = classed.join(heads, "label").select("sid", "sid2", "label", "class_id", "n_links", (F.col("copies") - 1).alias("n_copies"))
    out = written(spark, rows.select("doc_id", "tkey", "sid", "sid2").join(per_set, ["sid", "sid2"]).select("doc_id", "tkey", "label", "class_id", "n_links", "n_copies"), "near-classes")
    for used in (rows, sets, found, labels):
        drop(used)
    return out


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of `docs` of each class, all columns unchanged, whatever their names: that with the least id (null ids only where
    there is no other; of rows that repeat an id the one whose text has the least hash; of rows that repeat both, one).
    Rows are told apart by id and text, as `near_classes` does; where some repeat both, one more shuffle takes them out."""
    rows = _classed(spark, docs, id_col=id_col, text_col=text_col, **options)
    row = F.struct("doc_id", "tkey")
    kept = rows.groupBy("label").agg(F.min_by(row, F.struct(F.col("doc_id").isNull(), "doc_id", "tkey")).alias("r"))
    kept = kept.select(F.col("r.doc_id").alias("kept_of_id"), F.col("r.tkey").alias("kept_of_text"))
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tkey"))
    stays = whole.join(kept, whole["id"].eqNullSafe(kept["kept_of_id"]) & (whole["tkey"] == kept["kept_of_text"]), "left_semi")
    if not rows.groupBy("doc_id", "tkey").count().filter("count > 1").isEmpty():
        first = Window.partitionBy("id", "tkey").orderBy(F.xxhash64("row"))
        stays = stays.withColumn("place", F.row_number().over(first)).filter("place = 1")
    return stays.select("row.*")


def _record(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def connected(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each node's component; edges (a, b) of longs.  Each round takes the least label
    among neighbours and then the label of that label; a round's table in the shared folder replaces the one before."""
    both = written(spark, edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    now = written(spark, both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "cc-labels")
    while True:
        labels = now.select("node", "label")
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        roots = labels.select(F.col("node").alias("root"), F.col("label").alias("up"))
        new = written(spark, step.join(roots, step["label"] == roots["root"], "left").select("node", "old", F.least("label", F.coalesce("up", "label")).alias("label")), "cc-labels")
        drop(now)
        now = new
        if new.filter("old <> label").isEmpty():
            drop(both)
            out = new.select("node", "label")
            out.scratch_path = new.scratch_path
            return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(spark, table(spark, sf_dir, "documents"))
