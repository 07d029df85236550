"""Substring dedup by recompression: words covered by a passage that starts in an earlier document are removed.

Each document is a row of word names (64-bit hashes, the same everywhere).  Two rounds of recompression
replace neighbouring pairs by names: a hash of the name puts it on the left or the right side, and a left
name followed by a right one becomes one symbol, whose name is made from theirs.  Whether a pair is joined
depends on nothing but the two names, so in equal stretches all symbols but those near the ends are equal.
A symbol of the second round has at most 4 words, and the one that covers the middle of a 13-word window is
fixed by the window alone.  So every window belongs to the symbol over its middle, and equal windows to
equal symbols at equal places.  All windows of one symbol share the `window + 1 - length` words around it: the
symbol's high-level name is made from them.

Spark's rounds: (1) high-level names are dealt out by name and those that occur in two groups of documents are
marked; (2) the windows of marked symbols are verified: 128 bits of BLAKE2b over a window's own words are dealt
out to find the least document in which each starts, so two names that happen to be equal only cost work; (3) each
document removes what its marked windows cover.

Runs of one word are left as they are (a run's names never pair up): collapsing a long run to one symbol, as
recompression does elsewhere, would leave windows inside the run without a symbol of their own.

Scale
* Text is shuffled once, into groups of about `group_mb` by a hash of id and text; all three rounds work on
  these groups.  What moves between groups and buckets are packed arrays: 6 bytes per distinct name of a group,
  16 per distinct window of a marked symbol, and one bit each on the way back.  A group sends a row only to the
  buckets for which it has something, so rows never outnumber names or windows.
* A passage that a third of all documents hold is one entry per group (combined before the shuffle), so no
  task sees more than one entry per group of it.
* Groups and buckets grow in number with the input, not in size.

Defined cases: a null text is empty; documents of fewer than 13 words keep all.  Documents are compared by id;
null ids come before all others; a passage repeated only within one document, or in rows with the same id,
stays.  A very long text is one row of one group, read in blocks.  An empty table gives an empty result; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_SQL, documents, groups_for, table
from .words import BASES, hash_words, mix, slices, windows

WINDOW, GROUP_MB = 13, 6.0
NULL_ID = -(2**63)


class Parsed:
    """A group's documents, in order of id and text, as words and second-round symbols."""

    def __init__(self, rows: pa.Table, window: int):
        order = sorted(zip(rows["doc_id"].to_pylist(), (b" ".join(t.encode().split()) for t in rows["text"].to_pylist()), strict=True), key=lambda x: (NULL_ID if x[0] is None else x[0], x[1]))
        self.ids, self.texts = [x[0] for x in order], [x[1] for x in order]
        self.keys = np.array([NULL_ID if x is None else x for x in self.ids], np.int64)
        parts, sizes = [], []
        for a, b in slices(self.texts):
            (hashes,), offsets = hash_words(self.texts[a:b])
            parts.append(hashes)
            sizes.append(np.diff(offsets))
        self.sizes = np.concatenate([*sizes, np.zeros(0, np.int64)])
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        self.names = np.concatenate([*parts, np.zeros(0, np.uint64)])
        self.doc = np.repeat(np.arange(len(self.ids)), self.sizes)
        self.window, self.middle = window, (window - 1) // 2
        self._symbols()

    def _symbols(self) -> None:
        name, first = self.names, np.arange(len(self.doc))
        size = np.ones(len(name), np.int64)
        for turn in (1, 2):
            right = (mix(name ^ np.uint64(turn)) & np.uint64(1)).astype(bool)
            doc = self.doc[first]
            joined = np.zeros(len(name), bool)
            joined[:-1] = ~right[:-1] & right[1:] & (doc[:-1] == doc[1:])
            taken = np.roll(joined, 1)
            taken[:1] = False
            pair = mix(mix(name[:-1] * np.uint64(BASES[0]) + np.uint64(turn)) ^ name[1:])
            name = np.where(joined, np.append(pair, np.uint64(0))[: len(name)], name)[~taken]
            size = (size + np.where(joined, np.append(size[1:], 0), 0))[~taken]
            first = first[~taken]
        # the words that all windows of a symbol share
        a, b = first + size - 1 - self.middle, first - self.middle + self.window
        doc = self.doc[first]
        fits = (a >= self.begins[doc]) & (b <= self.ends[doc])
        self.first, self.size, a = first[fits], size[fits], a[fits]
        self.high = np.zeros(len(a), np.uint64)
        lengths = [self.window + 1 - s for s in (4, 3, 2, 1)]
        for length, stretch in zip(lengths, windows(self.names, *lengths), strict=True):
            own = self.size == self.window + 1 - length
            self.high[own] = stretch[a[own]]
        self.unique, self.number = np.unique(self.high, return_inverse=True)

    def in_two_documents(self) -> np.ndarray:
        """Which of the unique high-level names stand in documents of different ids here."""
        key = self.keys[self.doc[self.first]]
        low, high = np.full(len(self.unique), np.iinfo(np.int64).max), np.full(len(self.unique), np.iinfo(np.int64).min)
        np.minimum.at(low, self.number, key)
        np.maximum.at(high, self.number, key)
        return low < high

    def _digests(self, starts: np.ndarray) -> np.ndarray:
        """128 bits over the words of each window, as two columns of 64-bit numbers."""
        text = b" ".join([t for t in self.texts if t])
        space = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        begins, ends = np.concatenate([[0], space + 1]), np.append(space, len(text))
        digest = hashlib.blake2b
        out = b"".join([digest(text[a:b], digest_size=16).digest() for a, b in zip(begins[starts].tolist(), ends[starts + self.window - 1].tolist(), strict=True)]) if len(starts) else b""
        return np.frombuffer(out, "<u8").reshape(-1, 2)

    def marked_windows(self, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts of all windows of marked symbols; the distinct windows' digests and least document; number of each start."""
        take = marked[self.number]
        first, size = self.first[take], self.size[take]
        starts = np.repeat(first - self.middle, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        doc = self.doc[np.repeat(first, size)]
        ok = (starts >= self.begins[doc]) & (starts + self.window <= self.ends[doc])
        starts, doc = starts[ok], doc[ok]
        one, two = self._digests(starts).T
        order = np.lexsort((doc, two, one))
        one, two, doc = one[order], two[order], doc[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        number = np.empty(len(one), np.int64)
        number[order] = np.cumsum(new) - 1
        return starts, one[new], two[new], self.keys[doc[new]], number


def _by_bucket(names: np.ndarray, bits: int) -> np.ndarray:
    """Where each of 2**bits buckets, by the names' first bits, begins in sorted names (one more at the end)."""
    return np.searchsorted(names >> np.uint64(64 - bits) if bits else np.zeros(len(names), np.uint64), np.arange((1 << bits) + 1))


def _low_bytes(x: np.ndarray, width: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _from_bytes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _bits(rows: pa.Table, kind: int, cuts: np.ndarray) -> np.ndarray:
    """The bits that came back for each bucket, put in order."""
    out = np.zeros(cuts[-1], bool)
    for k, bucket, data in zip(rows["kind"].to_pylist(), rows["bucket"].to_pylist(), rows["bits"].to_pylist(), strict=True):
        if k == kind:
            n = cuts[bucket + 1] - cuts[bucket]
            out[cuts[bucket] : cuts[bucket + 1]] = np.unpackbits(np.frombuffer(data, np.uint8), count=n)
    return out


_MARKS = pa.schema([("g", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())])


def remove_repeats(docs: DataFrame, window: int = WINDOW, group_mb: float = GROUP_MB, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (and the kept text itself if `keep_text`)."""
    if window < 13:
        raise ValueError("a window must have 13 words, so that its middle symbol depends on nothing outside")
    plain = documents(docs, id_col, text_col)
    groups = groups_for(plain, "text", group_mb)
    bits = max(0, (groups - 1).bit_length() - 1)  # a bucket gets as much as two groups send
    grouped = plain.withColumn("g", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int"))

    def names(rows: pa.Table) -> pa.Table:  # round 1, out: the group's distinct high-level names
        own = Parsed(rows, window)
        cuts = _by_bucket(own.unique, bits)
        sent = np.flatnonzero(np.diff(cuts))
        data = [_low_bytes((own.unique[cuts[k] : cuts[k + 1]] << np.uint64(bits)) >> np.uint64(16), 6) for k in sent]
        return pa.table({"bucket": pa.array(sent, pa.int32()), "g": pa.array([rows["g"][0].as_py()] * len(sent), pa.int32()), "names": pa.array(data, pa.binary())})

    def shared(rows: pa.Table) -> pa.Table:  # round 1, back: which of them other groups have too
        each = [_from_bytes(x, 6) for x in rows["names"].to_pylist()]
        _, number, counts = np.unique(np.concatenate(each), return_inverse=True, return_counts=True)
        found = np.split(counts[number] > 1, np.cumsum([len(x) for x in each])[:-1])
        return pa.table([rows["g"], pa.array([0] * len(each), pa.int32()), rows["bucket"], pa.array([np.packbits(x).tobytes() for x in found], pa.binary())], schema=_MARKS)

    def marked(own: Parsed, marks: pa.Table) -> np.ndarray:
        return _bits(marks, 0, _by_bucket(own.unique, bits)) | own.in_two_documents()

    def found(rows: pa.Table, marks: pa.Table) -> pa.Table:  # round 2, out: distinct windows and their least document
        columns = {"bucket": [], "g": [], "windows": [], "ids": [], "counts": []}
        if rows.num_rows:
            own = Parsed(rows, window)
            _, one, two, key, _ = own.marked_windows(marked(own, marks))
            cuts = _by_bucket(one, bits)
            for bucket in np.flatnonzero(np.diff(cuts)):
                a, b = cuts[bucket], cuts[bucket + 1]
                order = np.argsort(key[a:b], kind="stable")  # by document: its id is then sent once
                ids, counts = np.unique(key[a:b], return_counts=True)
                columns["bucket"].append(bucket)
                columns["g"].append(rows["g"][0].as_py())
                columns["windows"].append(one[a:b][order].tobytes() + two[a:b][order].tobytes())
                columns["ids"].append(ids)
                columns["counts"].append(counts)
        kinds = {"bucket": pa.int32(), "g": pa.int32(), "windows": pa.binary(), "ids": pa.list_(pa.int64()), "counts": pa.list_(pa.int64())}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in columns.items()})

    def least(rows: pa.Table) -> pa.Table:  # round 2, back: which of them start in an earlier document of another group
        one, two, key, sizes = [], [], [], []
        for data, ids, counts in zip(rows["windows"].to_pylist(), rows["ids"].to_pylist(), rows["counts"].to_pylist(), strict=True):
            n = len(data) // 16
            one.append(np.frombuffer(data, "<u8", n))
            two.append(np.frombuffer(data, "<u8", n, 8 * n))
            key.append(np.repeat(np.array(ids, np.int64), np.array(counts, np.int64)))
            sizes.append(n)
        one, two, key = np.concatenate(one), np.concatenate(two), np.concatenate(key)
        order = np.lexsort((key, two, one))
        new = np.ones(len(one), bool)
        new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
        lowest = key[order][new][np.cumsum(new) - 1]
        earlier = np.empty(len(one), bool)
        earlier[order] = lowest < key[order]
        parts = np.split(earlier, np.cumsum(sizes)[:-1])
        return pa.table([rows["g"], pa.array([1] * len(parts), pa.int32()), rows["bucket"], pa.array([np.packbits(x).tobytes() for x in parts], pa.binary())], schema=_MARKS)

    def removed(rows: pa.Table, marks: pa.Table) -> pa.Table:  # round 3
        out = {"doc_id": [], "n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
        if rows.num_rows:
            own = Parsed(rows, window)
            starts, one, _, key, number = own.marked_windows(marked(own, marks))
            cuts = _by_bucket(one, bits)
            sent = _bits(marks, 1, cuts)
            elsewhere = np.empty(len(one), bool)
            for k in np.flatnonzero(np.diff(cuts)):
                a, b = cuts[k], cuts[k + 1]
                elsewhere[a:b][np.argsort(key[a:b], kind="stable")] = sent[a:b]
            gone = elsewhere[number] | (own.keys[own.doc[starts]] > key[number])
            depth = np.zeros(len(own.doc) + 1, np.int64)
            np.add.at(depth, starts[gone], 1)
            np.add.at(depth, starts[gone] + window, -1)
            stays = np.cumsum(depth)[:-1] == 0
            for k, (doc_id, text) in enumerate(zip(own.ids, own.texts, strict=True)):
                mine = stays[own.begins[k] : own.ends[k]]
                words = text.split(b" ") if text else []
                kept = b" ".join(words if mine.all() else compress(words, mine.tolist()))
                out["doc_id"].append(doc_id)
                out["n_words"].append(len(words))
                out["n_removed"].append(int((~mine).sum()))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept"].append(kept.decode() if keep_text else None)
        kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "kept": pa.string()}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items() if c != "kept" or keep_text})

    by_group, marks = lambda df: df.groupBy("g"), "g int, kind int, bucket int, bits binary"
    first = by_group(grouped).applyInArrow(names, "bucket int, g int, names binary").groupBy("bucket").applyInArrow(shared, marks)
    second = by_group(grouped).cogroup(by_group(first)).applyInArrow(found, "bucket int, g int, windows binary, ids array<long>, counts array<long>").groupBy("bucket").applyInArrow(least, marks)
    return by_group(grouped).cogroup(by_group(first.unionByName(second))).applyInArrow(removed, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


ORACLE_SQL = f"""
with w as (select doc_id, unnest(ws) word, generate_subscripts(ws, 1) pos from (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD_SQL}') ws from documents)),
v as (select doc_id, pos, word, string_agg(word, ' ') over f as passage, count(*) over f as n from w window f as (partition by doc_id order by pos rows between current row and {WINDOW - 1} following)),
l as (select passage, min(doc_id) as least from v where n = {WINDOW} group by passage),
s as (select doc_id, pos, word, coalesce(least < doc_id, false) as starts from v left join l on v.passage = l.passage and v.n = {WINDOW}),
k as (select doc_id, pos, word, bool_or(starts) over (partition by doc_id order by pos rows between {WINDOW - 1} preceding and current row) as gone from s)
select d.doc_id, count(k.pos) n_words, count(k.pos) filter (gone) n_removed, sha256(coalesce(string_agg(word, ' ' order by pos) filter (not gone), '')) kept_sha256
from documents d left join k on d.doc_id = k.doc_id group by d.doc_id
"""
