"""Phrase collocation mining by dynamic itemset counting.

The corpus is dealt into shards, which are scanned in a cycle; every step scans one shard and counts phrases of all lengths
that are active.  Single words are active from the first step.  A longer phrase becomes active in the step after both its
subphrases (all but its last word, all but its first) have been counted `least` times, and stays active until it has seen
each shard once; its count is then exact.  A phrase is never more frequent than its subphrases, so every phrase that
occurs `least` times is activated, and rare ones mostly are not counted at all.  The scan ends a full cycle after the last
step in which some phrase reached the threshold.

When a phrase was reached stands in an array of step numbers, one byte a slot; a phrase's slot is a hash of it, within a part
of the array for its length.  Phrases that share a slot may activate longer phrases that need not be counted.  Those are counted over a full cycle like all others, as
the array decides alike in each step, and fall short of the threshold; the result does not depend on the array's size.

Scale
* The text is copied once, dealt into shards; five cycles at most are read, one for each length, and a shard at a time.
* A task counts its words and phrases in blocks of `CHUNK` bytes before anything is shuffled; Spark sums these partially
  again.  What is shuffled are active phrases only, by (lang, phrase), so a common word costs one row a block.
* Counts of phrases that are not finished are a table in the shared folder that each step replaces.  Phrases that
  finish below the threshold are dropped, so it is largest in the first cycle.
* Broadcast: the array of slots, a byte for each 64 bytes of text, at most 64 MB.  Where more phrases are frequent than it has
  slots, more is counted than need be; nothing is lost.
* Scores come from joins on (lang, phrase) of frequent phrases only.  The report keeps `top` rows of each lang, which Spark
  limits before the exchange.

Defined cases: a null text is empty, a null lang is `und`.  Empty texts give nothing.  Repeated rows count as often as they
stand.  A very long text is read in blocks that share their last words, and counted whole.  Ties go by score, then
count, then phrase in byte order; of cuts with the same score the first.  An empty table gives an empty result; ids and other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop, table, written
from .words import blocks, hash_block, hash_words, mix, slices, windows

MOST, LEAST, TOP, SHARDS = 5, 100, 2000, 3
CHUNK, SLOTS_MIN, SLOTS_MAX = 2_000_000, 1 << 16, 1 << 26
NEVER = 255
#: What ends a piece becomes a line end, what ends a word a space; A-Z are lower-cased.
_ENDS = b".,;:!?\n\v\f\r"
_PLAIN = bytes(10 if c in _ENDS else 32 if c == 9 else c for c in range(256)).translate(bytes(range(256)).lower())


def slots_of(grams: np.ndarray, lang: str, k: int, size: int, most: int) -> np.ndarray:
    """The slots of phrases of k words, given by their hashes, in an array of `size` slots; every length has a part of its
    own, a power of two."""
    part = 1 << ((size // max(1, most - 1)).bit_length() - 1)
    return (mix(grams ^ np.uint64(xxhash.xxh64_intdigest(lang.encode()))) & np.uint64(part - 1)).astype(np.int64) + (k - 1) * part


class _Scan:
    """Counts the active phrases of one lang in one step."""

    def __init__(self, lang: str, step: int, shards: int, most: int, reached: np.ndarray, lengths: set[int]):
        self.lang, self.step, self.shards, self.most, self.reached, self.lengths = lang, step, shards, most, reached, lengths

    def rows(self, texts: list[bytes]) -> Iterator[tuple[Counter, dict, int]]:
        """For each block: how often each active phrase occurs, in which step it became active (words: 0), how many words."""
        for a, b in slices(texts, CHUNK):
            if b - a > 1 or len(texts[a]) <= 2 * CHUNK:
                yield self._count(b"\n".join(texts[a:b]).translate(_PLAIN), 0)[:3]
                continue
            tail, held = b"", 0
            for block in blocks(texts[a], CHUNK):
                data = tail + block.translate(_PLAIN)
                counts, starts, n, begins = self._count(data, held)
                yield counts, starts, n
                held = min(self.most - 1, len(begins))
                tail = data[begins[-held] :] if held else b""

    def _count(self, data: bytes, held: int) -> tuple[Counter, dict, int, np.ndarray]:
        """`data`'s first `held` words belong to the block before: only phrases that end after them count."""
        begins, _, (hashes,) = hash_block(data, 1)
        words = data.split()
        counts: Counter = Counter(words[held:]) if self.step < self.shards else Counter()
        starts: dict = {}
        piece = np.searchsorted(np.flatnonzero(np.frombuffer(data, np.uint8) == 10), begins)
        grams = windows(hashes, *range(1, self.most)) if self.lengths else []
        join = b" ".join
        for k in sorted(self.lengths):
            n = len(words) - k + 1
            if n <= 0:
                break
            at = self.reached[slots_of(grams[k - 2], self.lang, k - 1, len(self.reached), self.most)]
            start = np.maximum(at[:n], at[1 : n + 1]).astype(np.int32) + 1
            live = (start <= self.step) & (self.step < start + self.shards) & (piece[:n] == piece[k - 1 :])
            live[: max(0, held - k + 1)] = False
            where = np.flatnonzero(live)
            if len(where):
                found = [join(words[i : i + k]) for i in where.tolist()]
                counts.update(found)
                starts |= zip(found, start[where].tolist(), strict=True)
        return counts, starts, len(words) - held, begins


def _scan(shard: DataFrame, step: int, shards: int, most: int, reached: np.ndarray, lengths: set[int]) -> DataFrame:
    """(key, mark, count): active phrases of a shard, counted by block.  A key is the lang, a line end and the phrase, the empty
    phrase having the number of words; a mark is twice the step in which the phrase became active."""
    shared = shard.sparkSession.sparkContext.broadcast(reached)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                by_lang.setdefault(lang, []).append(text.as_py())
            for lang, texts in by_lang.items():
                head = lang.encode() + b"\n"
                for counts, starts, n in _Scan(lang, step, shards, most, shared.value, lengths).rows(texts):
                    if step < shards:
                        counts[b""] = n
                    keys = pa.array([head + p for p in counts], pa.binary()).cast(pa.string())
                    marks = pa.array([2 * starts.get(p, 0) for p in counts], pa.int32())
                    yield pa.record_batch([keys, marks, pa.array(counts.values(), pa.int64(), size=len(counts))], names=["key", "mark", "count"])

    return shard.mapInArrow(run, "key string, mark int, count long")


def _mark(reached: np.ndarray, new: DataFrame, step: int, most: int) -> set[int]:
    """Notes `step` at the slots of phrases that are newly reached; they come to the driver as a bit map of the slots.
    Returns the lengths of phrases with new slots."""
    size = len(reached)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, _, phrases = zip(*(key.rpartition("\n") for key in batch.column("key").to_pylist()), strict=True)
            (hashes,), first = hash_words([p.encode() for p in phrases])
            ks, langs = np.diff(first), np.array(langs, object)
            for k in np.unique(ks).tolist():
                grams = windows(hashes, k)[0]
                for lang in set(langs[ks == k]):
                    at = first[:-1][(ks == k) & (langs == lang)]
                    yield pa.record_batch([pa.array(slots_of(grams[at], lang, k, size, most))], names=["slot"])

    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = new.select("key").mapInArrow(run, "slot long").groupBy(F.expr("shiftright(slot, 6)").alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.int64).view(np.uint64)
    fresh = np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool) & (reached == NEVER))
    reached[fresh] = step
    part = 1 << ((size // max(1, most - 1)).bit_length() - 1)
    return set((np.unique(fresh // part) + 1).tolist())


def frequent_phrases(docs: DataFrame, least: int = LEAST, most: int = MOST, shards: int = SHARDS, lang_col: str = "lang", text_col: str = "text", slots: int | None = None) -> DataFrame:
    """(lang, phrase, k, count) of all phrases of 1 to `most` words that occur `least` times in their lang; k = 0 has the
    number of words of the lang."""
    spark = docs.sparkSession
    plain = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text")).filter("text is not null")
    dealt = written(spark, plain.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")), "phrase-shards", "shard")
    if slots is None:
        size = dealt.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        slots = min(SLOTS_MAX, max(SLOTS_MIN, 1 << (int(size) // 64).bit_length()))
    reached = np.full(slots, NEVER, np.uint8)
    news: dict[int, set[int]] = {}  # the lengths of phrases that each step reached
    state, done, step = None, [], 0
    while step < shards or any(news.get(s) for s in range(step - shards, step)):
        if step >= NEVER:
            raise ValueError("so many shards do not fit into a byte a slot")
        # a phrase is active up to a cycle after the later of its subphrases was reached
        lengths = {k + 1 for s in range(step - shards, step) for k in news.get(s, ())}
        rows = _scan(dealt.filter(F.col("shard") == step % shards).select("lang", "text"), step, shards, most, reached, lengths)
        rows = rows if state is None else rows.unionByName(state)
        now = written(spark, rows.groupBy("key").agg(F.max("mark").alias("mark"), F.sum("count").alias("count")), "phrase-counts")
        phrase = F.substring_index("key", "\n", -1)
        size = F.when(phrase == "", 0).otherwise(F.char_length(phrase) - F.char_length(F.replace(phrase, F.lit(" "))) + 1)
        named = now.withColumn("phrase", phrase).withColumn("k", size)
        told, full = F.col("mark") % 2 == 1, F.floor(F.col("mark") / 2) + shards - 1 <= step
        news[step] = _mark(reached, named.filter((F.col("count") >= least) & ~told & F.col("k").between(1, most - 1)), step, most)
        lang = F.expr("substring(key, 1, char_length(key) - char_length(phrase) - 1)")
        done.append(written(spark, named.filter(full & (F.col("count") >= least)).select(lang.alias("lang"), "phrase", "k", "count"), "phrases"))
        if state is not None:
            drop(former)
        # an odd mark: the phrase has been told to the array
        former, state = now, now.filter(~full).withColumn("mark", F.when((F.col("count") >= least) & ~told, F.col("mark") + 1).otherwise(F.col("mark")))
        step += 1
    drop(former)
    drop(dealt)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    out = written(spark, out, "phrases-all")
    for used in done:
        drop(used)
    return out


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST, top: int = TOP, within: int = 100, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each lang's `top` phrases of 2 to `most` words by their lowest-scoring cut,
    without those of which at least `within` percent of the occurrences lie inside one longer phrase."""
    known = frequent_phrases(docs, least, most, **options)
    f = known.filter("k > 0").select("lang", "phrase", "k", F.col("count").alias("a"))
    n = known.filter("k = 0").select("lang", F.col("count").alias("n"))
    candidates = f.filter("k > 1")

    inside = candidates.filter("k > 2").withColumn("w", F.split("phrase", " ")).withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    inside = inside.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    inside = inside.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < within * F.col("a"))).drop("longer")

    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', cut)")).withColumn("right", F.expr("substring_index(phrase, ' ', cut - k)"))
    side = lambda key, name: f.select("lang", F.col("phrase").alias(key), F.col("a").alias(name))
    cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"]).join(n, "lang")
    wide = lambda c: f"cast({c} as decimal(19, 0))"
    cuts = cuts.withColumn("score", F.expr(f"({wide('a')} * {wide('n')} * 1000) div ({wide('l')} * {wide('r')})"))
    best = cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("n").alias("n"), F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = rf"""
with pieces as (select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') ws from pieces),
grams as (select lang, k, array_to_string(ws[i : i + k - 1], ' ') phrase from (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) i from w, range(1, {MOST + 1}) t(k))),
f as (select lang, k, phrase, count(*) a from grams group by all having count(*) >= {LEAST}),
words as (select lang, sum(len(ws))::bigint n from w group by lang),
c as (select *, string_split(phrase, ' ') ws from f where k > 1),
inside as (select lang, array_to_string(ws[i : i + s - 1], ' ') phrase, max(a) longer from (select lang, ws, a, s, unnest(range(1, k - s + 2)) i from c, range(2, {MOST}) t(s) where s < k) group by all),
kept as (select c.* from c left join inside using (lang, phrase) where longer is null or 100 * longer < 100 * a),
cuts as (select kept.lang, kept.phrase, kept.a, n, cut, l.a l, r.a r, ((1000::hugeint * kept.a * n) // (l.a::hugeint * r.a))::bigint score
  from kept, range(1, {MOST}) t(cut), f l, f r, words where cut < kept.k and l.lang = kept.lang and r.lang = kept.lang and words.lang = kept.lang
  and l.phrase = array_to_string(kept.ws[1 : cut], ' ') and r.phrase = array_to_string(kept.ws[cut + 1 :], ' ')),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from best qualify rank <= {TOP}
"""
