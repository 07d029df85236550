"""Edit-aware token counts: a tree of pre-tokens per document, re-encoded only where edits touch it.

The leaves of a document's tree hold runs of consecutive pre-tokens (their lengths and token counts); the
inner nodes hold sums of characters and tokens, so a place in the text is found, and a count updated, along
one path.  An edit replaces characters [start, end) by new text.  Matching restarts at the last pre-token
that cannot have looked at a changed character (the pattern looks at most one character past the end of
what it matches) and stops at the first old boundary behind the edit that the new matching meets again:
from there on both texts are equal and so are their pre-tokens.

Scale: no shuffle; a document and its edits are one row, so trees live only while their row is handled.
Counts of distinct pre-tokens are remembered per Python worker, up to `KEEP` entries.

Defined cases: a null text is empty; null or empty edits change nothing; edits apply one after another, each
in the coordinates of the text as it then is; places outside the text are moved to its ends and a null
replacement is empty.  A null id is returned as null, repeated rows give repeated results, an empty table
gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
KEEP, LEAF = 1_000_000, 64
EDITS = "array<struct<start:int,stop:int,put:string>>"
#: How many characters past its end the pattern may look at when it matches a pre-token.
LOOKAHEAD = 1


class Counter:
    """Token counts of pre-tokens, remembered."""

    def __init__(self, vocabulary: bytes, pattern: str):
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def __call__(self, word: str) -> int:
        n = self.known.get(word)
        if n is None:
            if len(self.known) >= KEEP:
                self.known.clear()
            n = self.known[word] = len(self.encoding.encode_ordinary(word))
        return n


class CountTree:
    """Segment tree over leaves of pre-tokens; node k has children 2k and 2k + 1."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter, self.encoded = text, counter, 0
        words = counter.pattern.findall(text)
        pairs = [(len(w), counter(w)) for w in words]
        self.n_words = len(pairs)
        parts = [pairs[i : i + LEAF] for i in range(0, len(pairs), LEAF)] or [[]]
        self.width = 1 << (len(parts) - 1).bit_length()
        self.leaves: list[list[tuple[int, int]]] = parts + [[] for _ in range(self.width - len(parts))]
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for k, leaf in enumerate(self.leaves):
            self.chars[self.width + k], self.tokens[self.width + k] = sum(x[0] for x in leaf), sum(x[1] for x in leaf)
        for k in range(self.width - 1, 0, -1):
            self._sum(k)

    def _sum(self, k: int) -> None:
        self.chars[k], self.tokens[k] = self.chars[2 * k] + self.chars[2 * k + 1], self.tokens[2 * k] + self.tokens[2 * k + 1]

    @property
    def count(self) -> int:
        return self.tokens[1]

    def _set(self, leaf: int, pairs: list[tuple[int, int]]) -> None:
        self.leaves[leaf] = pairs
        k = self.width + leaf
        self.chars[k], self.tokens[k] = sum(x[0] for x in pairs), sum(x[1] for x in pairs)
        while k > 1:
            k //= 2
            self._sum(k)

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf with the pre-token that covers character `place`, and the leaf's first character."""
        k, at = 1, 0
        while k < self.width:
            k *= 2
            if place >= at + self.chars[k] and self.chars[k + 1]:
                at += self.chars[k]
                k += 1
        return k - self.width, at

    def edit(self, start: int, stop: int, put: str) -> None:
        n = len(self.text)
        start = min(max(start, 0), n)
        stop = min(max(stop, start), n)
        text = self.text[:start] + put + self.text[stop:]
        shift = len(put) - (stop - start)
        # the first pre-token that may have looked at a changed character: the one that covers this place
        leaf, at = self._leaf_at(max(0, start - 1 - LOOKAHEAD))
        first, begin, kept = leaf, at, []
        for pair in self.leaves[leaf]:
            if begin + pair[0] >= start - LOOKAHEAD:
                break
            begin += pair[0]
            kept.append(pair)
        # old boundaries from there on, lazily, and new matches, until both meet behind the edit
        position, skip = begin, len(kept)
        old, fresh = begin, []
        while True:
            while old < stop or old + shift < position:  # walk the old boundaries up to the new place
                while skip >= len(self.leaves[leaf]) and leaf + 1 < self.width:
                    leaf, skip = leaf + 1, 0
                if skip >= len(self.leaves[leaf]):
                    break
                old += self.leaves[leaf][skip][0]
                skip += 1
            if old >= stop and old + shift == position:
                break
            match = self.counter.pattern.match(text, position)
            if match is None:
                break
            word = match[0]
            fresh.append((len(word), self.counter(word)))
            self.encoded += 1
            position += len(word)
        rest = self.leaves[leaf][skip:]
        self.text = text
        for k in range(first + 1, leaf + 1):
            self._set(k, [])
        self._set(first, kept + fresh + rest)
        if len(self.leaves[first]) > 16 * LEAF:  # a large insertion: build anew, so that leaves stay short
            encoded, words = self.encoded, self.n_words
            self.__init__(text, self.counter)
            self.encoded, self.n_words = encoded, words


_COUNTERS: dict[int, Counter] = {}


def counter(vocabulary: bytes, pattern: str) -> Counter:
    key = hash((vocabulary, pattern))
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(vocabulary, pattern)
    return _COUNTERS[key]


def count_edits(docs: DataFrame, edits: Column, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_words (pre-tokens before), n_tokens before and n_tokens_edited after `edits` (an
    array of (start, stop, put)), and n_reencoded, the pre-tokens that were encoded again for them."""
    with open(vocabulary_path, "rb") as f:
        vocabulary = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary, pattern)
        for batch in batches:
            rows = []
            for text, changes in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist(), strict=True):
                tree = CountTree(text, own)
                before = tree.count
                for change in changes or []:
                    tree.edit(change["start"] or 0, change["stop"] or 0, change["put"] or "")
                rows.append((tree.n_words, before, tree.count, tree.encoded))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "n_words", "n_tokens", "n_tokens_edited", "n_reencoded"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), edits.cast(EDITS).alias("edits"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_tokens_edited long, n_reencoded long")


def sample_edits(text: Column) -> Column:
    """Three edits of every text that the text itself determines: characters cut out at a quarter, the first 20
    characters put in at the middle, and three characters near the end replaced."""
    text = F.coalesce(text, F.lit(""))
    n = F.char_length(text)
    one = lambda start, stop, put: F.struct(F.floor(start).cast("int").alias("start"), F.floor(stop).cast("int").alias("stop"), put.alias("put"))
    return F.array(one(n / 4, n / 4 + 7, F.lit("")), one(n / 2, n / 2, F.substring(text, 1, 20)), one(n * 0.9, n * 0.9 + 3, F.lit(" 2x,\n")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return count_edits(docs, sample_edits(F.col("text")), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
