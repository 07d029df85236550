"""Byte-level BPE encoding and decoding with DuckDB recursive queries inside each Spark partition.

A partition's texts are cut into pieces, whose distinct ones are cut into pre-tokens.  The distinct pre-tokens that are
not single tokens go to an in-process DuckDB as token rows; a recursive query joins neighbouring tokens with the merge table, takes
each word's leftmost pair of minimum rank, contracts it, and repeats until no word changes.  A document's
ids are those of its pre-tokens in order.  Decoding joins (position, id) rows with the vocabulary,
and the pieces in order of position are the documents' bytes.

Scale
* No shuffle: rows stay in the partition that read them.  The vocabulary (about 1 MB) travels with the
  task.  Encoded pre-tokens are remembered per Python worker in two generations of about `KEEP` bytes; what was used
  lately stays, and memory is bounded.
* Texts are cut before single spaces between non-space characters first.  No pre-token of the pattern spans
  such a place or looks past it, so equal pieces of a slice are matched against the pattern once, most of them as one
  text.  Only distinct pieces are handled in Python; their places in the texts are found and filled in Arrow and numpy.
* A word is contracted pair by pair in the order of ranks.  In words over `LONG` bytes a round contracts at once all
  pairs that this order would contract as they stand, and words are cut where no token spans the place, so that long
  words take few rounds.  A very long text is cut at spaces like any other; what remains is one long word.

Defined cases: a null text is empty and has no ids; a null id is returned as null; repeated rows give
repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import pairwise

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import documents, give_back, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bytes remembered in a generation, of which `ENTRY` for each pre-token beside its text; longest word contracted as one list;
#: words, and tokens of long words, in a query at once; rounds of a query on long words.
KEEP, ENTRY, LONG, AT_ONCE, ROWS, ROUNDS = 60_000_000, 200, 96, 30_000, 200_000, 4
MOST = 2**31 - 1

# pos counts from 1 in the list; a pair's rank is the id of what it makes, so the least (id, pos) is the leftmost of the least rank
_SHORT = """
with recursive step(round, word, ids) as (
  select 0, word, ids from seed
  union all
  select s.round + 1, s.word, s.ids[:(b.best & 4294967295) - 1] || [(b.best >> 32)::int] || s.ids[(b.best & 4294967295) + 2:]
  from step s join (
    select word, min((m.made::bigint << 32) | pos) best
    from (select word, unnest(ids) l, unnest(ids[2:]) r, generate_subscripts(ids, 1) pos from step) t join merges m on m.pair = (t.l::bigint << 32 | t.r)
    where r is not null group by word) b on b.word = s.word)
select word, ids from (select word, ids, round, max(round) over (partition by word) last from step) where round = last
"""

# Longer words: in one round, every pair is contracted that the order of ranks would contract as it stands.  `base` is at
# most the least rank of any token that may come to span the boundary after a row: while a pair's rank is below that of the
# boundary before it and not above that of the boundary after it, nothing can take its tokens away first.  Runs of one
# pair take every second; the word's leftmost pair of minimum rank is always due.
_LONG = """
with recursive step(round, word, pos, id, base) as (
  select 0, word, pos, id, base from seed
  union all
  select round + 1, word, pos, case when here then made else id end, case when here then after else base end from (
    select *, lag(here, 1, false) over (partition by word order by pos) gone from (
      select *, made is not null and (pos = best & 4294967295 or (made <= after and run & 4294967295 > made and (place - (run >> 32)) % 2 = 0)) here from (
        select *, max(case when new_run then place << 32 | before end) over (partition by word order by pos rows unbounded preceding) run from (
          select *, made is distinct from lag(made) over w or before <> made new_run from (
            select *, lag(base, 1, {most}) over w before, min(made::bigint << 32 | pos) over (partition by word) best from (
              select t.*, made from (
                select *, lead(id) over w r, lead(base, 1, {most}) over w after, row_number() over w place from step window w as (partition by word order by pos)) t
              left join merges m on m.pair = (t.id::bigint << 32 | t.r))
            window w as (partition by word order by pos))
          window w as (partition by word order by pos))))
    where best is not null and round < {rounds})
  where not gone)
select word, pos, id, last from (select *, max(round) over (partition by word) as last from step) where round = last order by pos
"""

_DECODE = "select piece from tokens left join vocabulary using (id) order by pos"


def _wide(lead: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether characters that begin with these bytes of UTF-8 may be white space; some that are not count too."""
    ascii_ = (lead == 0x20) | ((lead >= 0x09) & (lead <= 0x0D)) | ((lead >= 0x1C) & (lead <= 0x1F))
    return ascii_ | (lead == 0xC2) | ((lead == 0xE1) & (second == 0x9A)) | ((lead == 0xE2) & (second <= 0x81)) | ((lead == 0xE3) & (second == 0x80))


def _ends(items: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """0 and where each string or binary ends, and the bytes of all, in one row."""
    items = items.cast(pa.large_binary())
    ends = np.frombuffer(items.buffers()[1] or bytes(8), np.int64)[items.offset : items.offset + len(items) + 1]
    return ends - ends[0], np.frombuffer(items.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]


def _stretches(ends: np.ndarray, data: np.ndarray) -> list[bytes]:
    """The bytes between neighbouring ends."""
    return [data[a:b].tobytes() for a, b in pairwise(ends.tolist())]


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All texts cut before single spaces between characters that are not white space, as one array of pieces, and where
    each text's pieces begin in it.  A place beside a character that may be white space is left whole, which is always
    right."""
    ends, data = _ends(texts)
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 2) & (at < len(data) - 2)]  # near either end of all nothing is cut, so that neighbours can be looked at
    one, two, three = data[at - 1], data[at - 2], data[at - 3]
    before = np.where(one < 0x80, _wide(one, one), (two == 0xC2) | ((three > 0xC2) & _wide(three, two)))
    at = at[~(before | _wide(data[at + 1], data[at + 2]))]
    text = np.searchsorted(ends, at, "right") - 1
    at = at[(at > ends[text]) & (at + 1 < ends[text + 1])]  # a text's first or last character has no neighbour
    bounds = np.insert(at, np.searchsorted(at, ends), ends)
    starts = np.searchsorted(at, ends) + np.arange(len(ends))
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)), starts


class Codec:
    """Encoder and decoder over one rank file; one DuckDB with one thread."""

    def __init__(self, vocabulary: bytes, pattern: str, keep: int = KEEP):
        self.keep = keep
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        #: Packed ids of the words that are a token.
        self.whole = {w: rank.to_bytes(4, "little") for t, rank in self.ranks.items() if (w := t.decode(errors="replace")).encode() == t}
        self.pattern = regex.compile(pattern)
        self.bytes_ = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.forget()
        tokens = list(self.ranks)
        pairs = [(left, right, rank) for token, rank in self.ranks.items() for i in range(1, len(token)) if (left := self.ranks.get(token[:i])) is not None and (right := self.ranks.get(token[i:])) is not None]
        left, right, made = np.array(pairs, np.int64).T if pairs else np.zeros((3, 0), np.int64)
        self.longest = max(map(len, tokens), default=0)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        self._load("merges", {"pair": left << 32 | right, "made": made.astype(np.int32)})
        self._load("vocabulary", {"id": pa.array(self.ranks.values(), pa.int32()), "piece": pa.array(tokens, pa.binary())})

    def forget(self) -> None:
        """Lets go of what was remembered: packed ids of pre-tokens used lately, and the same of the time before; `size` is
        an estimate of the former's bytes."""
        self.packed: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.size, self.prefixes = 0, set()

    def _load(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"create or replace table {name} as select * from given" + (" order by id" if name == "vocabulary" else ""))
        self.db.unregister("given")

    def _words(self, words: set[str]) -> dict[str, bytes]:
        """Packed ids of distinct pre-tokens."""
        out = {w: self.whole[w] for w in words & self.whole.keys()}
        rest = list(words - self.whole.keys())
        for at in range(0, len(rest), AT_ONCE):
            part = rest[at : at + AT_ONCE]
            ends, data = _ends(pa.array(part, pa.large_string()))
            if len(long := np.flatnonzero(np.diff(ends) > LONG)):
                out.update((part[k], self._long(data[ends[k] : ends[k + 1]].tobytes())) for k in long.tolist())
                part = np.delete(np.array(part, object), long).tolist()
                if not part:
                    continue
                ends, data = _ends(pa.array(part, pa.large_string()))
            seed = pa.table({"word": np.arange(len(part), dtype=np.int32), "ids": pa.ListArray.from_arrays(ends.astype(np.int32), self.bytes_[data])})
            self.db.register("seed", seed)
            found = self.db.sql(_SHORT).to_arrow_table()
            self.db.unregister("seed")
            flat = found["ids"].combine_chunks()
            values, ends = flat.flatten().to_numpy().astype("<u4").tobytes(), (4 * (flat.offsets.to_numpy() - flat.offsets[0].as_py())).tolist()
            out.update(zip(map(part.__getitem__, found["word"].to_numpy().tolist()), [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], strict=True))
        return out

    def _spanned(self, data: bytes, pos: list[int], base: np.ndarray) -> np.ndarray:
        """For the boundary after each token, the least rank of the vocabulary's tokens that stand in the word, begin and
        end where tokens do, and span it; nothing else can ever be made across it."""
        if not self.prefixes:
            self.prefixes = {t[:i] for t in self.ranks for i in range(1, len(t))}
        out, last, ends = [MOST] * len(pos), (base == MOST).tolist(), [*pos[1:], len(data)]
        for i, at in enumerate(pos):
            j = i
            while not last[j] and ends[j + 1] - at <= self.longest:
                j += 1
                piece = data[at : ends[j]]
                rank = self.ranks.get(piece)
                if rank is not None:
                    for k in range(i, j):
                        if rank < out[k]:
                            out[k] = rank
                if piece not in self.prefixes:
                    break
        return np.array(out, np.int64)

    def _long(self, data: bytes) -> bytes:
        """Packed ids of a long word.  After every few rounds it is cut wherever no token can come to span the place, so
        that its stretches contract side by side."""
        ids, pos = self.bytes_[np.frombuffer(data, np.uint8)].astype(np.int64), np.arange(len(data))
        base = np.zeros(len(data), np.int64)
        base[-1] = MOST
        live = np.ones(len(data), bool)  # tokens of stretches that may still change
        while True:
            base = np.where(live, self._spanned(data, pos.tolist(), np.where(live, base, MOST)), MOST)
            word = np.concatenate([[0], np.cumsum(base == MOST)[:-1]])
            live = np.bincount(word)[word] > 1
            if not live.any():
                return ids.astype("<u4").tobytes()
            at = np.flatnonzero(live)
            gone, more = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
            firsts = np.flatnonzero(np.diff(word[at], prepend=-1))
            for rows in np.split(at, firsts[np.flatnonzero(np.diff(firsts // ROWS)) + 1]):  # whole stretches, about ROWS tokens at a time
                self.db.register("seed", pa.table({"word": word[rows].astype(np.int32), "pos": rows.astype(np.int32), "id": ids[rows].astype(np.int32), "base": base[rows].astype(np.int32)}))
                left = self.db.sql(_LONG.format(rounds=ROUNDS, most=MOST)).to_arrow_table()
                self.db.unregister("seed")
                keep = left["pos"].to_numpy()
                gone[rows], gone[keep] = True, False
                ids[keep], more[keep] = left["id"].to_numpy(), left["last"].to_numpy() == ROUNDS
            stays = np.flatnonzero(~gone)
            base = base[np.append(stays[1:], len(ids)) - 1]
            ids, pos, live = ids[stays], pos[stays], more[stays]

    def _split(self, pieces: pa.Array, alone: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Pre-tokens of distinct pieces, those that stand alone last, and how many each piece has.  The others begin with
        a space and end without one, so that side by side they are a text that is cut between them."""
        own = [self.pattern.findall(p) for p in pieces.filter(pa.array(alone)).to_pylist()]
        joined = pieces.filter(pa.array(~alone))
        words = self.pattern.findall(pc.binary_join(pa.ListArray.from_arrays([0, len(joined)], joined), pa.scalar("", pa.large_string()))[0].as_py())
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        marks = np.cumsum(pc.utf8_length(joined).to_numpy())
        last = np.searchsorted(ends, marks)
        if len(marks) and (last[-1] != len(words) - 1 or (ends[last] != marks).any()):
            raise ValueError("the pattern must match every character of a text, and no match may span a cut")
        counts = np.zeros(len(pieces), np.int64)
        counts[~alone], counts[alone] = np.diff(last, prepend=-1), [len(x) for x in own]
        for x in own:
            words += x
        return words, counts

    def _remembered(self, words: list[str]) -> None:
        """Sees to it that `packed` holds all these pre-tokens."""
        if self.size > self.keep:
            self.before, self.packed, self.size = self.packed, {}, 0
        missing = set(words) - self.packed.keys()
        made = {w: known for w in missing if (known := self.before.get(w)) is not None}
        made |= self._words(missing - made.keys())
        self.packed |= made
        self.size += sum(map(len, made)) + sum(map(len, made.values())) + ENTRY * len(made)

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        if not len(texts):
            return []
        pieces, starts = _pieces(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        coded = pieces.dictionary_encode()
        codes = coded.indices.to_numpy()
        alone = np.zeros(len(coded.dictionary), bool)
        alone[codes[starts[:-1]]] = alone[codes[starts[1:] - 1]] = True  # each text's first and last
        words, counts = self._split(coded.dictionary, alone)
        self._remembered(words)
        packed = [self.packed[w] for w in words]
        ends = np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed)))
        order = np.concatenate([np.flatnonzero(~alone), np.flatnonzero(alone)])  # of the pieces whose words stand in a row
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts[order])])]
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(order), [None, pa.py_buffer(bounds), pa.py_buffer(b"".join(packed))])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        filled = ids.take(pa.array(place[codes]))
        ends, data = _ends(filled)
        return _stretches(ends[starts], data)

    def decode(self, coded: list[bytes]) -> list[bytes]:
        """The bytes that each text's ids stand for."""
        ids = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
        self.db.register("tokens", pa.table({"pos": np.arange(len(ids), dtype=np.int32), "id": ids}))
        ends, data = _ends(self.db.sql(_DECODE).to_arrow_table()["piece"].combine_chunks())
        self.db.unregister("tokens")
        return _stretches(ends[np.cumsum([0, *map(len, coded)]) // 4], data)


_CODECS: dict[bytes, Codec] = {}


def codec(vocabulary: bytes, pattern: str, keep: int = KEEP) -> Codec:
    """The worker's codec for this vocabulary, kept between batches and tasks."""
    key = hashlib.sha256(vocabulary + pattern.encode() + b"%d" % keep).digest()
    if key not in _CODECS:
        _CODECS[key] = Codec(vocabulary, pattern, keep)
    return _CODECS[key]


def _slices(texts: pa.Array, most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` characters."""
    at = size = 0
    for i, n in enumerate(pc.utf8_length(texts).to_pylist()):
        size += n
        if size >= most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def encode_documents(docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, keep: int = KEEP) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and the ids themselves if `keep_ids`; a worker remembers pre-tokens
    of about twice `keep` bytes."""
    with open(vocabulary_path, "rb") as f:
        vocabulary = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern, keep)
        for batch in (whole.slice(at, 2048) for whole in batches for at in range(0, whole.num_rows, 2048)):
            texts = batch.column("text")
            for a, b in _slices(texts):
                coded = own.encode(texts.slice(a, b - a))
                decoded = own.decode(coded)
                sha = lambda items: pa.array([hashlib.sha256(x).hexdigest() for x in items], pa.string())
                columns = [batch.column("doc_id")[a:b], pa.array([len(x) // 4 for x in coded], pa.int64()), sha(coded), sha(decoded)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in coded], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.record_batch(columns, names=names)
        own.prefixes = set()
        give_back()

    return documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
