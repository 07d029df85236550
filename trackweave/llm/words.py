"""Words of many texts at once as 64-bit hashes (numpy), for operators on word sequences."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np

#: The bytes between words; odd multipliers.
SPACES = b" \t\n\v\f\r"
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Bytes hashed at a time; words longer than `LONG` bytes are hashed by BLAKE2b instead of eight bytes at a time.
SLICE, LONG = 500_000, 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(texts: list[bytes], most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` bytes; a longer text is a range of its own."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def blocks(data: bytes, most: int) -> Iterator[bytes]:
    """`data` in blocks of about `most` bytes that end between words."""
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + most) if at + most < len(data) else None
        end = gap.end() if gap else len(data)
        yield data[at:end]
        at = end


def hash_block(data: bytes, lanes: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Begins and ends of the words of a block, and their hashes once per lane."""
    n = len(data)
    padded = data + bytes(8)
    gap = _IS_SPACE[np.frombuffer(padded, np.uint8, n)]
    turn = np.flatnonzero(np.diff(gap, prepend=True, append=True))  # begins and ends of words alternate
    begins, ends = turn[0::2], turn[1::2]
    sizes = ends - begins
    eight = np.ndarray((n + 1,), "<u8", padded, strides=(1,))  # the eight bytes from every place on
    out = [mix(sizes.astype(np.uint64) * np.uint64(base) + np.uint64(base >> 7)) for base in BASES[:lanes]]
    live = np.flatnonzero(sizes <= LONG) if len(sizes) and sizes.max() > LONG else np.arange(len(sizes))
    step = 0
    while len(live):
        at = begins[live] + 8 * step
        value = eight[at] & _MASKS[np.minimum(ends[live] - at, 8)]
        for h, base in zip(out, BASES, strict=False):
            h[live] = mix((h[live] ^ value) * np.uint64(base))
        step += 1
        live = live[sizes[live] > 8 * step]
    for k in np.flatnonzero(sizes > LONG):
        digest = hashlib.blake2b(data[begins[k] : ends[k]], digest_size=8 * lanes).digest()
        for h, value in zip(out, np.frombuffer(digest, "<u8"), strict=True):
            h[k] = value
    return begins, ends, out


def hash_words(texts: list[bytes], lanes: int = 1) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of all words of all texts in order, once per lane, and where each text's words begin (one more at the end).

    Eight bytes at a time go through a bijection that mixes all bits, so no algebraic relation between words makes
    them collide; long words go through a cryptographic digest.  Memory is bounded by the block, not by the text."""
    data = b"\n".join([*texts, b""])
    firsts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    begins, hashes, at = [], [[] for _ in range(lanes)], 0
    for block in blocks(data, SLICE):
        b, _, found = hash_block(block, lanes)
        begins.append(b + at)
        for k in range(lanes):
            hashes[k].append(found[k])
        at += len(block)
    begin = np.concatenate([np.zeros(0, np.int64), *begins])
    return [np.concatenate([np.zeros(0, np.uint64), *h]) for h in hashes], np.searchsorted(begin, firsts)


def windows(hashes: np.ndarray, *sizes: int, base: int = BASES[0]) -> list[np.ndarray]:
    """For each of the ascending `sizes`, the hash of every so many consecutive words (also across texts; callers leave
    those out).  Words are taken in one after another, each through the bijection."""
    out = []
    total = np.full(len(hashes), base, np.uint64)
    for j in range(max(sizes)):
        n = max(0, len(hashes) - j)
        total = mix((total[:n] ^ hashes[j : j + n]) * np.uint64(base))
        if j + 1 in sizes:
            out.append(mix(total + np.uint64(j + 1)))
    return out
