"""Vectorised word tables: split many texts into words and hash each word.

Works on UTF-8 bytes with numpy, a bounded slice of documents at a time, so
the cost per byte is a few nanoseconds and no Python object is made per word.

A word is hashed eight bytes at a time by a chain of bijective, non-linear
steps, so words of up to eight bytes and one length never collide, and no
pattern inside a longer word makes it collide with another. Two independent
lanes (``hash``, ``hash2``) make 128 bits where words stand for themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

SLICE_BYTES = 2_000_000          # text handled at once inside a task
LONG = 512                       # bytes; a longer stretch is hashed as a whole by BLAKE2

_MUL = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_STEPS = (np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: masks that keep a little-endian word's first 0 to 8 bytes
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def stretch_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """One 64-bit value a stretch of ``data`` (bytes, with at least eight more
    after the last stretch's end); equal bytes give equal values."""
    eight = np.ndarray((max(0, len(data) - 7),), dtype="<u8", buffer=data, strides=(1,))
    size = end - start
    h = mix(size.astype(np.uint64) * _MUL + _SEEDS[lane])
    short = size <= LONG
    at = np.flatnonzero(short & (size > 0))
    begin, left, own = start[at], size[at], h[at]
    while len(at):
        own = mix((own ^ (eight[begin] & _KEEP[np.minimum(left, 8)])) * _STEPS[lane])
        done = left <= 8
        h[at[done]] = own[done]
        going = ~done
        at, begin, left, own = at[going], begin[going] + 8, left[going] - 8, own[going]
    for i in np.flatnonzero(~short).tolist():
        digest = hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=16).digest()
        h[i] = np.frombuffer(digest, "<u8")[lane]
    return h


def separators(pattern_bytes) -> np.ndarray:
    """256 flags: True where a byte separates words."""
    table = np.zeros(256, dtype=bool)
    table[list(pattern_bytes)] = True
    return table


#: words ``[^\x20\x09-\x0D]+``
SPACES = separators([0x20, *range(0x09, 0x0E)])
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (of lower-cased text)
NON_ALNUM = separators([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


class Words:
    """Words of some texts. ``hash`` and ``hash2``: a 64-bit value a word each;
    ``first``: index of each text's first word, with the total at the end;
    ``start`` and ``end``: byte places in ``data`` (lower-cased if folded)."""

    def __init__(self, texts: list[str | None], sep: np.ndarray, fold: bool):
        raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        buf = np.frombuffer(b" " + b" ".join(raw) + b" " * 9, dtype=np.uint8)
        if fold:
            buf = _FOLD[buf]
        inside = ~sep[buf]
        change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.start, self.end = change[0::2], change[1::2]
        self.data = buf
        begins = np.zeros(len(raw) + 1, dtype=np.int64)
        begins[1:] = np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw)))
        self.first = np.searchsorted(self.start, begins + 1, side="left")
        self._lanes: list[np.ndarray | None] = [None, None]

    def hash_of(self, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
        """Hash of any stretches of ``data``; equal bytes give equal values."""
        return stretch_hashes(self.data, start, end, lane)

    def _lane(self, lane: int) -> np.ndarray:
        if self._lanes[lane] is None:
            self._lanes[lane] = self.hash_of(self.start, self.end, lane)
        return self._lanes[lane]

    @property
    def hash(self) -> np.ndarray:
        return self._lane(0)

    @property
    def hash2(self) -> np.ndarray:
        """The second lane, independent of the first."""
        return self._lane(1)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def sequence_hashes(hashes: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values (length n - size + 1):
    runs of doubled width are put together from two halves, the last step from
    two that overlap. Equal runs give equal values."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h, width = mix(hashes + np.uint64(salt) + _SEEDS[0]), 1
    while width * 2 <= size:
        h = mix(h[:-width] * _STEPS[0] + mix(h[width:] ^ _STEPS[1]))
        width *= 2
    rest = size - width
    return h[:n] if not rest else mix(h[:n] * _STEPS[1] + mix(h[rest:rest + n] ^ _STEPS[0]))


def within(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (and their text's number) where ``size`` words fit in one text."""
    n = int(first[-1])
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(n)
    ok = at + size <= first[1:][doc] if n else np.zeros(0, dtype=bool)
    return at[ok], doc[ok]


def slices(texts: list, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive (from, to) ranges of about ``limit`` characters; a longer
    text makes a range of its own."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if size and size + n > limit:
            yield begin, i
            begin, size = i, 0
        size += n + 1
    if begin < len(texts):
        yield begin, len(texts)
