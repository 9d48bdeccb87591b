"""Substring deduplication by recompression.

Every document is parsed into ever longer symbols by rounds of recompression:
a run of one symbol becomes a symbol, then every adjacent pair of a "left"
and a "right" symbol does, where a symbol's side is a bit of its name in that
round. A new symbol's name is a hash of what it is made of, so it is the same
in every document without a common dictionary, and equal word sequences get
equal symbols but near their ends. The parse keeps for each symbol the words
that decided it (its context): wherever those words recur, so does the symbol.

1. Names of the last round's symbols are exchanged (``blocks.shared``): which
   occur twice or more. Most text ends here.
2. A window of ``window`` words can recur only if it holds the context of a
   shared symbol, or of no symbol at all (then nothing is known, and it is
   kept). Hashes of just these windows (two times 64 bits) are exchanged.
3. The words of windows that occur twice are removed, judged on the input.

The answer is exact but for collisions of 128-bit hashes (two independent
64-bit hashes of every word and of every window). Texts are shuffled
as compressed blocks, twice; words never are. A window in a third of all
documents is sent once a block.

Words: ``[^\\x20\\x09-\\x0D]+``. Defined results: a null text has no words and
an empty kept text; repeated rows repeat each other's windows; a text of fewer
words than a window loses nothing; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import bucket_count, make_blocks, read_answers, shared, unpack
from .common import read
from .words import SPACES, Words, mix, sequence_hashes, within

WINDOW = 35
ROUNDS = 6

_RUN = np.uint64(0x8CB92BA72F3D8DD7)
_PAIR = np.uint64(0xD1B54A32D192ED03)


def symbols(hashes: np.ndarray, first: np.ndarray, rounds: int = ROUNDS):
    """Last round's symbols of texts whose words' hashes stand one after the
    other: (name, context from, context to), contexts in words; a context
    that reaches past its text's ends includes the border, as a place outside
    any window."""
    n = len(hashes)
    name, lo, hi = hashes.copy(), np.arange(n), np.arange(n) + 1
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    far = 1 << 40                                   # a context with a border in it fits no window
    for r in range(rounds):
        if not len(name):
            break
        joined = np.append(doc[1:] == doc[:-1], False)          # i and i + 1 are of one text
        before_lo = np.where(np.append(False, joined[:-1]), np.append(0, lo[:-1]), -far)
        after_hi = np.where(joined, np.append(hi[1:], 0), far)
        if r % 3 == 0:                              # runs of one symbol
            same = joined & np.append(name[1:] == name[:-1], False)
            head = np.flatnonzero(~np.append(False, same[:-1]))
            last = np.append(head[1:], len(name)) - 1
            size = (last - head + 1).astype(np.uint64)
            lo, hi = np.minimum(lo[head], before_lo[head]), np.maximum(hi[last], after_hi[last])
            name = np.where(size > 1, mix(name[head] * _RUN + size), name[head])
            doc = doc[head]
            if not len(name):
                break
            joined = np.append(doc[1:] == doc[:-1], False)
            before_lo = np.where(np.append(False, joined[:-1]), np.append(0, lo[:-1]), -far)
            after_hi = np.where(joined, np.append(hi[1:], 0), far)
        right = ((mix(name + np.uint64(r + 1)) >> np.uint64(17)) & np.uint64(1)).astype(bool)
        pair = joined & ~right & np.append(right[1:], False)
        lo = np.where(right, np.minimum(lo, before_lo), lo)
        hi = np.where(right, hi, np.maximum(hi, after_hi))
        at = np.flatnonzero(pair)
        made = mix(name[at] * _PAIR + mix(name[at + 1] + np.uint64(r)))
        lo[at] = np.minimum(lo[at], lo[at + 1])
        hi[at] = np.maximum(hi[at], hi[at + 1])
        name = name.copy()
        name[at] = made
        keep = np.ones(len(name), dtype=bool)
        keep[at + 1] = False
        name, lo, hi, doc = name[keep], lo[keep], hi[keep], doc[keep]
    return name, lo, hi


class Parsed:
    """A block's words, symbols and windows."""

    def __init__(self, texts: list[str | None], window: int):
        self.window = window
        self.words = Words(texts, SPACES, fold=False)
        self.name, self.lo, self.hi = symbols(self.words.hash, self.words.first)
        self.names, self.which, self.times = np.unique(self.name, return_inverse=True, return_counts=True)

    def windows_with(self, chosen: np.ndarray) -> np.ndarray:
        """Of each place: does the window there hold one of the contexts."""
        n = len(self.words)
        lo, hi = self.lo[chosen], self.hi[chosen]
        fits = hi - lo <= self.window
        begin, end = np.maximum(hi[fits] - self.window, 0), lo[fits] + 1
        return np.cumsum(np.bincount(begin, minlength=n + 1)[:n + 1] - np.bincount(end, minlength=n + 1)[:n + 1])[:n] > 0

    def candidates(self, answers, buckets: int):
        """Places of the windows that may recur, and their hashes."""
        twice = (self.times > 1) | read_answers(answers, self.names, buckets)
        places, _ = within(self.words.first, self.window)
        if not len(places):
            none = np.zeros(0, dtype=np.uint64)
            return places, none, none
        may = self.windows_with(twice[self.which]) | ~self.windows_with(np.ones(len(self.name), dtype=bool))
        places = places[may[places]]
        one = sequence_hashes(self.words.hash, self.window)[places]
        two = sequence_hashes(self.words.hash2, self.window)[places]
        return places, one, two


def distinct(one: np.ndarray, two: np.ndarray):
    """Distinct pairs in order: (first, second, each pair's number, times)."""
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    number = np.empty(len(a), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return a[new], b[new], number, np.bincount(number, minlength=int(new.sum()))


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, spans ([from, to) in words
    that are removed) and kept (the words that stay, joined by a space)."""
    if window < 1:
        raise ValueError("window must be at least 1")
    blocks = make_blocks(docs, doc_id, text)
    buckets = bucket_count(blocks)
    blocks = blocks.select("block", "payload")

    def symbol_names(payload):
        return Parsed(unpack(payload)[1], window).names, None

    def window_names(payload, symbols):
        p = Parsed(unpack(payload)[1], window)
        _, one, two = p.candidates(symbols, buckets)
        one, two, _, _ = distinct(one, two)
        return one, two
    window_names.wide = True

    found = shared(blocks, symbol_names, "shared-symbols", buckets).withColumnRenamed("answers", "symbols")
    known = blocks.join(found, "block", "left")
    repeats = shared(known, window_names, "shared-windows", buckets).withColumnRenamed("answers", "windows")
    whole = known.join(repeats, "block", "left").select("payload", "symbols", "windows")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, found, again in zip(*(batch.column(k) for k in range(3))):
                yield removed(*unpack(payload.as_py()), found.as_py(), again.as_py())

    def removed(ids, texts, found, again) -> pa.RecordBatch:
        p = Parsed(texts, window)
        places, one, two = p.candidates(found, buckets)
        one, _, number, times = distinct(one, two)
        begin = places[((times > 1) | read_answers(again, one, buckets))[number]]
        n = len(p.words)
        gone = np.cumsum(np.bincount(begin, minlength=n + 1) - np.bincount(begin + window, minlength=n + 1)[:n + 1])[:n] > 0
        total = np.append(0, np.cumsum(gone))
        first, counts = p.words.first, p.words.counts()
        lost = total[first[1:]] - total[first[:-1]]
        spans, kept = [], []
        for d, t in enumerate(texts):
            parts = (t or "").encode("utf-8", "surrogatepass").split()
            if lost[d]:
                mine = gone[first[d]:first[d + 1]]
                edge = np.flatnonzero(np.diff(mine, prepend=False, append=False))
                spans.append(edge.reshape(-1, 2).tolist())
                parts = list(itertools.compress(parts, (~mine).tolist()))
            else:
                spans.append([])
            kept.append(b" ".join(parts).decode("utf-8", "surrogatepass"))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(lost, pa.int64()),
             pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "n_removed", "spans", "kept"])
    return whole.mapInArrow(
        remove, "doc_id bigint, n_words bigint, n_removed bigint, spans array<array<bigint>>, kept string")


def query(spark, sf_dir: str) -> DataFrame:
    """op3: what stays of every document."""
    out = dedup_substrings(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[str | None], window: int = WINDOW) -> list[tuple[int, int, str]]:
    """(n_words, n_removed, kept text) by comparing all windows, for tests."""
    import re
    from collections import Counter
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out
