"""Benchmark decontamination by Wu-Manber multi-pattern search.

A benchmark item's patterns are its windows of ``window`` consecutive words
(an item of fewer words is one window). Patterns of one length are searched
together: a shift table, indexed by a block of two words, tells how far the
search may jump from a place; where it says zero, the bucket of patterns
with that last block is tested, and an occurrence counts only after its
words are compared directly with the pattern's.

Documents are searched where they lie (no shuffle). The patterns travel to
the tasks in batches of at most ``batch_windows`` windows, so what is sent
has a fixed bound however many benchmark items there are; with more than one
batch, the batches' occurrences are united by a running column of spans.

Words: A-Z lower-cased, then maximal runs of digits, letters a-z and
non-ASCII characters. Defined results: a null or wordless text has no words
and no hit; an item without words is no pattern; a null item_id is written
``null``; repeated items and rows are each judged alike; an empty benchmark
hits nothing. All columns of the documents are kept; the result is one more
struct column whose name avoids theirs.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_struct, read
from .words import NON_ALNUM, Words, slices

WINDOW = 13
BATCH_WINDOWS = 500_000
LANE = 128                        # places that one lane of the search walks through
_BLOCK = np.uint64(0x9E3779B97F4A7C15)

MATCH = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),   # [from, to) in words
    T.StructField("items", T.ArrayType(T.StringType())),
])


def item_windows(text: str | None, window: int = WINDOW) -> list[bytes]:
    """An item's windows, as their words joined by one space."""
    w = Words([text], NON_ALNUM, fold=True)
    n = len(w)
    if n == 0:
        return []
    words = [w.text(i) for i in range(n)]
    size = min(window, n)
    return [b" ".join(words[i:i + size]) for i in range(n - size + 1)]


class Patterns:
    """Search tables for the patterns of one length."""

    def __init__(self, length: int, texts: list[bytes]):
        self.length, self.texts = length, texts
        self.block = min(2, length)
        table = Words([t.decode("utf-8", "surrogatepass") for t in texts], NON_ALNUM, fold=False)
        rows = table.hash.reshape(len(texts), length)
        self.bits = np.uint64(64 - max(12, int(len(texts) * length * 4).bit_length()))
        most = length - self.block + 1
        self.shift = np.full(1 << (64 - int(self.bits)), most, dtype=np.int64)
        for j in range(self.block, length + 1):
            np.minimum.at(self.shift, self.slot(self.block_at(rows, j - 1)), length - j)
        last = self.block_at(rows, length - 1)
        order = np.argsort(last, kind="stable")
        self.rows, self.number = rows[order], order
        self.keys, begin = np.unique(last[order], return_index=True)
        self.bucket = np.append(begin, len(texts))

    def block_at(self, rows: np.ndarray, j: int) -> np.ndarray:
        """Block value of the words that end at place j of each row."""
        if self.block == 1:
            return rows[:, j] * _BLOCK
        return (rows[:, j - 1] * np.uint64(3) + rows[:, j]) * _BLOCK

    def slot(self, block: np.ndarray) -> np.ndarray:
        return (block >> self.bits).astype(np.int64)

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word's place, pattern number) of every occurrence."""
        m, h = self.length, w.hash
        lo, hi = w.first[:-1] + m - 1, w.first[1:]
        lanes = np.maximum(0, -(-(hi - lo) // LANE))
        doc = np.repeat(np.arange(len(lo)), lanes)
        step = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = lo[doc] + step * LANE
        stop = np.minimum(at + LANE, hi[doc])
        ends = []
        while len(at):
            b = h[at] * _BLOCK if self.block == 1 else (h[at - 1] * np.uint64(3) + h[at]) * _BLOCK
            jump = self.shift[self.slot(b)]
            zero = jump == 0
            if zero.any():
                ends.append(np.stack([at[zero].astype(np.uint64), b[zero]]))
            at = at + np.maximum(jump, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found = np.concatenate(ends, axis=1)
        end, b = found[0].astype(np.int64), found[1]
        k = np.minimum(np.searchsorted(self.keys, b), len(self.keys) - 1)
        ok = self.keys[k] == b
        end, k = end[ok], k[ok]
        size = self.bucket[k + 1] - self.bucket[k]
        each = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        end, row = np.repeat(end, size), np.repeat(self.bucket[k], size) + each
        for j in range(m):                       # words' hashes, then the words themselves
            same = h[end - m + 1 + j] == self.rows[row, j]
            end, row = end[same], row[same]
        number = self.number[row]
        same = np.fromiter((self.equal(w, e - m + 1, p) for e, p in zip(end.tolist(), number.tolist())),
                           bool, len(end))
        return end[same] - m + 1, number[same]

    def equal(self, w: Words, begin: int, number: int) -> bool:
        return b" ".join(w.text(i) for i in range(begin, begin + self.length)) == self.texts[number]


class Searcher:
    """All patterns of a batch: window text → item ids."""

    def __init__(self, windows: list[tuple[bytes, list[str]]]):
        by_length = defaultdict(list)
        for text, ids in windows:
            by_length[text.count(b" ") + 1].append((text, ids))
        self.parts = [(Patterns(n, [t for t, _ in group]), [ids for _, ids in group])
                      for n, group in sorted(by_length.items())]

    def __call__(self, texts: list[str | None]) -> list[tuple[int, list[list[int]], list[str]]]:
        out = []
        for a, b in slices(texts):
            w = Words(texts[a:b], NON_ALNUM, fold=True)
            spans, items = defaultdict(list), defaultdict(set)
            for patterns, ids in self.parts:
                begin, number = patterns.find(w)
                doc = np.searchsorted(w.first, begin, side="right") - 1
                for d, s, p in zip(doc.tolist(), (begin - w.first[doc]).tolist(), number.tolist()):
                    spans[d].append((s, s + patterns.length))
                    items[d].update(ids[p])
            for d, n in enumerate(w.counts().tolist()):
                out.append((n, merge(spans[d]) if d in spans else [], sorted(items[d]) if d in items else []))
        return out


def merge(spans) -> list[list[int]]:
    """Sorted union of [from, to) spans."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def _batches(benchmark: DataFrame, item_id: str, text: str, window: int, limit: int):
    """Batches of (window text, item ids) of at most ``limit`` windows, read
    row by row (one partition of the benchmark on the driver at a time)."""
    batch: dict[bytes, set[str]] = {}
    for row in benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")), F.col(text)).toLocalIterator():
        for w in item_windows(row[1], window):
            batch.setdefault(w, set()).add(row[0])
            if len(batch) >= limit:
                yield [(k, sorted(v)) for k, v in batch.items()]
                batch = {}
    if batch:
        yield [(k, sorted(v)) for k, v in batch.items()]


def search(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
           item_text: str = "text", window: int = WINDOW,
           batch_windows: int = BATCH_WINDOWS) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (n_words, spans, items) and its name."""
    if window < 1:
        raise ValueError("window must be at least 1")
    spark = docs.sparkSession
    found: list[str] = []
    out = docs
    for batch in _batches(benchmark, item_id, item_text, window, batch_windows) or ():
        out, name = _search_batch(spark, out, text, batch)
        found.append(name)
    if not found:
        out, name = _search_batch(spark, out, text, [])
        found = [name]
    if len(found) == 1:
        return out, found[0]
    spans = F.flatten(F.array(*[F.col(f"`{c}`.spans") for c in found]))
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"`{c}`.items") for c in found]))))
    ordered = F.array_sort(spans)
    last = F.element_at
    union = F.aggregate(ordered, F.array().cast("array<array<bigint>>"), lambda acc, s: F.when(
        (F.size(acc) > 0) & (s[0] <= F.when(F.size(acc) > 0, last(acc, -1)[1])),
        F.concat(F.slice(acc, 1, F.size(acc) - 1),
                 F.array(F.array(last(acc, -1)[0], F.greatest(last(acc, -1)[1], s[1])))),
    ).otherwise(F.concat(acc, F.array(s))))
    whole = F.struct(F.col(f"`{found[0]}`.n_words").alias("n_words"), union.alias("spans"), items.alias("items"))
    return out.withColumn(found[0], whole).drop(*found[1:]), found[0]


def _search_batch(spark, docs: DataFrame, text: str, batch) -> tuple[DataFrame, str]:
    sent = spark.sparkContext.broadcast(batch)      # at most batch_windows windows

    def make():
        find = Searcher(sent.value)

        def column(texts):
            found = find(texts)
            return pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.list_(pa.list_(pa.int64()))),
                 pa.array([f[2] for f in found], pa.list_(pa.string()))],
                names=["n_words", "spans", "items"])
        return column
    return add_struct(docs, "benchmark_match", MATCH, text, make)


def n_hit(match: str):
    """Words inside any occurrence, from the spans."""
    return F.aggregate(F.col(f"`{match}`.spans"), F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])


def contaminated(match: str):
    """The contract's rule: some hit, and at least a twentieth of the words."""
    return (n_hit(match) > 0) & (F.lit(20) * n_hit(match) >= F.col(f"`{match}`.n_words"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones, columns as given."""
    found, match = search(docs, benchmark, text)
    return found.filter(~contaminated(match)).drop(match)


def query(spark, sf_dir: str) -> DataFrame:
    """op10: the contract's digest for all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found, m = search(docs, read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.col(f"{m}.n_words").alias("n_words"), n_hit(m).alias("n_hit"),
                        F.size(F.col(f"{m}.items")).cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", F.col(f"{m}.items")), 256).alias("items_sha256"),
                        contaminated(m).alias("contaminated"))


def brute_force(texts: list[str | None], items: list[tuple[object, str | None]], window: int = WINDOW):
    """Plain-Python answer for tests: (n_words, n_hit, n_items, items_sha256, contaminated) a text."""
    import re
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = []
    benchmark = [("null" if i is None else str(i), split(t)) for i, t in items]
    for t in texts:
        words = split(t)
        hit, ids = set(), set()
        for i, item in benchmark:
            size = min(window, len(item))
            for a in range(len(item) - size + 1 if size else 0):
                for b in range(len(words) - size + 1):
                    if words[b:b + size] == item[a:a + size]:
                        hit.update(range(b, b + size))
                        ids.add(i)
        out.append((len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(words)))
    return out
