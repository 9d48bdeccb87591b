"""Best-fit packing of tokenised documents, in bulk-synchronous rounds.

``tokenize`` cuts each document's ids (the tokenizer's, then id 1) into
pieces of at most ``capacity`` tokens. A full piece is a sequence of its own;
``pack`` places the others, by length alone:

* items (unplaced pieces) and gaps (room left in open sequences) are sorted
  together by size, largest first, a gap before an item of its size, and
  dealt to tasks by range, one for each ``RANGE_ROWS``;
* each task sweeps its range downwards and gives every item the smallest gap
  that holds it (its successor in the order), updating the gap at once;
* items left over are matched with gaps left over in larger ranges by rank:
  the tasks' counts (one row a task) decide which ranks of which range meet,
  so that no two items claim the same room, and an equi-join on the rank
  carries it out;
* gaps are updated and the round repeats. When items exceed every gap, as
  many sequences are opened as those items need at least (by volume, and by
  the number of items over half the capacity).

Each round's items, gaps and placements are written to the shared folder, so
a lost executor costs one step. The driver sees one row a task and a
histogram of at most ``capacity`` sizes. Only ids and lengths travel; texts
are read once. A size shared by a third of all pieces is no hot key: the sort
breaks ties by id and the ranges split anywhere.

Defined results: null text is empty text (one token, the end id); repeated
rows and ids are separate documents; pieces of equal length are placed in the
order of their rows, documents of any length are tokenised part by part and
cut; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import itertools
import math
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .common import batch_slices, by_group, kept, read, stage_table
from .words import SLICE_BYTES, Words, separators, stretch_hashes

CAPACITY = 4096
END_ID = 1
CACHE_UNITS = 1_500_000
RANGE_ROWS = 1 << 14              # items and gaps swept in one task

_BLANK = re.compile(r"[ \t\n\r]")
BLANKS = separators([0x20, 0x09, 0x0A, 0x0D])
_ASCII_UPPER = separators(range(0x41, 0x5B))
_ASCII_LETTER = _ASCII_UPPER | separators(range(0x61, 0x7B))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of UTF-8 bytes: is it part of an ASCII or Latin-1 letter, and is it
    the second byte of a Latin-1 one."""
    second = np.zeros(len(data), dtype=bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)       # but for the signs of times and division
    letter = _ASCII_LETTER[data] | second
    letter[:-1] |= second[1:]
    return letter, second


class Units:
    """The stretches of some texts that are encoded one by one: blank-separated
    chunks, parted before a last full stop or comma that follows a letter.
    ``plain``: nothing but Latin-1 letters, lower-cased here as the tokenizer
    does (the others keep their bytes). ``first`` as in ``Words``."""

    def __init__(self, texts: list[str | None]):
        w = Words(texts, BLANKS, fold=False)
        letter, second = _letters(w.data)
        last = w.data[w.end - 1]
        parted = ((last == 0x2E) | (last == 0x2C)) & (w.end - w.start > 1) & letter[w.end - 2]
        before = np.append(0, np.cumsum(parted))
        at = np.arange(len(w)) + before[:-1]
        self.start, self.end = np.empty(len(w) + before[-1], np.int64), np.empty(len(w) + before[-1], np.int64)
        self.start[at], self.end[at] = w.start, w.end - parted
        self.start[at[parted] + 1], self.end[at[parted] + 1] = w.end[parted] - 1, w.end[parted]
        self.first = w.first + before[w.first]
        other = np.append(0, np.cumsum(~letter, dtype=np.int32))
        self.plain = other[self.end] == other[self.start]
        edge = np.zeros(len(w.data) + 1, dtype=np.int8)
        edge[self.start[self.plain]] += 1
        edge[self.end[self.plain]] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        upper = inside & np.where(second, w.data <= 0x9E, _ASCII_UPPER[w.data])
        self.data = w.data + (upper.astype(np.uint8) << np.uint8(5))


class Encoder:
    """Whole-text ids as unsigned 32-bit arrays.

    This tokenizer drops white space and never joins what it parts, so a
    text's ids are those of its units (``Units``) in turn. A slice's units are
    split and hashed in numpy; each distinct one is looked up by 128 bits, or
    encoded, once; the texts' ids are gathered by offsets from the ids of
    units met so far (about ``CACHE_UNITS``, then afresh). A plain unit is one
    pre-token and goes straight to the tokenizer's BPE model; any other
    through all its steps."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # the byte-level alphabet: each byte's stand-in character, as the library maps it
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = str.maketrans({c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x100)})
        self.forget()

    def forget(self) -> None:
        """Start the store of units anew: slot 0 is the end id. ``keys`` (sorted)
        and ``at`` lead to a unit's slot, ``check`` has its second lane."""
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.pool, self.begin, self.size, self.check = array("I", [END_ID]), array("I", [0]), array("I", [1]), array("Q", [0])

    def add(self, units: list[bytes], plain: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Slots of units not met before."""
        ids: list[list[int]] = [[]] * len(units)
        some = np.flatnonzero(plain).tolist()
        if some:
            texts = b" ".join([units[i] for i in some]).decode("utf-8").translate(self.letters).split(" ")
            tokens = self.model.tokenize
            for i, found in zip(some, [[t.id for t in tokens(x)] for x in texts]):
                ids[i] = found
        some = np.flatnonzero(~plain).tolist()
        if some:
            texts = [units[i].decode("utf-8", "surrogatepass") for i in some]
            for i, found in zip(some, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
                ids[i] = found.ids
        first = len(self.begin)
        size = np.fromiter(map(len, ids), np.uint32, len(ids))
        self.begin.frombytes((len(self.pool) + np.append(0, np.cumsum(size))[:-1]).astype(np.uint32).tobytes())
        self.size.frombytes(size.tobytes())
        self.check.frombytes(checks.tobytes())
        self.pool.extend(itertools.chain.from_iterable(ids))
        return np.arange(first, first + len(ids), dtype=np.int32)

    def slots(self, u: Units, value: np.ndarray, checks: np.ndarray, index: np.ndarray) -> np.ndarray:
        """Slots of distinct units, by their two lanes (the first ascending)."""
        found = np.full(len(value), -1, dtype=np.int32)
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, value), len(self.keys) - 1)
            slot = self.at[place]
            hit = (self.keys[place] == value) & (np.frombuffer(self.check, np.uint64)[slot] == checks)
            found[hit] = slot[hit]
        new = np.flatnonzero(found < 0)
        if len(new):
            begin, stop = u.start[index[new]].tolist(), u.end[index[new]].tolist()
            data = u.data.tobytes()
            found[new] = self.add([data[a:b] for a, b in zip(begin, stop)], u.plain[index[new]], checks[new])
            place = np.searchsorted(self.keys, value[new])
            self.keys, self.at = np.insert(self.keys, place, value[new]), np.insert(self.at, place, found[new])
        return found

    def __call__(self, texts: list[str | None], end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after the other, and where each text's begin
        (with the total at the end); ``end``: each text closes with the end id."""
        if len(self.begin) > CACHE_UNITS:
            self.forget()
        u = Units(texts)
        one, two = (stretch_hashes(u.data, u.start, u.end, lane) for lane in (0, 1))
        value, index, number = np.unique(one, return_index=True, return_inverse=True)
        if not (two == two[index][number]).all():            # unlike units of one 64-bit value: parted by the second lane
            _, index, number = np.unique(np.stack([one, two], axis=1), axis=0, return_index=True, return_inverse=True)
            value, number = one[index], number.reshape(-1)
        found = self.slots(u, value, two[index], index)
        slots = found[number]
        stop = u.first[1:].copy()
        if end:
            slots = np.insert(slots, stop, 0)
            stop += np.arange(1, len(stop) + 1)
        pool, begin, size = (np.frombuffer(x, np.uint32) for x in (self.pool, self.begin, self.size))
        length = size[slots].astype(np.int64)
        total = np.append(0, np.cumsum(length))
        at = np.repeat(begin[slots] - total[:-1], length) + np.arange(total[-1])
        ids = pool[at]
        del pool, begin, size                     # arrays can't grow while they are looked at
        return ids, np.append(0, total[stop])


def cut_long(text: str, limit: int = SLICE_BYTES) -> list[str]:
    """A long text in parts that begin and end at blanks."""
    parts, begin = [], 0
    while len(text) - begin > limit:
        blank = _BLANK.search(text, begin + limit)
        if blank is None:
            break
        parts.append(text[begin:blank.start()])
        begin = blank.end()
    return [*parts, text[begin:]]


def encoder(path: str) -> Encoder:
    """The worker process's encoder for this file; it outlives a task, so later tasks find words met before."""
    return kept(f"encoder {path}", lambda: Encoder(path))


PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])


def tokenize(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, doc_id: str = "doc_id",
             text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of every document; ``with_ids`` adds their ids (array<int>)."""
    path = path or tokenizer_path()
    schema = T.StructType([*PIECES.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]) if with_ids else PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            for a, b in batch_slices(batch.column(1), SLICE_BYTES):
                texts = batch.column(1).slice(a, b - a).to_pylist()
                if len(texts) == 1 and len(texts[0] or "") > 2 * SLICE_BYTES:
                    *most, last = cut_long(texts[0])                  # encoded part by part
                    ids = np.concatenate([*(encode([t], end=False)[0] for t in most), encode([last])[0]])
                    first = np.array([0, len(ids)])
                else:
                    ids, first = encode(texts)
                yield _pieces(batch.column(0).slice(a, b - a), ids, first, capacity, with_ids)
    return docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text")
                       ).mapInArrow(run, schema)


def _pieces(keys: pa.Array, ids: np.ndarray, first: np.ndarray, capacity: int, with_ids: bool) -> pa.RecordBatch:
    """Rows of the pieces of some texts, whose ids begin at ``first``."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    size = np.diff(first)
    count = -(-size // capacity)
    doc = np.repeat(np.arange(len(size)), count)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = piece * capacity
    length = np.minimum(size[doc] - start, capacity)
    begin = first[doc] + start
    crc = [zlib.crc32(ids[a:a + n]) for a, n in zip(begin.tolist(), length.tolist())]
    columns = [keys.take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
               pa.array(crc, pa.int64())]
    if with_ids:                                  # pieces stand one after the other
        columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
    return pa.RecordBatch.from_arrays(columns, names=[f.name for f in PIECES] + ["ids"] * with_ids)


# --- rounds ---------------------------------------------------------------
_ROUND = "kind int, id bigint, size bigint, bin bigint, part int, rank bigint, low bigint"
#: kinds of a sweep's output: placed item, item left, gap left for larger-range matching, gap of no use there, summary
PLACED, ITEM, GAP, SMALL, SUMMARY = range(5)


def sweep(sizes: np.ndarray, kinds: np.ndarray, ids: np.ndarray):
    """Best fit down one range. Sizes descend, a gap (kind 0) comes before an
    item (kind 1) of its size. Returns placed (item, bin, size) rows, items
    left and gaps left as (id, size)."""
    room: dict[int, list[int]] = {}
    order: list[int] = []                       # distinct gap sizes, ascending
    placed, left = [], []
    for size, kind, key in zip(sizes.tolist(), kinds.tolist(), ids.tolist()):
        if kind == 1:
            at = bisect.bisect_left(order, size)
            if at == len(order):
                left.append((key, size))
                continue
            gap = order[at]
            key_bin = room[gap].pop()
            if not room[gap]:
                del room[gap]
                order.pop(at)
            placed.append((key, key_bin, size))
            size, key = gap - size, key_bin
            if size == 0:
                continue
        if size not in room:
            room[size] = []
            bisect.insort(order, size)
        room[size].append(key)
    return placed, left, [(b, g) for g in order for b in room[g]]


def _sweep_range(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext
    frames = [f for f in frames if len(f)]
    if not frames:
        return
    f = pd.concat(frames, ignore_index=True)
    part = TaskContext.get().partitionId()
    placed, left, gaps = sweep(f["size"].to_numpy(), f["kind"].to_numpy(), f["id"].to_numpy())
    lowest = int(f["size"].min())
    wide = [g for g in gaps if g[1] >= lowest]   # hold any item of a later range
    rows = [(PLACED, k, s, b, part, 0, 0) for k, b, s in placed]
    rows += [(ITEM, k, s, -1, part, r, 0) for r, (k, s) in enumerate(left)]
    rows += [(GAP, b, s, b, part, r, 0) for r, (b, s) in enumerate(wide)]
    rows += [(SMALL, b, s, b, part, 0, 0) for b, s in gaps if s < lowest]
    rows.append((SUMMARY, len(left), left[0][1] if left else 0, len(wide), part, 0,
                 min((s for _, s in wide), default=0)))
    yield pd.DataFrame(rows, columns=["kind", "id", "size", "bin", "part", "rank", "low"])


def assign(summaries: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """From (part, items left, longest, gaps left, smallest gap), in order:
    (item part, first item rank, items, gap part, first gap rank, items a gap).
    The latest (smallest) gaps are used first."""
    stack: list[list[int]] = []
    out = []
    for part, items, longest, gaps, low in sorted(summaries):
        rank = 0
        while items and stack:
            q, free, have, first = stack[-1]
            each = have // longest
            take = min(items, free * each)
            used = -(-take // each)
            out.append((part, rank, take, q, first, each))
            rank, items = rank + take, items - take
            stack[-1][1] -= used
            stack[-1][3] += used
            if not stack[-1][1]:
                stack.pop()
        if gaps:
            stack.append([part, gaps, low, 0])
    return out


def _slots(matches):
    """Batch function over a sweep's left-overs: kind (0 gap, 1 item), id,
    size, and the slot (gap part, gap rank) that an item may use or a gap
    offers this round, -1 for none."""
    items: dict[int, list] = {}
    gaps: dict[int, list] = {}
    for part, first, take, q, gap0, each in matches:
        items.setdefault(part, []).append((first, take, q, gap0, each))
        gaps.setdefault(q, []).append((gap0, -(-take // each)))
    tables = {p: np.array(m) for p, m in items.items()}
    used = {q: np.array(sorted(m)) for q, m in gaps.items()}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            part, slot = np.full(len(f), -1), np.full(len(f), -1)
            kind, rank = f["kind"].to_numpy(), f["rank"].to_numpy()
            for p, at in f.groupby("part").indices.items():
                mine = at[kind[at] == ITEM]
                if p in tables and len(mine):
                    first, take, q, gap0, each = tables[p].T
                    k = np.maximum(np.searchsorted(first, rank[mine], side="right") - 1, 0)
                    into = rank[mine] - first[k]
                    ok = (into >= 0) & (into < take[k])
                    part[mine] = np.where(ok, q[k], -1)
                    slot[mine] = np.where(ok, gap0[k] + into // each[k], -1)
                mine = at[kind[at] == GAP]
                if p in used and len(mine):
                    first, n = used[p].T
                    k = np.maximum(np.searchsorted(first, rank[mine], side="right") - 1, 0)
                    ok = (rank[mine] >= first[k]) & (rank[mine] < first[k] + n[k])
                    part[mine] = np.where(ok, p, -1)
                    slot[mine] = np.where(ok, rank[mine], -1)
            yield pd.DataFrame({"kind": (kind == ITEM).astype(np.int32), "id": f["id"], "size": f["size"],
                                "gap_part": part, "gap_rank": slot})
    return run


def _fill(group: dict[str, np.ndarray]) -> list[tuple]:
    """One slot: its gap and the items it takes (at most ``capacity``)."""
    kind, ids, sizes = group["kind"], group["id"], group["size"]
    gap = int(ids[kind == 0][0])
    rest = int(sizes[kind == 0][0] - sizes[kind == 1].sum())
    rows = [(2, int(i), int(n), gap) for i, n in zip(ids[kind == 1], sizes[kind == 1])]
    return rows + [(0, gap, rest, -1)] * (rest > 0)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(key, length) pieces of 1 to ``capacity`` tokens, keys unique →
    (key, sequence_id, offset)."""
    spark = pieces.sparkSession
    full = pieces.filter(F.col("length") == capacity).select(
        "key", (F.col("key") * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    state = pieces.filter(F.col("length") < capacity).select(
        F.lit(1).alias("kind"), F.col("key").alias("id"), F.col("length").alias("size"))
    placements, opened = [], 0
    while True:
        histogram = state.groupBy("kind", "size").count().collect()         # at most 2 * capacity rows
        if not any(h.kind == 1 for h in histogram):
            break
        widest = max((h["size"] for h in histogram if h.kind == 0), default=0)
        over = [(h["size"], h["count"]) for h in histogram if h.kind == 1 and h["size"] > widest]
        new = max(math.ceil(sum(s * c for s, c in over) / capacity),
                  sum(c for s, c in over if 2 * s > capacity))
        if new:
            state = state.unionByName(spark.range(opened, opened + new).select(
                F.lit(0).alias("kind"), "id", F.lit(capacity).cast("bigint").alias("size")))
            opened += new
        n = max(1, math.ceil((sum(h["count"] for h in histogram) + new) / RANGE_ROWS))     # ranges follow the rows
        ranges = state.repartitionByRange(n, F.desc("size"), "kind", "id") if n > 1 else state.repartition(1)   # one range needs no bounds
        swept = stage_table(ranges.sortWithinPartitions(F.desc("size"), "kind", "id").select("kind", "id", "size").mapInPandas(_sweep_range, _ROUND), "pack-round")
        summary = swept.filter(F.col("kind") == SUMMARY).select("part", "id", "size", "bin", "low").collect()
        matches = assign([tuple(s) for s in summary])
        placements.append(swept.filter(F.col("kind") == PLACED).select("id", "bin"))
        left = swept.filter(F.col("kind").isin(ITEM, GAP, SMALL))
        if not matches:
            state = left.select((F.col("kind") == ITEM).cast("int").alias("kind"), "id", "size")
            continue
        slotted = left.select("kind", "id", "size", "part", "rank").mapInPandas(
            _slots(matches), "kind int, id bigint, size bigint, gap_part int, gap_rank bigint")
        settled = by_group(slotted.filter("gap_part >= 0"), ["gap_part", "gap_rank"], _fill,
                           "kind int, id bigint, size bigint, bin bigint", n)
        settled = stage_table(slotted.filter("gap_part < 0").select("kind", "id", "size", F.lit(-1).cast("bigint").alias("bin")).unionByName(
            settled), "pack-match")
        placements.append(settled.filter("kind = 2").select("id", "bin"))
        state = settled.filter("kind < 2").select("kind", "id", "size")
    if not placements:
        return full
    placed = placements[0]
    for p in placements[1:]:
        placed = placed.unionByName(p)
    in_bin = Window.partitionBy("bin").orderBy(F.desc("length"), "key")      # at most ``capacity`` pieces
    placed = placed.select(F.col("id").alias("key"), "bin").join(pieces.select("key", "length"), "key").select(
        "key", (F.col("bin") * 2 + 1).alias("sequence_id"),
        (F.sum("length").over(in_bin.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")).alias("offset"))
    return full.unionByName(placed)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, doc_id: str = "doc_id",
                   text: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: the pieces with sequence_id and offset."""
    pieces = tokenize(docs, path, capacity, doc_id, text, with_ids)
    pieces = stage_table(pieces.withColumn("key", F.monotonically_increasing_id()), "pack-pieces")
    return pieces.join(pack(pieces.select("key", "length"), capacity), "key").drop("key")


def query(spark, sf_dir: str) -> DataFrame:
    """op2: every document's pieces, packed into sequences of 4096 tokens."""
    return pack_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))


def best_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> int:
    """Sequences that sequential best-fit decreasing needs (for tests)."""
    room: list[int] = []
    bins = 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(room, n)
        if at < len(room):
            gap = room.pop(at)
        else:
            gap, bins = capacity, bins + 1
        if gap > n:
            bisect.insort(room, gap - n)
    return bins
