"""Blocks of documents and the exchange of names between them.

A block is a row that holds some consecutive documents' texts, compressed.
Blocks are written once; later steps read them again instead of shuffling
words. ``shared`` answers, for names (64-bit values, or pairs of them) that
every block derives from its texts, which of them occur in another block as
well. A block sends each of its names once, so a name in a third of all
documents is one entry a block; names travel as packed arrays dealt by their
own value, and the answer is a bit for each name sent, in the order in which
the block sent them (no row ids travel).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_slices, let_go, partitions, stage_table
from .words import SLICE_BYTES

BUCKET_BYTES = 8_000_000

_ANSWERS = "array<struct<bucket:int,bits:binary>>"


def unpack(payload: bytes) -> tuple[list[int | None], list[str | None]]:
    """A block's (ids, texts)."""
    return pickle.loads(zstandard.ZstdDecompressor().decompress(payload))


def make_blocks(docs: DataFrame, doc_id: str, text: str, limit: int = SLICE_BYTES) -> DataFrame:
    """(block, payload) of the documents, as a written table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for a, b in batch_slices(batch.column(1), limit):
                ids, texts = (batch.column(k).slice(a, b - a).to_pylist() for k in (0, 1))
                data = pickle.dumps((ids, texts))
                yield pa.RecordBatch.from_arrays([pa.array([pack.compress(data)], pa.binary()), pa.array([len(data)], pa.int64())],
                                                 names=["payload", "size"])
    packed = docs.select(F.col(f"`{doc_id}`").cast("bigint"), F.col(f"`{text}`")).mapInArrow(run, "payload binary, size bigint")
    return stage_table(packed.select(F.monotonically_increasing_id().alias("block"), "payload", "size"), "blocks")


def bucket_count(blocks: DataFrame) -> int:
    """Buckets that names are dealt into: so many that the names of one, sent
    by blocks of this many bytes in all, take about ``BUCKET_BYTES``."""
    size = blocks.agg(F.sum("size")).first()[0] or 0
    return max(partitions(blocks.sparkSession) * 2, -(-size // BUCKET_BYTES))


def buckets_of(names: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its names' places), buckets by the names' value."""
    bucket = (names % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edge = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=n))
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        yield int(bucket[order[a]]), order[a:b]


def read_answers(answers, names: np.ndarray, n: int) -> np.ndarray:
    """One flag a name: shared with another block."""
    out = np.zeros(len(names), dtype=bool)
    got = {a["bucket"]: a["bits"] for a in answers} if answers is not None else {}
    if got:
        for bucket, at in buckets_of(names, n):
            if bucket in got:
                out[at] = np.unpackbits(np.frombuffer(got[bucket], np.uint8), count=len(at)).astype(bool)
    return out


def shared(frame: DataFrame, names_of: Callable[..., tuple[np.ndarray, np.ndarray | None]], label: str, n: int) -> DataFrame:
    """(block, answers) for the blocks of ``frame`` that have any shared name.
    ``names_of`` gives a row's distinct names, in an order that it always
    gives them in, and perhaps a second array of values that must agree too
    (``names_of.wide``). With ``names_of.short`` only the upper 32 bits travel
    beside the bucket: names may then be called shared that are not, evenly
    for all that hold them. ``n``: buckets (``bucket_count``)."""
    columns = frame.columns

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                values = {c: batch.column(k)[row].as_py() for k, c in enumerate(columns)}
                names, more = names_of(**{k: v for k, v in values.items() if k != "block"})
                which, sent = [], []
                for bucket, at in buckets_of(names, n):
                    which.append(bucket)
                    mine = (names[at] >> np.uint64(32)).astype(np.uint32) if short else names[at]
                    sent.append(mine.tobytes() + (more[at].tobytes() if more is not None else b""))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([values["block"]] * len(which), pa.int64()), pa.array(which, pa.int32()),
                     pa.array(sent, pa.binary())], names=["block", "bucket", "names"])

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        sent = [np.frombuffer(x, dtype=np.uint32 if short else np.uint64) for x in group["names"]]
        if wide:
            first = np.concatenate([s[:len(s) // 2] for s in sent])
            second = np.concatenate([s[len(s) // 2:] for s in sent])
            order = np.lexsort((second, first))
            same = (np.diff(first[order]) == 0) & (np.diff(second[order]) == 0)
        else:
            first = np.concatenate(sent)
            order = np.argsort(first)
            same = np.diff(first[order]) == 0
        flag = np.zeros(len(first), dtype=bool)
        flag[order[1:][same]] = True
        flag[order[:-1][same]] = True
        rows, at = [], 0
        for block, bucket, s in zip(group["block"], group["bucket"], sent):
            mine = flag[at:at + len(s) // (1 + wide)]
            at += len(mine)
            if mine.any():
                rows.append((block, bucket, np.packbits(mine).tobytes()))
        return pd.DataFrame(rows, columns=["block", "bucket", "bits"])

    wide, short = getattr(names_of, "wide", False), getattr(names_of, "short", False)
    sent = frame.mapInArrow(send, "block bigint, bucket int, names binary")
    answers = sent.groupBy("bucket").applyInPandas(answer, "block bigint, bucket int, bits binary")
    return stage_table(answers.groupBy("block").agg(
        F.collect_list(F.struct("bucket", "bits")).alias("answers")), label)
