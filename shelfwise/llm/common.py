"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage_table
from .words import SLICE_BYTES

__all__ = ["add_struct", "apart", "batch_slices", "drop_stage", "fresh_name", "kept", "let_go", "read", "sorted_join",
           "stage_table", "partitions"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores put before it until no column of ``df``
    has that name (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def apart(df: DataFrame, key: str) -> DataFrame:
    """``df`` with its key computed anew, so that Spark does not take it as
    partitioned by the key and plans an exchange below the next join on it:
    AQE splits a hot key's rows only between two exchanges."""
    kind, c = dict(df.dtypes)[key], F.col(f"`{key}`")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return df.withColumn(key, F.bitwise_not(F.bitwise_not(c)))
    if kind in ("string", "binary"):
        return df.withColumn(key, F.concat(c, F.lit("" if kind == "string" else b"")))
    raise TypeError(f"no exchange of its own for {kind}")


def sorted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """The join of two sides that grow with the input, sorted by the key on
    the executors. Spark sizes a stage table by its compressed files, so below
    the broadcast threshold it would gather many times that in the driver."""
    return left.join(right.hint("merge"), key, how)


def drop_stage(df: DataFrame) -> None:
    """Deletes a stage table whose readers have all been written."""
    jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/shelfwise-stages/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]) -> object:
    """What the worker process keeps under ``name`` for later tasks of the
    same operator, made if absent; another operator's task lets it go."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def let_go() -> None:
    """Frees what other operators' tasks left in this worker process: Spark
    uses a worker for all operators of a session, so an executor would hold
    their stores beside the present task's data."""
    _KEPT.clear()
    pa.default_memory_pool().release_unused()


def batch_slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """(from, to) ranges of a batch's texts of about ``limit`` bytes, found
    without making Python objects; a longer text makes a range of its own."""
    size = np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64) + 1
    total = np.cumsum(size)
    begin = 0
    while begin < len(size):
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield begin, end
        begin = end


def by_group(df: DataFrame, keys: list[str], rows_of: Callable[[dict[str, np.ndarray]], list[tuple]], schema: str,
             parts: int | None = None) -> DataFrame:
    """``rows_of`` applied to each group's columns. Groups are dealt and
    sorted by their keys and cut out of the batches, so a small group costs a
    slice of arrays, not a frame of its own. Only for groups of bounded size."""
    names = [part.split()[0] for part in schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for f in frames:
            f = f if rest is None else pd.concat([rest, f], ignore_index=True)
            if not len(f):
                continue
            key = f[keys].to_numpy()
            cut = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist()]
            rest = f.iloc[cut[-1]:]
            yield made(f, cut)
        if rest is not None and len(rest):
            yield made(rest, [0, len(rest)])

    def made(f: pd.DataFrame, cut: list[int]) -> pd.DataFrame:
        columns = {c: f[c].to_numpy() for c in f.columns}
        rows = [r for a, b in zip(cut[:-1], cut[1:]) for r in rows_of({c: v[a:b] for c, v in columns.items()})]
        return pd.DataFrame(rows, columns=names)
    n = parts or partitions(df.sparkSession)      # given, so that groups with few bytes and much work aren't coalesced
    return df.repartition(n, *keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def add_struct(df: DataFrame, base: str, struct: T.StructType, text: str,
               make: Callable[[], Callable[[list], pa.StructArray]]) -> tuple[DataFrame, str]:
    """``df`` with one more struct column computed from the text column in
    Arrow batches; all other columns pass through untouched. ``make`` runs
    once a task and returns the function from a batch's texts to the column.
    Returns the frame and the column's (fresh) name."""
    name = fresh_name(df, base)
    schema = T.StructType([*df.schema.fields, T.StructField(name, struct)])
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        compute = make()
        for whole in batches:
            for a, b in batch_slices(whole.column(place), SLICE_BYTES):        # texts of a few MB at once
                batch = whole.slice(a, b - a)
                out = compute(batch.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, name])

    return df.mapInArrow(run, schema), name
