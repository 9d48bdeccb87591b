"""Registry of checkable queries: a Spark callable ``(spark, sf_dir) →
DataFrame`` and, where SQL can express it, the DuckDB twin.

Float sums differ in their last bits between engines (and between Spark
partitionings), so both sides snap the declared double columns to a binary
grid of ``digits`` significant bits as their final step (see
``functions.columns.grid_round``). Everything before that step is the
library's own output.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.columns import grid_round, grid_round_sql


@dataclass
class Entry:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: tuple[str, ...]
    digits: int


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, doubles=(), digits: int = 32):
    def deco(fn):
        REGISTRY[name] = Entry(name, fn, sql, tuple(doubles), digits)
        return fn
    return deco


def spark_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    entry = REGISTRY[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = entry.build(spark, sf_dir)
        if not entry.doubles:
            return df
        rounded = set(entry.doubles)
        return df.select(*[
            grid_round(F.col(c), entry.digits).alias(c) if c in rounded else F.col(c)
            for c in df.columns
        ])
    run.__name__ = name
    run.__doc__ = entry.build.__doc__
    return run


def oracle_query(name: str) -> str | None:
    from .oracle import expand_aggregates
    entry = REGISTRY[name]
    if entry.sql is None:
        return None
    sql = expand_aggregates(entry.sql)
    if not entry.doubles:
        return sql
    repl = ", ".join(f"{grid_round_sql(c, entry.digits)} AS {c}" for c in entry.doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"
