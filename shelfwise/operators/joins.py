"""Join helpers.

``join_dimension`` is a plain equi-join: no hint and no size check of its
own. Spark broadcasts the smaller side when its measured size lies below
``spark.sql.autoBroadcastJoinThreshold`` (before the run from file sizes,
and again at run time from shuffle sizes under AQE); beyond it the sides are
shuffled on the key and sort-merged, which spills, and AQE splits a skewed
key's partition as long as both sides come straight from an exchange.
``fresh_exchange`` makes sure of that for a side that is already
partitioned by the key. ``join_facts`` joins two line-scale tables with a
sort-merge join, never a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join ``fact`` to ``dim``; Spark picks the strategy by measured size."""
    return fact.join(dim, on, how)


def fresh_exchange(df: DataFrame, key: str) -> DataFrame:
    """``df`` with its integer key recomputed (two bitwise negations), so that
    Spark does not take it as partitioned by the key any more and plans an
    exchange below the next join on it. AQE splits a hot key only between two
    exchanges: without this a key that holds a third of the other side's rows
    would stay in one task."""
    return df.withColumn(key, F.bitwise_not(F.bitwise_not(F.col(key))))


def join_facts(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join two line-scale tables with a sort-merge join on the key (both
    sides shuffled by it; AQE splits a skewed key's partition). Pinned so
    that neither side is ever broadcast because a file looked small."""
    return left.join(right.hint("merge"), on, how)
