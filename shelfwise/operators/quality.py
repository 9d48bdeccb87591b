"""Data-quality and profile figures, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import np_round
from ..functions.quantiles import exact_quantiles


def join_null_check(joined: DataFrame, probe: str = "Inventory_Level") -> DataFrame:
    """Rows of the master join and how many found no inventory."""
    return joined.agg(F.count(F.lit(1)).alias("joined_rows"),
                      F.count_if(F.col(probe).isNull()).alias("unmatched_rows"))


def describe_column(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Count / mean / std / min / 25 % / 50 % / 75 % / max with exact,
    linearly interpolated quartiles (``summary()`` would approximate them),
    as one (statistic, value) row each."""
    x = F.col(column)
    stats = df.agg(
        F.count(x).cast("double").alias("count"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )
    quartiles = exact_quantiles(df, {"25%": (column, 0.25), "50%": (column, 0.5), "75%": (column, 0.75)})
    stats = stats.crossJoin(F.broadcast(quartiles))          # one row each
    names = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    long = stats.unpivot([], [F.col(f"`{n}`") for n in names], "statistic", "value")
    order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("statistic"))
    return long.select("statistic", np_round("value", digits).alias("value"),
                       order.cast("bigint").alias("position"))


def null_counts(df: DataFrame) -> DataFrame:
    """NULL count per column, only columns with at least one NULL.
    One pass: every count is a ``count_if`` in the same aggregation."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    long = counts.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column", "nulls")
    return long.filter(F.col("nulls") > 0)


def input_profile(df: DataFrame, *columns: str) -> DataFrame:
    """Row count and the sorted distinct values of ``columns``."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.array_join(F.sort_array(F.collect_set(c)), ",").alias(f"{c}_values")
             for c in columns]
    return df.agg(*aggs)


def profile_of_parts(parts: DataFrame) -> DataFrame:
    """A21 from the line pass's parts: lines, sorted distinct categories and
    regions of both inputs, in one row."""
    out = []
    for name, kind in (("sales", "S"), ("inventory", "I")):
        mine = F.col("kind") == kind
        out.append(F.coalesce(F.sum(F.when(mine, F.col("rows"))), F.lit(0)).alias(f"{name}_rows"))
        for column, plural in (("Category", "categories"), ("Region", "regions")):
            out.append(F.array_join(F.sort_array(F.collect_set(F.when(mine, F.col(column)))), ",").alias(f"{name}_{plural}"))
    return parts.agg(*out)
