"""Exact, linearly interpolated quantiles without gathering a column in one task.

The values are range-partitioned and sorted; a value's position is its
partition's offset plus its place in the partition. Only the partitions'
counts (one row per partition and column) meet in one place, and only the
two neighbours of each wanted position leave their partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """One row with a column per entry ``name: (column, quantile)``; NULLs do
    not count, and a column without values gives NULL. The sorted values are
    written as a stage table (a range partitioning is sampled, so it must not
    be drawn twice)."""
    columns = sorted({c for c, _ in wanted.values()})
    long = df.select([F.col(f"`{c}`").cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "column", "v").filter("v IS NOT NULL")
    ordered = long.repartitionByRange("column", "v").sortWithinPartitions("column", "v")
    ordered = stage_table(ordered.withColumn("id", F.monotonically_increasing_id()), "sorted-values")
    ordered = ordered.withColumn("part", F.shiftright("id", 33))
    counts = ordered.groupBy("column", "part").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("column", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
                           F.sum("n").over(Window.partitionBy("column")).alias("total"))
    place = F.col("offset") + F.col("id") - F.col("first")
    placed = ordered.join(counts, ["column", "part"]).select("column", "v", "total", place.alias("place"))
    near, out = F.lit(False), []
    for name, (column, q) in wanted.items():
        at = F.lit(float(q)) * (F.col("total") - 1)
        low, high = F.floor(at), F.ceil(at)
        mine = F.col("column") == column
        near = near | (mine & F.col("place").isin(low, high))
        lower = F.max(F.when(mine & (F.col("place") == low), F.col("v")))
        upper = F.max(F.when(mine & (F.col("place") == high), F.col("v")))
        share = F.max(F.when(mine, at - low))
        out.append(F.when(share == 0, lower).otherwise((1 - share) * lower + share * upper).alias(name))
    return placed.filter(near).agg(*out)
