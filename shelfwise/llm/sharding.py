"""Sharding by a hypergeometric communication matrix: a uniform shuffle of all
rows into shards of exactly equal size (counts at most one apart).

The rows are numbered as they were written and cut into source blocks of
``block`` rows. How many rows of block p go to shard s is the matrix of a
uniform random permutation: a multivariate hypergeometric draw with the
blocks' sizes as row sums and the shards' sizes as column sums. It is drawn
exactly, before any row moves:

* a binary tree over the blocks splits a node's column counts between its two
  halves, all nodes of a height at once;
* a split draws the columns in turn from what is left, each by inverting the
  hypergeometric distribution on a seeded uniform number (``hypergeometric``).

Then each block permutes its rows (a row number by seeded hashes), the first
a[p][0] of them go to shard 0, the next a[p][1] to shard 1 and so on; a row's
place of arrival in the shard follows from the counts of the blocks before.
A shard of more than ``block`` rows is treated alike, with its arrivals cut
into blocks and ``FAN`` sub-shards of exact sizes, until a piece holds at most
``block`` rows; there a last permutation gives the slot.

Only SQL functions are used. A window never holds more than ``block`` rows, whatever the
keys: a doc_id, text or source in a third of all rows is spread like any other
rows (groups of equal texts are not kept together: the law is on ``rows``).
The matrix has one row a block. The driver sees the number of rows; one task
sums one row count for each task that wrote the rows.

Defined results: a null text has size 1 and crc32 0; null and repeated ids,
repeated rows and long texts are rows like others; an empty table gives no
rows; columns of the given frame stay, added ones take fresh names. The same
written rows and seed give the same shards whatever tasks are lost or retried.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_name, partitions, read, stage_table

SHARDS = 16
FAN = 16
BLOCK = 1 << 14
SEED = 20260


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x)


def uniform(*key) -> Column:
    """A number in [0, 1) decided by the key: 53 bits of its hash."""
    return F.shiftrightunsigned(F.xxhash64(*[k if isinstance(k, Column) else F.lit(k) for k in key]), 11) * F.lit(2.0 ** -53)


def hypergeometric(u: Column, draws: Column, good: Column, total: Column) -> Column:
    """How many of ``draws`` out of ``total`` are among the ``good`` ones:
    the distribution's inverse at ``u``. Probabilities are walked by their
    exact ratios over all values within 9 standard deviations and 30 of the
    mode; what lies beyond is less than one step of ``u``."""
    n, k, m = (c.cast("double") for c in (draws, good, total))
    low, high = F.greatest(F.lit(0).cast("bigint"), draws + good - total), F.least(draws, good)
    mode = F.floor((n + 1) * (k + 1) / (m + 2))
    spread = F.sqrt(F.greatest(F.lit(0.0), n * k / F.greatest(m, F.lit(1.0)) * (m - k) / F.greatest(m, F.lit(1.0))
                               * (m - n) / F.greatest(m - 1, F.lit(1.0))))
    reach = F.ceil(spread * 9) + 30
    first, last = F.least(F.greatest(low, mode - reach), high), F.greatest(F.least(high, mode + reach), low)

    def ratio(x: Column) -> Column:              # of the probability of x + 1 to that of x
        return (k - x) * (n - x) / ((x + 1) * (m - k - n + x + 1))

    def walk(values: Column) -> Column:
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
        whole = F.aggregate(values, start, lambda a, x: F.struct((a["w"] * ratio(x)).alias("w"), (a["sum"] + a["w"]).alias("sum")),
                            lambda a: a["sum"])
        none = F.lit(-1).cast("bigint")

        def step(a, x):
            return F.when(a["x"] >= 0, a).when(a["rest"] < a["w"], F.struct(a["w"].alias("w"), a["rest"].alias("rest"), x.alias("x"))
                                               ).otherwise(F.struct((a["w"] * ratio(x)).alias("w"), (a["rest"] - a["w"]).alias("rest"), none.alias("x")))
        return F.aggregate(values, F.struct(F.lit(1.0).alias("w"), (u * whole).alias("rest"), none.alias("x")), step,
                           lambda a: F.when(a["x"] >= 0, a["x"]).otherwise(F.element_at(values, -1)))
    return _let(F.sequence(first, last), walk)


def split(columns: Column, draws: Column, *key) -> Column:
    """Multivariate draw: how many of each column's rows are among ``draws``
    taken without replacement from all of them (array<bigint>)."""
    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("i"), _total(columns).alias("total"), draws.cast("bigint").alias("draws"),
                     F.array().cast("array<bigint>").alias("out"))

    def take(a, good):
        return _let(hypergeometric(uniform(*key, a["i"]), a["draws"], good, a["total"]), lambda x: F.struct(
            (a["i"] + 1).alias("i"), (a["total"] - good).alias("total"), (a["draws"] - x).alias("draws"),
            F.concat(a["out"], F.array(x)).alias("out")))
    return F.aggregate(columns, start, take, lambda a: a["out"])


def _pieces(size: Column, parts: int) -> Column:
    """Sizes of ``parts`` pieces, at most one apart."""
    return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.floor((size + parts - 1 - i) / parts).cast("bigint"))


def _starts(counts: Column) -> Column:
    """What stands before each entry: sums of the entries before it."""
    return F.transform(counts, lambda _, i: _total(F.slice(counts, F.lit(1), i)))


def _halves(left: Column) -> Callable[[Column], Column]:
    """From the draw of a tree node's left half: both halves' rows."""
    def both(drawn: Column) -> Column:
        return F.array(
            F.struct((F.col("block") * 2).alias("block"), left.alias("draws"), drawn.alias("counts"), F.col("before").alias("before")),
            F.struct((F.col("block") * 2 + 1).alias("block"), (F.col("draws") - left).alias("draws"),
                     F.zip_with("counts", drawn, lambda a, b: a - b).alias("counts"),
                     F.zip_with("before", drawn, lambda a, b: a + b).alias("before")))
    return both


def matrix(nodes: DataFrame, largest: int, parts: int, block: int, seed: int, level: int) -> DataFrame:
    """Nodes (node, size, start) of at most ``largest`` rows → one row a block:
    (node, block, first, sizes, starts, base). ``first`` holds the ranks in the block at
    which each part's rows begin, ``base`` + rank is a row's place of arrival."""
    height = max(0, math.ceil(math.log2(max(1, math.ceil(largest / block)))))
    spread = partitions(nodes.sparkSession)
    sizes = _pieces(F.col("size"), parts)
    state = nodes.select("node", "size", "start", F.lit(0).cast("bigint").alias("block"), F.col("size").alias("draws"),
                         sizes.alias("counts"), F.transform(sizes, lambda _: F.lit(0).cast("bigint")).alias("before"))
    for h in range(height, 0, -1):
        left = F.least(F.col("draws"), F.lit((1 << (h - 1)) * block).cast("bigint"))
        drawn = split(F.col("counts"), left, seed, level, F.col("node"), h, F.col("block"))
        state = state.select("node", "size", "start", F.explode(_let(drawn, _halves(left))).alias("_h")).select(
            "node", "size", "start", "_h.*").filter("draws > 0")
        if (height - h) % 4 == 3:                # many nodes by now: deal them out
            state = state.repartition(spread, "node", "block")
    inside = state.select("node", "block", "counts", "before", sizes.alias("sizes"), F.col("start"))
    inside = inside.withColumn("first", _starts(F.col("counts"))).withColumn(
        "starts", F.transform(_starts(F.col("sizes")), lambda x: x + F.col("start")))
    return inside.select("node", "block", "first", "sizes", "starts", F.transform(
        F.arrays_zip("starts", "before", "first"), lambda z: z["starts"] + z["before"] - z["first"]).alias("base"))


def _level(rows: DataFrame, drawn: DataFrame, block: int, parts: int, seed: int, level: int) -> DataFrame:
    """Sends each row of a node to one of the node's parts: new place, node, start and size."""
    rows = rows.withColumn("block", F.floor((F.col("pos") - F.col("start")) / block))
    local = Window.partitionBy("node", "block").orderBy(F.xxhash64(F.lit(seed), F.lit(level), F.lit("out"), "pos"), "pos")
    rows = rows.withColumn("rank", (F.row_number().over(local) - 1).cast("bigint")).drop("start", "size")
    met = rows.join(drawn, ["node", "block"])
    # the last part that begins at or before the rank: of parts without rows, the ones that follow share its beginning
    part = F.size(F.filter("first", lambda c: c <= F.col("rank")))
    met = met.withColumn("part", part)
    return met.select(*[c for c in rows.columns if c not in ("pos", "node", "block", "rank")],
                      (F.element_at("base", F.col("part")) + F.col("rank")).alias("pos"),
                      (F.col("node") * parts + F.col("part") - 1).alias("node"),
                      F.element_at("starts", F.col("part")).alias("start"), F.element_at("sizes", F.col("part")).alias("size"))


def places(rows: DataFrame, row: str, shards: int = SHARDS, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """(row, shard, slot) of a written table's rows, whose ``row`` column is
    the id that ``monotonically_increasing_id`` gave them when they were written."""
    spark: SparkSession = rows.sparkSession
    if shards < 1 or block < 1:
        raise ValueError("shards and block must be at least 1")
    ids = rows.select(F.col(f"`{row}`").alias("row"))
    n = ids.count()
    # gapless numbers: an id is its writing task and the row's number there
    task = F.shiftrightunsigned("row", 33)
    by_task = ids.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("c"))
    offset = by_task.select("task", (F.sum("c").over(Window.orderBy("task").rowsBetween(
        Window.unboundedPreceding, 0)) - F.col("c")).alias("offset"))
    state = ids.withColumn("task", task).join(offset, "task").select(
        "row", (F.col("offset") + F.col("row").bitwiseAND(F.lit((1 << 33) - 1))).alias("pos"),
        F.lit(0).cast("bigint").alias("node"), F.lit(0).cast("bigint").alias("start"), F.lit(n).cast("bigint").alias("size"))
    nodes = spark.range(1).select(F.lit(0).cast("bigint").alias("node"), F.lit(n).cast("bigint").alias("size"),
                                  F.lit(0).cast("bigint").alias("start"))
    largest, parts, level = n, shards, 0
    while True:
        drawn = stage_table(matrix(nodes, largest, parts, block, seed, level), "shard-matrix")
        state = _level(state, drawn, block, parts, seed, level)
        if level == 0:
            state = state.withColumns({"shard": F.col("node").cast("int"), "shard_start": F.col("start")})
        # every block knows its node's parts; block 0 of each node gives the next level's nodes
        nodes = drawn.filter("block = 0").select("node", F.posexplode(F.arrays_zip("starts", "sizes"))).select(
            (F.col("node") * parts + F.col("pos")).alias("node"), F.col("col.sizes").alias("size"), F.col("col.starts").alias("start"))
        largest, parts, level = math.ceil(largest / parts), FAN, level + 1
        if largest <= block:
            break
    last = Window.partitionBy("node").orderBy(F.xxhash64(F.lit(seed), F.lit("last"), "pos"), "pos")
    return state.select("row", "shard", (F.col("start") - F.col("shard_start") + F.row_number().over(last) - 1).alias("slot"))


def shard(frame: DataFrame, shards: int = SHARDS, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """``frame``'s rows with ``shard`` and ``slot`` columns. The frame is
    written once to the shared folder, so that its rows' numbers stay; only
    the numbers take part in the shuffle, then meet their rows again."""
    row = fresh_name(frame, "row")
    own = stage_table(frame.withColumn(row, F.monotonically_increasing_id()), "shard-rows")
    found = places(own, row, shards, seed, block)
    names = {c: fresh_name(frame, c) for c in ("shard", "slot")}
    found = found.select(F.col("row").alias(row), F.col("shard").alias(names["shard"]), F.col("slot").alias(names["slot"]))
    return own.join(found, row).drop(row)


def write_shards(frame: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, block: int = BLOCK) -> None:
    """Writes the shards as Parquet folders ``shard=0`` … with their rows in
    slot order, file after file."""
    given = shard(frame, shards, seed, block)
    names = {c: fresh_name(frame, c) for c in ("shard", "slot")}
    n = partitions(frame.sparkSession)
    given.repartitionByRange(n, names["shard"], names["slot"]).sortWithinPartitions(names["shard"], names["slot"]).write.mode(
        "overwrite").partitionBy(names["shard"]).parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    """op13: every document's shard and slot, counts at most one apart."""
    text = F.coalesce("text", F.lit(""))
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                              F.lit(None).cast("int").alias("grown_shard"))
