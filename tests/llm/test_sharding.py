"""Sharding: exact counts, the matrix's distribution and a uniform shuffle."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import sharding

SF = "/root/testdata/sf0.001"


def big(v):
    return F.lit(v).cast("bigint")


@pytest.mark.parametrize("n,shards,block", [(0, 16, 4), (5, 16, 2), (700, 3, 7), (3000, 16, 1 << 14), (4000, 16, 40)])
def test_exact_counts_and_gapless_slots(spark, n, shards, block):
    frame = spark.range(0, n, 1, 3).select("id", F.lit(None).cast("string").alias("Shard"), F.lit("x" * 50).alias("slot"))
    out = sharding.shard(frame, shards, 7, block)
    assert out.columns == ["id", "Shard", "slot", "_shard", "_slot"]
    slots = defaultdict(list)
    rows = out.collect()
    for r in rows:
        slots[r["_shard"]].append(r["_slot"])
    assert sorted(r["id"] for r in rows) == list(range(n))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_hypergeometric_distribution(spark):
    """Frequencies of 30000 draws against the exact probabilities."""
    for draws, good, total in ((12, 9, 30), (1, 1, 2), (40, 3, 1000), (7, 10, 12)):
        x = sharding.hypergeometric(sharding.uniform(3, F.col("id")), big(draws), big(good), big(total))
        got = {r.x: r["count"] for r in spark.range(30000).select(x.alias("x")).groupBy("x").count().collect()}
        for k in range(0, draws + 1):
            p = math.comb(good, k) * math.comb(total - good, draws - k) / math.comb(total, draws) if k <= good else 0
            assert abs(got.get(k, 0) - 30000 * p) <= 5 * math.sqrt(30000 * p * (1 - p)) + 1, (draws, good, total, k)


def test_hypergeometric_of_large_numbers(spark):
    """Mean and spread where all values lie far from both ends."""
    n, k, m = 3_000_000_000, 500_000_000, 8_000_000_000
    x = sharding.hypergeometric(sharding.uniform(4, F.col("id")), big(n), big(k), big(m))
    r = spark.range(60).select(x.alias("x")).agg(F.avg("x").alias("mean"), F.stddev("x").alias("sd")).first()
    sd = math.sqrt(n * k / m * (m - k) / m * (m - n) / (m - 1))
    assert abs(r.mean - n * k / m) < 5 * sd / math.sqrt(60) and 0.6 < r.sd / sd < 1.5


def test_split_keeps_sums(spark):
    counts = [3, 0, 5, 1, 0, 8]
    for draws in (0, 1, 9, 17):
        for r in spark.range(50).select(sharding.split(F.array(*map(big, counts)), F.lit(draws), 1, F.col("id")).alias("s")).collect():
            assert sum(r.s) == draws and all(0 <= x <= c for x, c in zip(r.s, counts))


def test_every_place_is_equally_likely(spark):
    """A row's place over many seeds: near each other and far rows alike."""
    frame, n, seeds = spark.range(0, 12, 1, 2), 12, 24
    places, together = Counter(), 0     # seeds are few: each is a Spark run
    own = frame.withColumn("row", F.monotonically_increasing_id())
    from shelfwise.llm.common import stage_table
    own = stage_table(own, "rows")
    for seed in range(seeds):
        at = {r.row: (r.shard, r.slot) for r in sharding.places(own, "row", 3, seed, 4).collect()}
        first, second = sorted(at)[:2]
        places[at[first]] += 1
        together += at[first][0] == at[second][0]
    assert len(places) >= 8 and max(places.values()) <= 9                     # 2 expected a place
    assert abs(together / seeds - 3 / 11) < 0.36                              # two given rows meet in a shard of four


def test_same_rows_and_seed_give_the_same_shards(spark):
    from shelfwise.llm.common import stage_table
    own = stage_table(spark.range(0, 900, 1, 4).withColumn("row", F.monotonically_increasing_id()), "rows")
    one, two = ({tuple(r) for r in sharding.places(own, "row", 4, 9, 50).collect()} for _ in range(2))
    assert one == two


def test_only_sql_functions(spark):
    plan = sharding.query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_query_law_sizes_and_checksums(spark):
    given = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = sharding.query(spark, SF).collect()
    assert len(rows) == len(given)
    for r in rows:
        data = given[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1


def test_nulls_repeated_rows_and_written_shards(spark, tmp_path):
    frame = spark.createDataFrame([(None, None), (1, "a"), (1, "a"), (1, ""), (2, "é" * 70000)] * 9, "doc_id bigint, text string")
    sharding.write_shards(frame, str(tmp_path / "out"), 4, 1, 6)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(map(tuple, back.select("doc_id", "text").collect())) == Counter(map(tuple, frame.collect()))
    sizes = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert sorted(sizes) == [11, 11, 11, 12]
