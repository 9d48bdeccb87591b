"""Shared helpers: hot keys split behind an exchange, slices by bytes, stage tables dropped."""

import contextlib
import gc
import os
import weakref
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm import blocks, common, graph, packing, pii, urls
from shelfwise.llm.common import apart, batch_slices, drop_stage, stage_table


@contextlib.contextmanager
def small_partitions(spark):
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["bigint", "string", "binary"])
def test_a_hot_key_is_split_behind_an_exchange_of_its_own(spark, tmp_path, kind):
    path = str(tmp_path / "fact")
    spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).cast("bigint").cast("string").alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("load")).write.parquet(path)
    key = F.col("k").cast("bigint") if kind == "bigint" else F.col("k").cast(kind)
    fact = spark.read.parquet(path).withColumn("k", key)
    with small_partitions(spark):
        totals = fact.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        joined = fact.join(apart(totals, "k"), "k")
        counts = Counter(7 if i % 3 == 0 else i % 5000 for i in range(60_000))
        assert joined.agg(F.sum("n")).first()[0] == sum(n * n for n in counts.values())
        assert "skew=true" in final_plan(joined)


def test_apart_refuses_other_types(spark):
    with pytest.raises(TypeError):
        apart(spark.range(1).withColumn("k", F.col("id") * 0.5), "k")


def test_a_hot_url_is_split(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.range(0, 40_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, F.lit("http://a.example.net/en/x")).otherwise(
        F.concat(F.lit("http://h"), F.col("id") % 3000, F.lit(".org/fr/"), F.sha2(F.col("id").cast("string"), 256))).alias("url"),
        F.sha2(F.col("id").cast("string"), 512).alias("load")).write.parquet(path)
    with small_partitions(spark):
        out = urls.judge(spark.read.parquet(path), urls.rules_frame(spark, urls.RULES))
        assert out.groupBy("rule").count().collect()
        assert "skew=true" in final_plan(out)


def test_components_of_a_star_and_binary_nodes(spark):
    edges = [(bytes([0]), bytes([i])) for i in range(1, 60)] + [(b"x", b"y"), (b"y", b"z")]
    got = {bytes(r.node): bytes(r.component) for r in graph.components(spark.createDataFrame(edges, "u binary, v binary")).collect()}
    assert got == {**{bytes([i]): bytes([0]) for i in range(60)}, b"x": b"x", b"y": b"x", b"z": b"x"}


def test_batch_slices_by_bytes():
    texts = pa.array(["a" * 10, None, "é" * 10, "", "b" * 500, "c"])
    cut = list(batch_slices(texts, 40))
    assert cut[0][0] == 0 and cut[-1][1] == 6 and all(a[1] == b[0] for a, b in zip(cut, cut[1:]))
    assert (4, 5) in cut                                               # a longer text alone
    assert list(batch_slices(pa.array([], pa.string()), 40)) == []
    assert list(batch_slices(texts.slice(2, 2), 1)) == [(0, 1), (1, 2)]


def test_stage_tables_are_dropped_and_others_are_not(spark, tmp_path):
    own = stage_table(spark.range(5), "t")
    files = [f.split(":")[-1].replace("///", "/") for f in own.inputFiles()]
    drop_stage(own)
    assert files and not any(os.path.exists(f) for f in files)
    spark.range(5).write.parquet(str(tmp_path / "mine"))
    mine = spark.read.parquet(str(tmp_path / "mine"))
    drop_stage(mine)
    assert mine.count() == 5


@pytest.mark.parametrize("task", ["add_struct", "make_blocks", "entities"])
def test_another_operators_task_frees_the_encoder(monkeypatch, task):
    """pipeline: the tokenizer and the units it met stayed in the workers of all later stages."""
    runs, struct = [], T.StructType([T.StructField("n", T.LongType())])

    class Docs:                                                        # a frame that hands out its task's function
        columns, schema = ["doc_id", "text"], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
        mapInArrow = lambda self, run, schema: runs.append(run) or self
        select = distinct = lambda self, *_: self                          # noqa: E731

    monkeypatch.setattr(blocks, "stage_table", lambda df, name: df)
    monkeypatch.setattr(blocks.F, "col", lambda name: _Column())
    monkeypatch.setattr(blocks.F, "monotonically_increasing_id", _Column)
    rows = {"add_struct": [[1, 2], ["a b", None]], "make_blocks": [[1, 2], ["a b", None]], "entities": [["a@example.org", None]]}[task]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=[f"c{i}" for i in range(len(rows))])
    {"add_struct": lambda: common.add_struct(Docs(), "x", struct, "text", lambda: lambda texts: pa.array([{"n": 1}] * len(texts))),
     "make_blocks": lambda: blocks.make_blocks(Docs(), "doc_id", "text"), "entities": lambda: pii.entities(Docs())}[task]()
    path = packing.tokenizer_path()
    held = packing.encoder(path)
    assert packing.encoder(path) is held                               # later tasks of the same operator find it
    gone = weakref.ref(held)
    del held
    assert list(runs[0](iter([batch])))
    gc.collect()
    assert gone() is None


class _Column:
    cast = alias = lambda self, *_: self                               # noqa: E731
