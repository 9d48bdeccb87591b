"""Join strategies: chosen by Spark, skew split on a hot key, facts sort-merged."""
import contextlib
import io

from pyspark.sql import functions as F

from shelfwise.operators import joins
from shelfwise.sources import tables


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@contextlib.contextmanager
def _settings(spark, **values):
    names = {k.replace("_", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_dimension_join_has_no_switch_of_its_own(spark):
    fact = spark.range(0, 1000).withColumnRenamed("id", "k")
    dim = spark.range(0, 50).withColumnRenamed("id", "k2")
    assert "BroadcastHashJoin" in _plan(joins.join_dimension(fact, dim, fact.k == dim.k2))
    with _settings(spark, spark_sql_autoBroadcastJoinThreshold="-1"):
        plan = _plan(joins.join_dimension(fact, dim, fact.k == dim.k2))
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_fact_join_is_sort_merge(spark):
    a = spark.range(0, 100).withColumnRenamed("id", "k")
    b = spark.range(0, 100).withColumnRenamed("id", "k2")
    plan = _plan(joins.join_facts(a, b, a.k == b.k2))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_hot_customer_is_split(spark, tmp_path):
    """One customer with a third of all orders: the final plan splits that partition."""
    n = 60_000
    d = str(tmp_path)
    F_ = F
    spark.createDataFrame([(0, "R")], "r_regionkey bigint, r_name string").write.parquet(d + "/region.parquet")
    spark.createDataFrame([(0, 0)], "n_nationkey bigint, n_regionkey bigint").write.parquet(d + "/nation.parquet")
    spark.range(0, 5000).select(F_.col("id").alias("c_custkey"), F_.lit(0).cast("bigint").alias("c_nationkey")).write.parquet(d + "/customer.parquet")
    spark.range(0, n, 1, 8).select(
        F_.col("id").alias("o_orderkey"),
        F_.when(F_.col("id") % 3 == 0, F_.lit(7)).otherwise(F_.col("id") % 5000).cast("bigint").alias("o_custkey"),
        F_.expr("date_add(date'2024-01-01', cast(id % 365 as int))").alias("o_orderdate"),
        F_.sha2(F_.col("id").cast("string"), 512).alias("o_orderpriority")).write.parquet(d + "/orders.parquet")
    low = dict(spark_sql_autoBroadcastJoinThreshold="-1", spark_sql_adaptive_advisoryPartitionSizeInBytes="64k",
               spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes="64k",
               spark_sql_adaptive_skewJoin_skewedPartitionFactor="1.5")
    with _settings(spark, **low):
        geo = tables._nation_regions(spark, d)
        out = tables._orders_enriched(spark, d, geo)
        assert out.count() == n
        out.write.format("noop").mode("overwrite").save()
        run = out.select("o_orderkey", "Sale_Date", "Region", "Customer_Type", "Sales_Channel")
        run.collect()
        plan = run._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan or "skewed" in plan
