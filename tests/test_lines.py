"""The line pass: joins of the line table, and the lazy inventory roll-up."""
import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import rollups
from shelfwise.sources import tables


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """Suppliers without a nation, with an unknown one and twice; lines without partners."""
    folder = str(tmp_path_factory.mktemp("lines"))
    day = dt.datetime(2020, 3, 5)
    rows = {
        "region": ([(0, "EAST"), (1, "WEST")], "r_regionkey int, r_name string"),
        "nation": ([(0, 0), (1, 1), (2, 7), (3, 1)], "n_nationkey int, n_regionkey int"),
        "supplier": ([(1, 0), (2, None), (3, 2), (4, 9), (5, 1), (5, 3), (5, None)], "s_suppkey long, s_nationkey int"),
        "customer": ([(1, 0), (2, 1)], "c_custkey long, c_nationkey int"),
        "part": ([(1, "STANDARD", 3, 10.0), (2, "SMALL", 4, 20.0)],
                 "p_partkey long, p_type string, p_size int, p_retailprice double"),
        "orders": ([(1, 1, day, "1-URGENT"), (2, 2, day, None), (3, 2, day + dt.timedelta(40), "5-LOW"), (4, 9, day, "2-HIGH"),
                    (5, 1, None, "5-LOW")], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(o, p, s, float((o or 9) + (p or 9)), 100.5, 0.05, "A", st, day + dt.timedelta(o or 9))
                      for o in (1, 2, 3, 4, 5, None) for p in (1, 2, 8, None) for s in (1, 2, 3, 4, 5, 6, None) for st in ("F", None)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_line_facts_hold_the_inventory_view(spark, odd_tables):
    facts = tables.line_facts(spark, odd_tables)
    view = tables.inventory_view(spark, odd_tables)
    mine = facts.filter("i_ok").select(*[F.col(f"i_{c}").alias(c) for c in view.columns])
    found, wanted = Counter(mine.collect()), Counter(view.collect())
    assert wanted and set(found) == set(wanted) and facts.filter("i_ok").count() == view.count()


def test_line_facts_hold_the_sales_view(spark, odd_tables):
    facts = tables.line_facts(spark, odd_tables)
    view = tables.sales_view(spark, odd_tables)
    mine = facts.filter("s_ok").select(*[F.col("s_Category" if c == "Product_Category" else f"s_{c}").alias(c) for c in view.columns])
    assert view.count() and set(mine.collect()) == set(view.collect())


def test_few_suppliers_do_not_shuffle_the_lines(spark, odd_tables):
    plan = tables.line_facts(spark, odd_tables)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_suppkey" not in plan and "hashpartitioning(l_orderkey" in plan


def test_inventory_rollup_is_a_hash_aggregation_of_lines(spark):
    rows = [(dt.date(2020, 1, 1 + i % 9), "E", "Toys", 5.0, i, i, 1.0, 2.0, 0.1, w, i % 2, 3.0, s)
            for i, (w, s) in enumerate([("Sunny", "Winter"), ("Rainy", None), ("Rainy", "Spring"), ("Sunny", "Spring"), (None, "Spring")])]
    df = spark.createDataFrame(rows, "Date date, Region string, Category string, Inventory_Level double, Units_Sold long, "
                                     "Units_Ordered long, Demand_Forecast double, Price double, Discount double, "
                                     "Weather_Condition string, Holiday_Promotion int, Competitor_Pricing double, Seasonality string")
    out = rollups.inventory_rollup(df)
    assert "mode(" not in out._jdf.queryExecution().executedPlan().toString()
    row = out.first()
    assert (row.Weather_Mode, row.Seasonality, row.Units_Ordered, row.Holiday_Days) == ("Rainy", "Spring", 10, 2)
    none = rollups.inventory_rollup(df.withColumn("Seasonality", F.lit(None).cast("string"))).first()
    assert none.Seasonality is None and none.Weather_Mode == "Rainy"
