"""One tiny frame per pandas-vs-Spark trap."""
import datetime as dt

from pyspark.sql import functions as F

from shelfwise.operators import features, rollups
from shelfwise.schema import INVENTORY_SCHEMA, SALES_SCHEMA

D = dt.date


def _sales(spark, rows):
    return spark.createDataFrame(rows, SALES_SCHEMA)


def _inv(spark, rows):
    return spark.createDataFrame(rows, INVENTORY_SCHEMA)


def test_null_keys_vanish_and_counts(spark):
    rows = [(D(2024, 1, 3), "East", "Food", 10.0, 2, 4.0, 5.0, 0.1, "p1", "New", "Online"),
            (D(2024, 1, 9), None, "Food", 99.0, 1, 1.0, 1.0, 0.1, "p2", "New", "Online"),
            (D(2024, 1, 9), "East", None, 99.0, 1, 1.0, 1.0, 0.1, "p3", "New", "Online"),
            (D(2024, 1, 20), "East", "Food", 30.0, 3, 6.0, 7.0, 0.3, None, "Returning", "Retail")]
    out = rollups.sales_rollup(_sales(spark, rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert r.Month == D(2024, 1, 1) and r.Total_Sales_Amount == 40.0 and r.Total_Qty_Sold == 5
    assert r.Num_Transactions == 1          # Product_ID counted non-null only
    assert (r.New_Customers, r.Returning_Customers, r.Online_Txn, r.Retail_Txn) == (1, 1, 1, 1)
    assert abs(r.Avg_Discount_Sales - 0.2) < 1e-12


def test_all_null_group_and_mode_ties(spark):
    rows = [(D(2024, 2, 1), "West", "Groceries", None, None, None, None, None, None, None, None,
             None, None),
            (D(2024, 3, 1), "West", "Food", 1.0, 1, 1, 1.0, 1.0, 0.1, "Sunny", 0, 1.0, "Spring"),
            (D(2024, 3, 2), "West", "Food", 1.0, 1, 1, 1.0, 1.0, 0.1, "Rainy", 0, 1.0, "Spring"),
            (D(2024, 3, 3), "West", "Food", 1.0, 1, 1, 1.0, 1.0, 0.1, "Cloudy", 1, 1.0, "Summer"),
            (D(2024, 3, 4), "West", "Food", 1.0, 1, 1, 1.0, 1.0, 0.1, "Cloudy", 1, 1.0, "Summer")]
    out = {r.Month: r for r in rollups.inventory_rollup(_inv(spark, rows)).collect()}
    feb = out[D(2024, 2, 1)]
    assert feb.Category == "Food"            # Groceries remapped
    assert feb.Units_Sold_Online == 0 and feb.Holiday_Days == 0   # all-null sum → 0
    assert feb.Inventory_Level is None and feb.Weather_Mode is None
    mar = out[D(2024, 3, 1)]
    assert mar.Weather_Mode == "Cloudy"      # most frequent
    assert mar.Seasonality == "Spring"       # 2-2 tie → smallest


def _joined(spark, rows):
    schema = ("Month date, Region string, Category string, Total_Sales_Amount double, "
              "Total_Qty_Sold bigint, Avg_Unit_Cost double, Avg_Unit_Price double, "
              "Num_Transactions bigint, Retail_Txn bigint, Online_Txn bigint, "
              "Inventory_Level double, Units_Sold_Online bigint, Units_Ordered bigint, "
              "Demand_Forecast double, Competitor_Pricing double")
    return spark.createDataFrame(rows, schema)


def test_zero_denominators_clip_and_half_even(spark):
    rows = [(D(2024, 1, 1), "E", "F", 0.0, 0, 2.0, 3.0, 0, 0, 0, 5.0, 9, 10, 0.0, None),
            (D(2024, 2, 1), "E", "F", 100.0, 30, 2.0, 3.0, 4, 1, 3, 60.0, 50, 10, 10.0, 2.5),
            (D(2024, 3, 1), "E", "F", 100.0, 30, 2.0, 3.0, 4, 1, 3, 60.0, 5, 10, None, 2.5)]
    out = features.derive_features(_joined(spark, rows)).orderBy("Month").collect()
    z, a, b = out
    assert z.Profit_Margin_Pct is None and z.Avg_Revenue_Per_Txn is None
    assert z.Spot_Sales_Ratio is None and z.Fulfillment_Rate is None and z.Inventory_Coverage is None
    assert z.Price_vs_Competitor == 0.0      # unknown competitor price → no gap
    assert a.Fulfillment_Rate == 1.0         # 50 / 10 clipped
    assert a.Inventory_Coverage == 60.0
    assert b.Recommended_Order_Qty == 12.0   # no forecast → ordered 10 × 1.15 = 11.5 → 12 (even)
    assert abs(a.Recommended_Price - 2.0 / 0.6) < 1e-12
    assert a.Year == 2024 and a.MonthNum == 2 and a.Quarter == 1


def test_growth_gap_null_zero_negative(spark):
    schema = "Month date, Region string, Category string, Total_Sales_Amount double, Net_Profit double"
    rows = [(D(2024, 1, 1), "E", "F", 100.0, 10.0),
            (D(2024, 3, 1), "E", "F", 150.0, None),      # gap: compares with previous row
            (D(2024, 4, 1), "E", "F", 0.0, -5.0),        # null profit carried forward (10)
            (D(2024, 5, 1), "E", "F", 30.0, 5.0),        # zero base → NULL
            (D(2024, 1, 1), "W", "F", 1.0, 1.0)]
    out = {(r.Region, r.Month): r for r in
           features.growth_mom(spark.createDataFrame(rows, schema)).collect()}
    assert out[("E", D(2024, 1, 1))].Sales_Growth_MoM is None
    assert abs(out[("E", D(2024, 3, 1))].Sales_Growth_MoM - 50.0) < 1e-9
    assert out[("E", D(2024, 3, 1))].Profit_Growth_MoM == 0.0      # ffill: 10 vs 10
    assert abs(out[("E", D(2024, 4, 1))].Profit_Growth_MoM - (-150.0)) < 1e-9
    assert out[("E", D(2024, 5, 1))].Sales_Growth_MoM is None      # 30 / 0
    assert abs(out[("E", D(2024, 5, 1))].Profit_Growth_MoM - (-200.0)) < 1e-9  # 5 / -5 − 1
    assert out[("W", D(2024, 1, 1))].Sales_Growth_MoM is None


def test_join_keeps_sales_rows(spark):
    s = spark.createDataFrame([(D(2024, 1, 1), "E", "F", 1.0), (D(2024, 2, 1), "E", "F", 2.0)],
                              "Month date, Region string, Category string, Total_Sales_Amount double")
    i = spark.createDataFrame([(D(2024, 1, 1), "E", "F", 5.0)],
                              "Month date, Region string, Category string, Inventory_Level double")
    j = features.join_master(s, i)
    assert j.count() == 2 and j.filter(F.col("Inventory_Level").isNull()).count() == 1


def test_order_qty_rounds_like_numpy(spark):
    import numpy as np
    forecasts = [10.0, 30.0, 50.0, 70.0, 3.0, 17.0, 110.0, 2.5]
    rows = [(D(2024, m + 1, 1), "E", "F", 1.0, 1, 1.0, 1.0, 1, 0, 1, 1.0, 1, 1, f, 1.0)
            for m, f in enumerate(forecasts)]
    out = features.derive_features(_joined(spark, rows)).orderBy("Month").collect()
    assert [r.Recommended_Order_Qty for r in out] == [float(np.round(f * 1.15)) for f in forecasts]


def test_median_fill(spark):
    from shelfwise.ml import prep
    df = spark.createDataFrame([(1.0, 10), (None, None), (3.0, 30), (4.0, 40)], "a double, b bigint")
    out = prep.median_fill(df, ["a", "b"]).collect()
    assert [r.a for r in out] == [1.0, 3.0, 3.0, 4.0] and [r.b for r in out] == [10, 30, 30, 40]


def test_two_step_rollup_equals_single_aggregation(spark):
    sales = _sales(spark, [
        (D(2024, 1, 3), "East", "Food", 10.25, 2, 4.0, 5.0, 0.1, "p1", "New", "Online"),
        (D(2024, 1, 9), None, "Food", 99.0, 1, 1.0, 1.0, 0.1, "p2", "New", "Online"),
        (D(2024, 1, 20), "East", "Food", 30.5, 3, None, 7.0, 0.3, None, "Returning", "Retail"),
        (D(2024, 2, 1), "West", "Food", 1.0, 1, 1.0, 1.0, 0.0, "p3", None, None)])
    inv = _inv(spark, [
        (D(2024, 2, 1), "West", "Groceries", None, None, None, None, None, None, None, None,
         None, None),
        (D(2024, 3, 1), "West", "Food", 1.0, 1, 1, 1.0, 1.0, 0.1, "Sunny", 0, 1.0, "Spring"),
        (D(2024, 3, 2), "West", "Food", 2.0, 1, 1, 1.0, 1.0, 0.1, "Rainy", 0, 1.0, "Spring"),
        (D(2024, 3, 3), "West", "Food", 3.0, 1, 1, 1.0, 1.0, 0.1, "Cloudy", 1, 1.0, "Summer"),
        (D(2024, 3, 4), "West", "Food", 4.0, 1, 1, 1.0, 1.0, 0.1, "Rainy", 1, 1.0, "Summer"),
        (D(2024, 3, 5), None, "Food", 4.0, 1, 1, 1.0, 1.0, 0.1, "Rainy", 1, 1.0, "Summer")])
    parts = rollups.raw_rollup_parts(sales, inv)
    s2, i2 = rollups.split_rollup(rollups.combined_rollup_finish(parts))
    srt = lambda df: sorted(tuple(str(x) for x in r) for r in df.collect())
    assert srt(s2) == srt(rollups.sales_rollup(sales).select(s2.columns))
    assert srt(i2) == srt(rollups.inventory_rollup(inv).select(i2.columns))
    mar = i2.filter(F.col("Month") == D(2024, 3, 1)).first()
    assert mar.Weather_Mode == "Rainy" and mar.Seasonality == "Spring"   # 2-2 tie → smallest
