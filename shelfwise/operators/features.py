"""Master table: sales_agg ⟕ inv_agg on K plus derived features.

Formulas are the reference's contract, quirks included (documented in
SURVEY §1.5): COGS is mean transaction cost × transaction count, the
fulfilment rate divides a summed unit count by a mean forecast, growth is
against the previous *row* of the segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import clip_keep_null, safe_div
from ..schema import KEY, SEGMENT, BusinessRules


def join_master(sales_agg: DataFrame, inv_agg: DataFrame) -> DataFrame:
    """Left join on K. Keys are unique on both sides (both are group-by
    outputs), so the row count equals sales_agg's. Both sides hold one row
    per month and segment whatever the line volume; the planner (AQE)
    broadcasts the inventory side by its measured size."""
    return sales_agg.join(inv_agg, KEY, "left")


def core_financials(df: DataFrame, rules: BusinessRules = BusinessRules()) -> DataFrame:
    """F2-F8."""
    return (
        df.withColumn("COGS", F.col("Avg_Unit_Cost") * F.col("Num_Transactions"))
        .withColumn("Gross_Profit", F.col("Total_Sales_Amount") - F.col("COGS"))
        .withColumn("Profit_Margin_Pct",
                    safe_div("Gross_Profit", "Total_Sales_Amount") * F.lit(100))
        .withColumn("Avg_Revenue_Per_Txn", safe_div("Total_Sales_Amount", "Num_Transactions"))
        .withColumn("Transport_Cost_Est", F.col("COGS") * F.lit(rules.transport_rate))
        .withColumn("Net_Profit", F.col("Gross_Profit") - F.col("Transport_Cost_Est"))
        .withColumn("Net_Profit_Margin",
                    safe_div("Net_Profit", "Total_Sales_Amount") * F.lit(100))
    )


def channel_ratios(df: DataFrame) -> DataFrame:
    """F9-F10."""
    return (df.withColumn("Spot_Sales_Ratio", safe_div("Retail_Txn", "Num_Transactions"))
            .withColumn("Online_Sales_Ratio", safe_div("Online_Txn", "Num_Transactions")))


def price_vs_competitor(df: DataFrame) -> DataFrame:
    """0 when no competitor price is known."""
    return df.withColumn(
        "Price_vs_Competitor",
        F.col("Avg_Unit_Price") - F.coalesce(F.col("Competitor_Pricing"), F.col("Avg_Unit_Price")))


def fulfillment_rate(df: DataFrame) -> DataFrame:
    """clipped to [0, 1]; NULL stays NULL."""
    return df.withColumn("Fulfillment_Rate",
                         clip_keep_null(safe_div("Units_Sold_Online", "Demand_Forecast")))


def inventory_coverage(df: DataFrame, rules: BusinessRules = BusinessRules()) -> DataFrame:
    """stock in days of sales."""
    daily = F.col("Total_Qty_Sold") / F.lit(rules.days_per_month)
    return df.withColumn("Inventory_Coverage", safe_div("Inventory_Level", daily))


def time_parts(df: DataFrame) -> DataFrame:
    """F14."""
    return (df.withColumn("Year", F.year("Month").cast("bigint"))
            .withColumn("MonthNum", F.month("Month").cast("bigint"))
            .withColumn("Quarter", F.quarter("Month").cast("bigint")))


def recommended_price_qty(df: DataFrame, rules: BusinessRules = BusinessRules()) -> DataFrame:
    """Price for the target margin; forecast (or ordered units when
    no forecast) plus safety stock, rounded half-to-even."""
    price_factor = 1 / (1 - rules.target_gross_margin)
    qty = F.coalesce(F.col("Demand_Forecast"), F.col("Units_Ordered")) * F.lit(rules.safety_stock)
    return (df.withColumn("Recommended_Price", F.col("Avg_Unit_Cost") * F.lit(price_factor))
            .withColumn("Recommended_Order_Qty", F.bround(qty, 0)))


def growth_mom(df: DataFrame) -> DataFrame:
    """W1-W2 (+W2a): change in % against the previous row of the segment,
    after carrying the last known value forward. A zero base gives NULL.

    Runs on the monthly roll-up, so each (Region, Category) partition holds
    one row per month whatever the raw volume."""
    w = Window.partitionBy(*SEGMENT).orderBy("Month")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = (df.withColumn("_sales_ff", F.last("Total_Sales_Amount", ignorenulls=True).over(upto))
           .withColumn("_profit_ff", F.last("Net_Profit", ignorenulls=True).over(upto)))
    out = (out.withColumn("Sales_Growth_MoM",
                          (safe_div("_sales_ff", F.lag("_sales_ff").over(w)) - F.lit(1)) * F.lit(100))
              .withColumn("Profit_Growth_MoM",
                          (safe_div("_profit_ff", F.lag("_profit_ff").over(w)) - F.lit(1)) * F.lit(100)))
    return out.drop("_sales_ff", "_profit_ff")


def derive_features(joined: DataFrame, rules: BusinessRules = BusinessRules()) -> DataFrame:
    """F2-F16 in one projection (Catalyst collapses the chain)."""
    df = core_financials(joined, rules)
    df = channel_ratios(df)
    df = price_vs_competitor(df)
    df = fulfillment_rate(df)
    df = inventory_coverage(df, rules)
    df = time_parts(df)
    return recommended_price_qty(df, rules)


def build_master(sales_agg: DataFrame, inv_agg: DataFrame,
                 rules: BusinessRules = BusinessRules()) -> DataFrame:
    """J1 → F2-F16 → W1-W2: the 42-column master table."""
    return growth_mom(derive_features(join_master(sales_agg, inv_agg), rules))
