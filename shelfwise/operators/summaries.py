"""Monthly and yearly roll-ups of the scored modelling frame (A3, A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import davg, dsum0, sum0

PERIOD_MONTH = ["Year", "MonthNum", "Region", "Category"]
PERIOD_YEAR = ["Year", "Region", "Category"]


def _actual_measures(qty_name: str, sales_name: str, profit_name: str):
    return [
        dsum0("Total_Sales_Amount").alias(sales_name),
        dsum0("Net_Profit").alias(profit_name),
        sum0("Total_Qty_Sold").alias(qty_name),
        davg("Net_Profit_Margin").alias("Avg_Margin_Pct"),
    ]


def monthly_summary(scored: DataFrame, with_predictions: bool = True) -> DataFrame:
    """A3: by (Year, MonthNum, Region, Category). Without predictions (the
    actual measures only) when ``with_predictions`` is False."""
    aggs = _actual_measures("Monthly_Qty", "Monthly_Sales", "Monthly_Profit") + [
        sum0("Retail_Txn").alias("Spot_Txn"),
        sum0("Online_Txn").alias("Online_Txn_Count"),
        dsum0("Transport_Cost_Est").alias("Transport_Cost"),
    ]
    if with_predictions:
        aggs += [dsum0("Predicted_Sales").alias("Pred_Sales"),
                 dsum0("Predicted_Net_Profit").alias("Pred_Profit")]
    return scored.groupBy(*PERIOD_MONTH).agg(*aggs)


def yearly_summary(scored: DataFrame) -> DataFrame:
    """A4: by (Year, Region, Category)."""
    aggs = _actual_measures("Yearly_Qty", "Yearly_Sales", "Yearly_Profit") + [
        dsum0("Transport_Cost_Est").alias("Total_Transport"),
        sum0("Retail_Txn").alias("Spot_Txn"),
        sum0("Online_Txn").alias("Online_Txn_Count"),
    ]
    out = scored.groupBy(*PERIOD_YEAR).agg(*aggs)
    return out.select("Year", "Region", "Category", "Yearly_Sales", "Yearly_Profit", "Yearly_Qty",
                      "Avg_Margin_Pct", "Total_Transport", "Spot_Txn", "Online_Txn_Count")
