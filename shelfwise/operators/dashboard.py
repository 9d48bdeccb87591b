"""Queries behind the dashboard tiles.

Each function takes report DataFrames (already filtered with
``apply_filters`` where the dashboard filters them) and returns a
DataFrame; rendering is not part of the library. Ranked outputs carry a
``rank`` column so their order survives order-insensitive comparison.
Ranking windows run over one row per segment / feature / month (bounded by
the category cardinalities), never over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import davg, dsum, month_short_name, np_round, py_format
from ..schema import (CURRENCY, HIGH_PROFIT, IMPORTANCE_LABELS, LAKH, MODEL_CARDS,
                      MSG_ON_TRACK, SEGMENT, SEGMENT_SEPARATOR, Filters)


# ------------------------------------------------------------------ filters
def apply_filters(df: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """Region / category membership and an optional year. The year is
    the frame's ``Year``, or that of its ``Month``; a year filter on a frame
    that has neither is an error (the report has none: filter it by
    ``filters.without_year()``)."""
    cond = F.lit(True)
    if filters.regions is not None:
        cond = cond & F.col("Region").isin(list(filters.regions))
    if filters.categories is not None:
        cond = cond & F.col("Category").isin(list(filters.categories))
    if filters.year is not None:
        if "Year" in df.columns:
            year = F.col("Year")
        elif "Month" in df.columns:
            year = F.year("Month")
        else:
            raise ValueError("a year filter needs a Year or Month column")
        cond = cond & (year == filters.year)
    return df.filter(cond)


def is_empty(df: DataFrame) -> bool:
    """The "no data matches the filters" check (reads at most one row)."""
    return df.isEmpty()


def filter_choices(preds: DataFrame) -> DataFrame:
    """Sorted distinct years, regions and categories (one row)."""
    return preds.agg(
        F.sort_array(F.collect_set("Year")).alias("years"),
        F.sort_array(F.collect_set("Region")).alias("regions"),
        F.sort_array(F.collect_set("Category")).alias("categories"))


def with_month_parts(preds: DataFrame) -> DataFrame:
    """Year, MonthNum and the ``Mon YYYY`` label from Month. A Year
    that is there already (the folder a row was written to) stays, so that a
    year filter still prunes folders."""
    year = F.col("Year") if "Year" in preds.columns else F.year("Month")
    return (preds.withColumn("Year", year.cast("bigint"))
            .withColumn("MonthNum", F.month("Month").cast("bigint"))
            .withColumn("MonthLabel", F.date_format("Month", "MMM yyyy")))


def _rank(df: DataFrame, *order) -> DataFrame:
    """``rank`` over one row per segment, month or region: their number is the
    categories', not the data's, so the window's single task stays small."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def _money(c) -> F.Column:
    return F.concat(F.lit(CURRENCY), py_format(c, 0, thousands=True))


# ----------------------------------------------------------------- overview
def kpi_row(preds_f: DataFrame) -> DataFrame:
    """D1 (A9, F29): revenue, profit, mean margin, units; with tile text."""
    k = preds_f.agg(
        dsum("Total_Sales_Amount").alias("Total_Revenue"),
        dsum("Net_Profit").alias("Total_Profit"),
        davg("Net_Profit_Margin").alias("Avg_Margin"),
        F.sum("Total_Qty_Sold").alias("Units_Sold"))
    lakh = F.lit(LAKH)
    return k.select(
        "*",
        F.concat(F.lit(CURRENCY), py_format(F.col("Total_Revenue") / lakh, 1, True), F.lit("L"))
        .alias("Revenue_Text"),
        F.concat(F.lit(CURRENCY), py_format(F.col("Total_Profit") / lakh, 1, True), F.lit("L"))
        .alias("Profit_Text"),
        F.concat(py_format("Avg_Margin", 1), F.lit("%")).alias("Margin_Text"),
        F.format_number("Units_Sold", 0).alias("Units_Text"))


def monthly_trend(monthly_f: DataFrame) -> DataFrame:
    """D2 (A10, F26, O5): revenue and profit by month number, in that order."""
    t = monthly_f.groupBy("MonthNum").agg(dsum("Monthly_Sales").alias("Revenue"),
                                          dsum("Monthly_Profit").alias("Profit"))
    return t.withColumn("Month", month_short_name("MonthNum")).orderBy("MonthNum")


def sales_by_category(preds_f: DataFrame) -> DataFrame:
    """D3 (A11): sales per category and its share of the total (%)."""
    c = preds_f.groupBy("Category").agg(dsum("Total_Sales_Amount").alias("Total_Sales_Amount"))
    total = c.agg(dsum("Total_Sales_Amount").alias("_total"))
    return (c.crossJoin(F.broadcast(total))
            .withColumn("Share_Pct", F.col("Total_Sales_Amount") / F.col("_total") * 100)
            .drop("_total"))


def sales_by_region(preds_f: DataFrame) -> DataFrame:
    """D4 (A12, O6): sales per region, ascending."""
    r = preds_f.groupBy("Region").agg(dsum("Total_Sales_Amount").alias("Total_Sales_Amount"))
    return _rank(r, "Total_Sales_Amount", "Region")


def channel_split(preds_f: DataFrame) -> DataFrame:
    """D5 (A13): mean spot / online share per category, in %."""
    return preds_f.groupBy("Category").agg(
        (davg("Spot_Sales_Ratio") * 100).alias("Spot"),
        (davg("Online_Sales_Ratio") * 100).alias("Online"))


# -------------------------------------------------------------- predictions
def segment_predictions(preds_f: DataFrame) -> DataFrame:
    """D6 (A15, A18): actual vs predicted per segment, rounded to 2 dp, with
    the parity-line extent (largest actual or predicted total)."""
    seg = preds_f.groupBy(*SEGMENT).agg(
        dsum("Total_Sales_Amount").alias("Actual_Sales"),
        dsum("Predicted_Sales").alias("Predicted_Sales"),
        dsum("Net_Profit").alias("Net_Profit"),
        davg("Net_Profit_Margin").alias("Avg_Margin"),
        F.sum("Predicted_Sell_Qty").alias("Pred_Sell_Qty"),
        dsum("Transport_Cost_Est").alias("Transport_Cost"))
    seg = seg.select(
        *SEGMENT, *[np_round(c, 2).alias(c) for c in
                    ("Actual_Sales", "Predicted_Sales", "Net_Profit", "Avg_Margin")],
        "Pred_Sell_Qty", np_round("Transport_Cost", 2).alias("Transport_Cost"))
    extent = seg.agg(F.greatest(F.max("Actual_Sales"), F.max("Predicted_Sales")).alias("Max_Extent"))
    return seg.crossJoin(F.broadcast(extent))


def modal_class(preds_f: DataFrame) -> DataFrame:
    """Most frequent predicted class per segment (smallest on ties)."""
    return preds_f.groupBy(*SEGMENT).agg(
        F.mode("Predicted_Profit_Class", deterministic=True).alias("Predicted_Profit_Class"))


def monthly_actual_vs_predicted(preds_f: DataFrame) -> DataFrame:
    """D7 (A17, A22, J3, O9): totals per month label, ordered by the month
    the label stands for (one label per month, so min(Month) orders it)."""
    m = preds_f.groupBy("MonthLabel").agg(
        dsum("Total_Sales_Amount").alias("Actual"),
        dsum("Predicted_Sales").alias("Predicted"),
        F.min("Month").alias("Month"))
    return _rank(m, "Month")


def segment_table(preds_f: DataFrame) -> DataFrame:
    """D8 (J2, P3, F28, F32): segment aggregate ⟕ modal class, renamed to
    Profit_Class, with display text and the highlight tag."""
    seg = segment_predictions(preds_f).drop("Max_Extent")
    t = seg.join(modal_class(preds_f), SEGMENT, "left").withColumnRenamed(
        "Predicted_Profit_Class", "Profit_Class")
    return t.select(
        *SEGMENT,
        _money("Actual_Sales").alias("Actual_Sales"),
        _money("Predicted_Sales").alias("Predicted_Sales"),
        _money("Net_Profit").alias("Net_Profit"),
        F.concat(py_format("Avg_Margin", 1), F.lit("%")).alias("Avg_Margin"),
        F.concat(F.format_number("Pred_Sell_Qty", 0), F.lit(" units")).alias("Pred_Sell_Qty"),
        _money("Transport_Cost").alias("Transport_Cost"),
        "Profit_Class",
        F.when(F.col("Profit_Class") == HIGH_PROFIT, F.lit("high")).otherwise(F.lit("low"))
        .alias("Class_Tag"))


# ------------------------------------------------------------- improvements
def with_segment_label(improve_f: DataFrame) -> DataFrame:
    """``Region · Category``."""
    return improve_f.withColumn("Segment", F.concat_ws(SEGMENT_SEPARATOR, "Region", "Category"))


def margin_gap_rank(improve_f: DataFrame) -> DataFrame:
    """D9 (O7): gap to the top quartile, ascending."""
    d = with_segment_label(improve_f).select("Segment", "Margin_Gap_vs_Top_Quartile")
    return _rank(d, "Margin_Gap_vs_Top_Quartile", "Segment")


def discount_rank(improve_f: DataFrame) -> DataFrame:
    """D10 (O8): mean discount, ascending."""
    d = with_segment_label(improve_f).select("Segment", "Avg_Discount_Pct")
    return _rank(d, "Avg_Discount_Pct", "Segment")


def coverage_rank(improve_f: DataFrame, low: float = 30.0, high: float = 60.0) -> DataFrame:
    """D11 (O8): coverage days, descending, with the 30/60-day band."""
    cov = F.col("Avg_Inventory_Coverage_Days")
    d = with_segment_label(improve_f).select(
        "Segment", cov.alias("Avg_Inventory_Coverage_Days"),
        F.when(cov > high, F.lit("overstock")).when(cov < low, F.lit("below ideal"))
        .otherwise(F.lit("ideal")).alias("Band"))
    return _rank(d, F.desc("Avg_Inventory_Coverage_Days"), "Segment")


def fulfillment_rank(improve_f: DataFrame) -> DataFrame:
    """D12 (O8): fulfilment rate, ascending."""
    d = with_segment_label(improve_f).select("Segment", "Fulfillment_Rate_Avg")
    return _rank(d, "Fulfillment_Rate_Avg", "Segment")


def action_list(improve_f: DataFrame) -> DataFrame:
    """D13 (O7, F30): segments by gap, descending, with status and text."""
    d = with_segment_label(improve_f).select(
        "Segment", "Margin_Gap_vs_Top_Quartile",
        F.when(F.col("Recommendations") == MSG_ON_TRACK, F.lit("on-track"))
        .otherwise(F.lit("needs action")).alias("Status"),
        F.concat(F.lit("Margin: "), py_format("Avg_Margin_Pct", 1), F.lit("% | Gap: "),
                 py_format("Margin_Gap_vs_Top_Quartile", 1), F.lit("pp | Discount: "),
                 py_format("Avg_Discount_Pct", 1), F.lit("%")).alias("Summary"),
        "Recommendations")
    return _rank(d, F.desc("Margin_Gap_vs_Top_Quartile"), "Segment")


# ---------------------------------------------------------------- ML models
def score_cards(scores: DataFrame) -> DataFrame:
    """D14 (J7, F31): model registry ⟕ scores with a not-found flag, primary
    metric and CV R² as 3-dp text (missing scores count as 0)."""
    spark = scores.sparkSession
    registry = spark.createDataFrame(
        [(k, t, a, lbl, pk, ck) for k, t, a, lbl, pk, ck, _, _ in MODEL_CARDS],
        "Model string, Title string, Algorithm string, Metric_Label string, "
        "Metric_Key string, CV_Key string")
    j = registry.join(scores, "Model", "left")
    primary = F.when(F.col("Metric_Key") == "R2", F.col("R2")).otherwise(F.col("Accuracy"))
    return j.select(
        "Model", "Title", "Algorithm", "Metric_Label",
        (F.col("R2").isNull() & F.col("Accuracy").isNull() & F.col("MAE").isNull()
         & F.col("CV_R2").isNull()).alias("Scores_Missing"),
        py_format(F.coalesce(primary, F.lit(0.0)), 3).alias("Primary_Text"),
        F.when(F.col("CV_Key").isNotNull(),
               py_format(F.coalesce(F.col("CV_R2"), F.lit(0.0)), 3)).alias("CV_Text"))


def top_features(fi: DataFrame, k: int = 12) -> DataFrame:
    """D15 (O3): the k most important features of the sales model (top-k
    is the feature; ties broken by name). Each task hands on its own k; only
    those are ranked."""
    top = fi.select("Feature", "Importance_Sales").orderBy(F.desc("Importance_Sales"), "Feature").limit(k)
    return _rank(top, F.desc("Importance_Sales"), "Feature")


def importance_long(fi: DataFrame, k: int = 10) -> DataFrame:
    """D16 (O4, J4, P4, P14, U3): top-k features (by the sales model) in
    long form, one row per (feature, model)."""
    top = top_features(fi, k).select("Feature")
    wide = (fi.join(top, "Feature", "left_semi")
            .select("Feature", *IMPORTANCE_LABELS).withColumnsRenamed(IMPORTANCE_LABELS))
    labels = list(IMPORTANCE_LABELS.values())
    return wide.unpivot("Feature", labels, "Model", "Importance")


def score_union(scores: DataFrame) -> DataFrame:
    """D17 (U1): the full sparse score table."""
    return scores.select("Model", "MAE", "R2", "CV_R2", "Accuracy")
