"""Registered queries: one per operator group of the inventory, each run on
the whole driver tables, with its DuckDB twin (``oracle.py`` CTEs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import register
from .oracle import master_sql, with_ctes, RAW_CTES, ROLLUP_CTES
from .operators import features
from .plans import master as master_plan
from .schema import KEY
from .session import stage_table

SALES_AGG_DOUBLES = ("Total_Sales_Amount", "Avg_Unit_Cost", "Avg_Unit_Price", "Avg_Discount_Sales")
INV_AGG_DOUBLES = ("Inventory_Level", "Demand_Forecast", "Avg_Price", "Avg_Discount_Inv",
                   "Competitor_Pricing")
DERIVED_DOUBLES = ("COGS", "Gross_Profit", "Profit_Margin_Pct", "Avg_Revenue_Per_Txn",
                   "Transport_Cost_Est", "Net_Profit", "Net_Profit_Margin", "Spot_Sales_Ratio",
                   "Online_Sales_Ratio", "Price_vs_Competitor", "Fulfillment_Rate",
                   "Inventory_Coverage", "Recommended_Price", "Recommended_Order_Qty",
                   "Sales_Growth_MoM", "Profit_Growth_MoM")
MASTER_DOUBLES = SALES_AGG_DOUBLES + INV_AGG_DOUBLES + DERIVED_DOUBLES


def _rollups(spark: SparkSession, sf_dir: str):
    return master_plan.rollups_from_tables(spark, sf_dir)


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master_plan.master_from_tables(spark, sf_dir)


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales_agg, inv_agg = _rollups(spark, sf_dir)
    return features.join_master(sales_agg, inv_agg)


def _rollup_sql(select: str) -> str:
    return with_ctes(RAW_CTES, ROLLUP_CTES, select=select)


# ---------------------------------------------------------------- roll-ups
@register("sales_rollup", _rollup_sql("SELECT * FROM sales_agg"), SALES_AGG_DOUBLES)
def sales_rollup(spark, sf_dir):
    """A2: sales lines → (Month, Region, Category) measures."""
    return _rollups(spark, sf_dir)[0]


@register("inventory_rollup", _rollup_sql("SELECT * FROM inv_agg"), INV_AGG_DOUBLES)
def inventory_rollup(spark, sf_dir):
    """A1: inventory lines → measures with deterministic modes."""
    return _rollups(spark, sf_dir)[1]


@register("category_remap", _rollup_sql(
    "SELECT Category, count(*) AS n_rows FROM inv_m GROUP BY Category"))
def category_remap(spark, sf_dir):
    """Categories after the remap, with their line counts, from the one line pass."""
    return master_plan.staged_parts(spark, sf_dir).filter("kind = 'I'").groupBy("Category").agg(F.sum("rows").alias("n_rows"))


# ------------------------------------------------------------ join/master
JOIN_COLS = ("Month, Region, Category, Total_Sales_Amount, Total_Qty_Sold, Avg_Unit_Cost, "
             "Avg_Unit_Price, Avg_Discount_Sales, Num_Transactions, New_Customers, "
             "Returning_Customers, Online_Txn, Retail_Txn, Inventory_Level, Units_Sold_Online, "
             "Units_Ordered, Demand_Forecast, Avg_Price, Avg_Discount_Inv, Weather_Mode, "
             "Holiday_Days, Competitor_Pricing, Seasonality")


@register("join_master", master_sql(f"SELECT {JOIN_COLS} FROM joined"),
          SALES_AGG_DOUBLES + INV_AGG_DOUBLES)
def join_master(spark, sf_dir):
    """sales_agg ⟕ inv_agg on (Month, Region, Category)."""
    return _joined(spark, sf_dir)


@register("unmatched_inventory", master_sql(
    "SELECT count(*) AS joined_rows, count(*) FILTER (WHERE Inventory_Level IS NULL) "
    "AS unmatched_rows FROM joined"))
def unmatched_inventory(spark, sf_dir):
    """Rows of the join without inventory (and the join's row count)."""
    from .operators.quality import join_null_check
    return join_null_check(_joined(spark, sf_dir))


def _register_master_slice(name: str, cols: list[str], doc: str):
    keep = KEY + cols
    dbl = tuple(c for c in cols if c in MASTER_DOUBLES)

    def build(spark, sf_dir):
        return _master(spark, sf_dir).select(*keep)
    build.__doc__ = doc
    register(name, master_sql(f"SELECT {', '.join(keep)} FROM master"), dbl)(build)


_register_master_slice("core_financials",
                       ["COGS", "Gross_Profit", "Profit_Margin_Pct", "Avg_Revenue_Per_Txn",
                        "Transport_Cost_Est", "Net_Profit", "Net_Profit_Margin"],
                       "F2-F8: cost, profit and margins per month and segment.")
_register_master_slice("channel_ratios", ["Spot_Sales_Ratio", "Online_Sales_Ratio"],
                       "F9-F10: retail and online shares of transactions.")
_register_master_slice("price_vs_competitor", ["Avg_Unit_Price", "Competitor_Pricing",
                                               "Price_vs_Competitor"],
                       "F11: price gap to competitors (0 when unknown).")
_register_master_slice("fulfillment_rate", ["Units_Sold_Online", "Demand_Forecast",
                                            "Fulfillment_Rate"],
                       "F12: clipped fulfilment rate.")
_register_master_slice("inventory_coverage", ["Inventory_Level", "Total_Qty_Sold",
                                              "Inventory_Coverage"],
                       "F13: stock coverage in days.")
_register_master_slice("recommended_price_qty", ["Year", "MonthNum", "Quarter",
                                                 "Recommended_Price", "Recommended_Order_Qty"],
                       "F14-F16: time parts, recommended price and order quantity.")
_register_master_slice("growth_mom", ["Total_Sales_Amount", "Net_Profit",
                                      "Sales_Growth_MoM", "Profit_Growth_MoM"],
                       "W1-W2: month-over-month growth per segment.")

MASTER_COLS = (JOIN_COLS + ", COGS, Gross_Profit, Profit_Margin_Pct, Avg_Revenue_Per_Txn, "
               "Transport_Cost_Est, Net_Profit, Net_Profit_Margin, Spot_Sales_Ratio, "
               "Online_Sales_Ratio, Price_vs_Competitor, Fulfillment_Rate, Inventory_Coverage, "
               "Year, MonthNum, Quarter, Recommended_Price, Recommended_Order_Qty, "
               "Sales_Growth_MoM, Profit_Growth_MoM")


@register("master", master_sql(f"SELECT {MASTER_COLS} FROM master"), MASTER_DOUBLES)
def master(spark, sf_dir):
    """Stage 1 output: the 42-column master table."""
    return _master(spark, sf_dir)


# ------------------------------------------------------------- quality
from .operators import quality, report, summaries  # noqa: E402
from .ml import prep  # noqa: E402
from .oracle import model_sql, np_round_sql  # noqa: E402
from .schema import (MSG_BELOW_COMPETITOR, MSG_HIGH_DISCOUNT, MSG_LOW_FULFILMENT,  # noqa: E402
                     MSG_LOW_ONLINE, MSG_MARGIN_GAP, MSG_ON_TRACK, MSG_OVERSTOCK,
                     MSG_UNDERSTOCK)

_DESCRIBE = [("count", "CAST(count(x) AS DOUBLE)"), ("mean", "avg(x)"), ("std", "stddev_samp(x)"),
             ("min", "min(x)"), ("25%", "quantile_cont(x, 0.25)"), ("50%", "quantile_cont(x, 0.5)"),
             ("75%", "quantile_cont(x, 0.75)"), ("max", "max(x)")]


@register("margin_describe", master_sql(" UNION ALL ".join(
    f"SELECT '{n}' AS statistic, {np_round_sql(e.replace('(x', '(Net_Profit_Margin'), 2)} AS value, "
    f"CAST({i + 1} AS BIGINT) AS position FROM master" for i, (n, e) in enumerate(_DESCRIBE))),
    ("value",))
def margin_describe(spark, sf_dir):
    """Summary statistics of the master net margin (2 dp)."""
    return quality.describe_column(_master(spark, sf_dir), "Net_Profit_Margin")


@register("null_counts", master_sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM master"
        for c in MASTER_COLS.split(", ")) + ") WHERE nulls > 0"))
def null_counts(spark, sf_dir):
    """NULL count per master column (columns with NULLs only)."""
    return quality.null_counts(_master(spark, sf_dir))


@register("input_profile", with_ctes(RAW_CTES, ROLLUP_CTES, select="""
SELECT s.sales_rows, i.inventory_rows, s.sales_categories, i.inventory_categories,
       s.sales_regions, i.inventory_regions
FROM (SELECT count(*) AS sales_rows,
             string_agg(DISTINCT Product_Category, ',' ORDER BY Product_Category) AS sales_categories,
             string_agg(DISTINCT Region, ',' ORDER BY Region) AS sales_regions FROM sales) s,
     (SELECT count(*) AS inventory_rows,
             string_agg(DISTINCT Category, ',' ORDER BY Category) AS inventory_categories,
             string_agg(DISTINCT Region, ',' ORDER BY Region) AS inventory_regions
      FROM (SELECT * REPLACE (CASE WHEN Category = 'Groceries' THEN 'STANDARD' ELSE Category END
                              AS Category) FROM inventory)) i"""))
def input_profile(spark, sf_dir):
    """Shapes and sorted distinct categories / regions of both inputs,
    from the one line pass."""
    return quality.profile_of_parts(master_plan.staged_parts(spark, sf_dir))


# ------------------------------------------------------- modelling frame
ENC_COLS = ("Region_enc", "Category_enc", "Weather_Mode_enc", "Seasonality_enc")


LABEL_COLS = ("is_test", "Profit_Threshold", "label_cls")


def _model_frame(spark, sf_dir):
    return master_plan.staged_model_frame(spark, sf_dir).drop(*LABEL_COLS)


_TOP: dict[tuple, DataFrame] = {}


def _top_margin(spark, sf_dir):
    """A6's one row, from one range sort a state of the tables."""
    return master_plan.remember(_TOP, master_plan.stage_key(spark, sf_dir), lambda: stage_table(
        report.margin_quantile(_model_frame(spark, sf_dir)), "top-margin"))


@register("model_frame", model_sql(f"SELECT {MASTER_COLS}, {', '.join(ENC_COLS)} FROM mf"),
          MASTER_DOUBLES)
def model_frame(spark, sf_dir):
    """Encoded master rows with every feature and target present."""
    return _model_frame(spark, sf_dir)


@register("label_codes", model_sql(" UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS \"column\", coalesce({c}, 'nan') AS value, "
    f"CAST({c}_enc AS BIGINT) AS code FROM enc"
    for c in ("Region", "Category", "Weather_Mode", "Seasonality"))))
def label_codes(spark, sf_dir):
    """sorted-label codes fitted on the whole master table."""
    return prep.label_codes(master_plan.staged_master(spark, sf_dir))


@register("split_assign", model_sql("SELECT Month, Region, Category, is_test FROM mf_split"))
def split_assign(spark, sf_dir):
    """M1: hash-based ~20 % test flag per modelling row."""
    return prep.with_split(_model_frame(spark, sf_dir)).select(*KEY, "is_test")


@register("fold_assign", model_sql(
    "SELECT Month, Region, Category, "
    "CAST(ntile(5) OVER (ORDER BY Region, Category, Month) - 1 AS BIGINT) AS fold FROM mf"))
def fold_assign(spark, sf_dir):
    """Contiguous 5-fold number in (Region, Category, Month) order."""
    return (prep.with_folds(_model_frame(spark, sf_dir), 5)
            .select(*KEY, F.col("fold").cast("bigint").alias("fold")))


@register("train_median_threshold", model_sql("SELECT Profit_Threshold FROM thr"),
          ("Profit_Threshold",))
def train_median_threshold(spark, sf_dir):
    """Median net margin of the training rows."""
    return prep.train_threshold(prep.with_split(_model_frame(spark, sf_dir)))


@register("class_label", model_sql(
    "SELECT Month, Region, Category, Net_Profit_Margin, is_test, "
    "CAST(Net_Profit_Margin >= Profit_Threshold AS DOUBLE) AS label_cls FROM mf_split, thr"),
    ("Net_Profit_Margin",))
def class_label(spark, sf_dir):
    """high/low profit label against the training median."""
    df = prep.with_class_label(prep.with_split(_model_frame(spark, sf_dir)))
    return df.select(*KEY, "Net_Profit_Margin", "is_test", "label_cls")


# ------------------------------------------------------------ summaries
@register("yearly_summary", model_sql("""
SELECT Year, Region, Category,
       @dsum0(Total_Sales_Amount) AS Yearly_Sales,
       @dsum0(Net_Profit) AS Yearly_Profit,
       CAST(coalesce(sum(Total_Qty_Sold), 0) AS BIGINT) AS Yearly_Qty,
       @davg(Net_Profit_Margin) AS Avg_Margin_Pct,
       @dsum0(Transport_Cost_Est) AS Total_Transport,
       CAST(coalesce(sum(Retail_Txn), 0) AS BIGINT) AS Spot_Txn,
       CAST(coalesce(sum(Online_Txn), 0) AS BIGINT) AS Online_Txn_Count
FROM mf GROUP BY Year, Region, Category"""),
    ("Yearly_Sales", "Yearly_Profit", "Avg_Margin_Pct", "Total_Transport"))
def yearly_summary(spark, sf_dir):
    """A4: yearly actuals per segment."""
    return summaries.yearly_summary(_model_frame(spark, sf_dir))


@register("monthly_summary_actuals", model_sql("""
SELECT Year, MonthNum, Region, Category,
       @dsum0(Total_Sales_Amount) AS Monthly_Sales,
       @dsum0(Net_Profit) AS Monthly_Profit,
       CAST(coalesce(sum(Total_Qty_Sold), 0) AS BIGINT) AS Monthly_Qty,
       @davg(Net_Profit_Margin) AS Avg_Margin_Pct,
       CAST(coalesce(sum(Retail_Txn), 0) AS BIGINT) AS Spot_Txn,
       CAST(coalesce(sum(Online_Txn), 0) AS BIGINT) AS Online_Txn_Count,
       @dsum0(Transport_Cost_Est) AS Transport_Cost
FROM mf GROUP BY Year, MonthNum, Region, Category"""),
    ("Monthly_Sales", "Monthly_Profit", "Avg_Margin_Pct", "Transport_Cost"))
def monthly_summary_actuals(spark, sf_dir):
    """A3 (actual measures): monthly per segment."""
    return summaries.monthly_summary(_model_frame(spark, sf_dir), with_predictions=False)


# --------------------------------------------------------------- report
@register("margin_quantile", model_sql(
    "SELECT quantile_cont(Net_Profit_Margin, 0.75) AS Top_Quartile_Margin FROM mf"),
    ("Top_Quartile_Margin",))
def margin_quantile(spark, sf_dir):
    """75th percentile of the modelling-frame net margin."""
    return _top_margin(spark, sf_dir)


METRIC_COLS = ("Avg_Margin_Pct", "Margin_Gap_vs_Top_Quartile", "Avg_Discount_Pct",
               "Avg_Price_vs_Competitor", "Avg_Inventory_Coverage_Days", "Spot_Sales_Ratio_Avg",
               "Online_Sales_Ratio_Avg", "Fulfillment_Rate_Avg")
_METRICS_SELECT = f"""
SELECT Region, Category,
  {np_round_sql('m', 2)} AS Avg_Margin_Pct,
  {np_round_sql('greatest(q75 - m, CAST(0.0 AS DOUBLE))', 2)} AS Margin_Gap_vs_Top_Quartile,
  {np_round_sql('d * 100', 2)} AS Avg_Discount_Pct,
  {np_round_sql('pg', 2)} AS Avg_Price_vs_Competitor,
  {np_round_sql('cov', 1)} AS Avg_Inventory_Coverage_Days,
  {np_round_sql('sp * 100', 2)} AS Spot_Sales_Ratio_Avg,
  {np_round_sql('onl * 100', 2)} AS Online_Sales_Ratio_Avg,
  {np_round_sql('ful * 100', 2)} AS Fulfillment_Rate_Avg
FROM (SELECT Region, Category, @davg(Net_Profit_Margin) AS m, @davg(Avg_Discount_Sales) AS d,
             @davg(Price_vs_Competitor) AS pg, @davg(Inventory_Coverage) AS cov,
             @davg(Spot_Sales_Ratio) AS sp, @davg(Online_Sales_Ratio) AS onl,
             @davg(Fulfillment_Rate) AS ful
      FROM mf GROUP BY Region, Category),
     (SELECT quantile_cont(Net_Profit_Margin, 0.75) AS q75 FROM mf)"""


@register("improvement_metrics", model_sql(_METRICS_SELECT), METRIC_COLS)
def improvement_metrics(spark, sf_dir):
    """Rounded segment metrics and the margin gap."""
    return report.improvement_metrics(_model_frame(spark, sf_dir), top=_top_margin(spark, sf_dir))


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_RULES = [
    ("Margin_Gap_vs_Top_Quartile > 5.0", "MARGIN_GAP",
     _lit(MSG_MARGIN_GAP.split("{gap}")[0]) + " || printf('%.1f', Margin_Gap_vs_Top_Quartile) || "
     + _lit(MSG_MARGIN_GAP.split("{gap}")[1])),
    ("Avg_Discount_Pct > 20.0", "HIGH_DISCOUNT",
     _lit(MSG_HIGH_DISCOUNT.split("{discount}")[0]) + " || printf('%.1f', Avg_Discount_Pct) || "
     + _lit(MSG_HIGH_DISCOUNT.split("{discount}")[1])),
    ("Avg_Price_vs_Competitor < -5.0", "BELOW_COMPETITOR", _lit(MSG_BELOW_COMPETITOR)),
    ("Avg_Inventory_Coverage_Days > 60.0", "OVERSTOCK", _lit(MSG_OVERSTOCK)),
    ("Avg_Inventory_Coverage_Days < 10.0", "UNDERSTOCK", _lit(MSG_UNDERSTOCK)),
    ("Fulfillment_Rate_Avg < 70.0", "LOW_FULFILMENT", _lit(MSG_LOW_FULFILMENT)),
    ("Online_Sales_Ratio_Avg < 20.0", "LOW_ONLINE", _lit(MSG_LOW_ONLINE)),
]
_CODES = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{k}' END" for c, k, _ in _RULES) + ")"
_TEXTS = "concat_ws(' | ', " + ", ".join(f"CASE WHEN {c} THEN {m} END" for c, _, m in _RULES) + ")"
RULES_SQL = model_sql(f"""
SELECT *, CASE WHEN {_CODES} = '' THEN 'ON_TRACK' ELSE {_CODES} END AS Rule_Codes,
          CASE WHEN {_TEXTS} = '' THEN {_lit(MSG_ON_TRACK)} ELSE {_TEXTS} END AS Recommendations
FROM ({_METRICS_SELECT}) metrics""")


@register("improvement_rules", RULES_SQL, METRIC_COLS)
def improvement_rules(spark, sf_dir):
    """The improvement report with rule codes and text."""
    return report.improvement_report(_model_frame(spark, sf_dir), top=_top_margin(spark, sf_dir))
