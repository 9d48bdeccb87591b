"""Registered dashboard queries (D1-D17 that SQL can express), run on the
whole driver tables with the segment-mean scorer supplying predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import register
from .checked_queries import RULES_SQL, _model_frame, _top_margin
from .ml import baseline
from .plans import master as master_plan
from .oracle import dash_sql
from .operators import dashboard, report, summaries
from .schema import Filters, MONTH_NAMES

IMPROVE_SELECT = RULES_SQL[RULES_SQL.rindex("\nSELECT *, CASE WHEN"):]


def _preds(spark, sf_dir):
    frame = master_plan.staged_model_frame(spark, sf_dir)
    return dashboard.with_month_parts(baseline.segment_mean_scores(frame))


def _monthly(spark, sf_dir):
    return summaries.monthly_summary(_preds(spark, sf_dir))


def _improve(spark, sf_dir):
    return report.improvement_report(_model_frame(spark, sf_dir), top=_top_margin(spark, sf_dir))


def _seg_sql(names: str) -> str:
    return f"'{names}'"


KPI_SELECT = """
SELECT *, '₹' || printf('%,.1f', Total_Revenue / CAST(100000.0 AS DOUBLE)) || 'L' AS Revenue_Text,
       '₹' || printf('%,.1f', Total_Profit / CAST(100000.0 AS DOUBLE)) || 'L' AS Profit_Text,
       printf('%.1f', Avg_Margin) || '%' AS Margin_Text,
       format('{{:,}}', Units_Sold) AS Units_Text
FROM (SELECT @dsum(Total_Sales_Amount) AS Total_Revenue, @dsum(Net_Profit) AS Total_Profit,
             @davg(Net_Profit_Margin) AS Avg_Margin, CAST(sum(Total_Qty_Sold) AS BIGINT) AS Units_Sold
      FROM preds {where})"""
KPI_DOUBLES = ("Total_Revenue", "Total_Profit", "Avg_Margin")


@register("kpi_row", dash_sql(KPI_SELECT.format(where="")), KPI_DOUBLES)
def kpi_row(spark, sf_dir):
    """KPI tiles over all predictions."""
    return dashboard.kpi_row(_preds(spark, sf_dir))


# The dashboard's own filter (P7/P8): one year, two regions, three categories.
SAMPLE_FILTERS = Filters(year=1997, regions=("AMERICA", "ASIA"),
                         categories=("ECONOMY", "SMALL", "STANDARD"))


@register("filtered_kpis", dash_sql(KPI_SELECT.format(
    where="WHERE Year = 1997 AND Region IN ('AMERICA', 'ASIA') "
          "AND Category IN ('ECONOMY', 'SMALL', 'STANDARD')")), KPI_DOUBLES)
def filtered_kpis(spark, sf_dir):
    """P7-P8 + D1: KPI tiles under a year / region / category filter."""
    return dashboard.kpi_row(dashboard.apply_filters(_preds(spark, sf_dir), SAMPLE_FILTERS))


_MONTHS = "[" + ", ".join(f"'{m}'" for m in MONTH_NAMES) + "]"


@register("monthly_trend", dash_sql(f"""
SELECT MonthNum, @dsum(Monthly_Sales) AS Revenue, @dsum(Monthly_Profit) AS Profit,
       CASE WHEN MonthNum BETWEEN 1 AND 12 THEN {_MONTHS}[MonthNum]
            ELSE CAST(MonthNum AS VARCHAR) END AS Month
FROM monthly GROUP BY MonthNum"""), ("Revenue", "Profit"))
def monthly_trend(spark, sf_dir):
    """Revenue and profit by calendar month (years folded)."""
    return dashboard.monthly_trend(_monthly(spark, sf_dir))


_CAT_SUMS = "SELECT Category, @dsum(Total_Sales_Amount) AS Total_Sales_Amount FROM preds GROUP BY Category"


@register("sales_by_category", dash_sql(f"""
SELECT Category, Total_Sales_Amount, Total_Sales_Amount / t._total * 100 AS Share_Pct
FROM ({_CAT_SUMS}) c, (SELECT @dsum(Total_Sales_Amount) AS _total FROM ({_CAT_SUMS})) t"""),
    ("Total_Sales_Amount", "Share_Pct"))
def sales_by_category(spark, sf_dir):
    """D3: sales per category with share of total."""
    return dashboard.sales_by_category(_preds(spark, sf_dir))


@register("sales_by_region", dash_sql("""
SELECT Region, Total_Sales_Amount,
       CAST(row_number() OVER (ORDER BY Total_Sales_Amount, Region) AS BIGINT) AS rank
FROM (SELECT Region, @dsum(Total_Sales_Amount) AS Total_Sales_Amount FROM preds GROUP BY Region)"""),
    ("Total_Sales_Amount",))
def sales_by_region(spark, sf_dir):
    """Revenue by region, ascending."""
    return dashboard.sales_by_region(_preds(spark, sf_dir))


@register("channel_split", dash_sql("""
SELECT Category, @davg(Spot_Sales_Ratio) * 100 AS Spot, @davg(Online_Sales_Ratio) * 100 AS Online
FROM preds GROUP BY Category"""), ("Spot", "Online"))
def channel_split(spark, sf_dir):
    """Spot vs online share by category."""
    return dashboard.channel_split(_preds(spark, sf_dir))


def _np2(e: str) -> str:
    return f"(round_even(({e}) * 100.0, 0) / 100.0)"


SEG_SELECT = f"""
SELECT Region, Category, {_np2('@dsum(Total_Sales_Amount)')} AS Actual_Sales,
       {_np2('@dsum(Predicted_Sales)')} AS Predicted_Sales,
       {_np2('@dsum(Net_Profit)')} AS Net_Profit,
       {_np2('@davg(Net_Profit_Margin)')} AS Avg_Margin,
       CAST(sum(Predicted_Sell_Qty) AS BIGINT) AS Pred_Sell_Qty,
       {_np2('@dsum(Transport_Cost_Est)')} AS Transport_Cost
FROM preds GROUP BY Region, Category"""
SEG_DOUBLES = ("Actual_Sales", "Predicted_Sales", "Net_Profit", "Avg_Margin", "Transport_Cost")


@register("segment_predictions", dash_sql(f"""
SELECT *, greatest(max(Actual_Sales) OVER (), max(Predicted_Sales) OVER ()) AS Max_Extent
FROM ({SEG_SELECT}) s"""), SEG_DOUBLES + ("Max_Extent",))
def segment_predictions(spark, sf_dir):
    """Actual vs predicted per segment and the parity extent."""
    return dashboard.segment_predictions(_preds(spark, sf_dir))


@register("monthly_actual_vs_predicted", dash_sql("""
SELECT MonthLabel, @dsum(Total_Sales_Amount) AS Actual, @dsum(Predicted_Sales) AS Predicted,
       min(Month) AS Month, CAST(row_number() OVER (ORDER BY min(Month)) AS BIGINT) AS rank
FROM preds GROUP BY MonthLabel"""), ("Actual", "Predicted"))
def monthly_actual_vs_predicted(spark, sf_dir):
    """Actual vs predicted by month label, in calendar order."""
    return dashboard.monthly_actual_vs_predicted(_preds(spark, sf_dir))


@register("segment_table_text", dash_sql(f"""
SELECT s.Region, s.Category,
       '₹' || printf('%,.0f', Actual_Sales) AS Actual_Sales,
       '₹' || printf('%,.0f', Predicted_Sales) AS Predicted_Sales,
       '₹' || printf('%,.0f', Net_Profit) AS Net_Profit,
       printf('%.1f', Avg_Margin) || '%' AS Avg_Margin,
       format('{{:,}}', Pred_Sell_Qty) || ' units' AS Pred_Sell_Qty,
       '₹' || printf('%,.0f', Transport_Cost) AS Transport_Cost,
       m.v AS Profit_Class,
       CASE WHEN m.v = 'High Profit' THEN 'high' ELSE 'low' END AS Class_Tag
FROM ({SEG_SELECT}) s
LEFT JOIN (SELECT Region, Category, v FROM (
             SELECT Region, Category, Predicted_Profit_Class AS v,
                    row_number() OVER (PARTITION BY Region, Category
                                       ORDER BY count(*) DESC, Predicted_Profit_Class) AS rn
             FROM preds WHERE Predicted_Profit_Class IS NOT NULL
             GROUP BY Region, Category, Predicted_Profit_Class) WHERE rn = 1) m
  ON s.Region = m.Region AND s.Category = m.Category"""))
def segment_table_text(spark, sf_dir):
    """Formatted segment table with the modal predicted class."""
    return dashboard.segment_table(_preds(spark, sf_dir))


def _rank_sql(cols: str, order: str, extra: str = "") -> str:
    return dash_sql(f"""
SELECT Region || ' · ' || Category AS Segment, {cols}{extra},
       CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS rank
FROM improve""", IMPROVE_SELECT)


@register("margin_gap_rank", _rank_sql("Margin_Gap_vs_Top_Quartile",
                                       "Margin_Gap_vs_Top_Quartile, Segment"),
          ("Margin_Gap_vs_Top_Quartile",))
def margin_gap_rank(spark, sf_dir):
    """Segments by margin gap, ascending."""
    return dashboard.margin_gap_rank(_improve(spark, sf_dir))


@register("discount_rank", _rank_sql("Avg_Discount_Pct", "Avg_Discount_Pct, Segment"),
          ("Avg_Discount_Pct",))
def discount_rank(spark, sf_dir):
    """Segments by mean discount, ascending."""
    return dashboard.discount_rank(_improve(spark, sf_dir))


@register("coverage_rank", _rank_sql(
    "Avg_Inventory_Coverage_Days", "Avg_Inventory_Coverage_Days DESC, Segment",
    ", CASE WHEN Avg_Inventory_Coverage_Days > 60.0 THEN 'overstock' "
    "WHEN Avg_Inventory_Coverage_Days < 30.0 THEN 'below ideal' ELSE 'ideal' END AS Band"),
    ("Avg_Inventory_Coverage_Days",))
def coverage_rank(spark, sf_dir):
    """Segments by stock coverage, descending, with the 30/60-day band."""
    return dashboard.coverage_rank(_improve(spark, sf_dir))


@register("fulfillment_rank", _rank_sql("Fulfillment_Rate_Avg", "Fulfillment_Rate_Avg, Segment"),
          ("Fulfillment_Rate_Avg",))
def fulfillment_rank(spark, sf_dir):
    """Segments by fulfilment, ascending."""
    return dashboard.fulfillment_rank(_improve(spark, sf_dir))


@register("action_list", _rank_sql(
    "Margin_Gap_vs_Top_Quartile",
    "Margin_Gap_vs_Top_Quartile DESC, Segment",
    ", CASE WHEN Recommendations = 'Performance is on-track.' THEN 'on-track' "
    "ELSE 'needs action' END AS Status, "
    "'Margin: ' || printf('%.1f', Avg_Margin_Pct) || '% | Gap: ' "
    "|| printf('%.1f', Margin_Gap_vs_Top_Quartile) || 'pp | Discount: ' "
    "|| printf('%.1f', Avg_Discount_Pct) || '%' AS Summary, Recommendations"),
    ("Margin_Gap_vs_Top_Quartile",))
def action_list(spark, sf_dir):
    """Action list by margin gap, descending, with status."""
    return dashboard.action_list(_improve(spark, sf_dir))


@register("filter_choices", dash_sql("""
SELECT string_agg(DISTINCT CAST(Year AS VARCHAR), ',' ORDER BY CAST(Year AS VARCHAR)) AS years,
       string_agg(DISTINCT Region, ',' ORDER BY Region) AS regions,
       string_agg(DISTINCT Category, ',' ORDER BY Category) AS categories
FROM preds"""))
def filter_choices(spark, sf_dir):
    """Sorted distinct years, regions, categories of the predictions."""
    c = dashboard.filter_choices(_preds(spark, sf_dir))
    return c.select(*[F.array_join(F.col(n).cast("array<string>"), ",").alias(n)
                      for n in ("years", "regions", "categories")])


_REG_METRICS = " UNION ALL ".join(
    f"SELECT '{m}' AS Model, avg(abs({y} - {p})) AS MAE, "
    f"1.0 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count({y})) AS R2 "
    f"FROM preds WHERE is_test"
    for m, y, p in (("Sales_Amount", "Total_Sales_Amount", "Predicted_Sales"),
                    ("Profit_Margin", "Net_Profit_Margin", "Predicted_Margin_Pct"),
                    ("Sell_Quantity", "Total_Qty_Sold", "Predicted_Sell_Qty")))


@register("regression_metrics", dash_sql(_REG_METRICS), ("MAE", "R2"))
def regression_metrics(spark, sf_dir):
    """M6-M7: holdout MAE and R² of the segment-mean scorer."""
    from .ml.models import regression_metrics as rm
    test = _preds(spark, sf_dir).filter(F.col("is_test"))
    parts = [rm(test, y, p).select(F.lit(m).alias("Model"), "MAE", "R2")
             for m, y, p in (("Sales_Amount", "Total_Sales_Amount", "Predicted_Sales"),
                             ("Profit_Margin", "Net_Profit_Margin", "Predicted_Margin_Pct"),
                             ("Sell_Quantity", "Total_Qty_Sold", "Predicted_Sell_Qty"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_CR_CTES = """
cr_t AS (SELECT label_cls AS y, CASE WHEN Predicted_Profit_Class = 'High Profit' THEN 1.0
                                    ELSE 0.0 END AS p FROM preds WHERE is_test),
cr_c AS (SELECT cls, name,
                count(*) FILTER (WHERE y = cls AND p = cls) AS tp,
                count(*) FILTER (WHERE y = cls) AS support,
                count(*) FILTER (WHERE p = cls) AS pred_n
         FROM cr_t, (VALUES (0.0, 'Low Profit'), (1.0, 'High Profit')) v(cls, name)
         GROUP BY cls, name),
cr_pc AS (SELECT name AS class,
                 coalesce(tp / nullif(pred_n, 0), 0.0) AS precision,
                 coalesce(tp / nullif(support, 0), 0.0) AS recall, support, tp FROM cr_c),
cr_pf AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0.0), 0.0) AS f1
          FROM cr_pc)"""


@register("classification_report", dash_sql("""
SELECT class, precision, recall, f1, support FROM cr_pf
UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / (SELECT count(*) FROM cr_t), sum(support)
          FROM cr_pf
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM cr_pf
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
                 sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
                 sum(support) FROM cr_pf""", extra_ctes=_CR_CTES), ("precision", "recall", "f1"))
def classification_report(spark, sf_dir):
    """Holdout classification report of the segment-majority class."""
    from .ml.models import classification_report as cr
    test = _preds(spark, sf_dir).filter(F.col("is_test")).withColumn(
        "_p", (F.col("Predicted_Profit_Class") == "High Profit").cast("double"))
    return cr(test, "label_cls", "_p")
