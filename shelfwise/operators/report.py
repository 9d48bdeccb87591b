"""Improvement report per segment.

One ``groupBy(Region, Category).agg`` computes the metrics; the global
75th percentile is a one-row aggregate broadcast onto the segment rows; the
rules are column expressions evaluated on the *rounded* metrics, in order.
No per-group Python loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import davg, np_round, py_format
from ..functions.quantiles import exact_quantiles
from ..schema import (MSG_BELOW_COMPETITOR, MSG_HIGH_DISCOUNT, MSG_LOW_FULFILMENT,
                      MSG_LOW_ONLINE, MSG_MARGIN_GAP, MSG_ON_TRACK, MSG_OVERSTOCK,
                      MSG_UNDERSTOCK, RECOMMENDATION_SEPARATOR, SEGMENT, Thresholds)

RULE_CODES = ["MARGIN_GAP", "HIGH_DISCOUNT", "BELOW_COMPETITOR", "OVERSTOCK",
              "UNDERSTOCK", "LOW_FULFILMENT", "LOW_ONLINE"]


def margin_quantile(frame: DataFrame, q: float = 0.75) -> DataFrame:
    """Exact, linearly interpolated quantile of the net margin (one row)."""
    return exact_quantiles(frame, {"Top_Quartile_Margin": ("Net_Profit_Margin", q)})


def improvement_metrics(frame: DataFrame, thresholds: Thresholds = Thresholds(), top: DataFrame | None = None) -> DataFrame:
    """A5 + F24: segment means (×100 for shares), rounded like numpy's
    ``round`` (the reference rounds numpy floats), and the gap to the top-quartile margin floored at 0.
    ``top``: the frame's ``margin_quantile`` if it is there already."""
    per_seg = frame.groupBy(*SEGMENT).agg(
        davg("Net_Profit_Margin").alias("_margin"),
        davg("Avg_Discount_Sales").alias("_discount"),
        davg("Price_vs_Competitor").alias("_price_gap"),
        davg("Inventory_Coverage").alias("_coverage"),
        davg("Spot_Sales_Ratio").alias("_spot"),
        davg("Online_Sales_Ratio").alias("_online"),
        davg("Fulfillment_Rate").alias("_fulfil"),
    )
    q = F.broadcast(margin_quantile(frame, thresholds.top_quantile) if top is None else top)          # one row
    joined = per_seg.crossJoin(q)
    return joined.select(
        "Region", "Category",
        np_round("_margin", 2).alias("Avg_Margin_Pct"),
        np_round(F.greatest(F.col("Top_Quartile_Margin") - F.col("_margin"), F.lit(0.0)), 2)
        .alias("Margin_Gap_vs_Top_Quartile"),
        np_round(F.col("_discount") * 100, 2).alias("Avg_Discount_Pct"),
        np_round("_price_gap", 2).alias("Avg_Price_vs_Competitor"),
        np_round("_coverage", 1).alias("Avg_Inventory_Coverage_Days"),
        np_round(F.col("_spot") * 100, 2).alias("Spot_Sales_Ratio_Avg"),
        np_round(F.col("_online") * 100, 2).alias("Online_Sales_Ratio_Avg"),
        np_round(F.col("_fulfil") * 100, 2).alias("Fulfillment_Rate_Avg"),
    )


def _message(template: str, field: str, value: F.Column) -> F.Column:
    head, tail = template.split("{" + field + "}")
    return F.concat(F.lit(head), py_format(value, 1), F.lit(tail))


def apply_rules(metrics: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """R1-R8 + F34: ``Rule_Codes`` (comma list, stable) and the
    ``Recommendations`` text joined by `` | `` (on-track text when none)."""
    t = thresholds
    gap = F.col("Margin_Gap_vs_Top_Quartile")
    disc = F.col("Avg_Discount_Pct")
    cov = F.col("Avg_Inventory_Coverage_Days")
    fired = [
        gap > t.margin_gap_pp,
        disc > t.discount_pct,
        F.col("Avg_Price_vs_Competitor") < t.below_competitor,
        cov > t.overstock_days,
        cov < t.understock_days,
        F.col("Fulfillment_Rate_Avg") < t.fulfilment_pct,
        F.col("Online_Sales_Ratio_Avg") < t.online_pct,
    ]
    texts = [
        _message(MSG_MARGIN_GAP, "gap", gap),
        _message(MSG_HIGH_DISCOUNT, "discount", disc),
        F.lit(MSG_BELOW_COMPETITOR), F.lit(MSG_OVERSTOCK), F.lit(MSG_UNDERSTOCK),
        F.lit(MSG_LOW_FULFILMENT), F.lit(MSG_LOW_ONLINE),
    ]
    # a NULL metric fires nothing (NaN comparisons are false in the reference)
    codes = F.concat_ws(",", *[F.when(c, F.lit(code)) for c, code in zip(fired, RULE_CODES)])
    joined = F.concat_ws(RECOMMENDATION_SEPARATOR, *[F.when(c, m) for c, m in zip(fired, texts)])
    return (metrics
            .withColumn("Rule_Codes", F.when(codes == "", F.lit("ON_TRACK")).otherwise(codes))
            .withColumn("Recommendations",
                        F.when(joined == "", F.lit(MSG_ON_TRACK)).otherwise(joined)))


def improvement_report(frame: DataFrame, thresholds: Thresholds = Thresholds(), top: DataFrame | None = None) -> DataFrame:
    """Metrics + rules, in the output column order."""
    return apply_rules(improvement_metrics(frame, thresholds, top), thresholds)
