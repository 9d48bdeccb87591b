"""Rule codes and texts on invented segments, on both sides of every threshold."""
from shelfwise.operators import report
from shelfwise.schema import (MSG_BELOW_COMPETITOR, MSG_HIGH_DISCOUNT, MSG_ON_TRACK,
                              RECOMMENDATION_SEPARATOR, Thresholds)

COLS = ["Region", "Category", "Avg_Margin_Pct", "Margin_Gap_vs_Top_Quartile", "Avg_Discount_Pct",
        "Avg_Price_vs_Competitor", "Avg_Inventory_Coverage_Days", "Spot_Sales_Ratio_Avg",
        "Online_Sales_Ratio_Avg", "Fulfillment_Rate_Avg"]

T = Thresholds()


def segment(name, rules, **metrics):
    """An invented segment: figures on the quiet side of every threshold but for the given ones."""
    quiet = dict(Avg_Margin_Pct=80.0, Margin_Gap_vs_Top_Quartile=T.margin_gap_pp - 1, Avg_Discount_Pct=T.discount_pct - 1,
                 Avg_Price_vs_Competitor=T.below_competitor + 1, Avg_Inventory_Coverage_Days=(T.overstock_days + T.understock_days) / 2,
                 Spot_Sales_Ratio_Avg=50.0, Online_Sales_Ratio_Avg=T.online_pct + 1, Fulfillment_Rate_Avg=T.fulfilment_pct + 1)
    return ("Harbour", name, *[(quiet | metrics)[c] for c in COLS[2:]], rules)


# Either side of every threshold, alone and together.
SEGMENTS = [
    segment("quiet", "ON_TRACK"),
    segment("gap", "MARGIN_GAP", Margin_Gap_vs_Top_Quartile=T.margin_gap_pp + 0.5),
    segment("discount", "HIGH_DISCOUNT", Avg_Discount_Pct=T.discount_pct + 0.4),
    segment("cheap", "BELOW_COMPETITOR", Avg_Price_vs_Competitor=T.below_competitor - 0.1),
    segment("full", "OVERSTOCK", Avg_Inventory_Coverage_Days=T.overstock_days + 0.1),
    segment("empty", "UNDERSTOCK", Avg_Inventory_Coverage_Days=T.understock_days - 0.1),
    segment("late", "LOW_FULFILMENT", Fulfillment_Rate_Avg=T.fulfilment_pct - 0.1),
    segment("offline", "LOW_ONLINE", Online_Sales_Ratio_Avg=T.online_pct - 0.1),
    segment("two", "HIGH_DISCOUNT,BELOW_COMPETITOR", Avg_Discount_Pct=T.discount_pct + 0.4,
            Avg_Price_vs_Competitor=T.below_competitor - 9),
    segment("exactly", "ON_TRACK", Margin_Gap_vs_Top_Quartile=T.margin_gap_pp, Avg_Discount_Pct=T.discount_pct,
            Avg_Price_vs_Competitor=T.below_competitor, Avg_Inventory_Coverage_Days=T.overstock_days,
            Fulfillment_Rate_Avg=T.fulfilment_pct, Online_Sales_Ratio_Avg=T.online_pct),
]
SCHEMA = ", ".join(f"{c} {'string' if i < 2 else 'double'}" for i, c in enumerate(COLS))


def _apply(spark, rows, t=Thresholds()):
    df = spark.createDataFrame([r[:10] for r in rows], SCHEMA)
    return {(r.Region, r.Category): r for r in report.apply_rules(df, t).collect()}


def test_rule_codes_and_text(spark):
    out = _apply(spark, SEGMENTS)
    for row in SEGMENTS:
        assert out[row[:2]].Rule_Codes == row[10], row[:2]
    two = out[("Harbour", "two")].Recommendations
    assert two == RECOMMENDATION_SEPARATOR.join([MSG_HIGH_DISCOUNT.format(discount=f"{T.discount_pct + 0.4:.1f}"), MSG_BELOW_COMPETITOR])
    assert out[("Harbour", "quiet")].Recommendations == MSG_ON_TRACK


def test_every_rule_fires(spark):
    rows = [
        ("A", "gap", 80.0, 7.25, 10.0, 0.0, 40.0, 50.0, 50.0, 90.0, "MARGIN_GAP"),
        ("A", "over", 80.0, 0.0, 10.0, 0.0, 61.0, 50.0, 50.0, 90.0, "OVERSTOCK"),
        ("A", "under", 80.0, 0.0, 10.0, 0.0, 9.9, 50.0, 50.0, 90.0, "UNDERSTOCK"),
        ("A", "ful", 80.0, 0.0, 10.0, 0.0, 40.0, 50.0, 50.0, 69.99, "LOW_FULFILMENT"),
        ("A", "all", 80.0, 6.0, 25.0, -6.0, 70.0, 90.0, 10.0, 10.0,
         "MARGIN_GAP,HIGH_DISCOUNT,BELOW_COMPETITOR,OVERSTOCK,LOW_FULFILMENT,LOW_ONLINE"),
        ("A", "edge", 80.0, 5.0, 20.0, -5.0, 60.0, 50.0, 20.0, 70.0, "ON_TRACK"),
        ("A", "null", None, None, None, None, None, None, None, None, "ON_TRACK"),
    ]
    out = _apply(spark, rows)
    for row in rows:
        assert out[row[:2]].Rule_Codes == row[10], row[:2]
    assert out[("A", "gap")].Recommendations.startswith("Margin is 7.2pp below")  # 7.25 → 7.2


def test_thresholds_are_parameters(spark):
    out = _apply(spark, SEGMENTS[:1], Thresholds(online_pct=T.online_pct + 5, below_competitor=T.below_competitor - 50))
    assert out[("Harbour", "quiet")].Rule_Codes == "LOW_ONLINE"
