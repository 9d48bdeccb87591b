"""Dashboard operators: filters, empty check, labels, score cards, top-k."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import dashboard
from shelfwise.schema import Filters

D = dt.date


def _preds(spark):
    rows = [(D(2023, 12, 1), "East", "Food", 100.0, 10.0, 5.0, 2, 0.25, 0.75, 90.0, 2.0, 1,
             "High Profit", 1.0),
            (D(2024, 1, 1), "East", "Food", 200.0, 20.0, 15.0, 4, 0.5, 0.5, 180.0, 4.0, 3,
             "Low Profit", 2.0),
            (D(2024, 1, 1), "West", "Toys", 300.0, 30.0, 25.0, 6, 0.0, 1.0, 310.0, 6.0, 5,
             "Low Profit", 3.0)]
    schema = ("Month date, Region string, Category string, Total_Sales_Amount double, "
              "Net_Profit double, Net_Profit_Margin double, Total_Qty_Sold bigint, "
              "Spot_Sales_Ratio double, Online_Sales_Ratio double, Predicted_Sales double, "
              "Transport_Cost_Est double, Predicted_Sell_Qty bigint, "
              "Predicted_Profit_Class string, Avg_Unit_Cost double")
    return dashboard.with_month_parts(spark.createDataFrame(rows, schema))


def test_filters_and_empty(spark):
    p = _preds(spark)
    f = dashboard.apply_filters(p, Filters(year=2024, regions=("East",), categories=("Food",)))
    assert f.count() == 1
    assert dashboard.is_empty(dashboard.apply_filters(p, Filters(regions=("North",))))
    assert dashboard.apply_filters(p, Filters()).count() == 3
    labels = sorted(r.MonthLabel for r in p.select("MonthLabel").distinct().collect())
    assert labels == ["Dec 2023", "Jan 2024"]
    choices = dashboard.filter_choices(p).first()
    assert choices.years == [2023, 2024] and choices.regions == ["East", "West"]


def test_kpis_and_tiles(spark):
    p = _preds(spark)
    k = dashboard.kpi_row(p).first()
    assert k.Total_Revenue == 600.0 and k.Units_Sold == 12
    assert k.Revenue_Text == "₹0.0L" and k.Margin_Text == "15.0%" and k.Units_Text == "12"
    cat = {r.Category: r for r in dashboard.sales_by_category(p).collect()}
    assert abs(cat["Food"].Share_Pct - 50.0) < 1e-12
    reg = dashboard.sales_by_region(p).orderBy("rank").collect()
    assert [r.Region for r in reg] == ["East", "West"]
    m = dashboard.monthly_actual_vs_predicted(p).orderBy("rank").collect()
    assert [r.MonthLabel for r in m] == ["Dec 2023", "Jan 2024"]
    seg = {(r.Region, r.Category): r for r in dashboard.segment_table(p).collect()}
    east = seg[("East", "Food")]
    assert east.Profit_Class == "High Profit"   # 1-1 tie → smallest label
    assert east.Actual_Sales == "₹300" and east.Pred_Sell_Qty == "4 units"
    assert east.Class_Tag == "high"
    ext = dashboard.segment_predictions(p).first().Max_Extent
    assert ext == 310.0


def test_score_cards_and_importances(spark):
    scores = spark.createDataFrame(
        [("Sales_Amount", 1.5, 0.9, 0.92, None), ("Profit_Classifier", None, None, None, 0.81)],
        "Model string, MAE double, R2 double, CV_R2 double, Accuracy double")
    cards = {r.Model: r for r in dashboard.score_cards(scores).collect()}
    assert cards["Sales_Amount"].Primary_Text == "0.900" and cards["Sales_Amount"].CV_Text == "0.920"
    assert cards["Profit_Classifier"].Primary_Text == "0.810" and cards["Profit_Classifier"].CV_Text is None
    assert cards["Profit_Margin"].Scores_Missing and cards["Profit_Margin"].Primary_Text == "0.000"
    fi = spark.createDataFrame([(f"f{i}", 1.0 / (i + 1), 0.1, 0.2, 0.3) for i in range(15)],
                               "Feature string, Importance_Sales double, Importance_Margin double, "
                               "Importance_Qty double, Importance_Cls double")
    top = dashboard.top_features(fi, 12).orderBy("rank").collect()
    assert len(top) == 12 and top[0].Feature == "f0"
    long = dashboard.importance_long(fi, 10)
    assert long.count() == 40
    assert sorted(r.Model for r in long.select("Model").distinct().collect()) == [
        "Classifier", "Margin", "Quantity", "Sales"]


def test_month_trend_names(spark):
    m = spark.createDataFrame([(1, 10.0, 1.0), (1, 5.0, 1.0), (12, 1.0, 0.5)],
                              "MonthNum bigint, Monthly_Sales double, Monthly_Profit double")
    t = {r.MonthNum: r for r in dashboard.monthly_trend(m).collect()}
    assert t[1].Month == "Jan" and t[1].Revenue == 15.0 and t[12].Month == "Dec"


def test_year_filter_filters_or_raises(spark):
    months = spark.createDataFrame([("2023-01-01", "E"), ("2024-01-01", "E")], "Month string, Region string").withColumn(
        "Month", F.to_date("Month"))
    assert dashboard.apply_filters(months, Filters(year=2024)).count() == 1
    report = months.drop("Month")
    with pytest.raises(ValueError, match="Year or Month"):
        dashboard.apply_filters(report, Filters(year=2024))
    assert dashboard.apply_filters(report, Filters(year=2024, regions=("E",)).without_year()).count() == 2


def test_trend_is_in_calendar_order(spark):
    m = spark.createDataFrame([(12, 1.0, 1.0), (2, 1.0, 1.0), (10, 1.0, 1.0)], "MonthNum bigint, Monthly_Sales double, Monthly_Profit double")
    assert [r.MonthNum for r in dashboard.monthly_trend(m).collect()] == [2, 10, 12]
