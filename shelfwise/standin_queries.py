"""The model stage on closed-form estimators, so that SQL can check it: group
means (``ml.standin``) by segment in place of the four models, by category in
the folds, with absolute correlations as importances. Fitting, folds, score
table, scoring and importances are the library's own code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import register
from .ml import models, prep
from .ml.standin import GroupMean
from .operators import dashboard, summaries
from .oracle import dash_sql
from .plans import master as master_plan
from .plans.modelling import select_prediction_columns
from .schema import FEATURE_COLS, IMPORTANCE_LABELS, PREDICTION_COLS, SEGMENT, ModelParams
from .session import stage_table

_KEYS = {"Month", "Region", "Category", "Total_Qty_Sold", "Predicted_Sell_Qty", "Predicted_Profit_Class"}
_MORE = ["Predicted_Gross_Profit", "Predicted_Transport_Cost"]
_DOUBLES = tuple(c for c in PREDICTION_COLS + _MORE if c not in _KEYS)


_FRAMES: dict[tuple, DataFrame] = {}
_SCORED: dict[tuple, DataFrame] = {}
_SCORES: dict[tuple, DataFrame] = {}


def _frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modelling frame with its folds, written once: fits, folds and
    scores read it some thirty times, and with the folds' windows in each of
    their plans the driver ran out of memory."""
    return master_plan.remember(_FRAMES, master_plan.stage_key(spark, sf_dir), lambda: stage_table(
        prep.with_folds(master_plan.staged_model_frame(spark, sf_dir), 5), "standin-frame"))


def _fitted(spark, sf_dir, everything: bool = False) -> models.Fitted:
    """The four stand-in models, on the training rows (or on all)."""
    frame = _frame(spark, sf_dir)
    rows = frame if everything else frame.filter(~F.col("is_test"))
    made = [GroupMean(models.SALES, "Predicted_Sales", SEGMENT), GroupMean(models.MARGIN, "Predicted_Margin_Pct", SEGMENT),
            GroupMean(models.QTY, "_pred_qty", SEGMENT, exact=False),
            GroupMean("label_cls", "_pred_cls", SEGMENT, majority=True, exact=False)]
    return models.Fitted(*models.fit_all([(m, rows) for m in made]), frame=frame, params=ModelParams())


def _scored(spark, sf_dir):
    """Every modelling row scored by the stand-ins, written once."""
    return master_plan.remember(_SCORED, master_plan.stage_key(spark, sf_dir), lambda: stage_table(
        dashboard.with_month_parts(models.score(_fitted(spark, sf_dir))), "standin-scored"))


@register("predictions_table", dash_sql(
    f"SELECT {', '.join(PREDICTION_COLS)}, Predicted_Sales * (Predicted_Margin_Pct / 100) AS Predicted_Gross_Profit, "
    "Avg_Unit_Cost * Predicted_Sell_Qty * CAST(0.02 AS DOUBLE) AS Predicted_Transport_Cost FROM preds"), _DOUBLES)
def predictions_table(spark, sf_dir):
    """P6 + F19-F23: the prediction output table with the derived money columns."""
    preds = _scored(spark, sf_dir)
    kept = select_prediction_columns(preds).columns
    return preds.select(*kept, *_MORE)


@register("monthly_summary_predicted", dash_sql(
    "SELECT Year, MonthNum, Region, Category, Monthly_Sales, Monthly_Profit, Pred_Sales, Pred_Profit FROM monthly"),
    ("Monthly_Sales", "Monthly_Profit", "Pred_Sales", "Pred_Profit"))
def monthly_summary_predicted(spark, sf_dir):
    """A3: monthly actual and predicted totals."""
    return summaries.monthly_summary(_scored(spark, sf_dir)).select(
        "Year", "MonthNum", "Region", "Category", "Monthly_Sales", "Monthly_Profit", "Pred_Sales", "Pred_Profit")


_SPECS = (("Sales_Amount", "Total_Sales_Amount", "Predicted_Sales", 2),
          ("Profit_Margin", "Net_Profit_Margin", "Predicted_Margin_Pct", 4),
          ("Sell_Quantity", "Total_Qty_Sold", "raw_qty", 2))

_SCORES_CTES = """
hold AS (SELECT p.*, q.raw_qty FROM preds p LEFT JOIN (
  SELECT Region, Category, avg(Total_Qty_Sold) AS raw_qty FROM preds WHERE NOT is_test GROUP BY ALL) q USING (Region, Category)),
pos AS (SELECT *, row_number() OVER (ORDER BY Region, Category, Month) - 1 AS i, count(*) OVER () AS n FROM preds),
fld AS (SELECT *, CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1)
                       ELSE (n % 5) + (i - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold FROM pos),
sc AS (""" + " UNION ALL ".join(f"""
  SELECT '{m}' AS Model,
         (SELECT round_even(avg(abs({y} - {p})) * 1e{d}, 0) / 1e{d} FROM hold WHERE is_test) AS MAE,
         (SELECT round_even((1.0 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count({y}))) * 1e4, 0) / 1e4
          FROM hold WHERE is_test) AS R2,
         (SELECT round_even(avg(r) * 1e4, 0) / 1e4 FROM (
            SELECT 1.0 - sum((h.{y} - k.m) * (h.{y} - k.m)) / (var_pop(h.{y}) * count(h.{y})) AS r
            FROM fld h JOIN (SELECT g.fold AS f, t.Category AS c, avg(t.{y}) AS m
                             FROM (SELECT DISTINCT fold FROM fld) g JOIN fld t ON t.fold <> g.fold GROUP BY 1, 2) k
              ON k.f = h.fold AND k.c = h.Category GROUP BY h.fold)) AS CV_R2,
         CAST(NULL AS DOUBLE) AS Accuracy""" for m, y, p, d in _SPECS) + """
  UNION ALL SELECT 'Profit_Classifier', NULL, NULL, NULL,
         (SELECT round_even(avg(CASE WHEN (label_cls = 1) = (Predicted_Profit_Class = 'High Profit') THEN 1.0 ELSE 0.0 END) * 1e4, 0) / 1e4
          FROM preds WHERE is_test))"""


def _scores(spark, sf_dir):
    """The score table (U1, M13) of the stand-ins, cross-validated (M8), written once."""
    def make():
        fitted = _fitted(spark, sf_dir)
        folds = [(name, GroupMean(label, "_cv", ["Category"]), label) for name, label, _, _ in _SPECS]
        return stage_table(models.score_table(fitted, cv=models.cv_all(fitted.frame, folds, 5, parallelism=2)), "standin-scores")
    return master_plan.remember(_SCORES, master_plan.stage_key(spark, sf_dir), make)


@register("score_union_standin", dash_sql("SELECT * FROM sc", extra_ctes=_SCORES_CTES), ("MAE", "R2", "CV_R2", "Accuracy"))
def score_union_standin(spark, sf_dir):
    """U1 + M13 + D17: the sparse score table."""
    return dashboard.score_union(_scores(spark, sf_dir))


@register("score_cards_standin", dash_sql("""
SELECT v.Model AS Model, Title, Algorithm, Metric_Label, sc.Model IS NULL AS Scores_Missing,
       printf('%.3f', coalesce(CASE WHEN Metric_Label = 'Accuracy' THEN Accuracy ELSE R2 END, 0.0)) AS Primary_Text,
       CASE WHEN Metric_Label <> 'Accuracy' THEN printf('%.3f', coalesce(CV_R2, 0.0)) END AS CV_Text
FROM (VALUES ('Sales_Amount', 'Sales Amount Predictor', 'Random Forest Regressor', 'R²'),
             ('Profit_Margin', 'Profit Margin Predictor', 'Gradient Boosting Regressor', 'R²'),
             ('Sell_Quantity', 'Sell Qty Predictor', 'Random Forest Regressor', 'R²'),
             ('Profit_Classifier', 'Profit Classifier', 'Random Forest Classifier', 'Accuracy'))
     v(Model, Title, Algorithm, Metric_Label) LEFT JOIN sc ON sc.Model = v.Model""", extra_ctes=_SCORES_CTES))
def score_cards_standin(spark, sf_dir):
    """D14 (J7, F31): score cards with their holdout and fold figures."""
    return dashboard.score_cards(_scores(spark, sf_dir))


_TARGETS = {"Importance_Sales": "Total_Sales_Amount", "Importance_Margin": "Net_Profit_Margin",
            "Importance_Qty": "Total_Qty_Sold", "Importance_Cls": "label_cls"}
_IMP_CTES = "imp AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS Feature, " + ", ".join(
        f"round_even(coalesce(CASE WHEN isfinite(corr({f}, {y})) THEN abs(corr({f}, {y})) END, 0.0) * 1e6, 0) / 1e6 AS {n}"
        for n, y in _TARGETS.items()) + " FROM preds" for f in FEATURE_COLS) + ")"


def _importance(spark, sf_dir):
    """U2 with |correlation| (6 dp; 0 for a constant feature) over all rows as importance."""
    return models.feature_importance(_fitted(spark, sf_dir, everything=True))


@register("top_features_standin", dash_sql("""
SELECT Feature, Importance_Sales, row_number() OVER (ORDER BY Importance_Sales DESC, Feature) AS rank
FROM imp QUALIFY rank <= 12""", extra_ctes=_IMP_CTES), ("Importance_Sales",))
def top_features_standin(spark, sf_dir):
    """D15 (O3): twelve features most correlated with sales, ranked."""
    return dashboard.top_features(_importance(spark, sf_dir), 12)


@register("importance_long_standin", dash_sql("""
SELECT Feature, Model, Importance FROM (
  SELECT Feature, """ + ", ".join(f"{c} AS {label}" for c, label in IMPORTANCE_LABELS.items()) + """
  FROM imp QUALIFY row_number() OVER (ORDER BY Importance_Sales DESC, Feature) <= 10)
UNPIVOT INCLUDE NULLS (Importance FOR Model IN (""" + ", ".join(IMPORTANCE_LABELS.values()) + """))""",
    extra_ctes=_IMP_CTES), ("Importance",))
def importance_long_standin(spark, sf_dir):
    """D16 (O4, J4, P4, P14, U3): top ten features by model, long form."""
    return dashboard.importance_long(_importance(spark, sf_dir), 10)
