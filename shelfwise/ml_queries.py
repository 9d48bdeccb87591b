"""Registered model queries (rows-only: tree training is not SQL; the same
outputs on a closed-form scorer are oracle-checked in ``standin_queries``).

Every query reads the whole driver tables and fits with the reference
configuration (``ModelParams()``: 200 trees or rounds, five folds). The
training frame, each fitted model and the cross-validation are kept per
session, folder and state of its tables (``plans.master.stage_key``), so the
queries of one check run share them and replaced tables are fitted anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import register
from .ml import models
from .operators import dashboard, summaries
from .plans import master as master_plan
from .plans import modelling
from .schema import ModelParams
from .session import result_folder, stage_table

PARAMS = ModelParams()

_FRAMES: dict[tuple, DataFrame] = {}
_MODELS: dict[str, dict[tuple, object]] = {name: {} for name in models.ESTIMATORS}


def _frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master_plan.remember(_FRAMES, master_plan.stage_key(spark, sf_dir), lambda: models.training_frame(
        master_plan.staged_master(spark, sf_dir), PARAMS))


def _model(spark: SparkSession, sf_dir: str, which: str):
    return master_plan.remember(_MODELS[which], master_plan.stage_key(spark, sf_dir),
                                lambda: models.fit_one(_frame(spark, sf_dir), which, PARAMS))


def _fitted(spark: SparkSession, sf_dir: str) -> models.Fitted:
    """All four models; those not fitted yet are fitted side by side."""
    key = master_plan.stage_key(spark, sf_dir)
    frame = _frame(spark, sf_dir)
    missing = [m for m in models.ESTIMATORS if key not in _MODELS[m]]
    train = frame.filter(~F.col("is_test"))
    done = models.fit_all([(models.ESTIMATORS[m](PARAMS), train) for m in missing]) if missing else []
    for m, fitted in zip(missing, done):
        master_plan.remember(_MODELS[m], key, lambda fitted=fitted: fitted)
    return models.Fitted(**{m: _MODELS[m][key] for m in models.ESTIMATORS}, frame=frame, params=PARAMS)


def _holdout(spark, sf_dir, which: str, label: str, pred: str, name: str) -> DataFrame:
    test = _frame(spark, sf_dir).filter(F.col("is_test"))
    return models.regression_metrics(_model(spark, sf_dir, which).transform(test), label, pred).select(
        F.lit(name).alias("Model"), "MAE", "R2")


@register("model_sales")
def model_sales(spark, sf_dir):
    """M2 + M6-M7: sales forest, holdout MAE and R²."""
    return _holdout(spark, sf_dir, "sales", models.SALES, "Predicted_Sales", "Sales_Amount")


@register("model_margin")
def model_margin(spark, sf_dir):
    """M3 + M6-M7: margin boosting, holdout MAE and R²."""
    return _holdout(spark, sf_dir, "margin", models.MARGIN, "Predicted_Margin_Pct", "Profit_Margin")


@register("model_quantity")
def model_quantity(spark, sf_dir):
    """M4 + M6-M7: quantity forest, holdout MAE and R²."""
    return _holdout(spark, sf_dir, "qty", models.QTY, "_pred_qty", "Sell_Quantity")


@register("model_class")
def model_class(spark, sf_dir):
    """M5 + M9-M10: profit classifier, holdout classification report."""
    test = _frame(spark, sf_dir).filter(F.col("is_test"))
    return models.classification_report(_model(spark, sf_dir, "cls").transform(test))


_CV: dict[tuple, DataFrame] = {}


def _cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validated R² per regressor, staged. Each fold's result lies in a
    folder named by the tables' state and the parameters: a run that was
    stopped, in this session or another, does only the fits that are missing."""
    def make():
        store = result_folder(spark, "cv", master_plan.stage_key(spark, sf_dir)[1:], PARAMS, spark.version)
        return stage_table(models.cv_all(_frame(spark, sf_dir), models.cv_regressors(PARAMS), PARAMS.folds, store), "cv_scores")
    return master_plan.remember(_CV, master_plan.stage_key(spark, sf_dir), make)


@register("cv_scores")
def cv_scores(spark, sf_dir):
    """M8: 5-fold contiguous cross-validated R² of the three regressors."""
    return _cv(spark, sf_dir)


@register("model_scores")
def model_scores(spark, sf_dir):
    """The full score table — holdout MAE and R², CV R² (4 dp),
    classifier accuracy — one row per model, sparse columns."""
    return models.score_table(_fitted(spark, sf_dir), cv=_cv(spark, sf_dir))


@register("feature_importance")
def feature_importance(spark, sf_dir):
    """The four models' importances per feature."""
    return models.feature_importance(_fitted(spark, sf_dir))


_SCORED: dict[tuple, DataFrame] = {}


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every modelling row scored by the four models, written once."""
    return master_plan.remember(_SCORED, master_plan.stage_key(spark, sf_dir), lambda: stage_table(
        models.score(_fitted(spark, sf_dir)), "scored"))


@register("scored_frame")
def scored_frame(spark, sf_dir):
    """M11 + F19-F23: the prediction output table."""
    return modelling.select_prediction_columns(_scored(spark, sf_dir))


@register("monthly_summary_scored")
def monthly_summary_scored(spark, sf_dir):
    """A3: monthly summary including predicted sales and profit."""
    return summaries.monthly_summary(_scored(spark, sf_dir))


@register("score_union")
def score_union(spark, sf_dir):
    """Sparse model score table."""
    return dashboard.score_union(model_scores(spark, sf_dir))


@register("score_cards")
def score_cards(spark, sf_dir):
    """Model score cards from the score table."""
    return dashboard.score_cards(model_scores(spark, sf_dir))


@register("top_features")
def top_features(spark, sf_dir):
    """Twelve most important features of the sales model."""
    return dashboard.top_features(models.feature_importance(_fitted(spark, sf_dir)), 12)


@register("importance_long")
def importance_long(spark, sf_dir):
    """Top-10 features × four models, long form."""
    return dashboard.importance_long(models.feature_importance(_fitted(spark, sf_dir)), 10)
