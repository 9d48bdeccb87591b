"""Stage 2: master table → models, scored rows and the six report tables.

``run`` keeps stage boundaries as written tables: the master table is read
back from the output folder (a stable, lineage-free input that survives
lost executors), and the report tables are written with executor-parallel
writers and counted back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ml import models
from ..operators import report, summaries
from ..schema import PREDICTION_COLS, BusinessRules, ModelParams, Thresholds
from ..session import result_folder, stage_table, tables_stamp
from ..sources import files
from . import scoring


@dataclass
class Outputs:
    fitted: models.Fitted
    scored: DataFrame
    predictions: DataFrame
    monthly_summary: DataFrame
    yearly_summary: DataFrame
    improvement_report: DataFrame
    feature_importance: DataFrame
    model_scores: DataFrame
    classification_report: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in files.REPORT_NAMES}


def select_prediction_columns(scored: DataFrame) -> DataFrame:
    """The prediction output columns that exist (drift-tolerant)."""
    return scored.select(*[c for c in PREDICTION_COLS if c in scored.columns])


def predictions_by_year(scored: DataFrame) -> DataFrame:
    """P6 with the Year that the predictions' folders go by."""
    return select_prediction_columns(scored).withColumn("Year", F.year("Month").cast("bigint"))


def build(master: DataFrame, params: ModelParams = ModelParams(),
          thresholds: Thresholds = Thresholds(), rules: BusinessRules = BusinessRules(), state: str | None = None) -> Outputs:
    """``state``: what the master table was read from; the folds' results are
    kept under it, so a stopped run goes on with the fits that are missing."""
    fitted = models.fit_models(master, params)
    scored = stage_table(models.score(fitted, rules), "scored")                  # read by three tables
    cv = None
    if params.cv:
        store = result_folder(master.sparkSession, "cv", state, params, master.sparkSession.version) if state else None
        cv = models.cv_all(fitted.frame, models.cv_regressors(params), params.folds, store)
    test = fitted.frame.filter(F.col("is_test"))
    return Outputs(
        fitted=fitted,
        scored=scored,
        predictions=predictions_by_year(scored),
        monthly_summary=summaries.monthly_summary(scored),
        yearly_summary=summaries.yearly_summary(scored),
        improvement_report=report.improvement_report(fitted.frame, thresholds),
        feature_importance=models.feature_importance(fitted),
        model_scores=models.score_table(fitted, with_cv=False, cv=cv),
        classification_report=models.classification_report(fitted.cls.transform(test)),
    )


def run(spark: SparkSession, out_dir: str, params: ModelParams = ModelParams(),
        fmt: str = "parquet") -> DataFrame:
    """Read the master table written by stage 1, build and write the six
    tables, and return their read-back row counts (S3, S8-S11)."""
    master = files.read_table(spark, f"{out_dir}/master_dataset", fmt,
                              "Build the master dataset first.")
    out = build(master, params, state=tables_stamp(spark, out_dir, ("master_dataset",), suffix=""))
    scoring.save(out.fitted, master, f"{out_dir}/models")
    paths = {}
    for name, df in out.tables().items():
        small = name in ("feature_importance", "model_scores", "improvement_report")
        by = ["Year"] if name == "predictions" else None
        paths[name] = files.write_table(df, f"{out_dir}/{name}", fmt, partition_by=by, single_file=small)
    out.fitted.unpersist()
    return files.output_counts(spark, paths, fmt)
