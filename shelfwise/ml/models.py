"""Tree models, evaluation and scoring with Spark ML.

All four models share one split (the reference draws four identical ones)
and one cached feature frame. Training runs as Spark ML jobs: each tree
level is an aggregation over the partitions of the (small) modelling frame.
"""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import np_round
from ..schema import FEATURE_COLS, HIGH_PROFIT, KEY, LOW_PROFIT, BusinessRules, ModelParams
from ..session import path_exists, stage_folder, stage_table
from . import prep

SALES, MARGIN, QTY = "Total_Sales_Amount", "Net_Profit_Margin", "Total_Qty_Sold"


def _rf_regressor(target: str, trees: int, depth: int, p: ModelParams, pred: str):
    return RandomForestRegressor(
        featuresCol="features", labelCol=target, predictionCol=pred, numTrees=trees,
        maxDepth=depth, minInstancesPerNode=p.min_leaf, seed=p.seed, maxBins=p.max_bins,
        featureSubsetStrategy="all", maxMemoryInMB=256, cacheNodeIds=False, checkpointInterval=10)


def sales_estimator(p: ModelParams, pred: str = "Predicted_Sales"):
    """M2: random forest on the monthly sales amount."""
    return _rf_regressor(SALES, p.sales_trees, p.sales_depth, p, pred)


def margin_estimator(p: ModelParams, pred: str = "Predicted_Margin_Pct"):
    """M3: gradient-boosted trees on the net margin."""
    return GBTRegressor(
        featuresCol="features", labelCol=MARGIN, predictionCol=pred, maxIter=p.gbt_rounds,
        stepSize=p.gbt_step, maxDepth=p.gbt_depth, subsamplingRate=p.gbt_subsample,
        seed=p.seed, maxBins=p.max_bins, featureSubsetStrategy="all", maxMemoryInMB=256,
        cacheNodeIds=False, checkpointInterval=10)


def qty_estimator(p: ModelParams, pred: str = "_pred_qty"):
    """M4: random forest on the monthly quantity."""
    return _rf_regressor(QTY, p.qty_trees, p.qty_depth, p, pred)


def class_estimator(p: ModelParams, pred: str = "_pred_cls"):
    """M5: random-forest classifier of high/low profit."""
    return RandomForestClassifier(
        featuresCol="features", labelCol="label_cls", predictionCol=pred,
        rawPredictionCol="_raw_cls", probabilityCol="_prob_cls", numTrees=p.cls_trees,
        maxDepth=p.cls_depth, minInstancesPerNode=p.min_leaf, seed=p.seed, maxBins=p.max_bins,
        featureSubsetStrategy="sqrt", maxMemoryInMB=256, cacheNodeIds=False,
        checkpointInterval=10)


# ------------------------------------------------------------------ metrics
def regression_metrics(scored: DataFrame, label: str, pred: str) -> DataFrame:
    """M6-M7: MAE and R² in one aggregation (R² = 1 − SSE / (n·var_pop))."""
    err = F.col(label) - F.col(pred)
    return scored.agg(
        F.avg(F.abs(err)).alias("MAE"),
        (F.lit(1.0) - F.sum(err * err) / (F.var_pop(label) * F.count(label))).alias("R2"),
    )


def classification_report(scored: DataFrame, label: str = "label_cls",
                          pred: str = "_pred_cls",
                          names: tuple[str, str] = (LOW_PROFIT, HIGH_PROFIT)) -> DataFrame:
    """Per-class precision / recall / F1 / support, macro and
    weighted means, accuracy. Confusion counts come from one groupBy;
    zero denominators give 0 (as the reference's report does)."""
    spark = scored.sparkSession
    classes = spark.createDataFrame([(0.0, names[0]), (1.0, names[1])], "cls double, name string")
    counts = scored.agg(*[
        expr.alias(f"{k}{int(c)}")
        for c in (0.0, 1.0)
        for k, expr in (
            ("tp", F.count_if((F.col(label) == c) & (F.col(pred) == c))),
            ("support", F.count_if(F.col(label) == c)),
            ("predicted", F.count_if(F.col(pred) == c)),
        )
    ] + [F.count(F.lit(1)).alias("n")])
    per_class = classes.crossJoin(counts).select(
        F.col("name").alias("class"),
        F.when(F.col("cls") == 0, F.col("tp0")).otherwise(F.col("tp1")).alias("tp"),
        F.when(F.col("cls") == 0, F.col("support0")).otherwise(F.col("support1")).alias("support"),
        F.when(F.col("cls") == 0, F.col("predicted0")).otherwise(F.col("predicted1")).alias("pred_n"),
        "n",
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.col("tp") / F.nullif(F.col("pred_n"), F.lit(0)), zero)
    recall = F.coalesce(F.col("tp") / F.nullif(F.col("support"), F.lit(0)), zero)
    per_class = per_class.select(
        "class", precision.alias("precision"), recall.alias("recall"), "support", "n", "tp")
    per_class = per_class.withColumn(
        "f1", F.coalesce(2 * F.col("precision") * F.col("recall")
                         / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)), zero))
    means = per_class.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
        F.sum("support").alias("total"), (F.sum("tp") / F.first("n")).alias("acc"))
    def row(name, prec, rec, f1):
        return F.struct(F.lit(name).alias("class"), prec.alias("precision"),
                        rec.alias("recall"), f1.alias("f1"), F.col("total").alias("support"))
    none = F.lit(None).cast("double")
    summary = means.select(F.explode(F.array(
        row("accuracy", none, none, F.col("acc")),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", F.col("wp"), F.col("wr"), F.col("wf")),
    )).alias("r")).select("r.*")
    return per_class.select("class", "precision", "recall", "f1", "support").unionByName(summary)


def accuracy(scored: DataFrame, label: str = "label_cls", pred: str = "_pred_cls") -> DataFrame:
    return scored.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("Accuracy"))


# ------------------------------------------------------------------ fitting
@dataclass
class Fitted:
    sales: object
    margin: object
    qty: object
    cls: object
    frame: DataFrame          # encoded, split, labelled, assembled, persisted
    params: ModelParams

    def unpersist(self) -> None:
        self.frame.unpersist()


def training_frame(master: DataFrame, p: ModelParams = ModelParams()) -> DataFrame:
    """Model frame + split flag + fold + class label + feature vector, cached
    once and reused by every fit. Its partitions follow its rows (one for each
    ``partition_rows``), are dealt by the row key and sorted inside: bagging is
    seeded per partition, so the fitted models depend on the rows, the seed
    and that parameter, not on the cluster or the session's shuffle setting.
    (Every tree level aggregates one array of all its nodes per partition: on
    some thousand rows more partitions would only multiply that.)"""
    frame = prep.model_frame(master)
    frame = prep.with_split(frame, p)
    frame = prep.with_folds(frame, p.folds)
    frame = prep.with_class_label(frame)
    return kept_for_fits(stage_table(prep.assembler().transform(frame), "training-frame"), p)


#: fold fits that run side by side
PARALLEL_FITS = 8


def _executors(spark: SparkSession) -> int:
    """Executors there are now, none in local mode (the driver counts itself)."""
    return spark.sparkContext._jsc.sc().getExecutorMemoryStatus().size() - 1


def kept_for_fits(frame: DataFrame, p: ModelParams) -> DataFrame:
    """``frame`` in its partitions, cached. Where there are fewer partitions
    than executors, each is kept on several (no more than fits run at a time,
    one partition an executor): a fit runs where its rows lie, so with one
    copy of a frame of one partition all fits would wait for the cores of one
    executor. The rows of a partition are the same in every copy."""
    parts = max(1, math.ceil(frame.count() / p.partition_rows))
    copies = max(1, min(PARALLEL_FITS, _executors(frame.sparkSession) // parts))
    one = StorageLevel.MEMORY_AND_DISK
    level = StorageLevel(one.useDisk, one.useMemory, one.useOffHeap, one.deserialized, copies)
    return frame.repartition(parts, *KEY).sortWithinPartitions(*KEY).persist(level)


def fit_all(jobs: list[tuple[object, DataFrame]], parallelism: int = 4) -> list:
    """Fit independent (estimator, data) pairs concurrently. Each fit is a
    series of small Spark jobs; running several at once keeps the executors
    busy (what ``CrossValidator(parallelism=…)`` does). Results keep order
    and are the same as sequential fits (seeded)."""
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(jobs)))) as pool:
        return list(pool.map(lambda job: job[0].fit(job[1]), jobs))


ESTIMATORS = {"sales": sales_estimator, "margin": margin_estimator, "qty": qty_estimator, "cls": class_estimator}


def fit_one(frame: DataFrame, which: str, p: ModelParams = ModelParams()):
    """One of the four models, fitted on the training rows of ``training_frame``."""
    return ESTIMATORS[which](p).fit(frame.filter(~F.col("is_test")))


def fit_models(master: DataFrame, p: ModelParams = ModelParams()) -> Fitted:
    frame = training_frame(master, p)
    train = frame.filter(~F.col("is_test"))
    sales, margin, qty, cls = fit_all([(make(p), train) for make in ESTIMATORS.values()])
    return Fitted(sales=sales, margin=margin, qty=qty, cls=cls, frame=frame, params=p)


def cv_regressors(p: ModelParams) -> list[tuple[str, object, str]]:
    """The three cross-validated regressors as (name, estimator, label)."""
    return [("Profit_Margin", margin_estimator(p, "_cv"), MARGIN), ("Sales_Amount", sales_estimator(p, "_cv"), SALES),
            ("Sell_Quantity", qty_estimator(p, "_cv"), QTY)]


def cv_folds(frame: DataFrame, regressors: list[tuple[str, object, str]], k: int, store: str | None = None,
             parallelism: int = PARALLEL_FITS, pred: str = "_cv") -> DataFrame:
    """M8, fold by fold → (Model, fold, R2): each of k contiguous folds held
    out and scored by a model fitted on the others. All fits run side by side
    (tree learning on a small frame is a chain of small jobs), and each writes
    its one row to a folder of its own below ``store`` when it is done; a run
    that was stopped goes on with the fits that are missing there. ``store``
    must belong to the frame and the parameters (see ``result_folder``)."""
    spark = frame.sparkSession
    store = store or f"{stage_folder(spark)}/cv-{uuid.uuid4().hex}"
    schema = "Model string, fold int, R2 double"

    def one(job) -> str:
        name, est, label, f = job
        path = f"{store}/{name}-{f}"
        if not path_exists(spark, f"{path}/_SUCCESS"):
            model = est.copy().fit(frame.filter(F.col("fold") != f))
            held = model.transform(frame.filter(F.col("fold") == f))
            r2 = regression_metrics(held, label, pred).select(F.lit(name).alias("Model"), F.lit(f).alias("fold"), "R2")
            r2.coalesce(1).write.mode("overwrite").parquet(path)
        return path
    jobs = [(name, est, label, f) for name, est, label in regressors for f in range(k)]
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(jobs)))) as pool:
        paths = list(pool.map(one, jobs))
    return spark.read.schema(schema).parquet(*paths)


def cv_all(frame: DataFrame, regressors: list[tuple[str, object, str]], k: int, store: str | None = None,
           parallelism: int = PARALLEL_FITS, pred: str = "_cv") -> DataFrame:
    """M8: mean R² over the folds → (Model, CV_R2)."""
    return cv_folds(frame, regressors, k, store, parallelism, pred).groupBy("Model").agg(F.avg("R2").alias("CV_R2"))


def cv_r2(frame: DataFrame, estimator, label: str, pred: str, k: int) -> DataFrame:
    """M8 for one estimator that predicts into ``pred``: (CV_R2)."""
    return cv_all(frame, [(label, estimator, label)], k, pred=pred).select("CV_R2")


def score_table(fitted: Fitted, with_cv: bool | None = None, cv: DataFrame | None = None) -> DataFrame:
    """U1 + M13: one row per model, sparse columns, rounded like the
    reference (MAE 2 dp, margin MAE 4 dp, R² 4 dp, accuracy 4 dp). ``cv``:
    the regressors' (Model, CV_R2) if they are there already; else they are
    cross-validated when ``with_cv`` (or the parameters) asks for it."""
    p = fitted.params
    if cv is None and (p.cv if with_cv is None else with_cv):
        cv = cv_all(fitted.frame, cv_regressors(p), p.folds)
    test = fitted.frame.filter(F.col("is_test"))
    specs = [("Sales_Amount", fitted.sales, SALES, "Predicted_Sales", 2),
             ("Profit_Margin", fitted.margin, MARGIN, "Predicted_Margin_Pct", 4),
             ("Sell_Quantity", fitted.qty, QTY, "_pred_qty", 2)]
    out = None
    for name, model, label, pred, mae_dp in specs:
        row = regression_metrics(model.transform(test), label, pred).select(
            F.lit(name).alias("Model"), np_round("MAE", mae_dp).alias("MAE"), np_round("R2", 4).alias("R2"))
        out = row if out is None else out.unionByName(row)
    if cv is None:
        out = out.withColumn("CV_R2", F.lit(None).cast("double"))
    else:
        out = out.join(cv.select("Model", np_round("CV_R2", 4).alias("CV_R2")), "Model", "left")
    acc = accuracy(fitted.cls.transform(test)).select(
        F.lit("Profit_Classifier").alias("Model"), np_round("Accuracy", 4).alias("Accuracy"))
    return out.unionByName(acc, allowMissingColumns=True)


def feature_importance(fitted: Fitted) -> DataFrame:
    """Impurity importances of the four models, one row per feature,
    sorted by the sales model's importance (the vectors hold 23 numbers)."""
    spark: SparkSession = fitted.frame.sparkSession
    vecs = [fitted.sales.featureImportances, fitted.margin.featureImportances,
            fitted.qty.featureImportances, fitted.cls.featureImportances]
    rows = [(f, *[float(v[i]) for v in vecs]) for i, f in enumerate(FEATURE_COLS)]
    schema = T.StructType([T.StructField("Feature", T.StringType())] + [
        T.StructField(c, T.DoubleType())
        for c in ("Importance_Sales", "Importance_Margin", "Importance_Qty", "Importance_Cls")])
    return spark.createDataFrame(rows, schema).orderBy(F.desc("Importance_Sales"), "Feature")


def derive_predictions(df: DataFrame, rules: BusinessRules = BusinessRules()) -> DataFrame:
    """Rounded quantity, class label text, predicted gross profit,
    transport and net profit."""
    qty = np_round("_pred_qty", 0).cast("bigint")
    return (df.withColumn("Predicted_Sell_Qty", qty)
            .withColumn("Predicted_Profit_Class",
                        F.when(F.col("_pred_cls") == 1, F.lit(HIGH_PROFIT)).otherwise(F.lit(LOW_PROFIT)))
            .withColumn("Predicted_Gross_Profit",
                        F.col("Predicted_Sales") * (F.col("Predicted_Margin_Pct") / F.lit(100)))
            .withColumn("Predicted_Transport_Cost",
                        F.col("Avg_Unit_Cost") * F.col("Predicted_Sell_Qty")
                        * F.lit(rules.transport_rate))
            .withColumn("Predicted_Net_Profit",
                        F.col("Predicted_Gross_Profit") - F.col("Predicted_Transport_Cost")))


def score(fitted: Fitted, rules: BusinessRules = BusinessRules(), frame: DataFrame | None = None) -> DataFrame:
    """Every row of the modelling frame (or of another ``frame`` with the
    feature vector) scored by the four models (chained transforms with
    distinct output columns), then F19-F23."""
    df = fitted.frame if frame is None else frame
    for model in (fitted.sales, fitted.margin, fitted.qty, fitted.cls):
        df = model.transform(df)
    df = derive_predictions(df, rules)
    return df.drop("features", "_raw_cls", "_prob_cls", "_pred_qty", "_pred_cls", "fold")
