"""Spark ML stage: planted-signal fit, determinism, metrics, importances."""
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shelfwise.ml import models
from shelfwise.schema import FEATURE_COLS, ModelParams

SMALL = ModelParams(sales_trees=10, qty_trees=10, cls_trees=10, gbt_rounds=10)


@pytest.fixture(scope="module")
def planted(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(400):
        x = [rnd.uniform(0, 10) for _ in FEATURE_COLS]
        y = 3.0 * x[5] + 2.0 * x[7] + rnd.gauss(0, 0.3)
        rows.append(tuple(x) + (y, y / 10.0, float(y > 25)))
    cols = FEATURE_COLS + ["Total_Sales_Amount", "Net_Profit_Margin", "label_cls"]
    df = spark.createDataFrame(rows, cols)
    df = VectorAssembler(inputCols=FEATURE_COLS, outputCol="features").transform(df)
    return df.withColumn("is_test", F.rand(1) < 0.2).cache()


def test_planted_signal_beats_mean(spark, planted):
    train, test = planted.filter(~F.col("is_test")), planted.filter("is_test")
    for est, label, pred in ((models.sales_estimator(SMALL), "Total_Sales_Amount", "Predicted_Sales"),
                             (models.margin_estimator(SMALL), "Net_Profit_Margin",
                              "Predicted_Margin_Pct")):
        r2 = models.regression_metrics(est.fit(train).transform(test), label, pred).first().R2
        assert r2 > 0.8
    cls = models.class_estimator(SMALL).fit(train).transform(test)
    assert models.accuracy(cls).first().Accuracy > 0.8
    rep = {r["class"]: r for r in models.classification_report(cls).collect()}
    assert set(rep) == {"Low Profit", "High Profit", "accuracy", "macro avg", "weighted avg"}
    assert rep["accuracy"].support == test.count()


def test_fixed_seed_is_deterministic(spark, planted):
    train = planted.filter(~F.col("is_test"))
    a = models.sales_estimator(SMALL).fit(train).transform(planted).select("Predicted_Sales")
    b = models.sales_estimator(SMALL).fit(train).transform(planted).select("Predicted_Sales")
    assert a.collect() == b.collect()


def test_cv_and_importances(spark, planted):
    from shelfwise.ml import prep
    df = planted.withColumn("Region", F.lit("R")).withColumn("Category", F.lit("C")).withColumn(
        "Month", F.expr("date_add(date'2020-01-01', cast(monotonically_increasing_id() % 1000 as int))"))
    df = prep.with_folds(df, 5)
    cv = models.cv_r2(df, models.sales_estimator(SMALL, "_cv"), "Total_Sales_Amount", "_cv", 5)
    assert cv.first().CV_R2 > 0.7
    imp = models.sales_estimator(SMALL).fit(planted).featureImportances.toArray()
    assert abs(imp.sum() - 1.0) < 1e-9
    assert {FEATURE_COLS[i] for i in imp.argsort()[-2:]} == {FEATURE_COLS[5], FEATURE_COLS[7]}


def test_pipeline_fit_on_driver_tables(spark):
    from conftest import SF_SMALL
    from shelfwise.plans import master as mp
    from shelfwise.operators import dashboard
    fitted = models.fit_models(mp.staged_master(spark, SF_SMALL), SMALL)
    scores = {r.Model: r for r in models.score_table(fitted, with_cv=False).collect()}
    assert set(scores) == {"Sales_Amount", "Profit_Margin", "Sell_Quantity", "Profit_Classifier"}
    assert scores["Profit_Classifier"].MAE is None and scores["Sales_Amount"].Accuracy is None
    fi = models.feature_importance(fitted)
    for c in ("Importance_Sales", "Importance_Margin", "Importance_Qty", "Importance_Cls"):
        assert abs(fi.agg(F.sum(c)).first()[0] - 1.0) < 1e-9
    assert dashboard.top_features(fi, 12).count() == 12
    assert dashboard.importance_long(fi, 10).count() == 40
    cards = dashboard.score_cards(models.score_table(fitted, with_cv=False)).collect()
    assert len(cards) == 4 and not any(c.Scores_Missing for c in cards)
    scored = models.score(fitted)
    assert scored.filter(F.col("Predicted_Profit_Class").isNull()).count() == 0
    fitted.unpersist()


def test_group_mean_importances_of_constant_columns(spark):
    from shelfwise.ml.standin import GroupMean
    rows = [tuple(float(i % 7 + j) if j != 3 else 5.0 for j in range(len(FEATURE_COLS))) + (float(i % 7), 2.0, "K") for i in range(50)]
    df = spark.createDataFrame(rows, FEATURE_COLS + ["y", "flat", "key"])
    imp = GroupMean("y", "p", ["key"]).fit(df).featureImportances
    assert imp[3] == 0.0 and [imp[i] for i in range(len(FEATURE_COLS)) if i != 3] == [1.0] * (len(FEATURE_COLS) - 1)
    assert not GroupMean("flat", "p", ["key"]).fit(df).featureImportances.toArray().any()
    assert not GroupMean("y", "p", ["key"]).fit(df.limit(1)).featureImportances.toArray().any()


def test_standin_stages_are_written_once(spark, monkeypatch):
    """F2-F8: with the folds' windows, the fits and the joins planned anew in
    every fold and every written report the driver ran out of memory."""
    import datetime

    from shelfwise import standin_queries as standin
    targets = [c for c in (models.SALES, models.MARGIN, models.QTY) if c not in FEATURE_COLS]
    rows = [(datetime.date(1990 + i // 12, i % 12 + 1, 1), region, "SMALL", i % 5 == 0, float(i % 2))
            + tuple(float((i * (j + 3)) % 11) for j in range(len(FEATURE_COLS) + len(targets)))
            for i in range(30) for region in ("ASIA", "EUROPE")]
    frame = spark.createDataFrame(rows, ["Month", "Region", "Category", "is_test", "label_cls", *FEATURE_COLS, *targets])
    monkeypatch.setattr(standin.master_plan, "staged_model_frame", lambda *_: frame)
    monkeypatch.setattr(standin.master_plan, "stage_key", lambda *_: ("app", "own rows", "1"))
    for name in ("_FRAMES", "_SCORED", "_SCORES"):
        monkeypatch.setattr(standin, name, {}, raising=False)
    made = [standin._fitted(spark, "own rows").frame, standin._scored(spark, "own rows"), standin._scores(spark, "own rows")]
    for df, n in zip(made, (60, 60, 4)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not any(step in plan for step in ("Window", "Aggregate", "Join")), plan
        assert df.count() == n
    assert {r.fold: r["count"] for r in made[0].groupBy("fold").count().collect()} == dict.fromkeys(range(5), 12)


def test_training_frame_is_kept_on_several_executors(spark, monkeypatch):
    """One copy of one partition left all fits to one executor."""
    frame = spark.range(10).select(F.col("id").alias("Month"), F.lit("R").alias("Region"), F.lit("C").alias("Category"))
    for executors, rows, parts, copies in ((3, 100, 1, 3), (40, 100, 1, 8), (3, 2, 5, 1), (0, 100, 1, 1)):
        monkeypatch.setattr(models, "_executors", lambda _, n=executors: n, raising=False)
        kept = models.kept_for_fits(frame, ModelParams(partition_rows=rows))
        assert kept.rdd.getNumPartitions() == parts and kept.storageLevel.replication == copies
        assert [r.Month for r in kept.orderBy("Month").collect()] == list(range(10))
        kept.unpersist(blocking=True)
