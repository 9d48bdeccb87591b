"""Saved models, resumable folds, reports by year, output in order, filled rows."""
import os

import pytest
from pyspark.sql import functions as F

from shelfwise import session
from shelfwise.ml import models, prep
from shelfwise.ml.standin import GroupMean
from shelfwise.operators import dashboard
from shelfwise.plans import master as mp
from shelfwise.plans import modelling, scoring
from shelfwise.schema import FEATURE_COLS, KEY, Filters, ModelParams
from shelfwise.sources import files

from conftest import SF_SMALL

SMALL = ModelParams(sales_trees=4, qty_trees=4, cls_trees=4, gbt_rounds=4, sales_depth=4, qty_depth=4, cls_depth=4, cv=False)


@pytest.fixture(scope="module")
def out(spark, tmp_path_factory):
    """Both stages' outputs in a folder."""
    folder = str(tmp_path_factory.mktemp("out"))
    mp.write_master(mp.staged_master(spark, SF_SMALL), folder)
    modelling.run(spark, folder, SMALL)
    return folder


def test_another_session_scores_alike(spark, out):
    preds = files.read_table(spark, f"{out}/predictions")
    cols = [c for c in preds.columns if c != "Year"]
    want = sorted(map(str, preds.select(*cols).collect()))
    other = spark.newSession()
    again = scoring.score_master(scoring.load(other, f"{out}/models"), files.read_table(other, f"{out}/master_dataset"))
    assert sorted(map(str, modelling.select_prediction_columns(again).select(*cols).collect())) == want


def test_scoring_drops_or_fills_what_lacks_a_feature(spark, out):
    master = files.read_table(spark, f"{out}/master_dataset")
    gap = (F.col("Region") == "ASIA") & (F.month("Month") == 3)
    master = master.withColumn("Inventory_Level", F.when(~gap, F.col("Inventory_Level")))
    whole = prep.encode_labels(master)
    n, complete = master.count(), whole.na.drop(subset=FEATURE_COLS).count()
    saved = scoring.load(spark, f"{out}/models")
    assert 0 < complete < n and whole.filter(gap).count() > 0
    scored = scoring.score_master(saved, master)
    assert scored.count() == complete and scored.filter(gap).isEmpty()
    filled = scoring.score_master(saved, master, fill=True)
    assert filled.count() == n and filled.filter("Predicted_Sales IS NULL OR Predicted_Net_Profit IS NULL").isEmpty()
    assert filled.filter(gap).select("Inventory_Level").distinct().count() == 1


def test_unseen_labels_get_a_code_of_their_own(spark, out):
    master = files.read_table(spark, f"{out}/master_dataset").limit(5).withColumn("Region", F.lit("ATLANTIS"))
    codes = prep.encode_labels(master, scoring.load(spark, f"{out}/models").labels).select("Region_enc").distinct().collect()
    assert [c.Region_enc for c in codes] == [5.0]                     # after the five regions


def test_missing_models_say_which_stage_makes_them(spark, tmp_path):
    with pytest.raises(files.MissingInputError, match="modelling stage"):
        scoring.load(spark, str(tmp_path))


def test_predictions_by_year_prune_and_replace(spark, out):
    years = sorted(d for d in os.listdir(f"{out}/predictions") if d.startswith("Year="))
    assert len(years) > 1
    preds = files.load_reports(spark, out)["predictions"]
    one = dashboard.apply_filters(preds, Filters(year=int(years[0][5:])))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan and "Year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {os.path.dirname(f).rsplit("/", 1)[1] for f in one.inputFiles()} >= {years[0]}
    # writing one year anew leaves the others
    before = {y: sorted(os.listdir(f"{out}/predictions/{y}")) for y in years}
    kept = preds.drop("MonthNum", "MonthLabel").filter(F.col("Year") == int(years[0][5:])).limit(3)
    kept = session.stage_table(kept, "few")
    files.write_table(kept, f"{out}/predictions", partition_by=["Year"])
    after = {y: sorted(os.listdir(f"{out}/predictions/{y}")) for y in years}
    assert after[years[0]] != before[years[0]] and all(after[y] == before[y] for y in years[1:])
    assert spark.read.parquet(f"{out}/predictions/{years[0]}").count() == 3


def test_master_is_in_order_as_a_whole(spark, tmp_path):
    order = ["Region", "Category", "Month"]
    master = mp.staged_master(spark, SF_SMALL).repartition(7)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    path = mp.write_master(master, str(tmp_path))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    parts = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    assert len(parts) > 3
    rows = [[tuple(r) for r in spark.read.parquet(f"{path}/{f}").select(*order).collect()] for f in parts]
    rows = [r for r in rows if r]
    assert all(r == sorted(r) for r in rows)
    assert all(a[-1] < b[0] for a, b in zip(rows, rows[1:]))          # successive files, successive ranges


def test_folds_go_on_where_a_run_stopped(spark, tmp_path):
    frame = prep.with_folds(mp.staged_model_frame(spark, SF_SMALL), 5)

    class Stops(GroupMean):
        fits = 0
        most = 100

        def _fit(self, dataset):
            if Stops.fits >= Stops.most:
                raise RuntimeError("stopped")
            Stops.fits += 1
            return super()._fit(dataset)
    jobs = [(label, Stops(label, "_cv", ["Category"]), label) for label in (models.SALES, models.MARGIN)]
    store = str(tmp_path / "cv")
    Stops.most = 4
    with pytest.raises(RuntimeError, match="stopped"):
        models.cv_folds(frame, jobs, 5, store, parallelism=1)
    assert Stops.fits == 4 and len(os.listdir(store)) == 4
    Stops.most = 100
    got = models.cv_folds(frame, jobs, 5, store, parallelism=2)
    assert Stops.fits == 10 and got.count() == 10                      # the six that were missing
    whole = {(r.Model, r.fold): r.R2 for r in models.cv_folds(frame, jobs, 5, str(tmp_path / "new")).collect()}
    assert {(r.Model, r.fold): r.R2 for r in got.collect()} == pytest.approx(whole, abs=1e-9)


def test_result_folders_follow_the_state(spark):
    a, b = (session.result_folder(spark, "cv", s, SMALL) for s in ("one", "two"))
    assert a != b and a == session.result_folder(spark, "cv", "one", SMALL) and not session.path_exists(spark, a)


def test_training_partitions_follow_the_rows(spark):
    """One task for some thousand rows, more for more, and the same forest whatever the session's setting."""
    master = mp.staged_master(spark, SF_SMALL)
    p = ModelParams(sales_trees=5, partition_rows=500)
    found = []
    for parts in ("3", "17"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        frame = models.training_frame(master, p)
        n = frame.count()
        assert frame.rdd.getNumPartitions() == -(-n // 500) > 2
        found.append(sorted(tuple(r) for r in models.fit_one(frame, "sales", p).transform(frame).select(*KEY, "Predicted_Sales").collect()))
        frame.unpersist()
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert found[0] == found[1]


def test_fill_uses_the_training_medians(spark):
    rows = [tuple([float(i)] * len(FEATURE_COLS)) for i in (1, 2, 3, 10)] + [tuple([None] * len(FEATURE_COLS))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in FEATURE_COLS))
    got = prep.fill_features(df, prep.feature_medians(df)).collect()
    assert sorted(r[FEATURE_COLS[3]] for r in got) == [1.0, 2.0, 2.5, 3.0, 10.0]


def test_profile_of_parts_counts_lines_without_a_key(spark):
    from shelfwise.operators import quality, rollups
    sales = spark.createDataFrame([("2024-01-02", None, "A"), ("2024-01-03", "R", "B"), (None, "R", "B")], "Sale_Date string, Region string, Product_Category string")
    sales = sales.withColumn("Sale_Date", F.to_date("Sale_Date"))
    s_types, i_types = rollups._contract_types()
    for name, kind in s_types.items():
        if name[2:] not in sales.columns:
            sales = sales.withColumn(name[2:], F.lit(None).cast(kind))
    inv = spark.createDataFrame([], "Date date, Region string, Category string")
    for name, kind in i_types.items():
        if name[2:] not in inv.columns:
            inv = inv.withColumn(name[2:], F.lit(None).cast(kind))
    parts = rollups.raw_rollup_parts(sales, inv)
    r = quality.profile_of_parts(parts).first()
    assert (r.sales_rows, r.sales_categories, r.sales_regions, r.inventory_rows, r.inventory_regions) == (3, "A,B", "R", 0, "")
    assert rollups.split_rollup(rollups.combined_rollup_finish(parts))[0].count() == 1
