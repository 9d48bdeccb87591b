"""File sources and sinks: CSV contract inputs and the two-stage plan."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise.plans import master as mp
from shelfwise.plans import modelling
from shelfwise.schema import INVENTORY_RENAMES, ModelParams
from shelfwise.sources import files, tables


def _rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_csv_inputs_roundtrip(spark, tmp_path):
    sales = tables.sales_view(spark, SF_SMALL)
    inv = tables.inventory_view(spark, SF_SMALL)
    sp, ip = str(tmp_path / "sales"), str(tmp_path / "inventory")
    sales.write.option("header", True).csv(sp)
    back = {v: k for k, v in INVENTORY_RENAMES.items()}
    inv.withColumnsRenamed(back).write.option("header", True).csv(ip)
    raw_csv = mp.raw_from_csv(spark, sp, ip)
    raw_csv.category_map = dict(tables.TESTDATA_CATEGORY_MAP)
    a = mp.master(raw_csv).select("Month", "Region", "Category", "Num_Transactions",
                                  "Units_Ordered", "Weather_Mode")
    b = mp.master_from_tables(spark, SF_SMALL).select(a.columns)
    assert _rows(a) == _rows(b)


def test_missing_input_hint(spark, tmp_path):
    with pytest.raises(files.MissingInputError, match="Provide the sales"):
        files.read_sales_csv(spark, str(tmp_path / "nope.csv")).count()


def test_two_stage_plan_writes_and_counts(spark, tmp_path):
    out = str(tmp_path / "out")
    mp.write_master(mp.staged_master(spark, SF_SMALL), out)
    counts = {r.output: r.rows for r in modelling.run(
        spark, out, ModelParams(sales_trees=5, qty_trees=5, cls_trees=5, gbt_rounds=5,
                                cv=False)).collect()}
    assert set(counts) == set(files.REPORT_NAMES)
    assert counts["feature_importance"] == 23 and counts["model_scores"] == 4
    reports = files.load_reports(spark, out)
    assert reports["predictions"].count() == counts["predictions"]
    assert dict(reports["predictions"].dtypes)["Month"] == "date"
    assert counts["improvement_report"] == reports["predictions"].select(
        "Region", "Category").distinct().count()


def test_reports_are_written_in_the_format_asked_for(spark, monkeypatch):
    """Each query wrote its six report tables in both formats."""
    import datetime

    from shelfwise import report_queries as rq
    rows, written = spark.createDataFrame([(datetime.date(1997, 1, 1), 1)], "Month date, n int"), []
    for name in ("_scored", "_importance", "_scores", "_model_frame", "_top_margin"):
        monkeypatch.setattr(rq, name, lambda *_: rows)
    for module, name in ((rq.summaries, "monthly_summary"), (rq.summaries, "yearly_summary"), (rq.report, "improvement_report")):
        monkeypatch.setattr(module, name, lambda df, **_: df)
    monkeypatch.setattr(rq.master_plan, "stage_key", lambda *_: ("app", "own rows", "1"))
    monkeypatch.setattr(rq.files, "write_table", lambda df, path, fmt="parquet", **_: written.append((path.split("/")[-1], fmt)))
    monkeypatch.setattr(rq.files, "load_reports", lambda spark, folder, fmt: fmt)
    monkeypatch.setattr(rq, "_REPORTS", {"csv": {}, "parquet": {}})
    for fmt in ("csv", "parquet"):
        written.clear()
        assert rq._reports(spark, "own rows", fmt) == rq._reports(spark, "own rows", fmt) == fmt
        assert sorted(written) == sorted((name, fmt) for name in rq.files.REPORT_NAMES)      # once, and no other format
