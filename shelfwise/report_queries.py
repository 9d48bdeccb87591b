"""Checked queries through files: the raw inputs read from CSV by contract, and
the report tables read back from what the modelling stage's writers wrote.

The inputs are the driver's views written as CSV with their columns in another
order and further ones between them; the reports are written once as CSV and
once as Parquet, each when first asked for (predictions a folder a year), and
loaded by ``load_reports``.
Each query is held to the same SQL as its twin without files.
"""

from __future__ import annotations


import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import REGISTRY, register
from .checked_queries import INV_AGG_DOUBLES, METRIC_COLS, RULES_SQL, SALES_AGG_DOUBLES, _model_frame, _top_margin
from .dashboard_queries import _MONTHS, KPI_DOUBLES, KPI_SELECT, SAMPLE_FILTERS
from .edge_queries import _LATE, _LATE_MASTER, _late
from .ml import models, prep
from .operators import dashboard, features, report, summaries
from .oracle import MODEL_CTES, RAW_CTES, ROLLUP_CTES, dash_sql, master_sql, model_sql, with_ctes
from .plans import master as master_plan
from .plans import modelling
from .schema import FEATURE_COLS, INVENTORY_RENAMES, KEY, TARGET_COLS
from .session import ensure_checkpoint_dir, stage_folder
from .sources import files, tables
from .standin_queries import _fitted, _importance, _scored, _scores

ORDER = ["Region", "Category", "Month"]


def _folder(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------- raw inputs as CSV
def _mixed(df: DataFrame) -> DataFrame:
    """The columns in another order, with columns that no contract names."""
    cols = [F.col(f"`{c}`") for c in reversed(df.columns)]
    return df.select(F.lit("S1").alias("Store ID"), *cols[:3], F.lit(0.5).alias("Another"), *cols[3:])


_RAW: dict[tuple, master_plan.RawInputs] = {}


def _raw(spark: SparkSession, sf_dir: str) -> master_plan.RawInputs:
    def make():
        folder = _folder(spark, "raw-csv")
        named = {new: old for old, new in INVENTORY_RENAMES.items()}
        for name, view in (("sales", tables.sales_view(spark, sf_dir)),
                           ("inventory", tables.inventory_view(spark, sf_dir).withColumnsRenamed(named))):
            files.write_table(_mixed(view), f"{folder}/{name}", "csv")
        raw = master_plan.raw_from_csv(spark, f"{folder}/sales", f"{folder}/inventory")
        raw.category_map = dict(tables.TESTDATA_CATEGORY_MAP)
        return raw
    return master_plan.remember(_RAW, master_plan.stage_key(spark, sf_dir), make)


@register("sales_rollup_csv", REGISTRY["sales_rollup"].sql, SALES_AGG_DOUBLES)
def sales_rollup_csv(spark, sf_dir):
    """S1 + A2: sales read from CSV by contract, rolled up."""
    return master_plan.rollups(_raw(spark, sf_dir))[0]


@register("inventory_rollup_csv", REGISTRY["inventory_rollup"].sql, INV_AGG_DOUBLES)
def inventory_rollup_csv(spark, sf_dir):
    """S2 + P1 + A1: inventory read from CSV by contract, remapped, rolled up."""
    return master_plan.rollups(_raw(spark, sf_dir))[1]


@register("rejected_cells_csv", with_ctes(RAW_CTES, ROLLUP_CTES, select="""
SELECT 'Unit_Cost' AS "column", count(*) AS cells, min('x' || strftime(Sale_Date, '%Y-%m-%d')) AS example
FROM sales WHERE Quantity_Sold = 7 HAVING count(*) > 0"""))
def rejected_cells_csv(spark, sf_dir):
    """Cells that their contract type cannot take, counted by column."""
    folder = _folder(spark, "bad-csv")
    bad = F.when(F.col("Quantity_Sold") == 7, F.concat(F.lit("x"), F.date_format("Sale_Date", "yyyy-MM-dd"))).otherwise(
        F.col("Unit_Cost").cast("string"))
    files.write_table(tables.sales_view(spark, sf_dir).withColumn("Unit_Cost", bad), folder, "csv")
    return files.rejected_cells(spark, folder, files.SALES_SCHEMA)


# ----------------------------------------------------------- master in order
@register("master_in_order", master_sql(
    "SELECT Region, Category, Month, row_number() OVER (ORDER BY Region, Category, Month) - 1 AS position FROM master"))
def master_in_order(spark, sf_dir):
    """Each row's place in the written master table, file after file."""
    folder = _folder(spark, "master")
    path = master_plan.write_master(master_plan.staged_master(spark, sf_dir), folder)
    place = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    back = spark.read.parquet(path).select(*ORDER, place.alias("place"))
    sizes = back.groupBy("place.file").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.alias("a").join(sizes.alias("b"), F.col("b.file") < F.col("a.file"), "left").groupBy("a.file").agg(
        F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))                     # one row a file
    return back.join(before, F.col("place.file") == F.col("file")).select(
        *ORDER, (F.col("before") + F.col("place.row")).cast("bigint").alias("position"))


# ------------------------------------------------------------ written reports
_REPORTS: dict[str, dict[tuple, dict[str, DataFrame]]] = {"csv": {}, "parquet": {}}


def _reports(spark: SparkSession, sf_dir: str, fmt: str) -> dict[str, DataFrame]:
    """The six report tables of the stand-in models, written as ``fmt`` and loaded."""
    def make():
        scored = _scored(spark, sf_dir).drop("Year", "MonthNum", "MonthLabel")
        scored = scored.withColumns({"Year": F.year("Month").cast("bigint"), "MonthNum": F.month("Month").cast("bigint")})
        out = {"predictions": modelling.predictions_by_year(scored), "monthly_summary": summaries.monthly_summary(scored),
               "yearly_summary": summaries.yearly_summary(scored),
               "improvement_report": report.improvement_report(_model_frame(spark, sf_dir), top=_top_margin(spark, sf_dir)),
               "feature_importance": _importance(spark, sf_dir), "model_scores": _scores(spark, sf_dir)}
        folder = _folder(spark, f"reports-{fmt}")
        for name, df in out.items():
            files.write_table(df, f"{folder}/{name}", fmt, partition_by=["Year"] if name == "predictions" else None)
        return files.load_reports(spark, folder, fmt)
    return master_plan.remember(_REPORTS[fmt], master_plan.stage_key(spark, sf_dir), make)


_WHERE = "Region IN ('AMERICA', 'ASIA') AND Category IN ('ECONOMY', 'SMALL', 'STANDARD')"

for _fmt in ("csv", "parquet"):
    def _trend(spark, sf_dir, fmt=_fmt):
        return dashboard.monthly_trend(dashboard.apply_filters(_reports(spark, sf_dir, fmt)["monthly_summary"], SAMPLE_FILTERS))

    def _report(spark, sf_dir, fmt=_fmt):
        return dashboard.apply_filters(_reports(spark, sf_dir, fmt)["improvement_report"], SAMPLE_FILTERS.without_year())

    def _kpis(spark, sf_dir, fmt=_fmt):
        return dashboard.kpi_row(dashboard.apply_filters(_reports(spark, sf_dir, fmt)["predictions"], SAMPLE_FILTERS))
    _trend.__doc__ = f"S3-S6, P9 + D2: the filtered monthly trend from the {_fmt} reports."
    _report.__doc__ = f"S5, P10: the improvement report of the filtered segments, from the {_fmt} reports."
    _kpis.__doc__ = f"S8, P7-P8 + D1: tiles from one year's folder of the {_fmt} predictions."
    register(f"monthly_trend_{_fmt}", dash_sql(f"""
SELECT MonthNum, @dsum(Monthly_Sales) AS Revenue, @dsum(Monthly_Profit) AS Profit,
       CASE WHEN MonthNum BETWEEN 1 AND 12 THEN {_MONTHS}[MonthNum]
            ELSE CAST(MonthNum AS VARCHAR) END AS Month
FROM monthly WHERE Year = 1997 AND {_WHERE} GROUP BY MonthNum"""), ("Revenue", "Profit"))(_trend)
    register(f"improvement_report_{_fmt}", f"SELECT * FROM ({RULES_SQL}) r WHERE {_WHERE}", METRIC_COLS)(_report)
    register(f"kpis_of_year_{_fmt}", dash_sql(KPI_SELECT.format(where=f"WHERE Year = 1997 AND {_WHERE}")), KPI_DOUBLES)(_kpis)


@register("output_rows", dash_sql("""
SELECT 'predictions' AS output, count(*) AS rows FROM preds
UNION ALL SELECT 'monthly_summary', count(*) FROM monthly
UNION ALL SELECT 'yearly_summary', count(*) FROM (SELECT DISTINCT Year, Region, Category FROM preds)
UNION ALL SELECT 'improvement_report', count(*) FROM (SELECT DISTINCT Region, Category FROM preds)
UNION ALL SELECT 'feature_importance', """ + str(len(FEATURE_COLS)) + """
UNION ALL SELECT 'model_scores', 4"""))
def output_rows(spark, sf_dir):
    """Rows of each written report, counted after reading it back."""
    out = None
    for name, df in _reports(spark, sf_dir, "parquet").items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("output"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


# -------------------------------------------------------------- filled rows
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLS + TARGET_COLS)


def _filled_sql() -> str:
    filled = ", ".join(f"coalesce(CAST(e.{c} AS DOUBLE), m.{c}) AS {c}" for c in FEATURE_COLS)
    medians = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in FEATURE_COLS)
    return with_ctes(RAW_CTES, ROLLUP_CTES, _LATE, _LATE_MASTER, MODEL_CTES.replace("{not_null}", _COMPLETE),
                     f"med AS (SELECT {medians} FROM mf_split WHERE NOT is_test)",
                     select=f"SELECT e.Month, e.Region, e.Category, {filled} FROM (SELECT * FROM enc WHERE NOT ({_COMPLETE})) e, med m")


@register("filled_rows_late", _filled_sql(), tuple(FEATURE_COLS))
def filled_rows_late(spark, sf_dir):
    """The rows that P5 drops for missing inventory, filled with the
    training rows' medians for scoring."""
    encoded = prep.encode_labels(features.build_master(*_late(spark, sf_dir)))
    complete = encoded.na.drop(subset=FEATURE_COLS + TARGET_COLS)
    medians = prep.feature_medians(prep.with_split(complete).filter(~F.col("is_test")))
    missing = F.lit(False)
    for c in FEATURE_COLS + TARGET_COLS:
        missing = missing | F.col(c).isNull()
    return prep.fill_features(encoded.filter(missing), medians).select(*KEY, *FEATURE_COLS)
