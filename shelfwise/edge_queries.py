"""Checked queries whose input mapping reaches the paths that the plain views
never take at the given scales: sales months without inventory (J1's missing
side, A14, P5, F11-F13, F16) and thresholds under which every report rule
fires (R1-R8). Both run over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import register
from .checked_queries import _METRICS_SELECT, _RULES, JOIN_COLS, MASTER_COLS, MASTER_DOUBLES, METRIC_COLS, _lit
from .checked_queries import INV_AGG_DOUBLES, SALES_AGG_DOUBLES, _model_frame, _rollups, _top_margin
from .ml import prep
from .operators import features, report
from .operators.quality import join_null_check
from .oracle import MASTER_CTES, MODEL_CTES, RAW_CTES, ROLLUP_CTES, model_sql, with_ctes
from .schema import FEATURE_COLS, KEY, MSG_ON_TRACK, TARGET_COLS, Thresholds

MONTHS_LATE = 7              # inventory months are moved on by so many

_LATE = f"""
inv_late AS (SELECT * REPLACE (CAST(Month + INTERVAL {MONTHS_LATE} MONTH AS DATE) AS Month) FROM inv_agg)"""
_LATE_MASTER = MASTER_CTES.replace("LEFT JOIN inv_agg i", "LEFT JOIN inv_late i")


def _late_sql(select: str, *more: str) -> str:
    return with_ctes(RAW_CTES, ROLLUP_CTES, _LATE, _LATE_MASTER, *more, select=select)


def _late(spark, sf_dir):
    sales_agg, inv_agg = _rollups(spark, sf_dir)
    return sales_agg, inv_agg.withColumn("Month", F.add_months("Month", MONTHS_LATE))


@register("join_master_late", _late_sql(f"SELECT {JOIN_COLS} FROM joined"), SALES_AGG_DOUBLES + INV_AGG_DOUBLES)
def join_master_late(spark, sf_dir):
    """J1 with sales months that find no inventory."""
    return features.join_master(*_late(spark, sf_dir))


@register("unmatched_inventory_late", _late_sql(
    "SELECT count(*) AS joined_rows, count(*) FILTER (WHERE Inventory_Level IS NULL) AS unmatched_rows FROM joined"))
def unmatched_inventory_late(spark, sf_dir):
    """A14 with unmatched rows."""
    return join_null_check(features.join_master(*_late(spark, sf_dir)))


@register("master_late", _late_sql(f"SELECT {MASTER_COLS} FROM master"), MASTER_DOUBLES)
def master_late(spark, sf_dir):
    """F2-F16, W1-W2 where the inventory is missing."""
    return features.build_master(*_late(spark, sf_dir))


@register("model_frame_late", _late_sql(
    "SELECT Month, Region, Category, Region_enc, Weather_Mode_enc, Seasonality_enc FROM mf",
    MODEL_CTES.replace("{not_null}", " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLS + TARGET_COLS))))
def model_frame_late(spark, sf_dir):
    """Rows without inventory are dropped after encoding (a missing label is a code of its own)."""
    return prep.model_frame(features.build_master(*_late(spark, sf_dir))).select(
        *KEY, "Region_enc", "Weather_Mode_enc", "Seasonality_enc")


EVERY_RULE = Thresholds(margin_gap_pp=5.5, understock_days=38.0, fulfilment_pct=30.0, online_pct=39.5)
_LIMITS = {"MARGIN_GAP": "> 5.5", "UNDERSTOCK": "< 38.0", "LOW_FULFILMENT": "< 30.0", "LOW_ONLINE": "< 39.5"}


def _fired(condition: str, code: str) -> str:
    return f"{condition.split(' ')[0]} {_LIMITS[code]}" if code in _LIMITS else condition


_CODES = "concat_ws(',', " + ", ".join(f"CASE WHEN {_fired(c, k)} THEN '{k}' END" for c, k, _ in _RULES) + ")"
_TEXTS = "concat_ws(' | ', " + ", ".join(f"CASE WHEN {_fired(c, k)} THEN {m} END" for c, k, m in _RULES) + ")"


@register("improvement_rules_all", model_sql(f"""
SELECT *, CASE WHEN {_CODES} = '' THEN 'ON_TRACK' ELSE {_CODES} END AS Rule_Codes,
          CASE WHEN {_TEXTS} = '' THEN {_lit(MSG_ON_TRACK)} ELSE {_TEXTS} END AS Recommendations
FROM ({_METRICS_SELECT}) metrics"""), METRIC_COLS)
def improvement_rules_all(spark, sf_dir):
    """R1-R8 under thresholds that every rule crosses somewhere."""
    return report.improvement_report(_model_frame(spark, sf_dir), EVERY_RULE, _top_margin(spark, sf_dir))
