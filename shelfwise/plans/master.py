"""Stage 1: raw inputs → master table (the dataset-building stage)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.features import build_master
from ..operators.rollups import (combined_rollup_finish, combined_rollup_parts, inventory_rollup,
                                 raw_rollup_parts, sales_rollup, split_rollup)
from ..schema import BusinessRules
from ..session import ensure_checkpoint_dir, stage_table, tables_stamp
from ..sources import files, tables


@dataclass
class RawInputs:
    sales: DataFrame
    inventory: DataFrame
    category_map: dict[str, str] | None = None   # None → the contract default


def raw_from_tables(spark: SparkSession, sf_dir: str) -> RawInputs:
    """Raw inputs derived from the star-schema tables in ``sf_dir``."""
    return RawInputs(tables.sales_view(spark, sf_dir), tables.inventory_view(spark, sf_dir),
                     dict(tables.TESTDATA_CATEGORY_MAP))


def raw_from_csv(spark: SparkSession, sales_path: str, inventory_path: str) -> RawInputs:
    """Raw inputs from the two contract CSV files."""
    return RawInputs(files.read_sales_csv(spark, sales_path),
                     files.read_inventory_csv(spark, inventory_path))


def rollups(raw: RawInputs) -> tuple[DataFrame, DataFrame]:
    """A2 / A1 as two single aggregations (lazy)."""
    return sales_rollup(raw.sales), inventory_rollup(raw.inventory, raw.category_map)


def master(raw: RawInputs, rules: BusinessRules = BusinessRules()) -> DataFrame:
    """Master table from the two raw inputs: one hash aggregation of both
    (``raw_rollup_parts``), written as the line-level stage table,
    then totals, modes, J1 and the derived features on the small table."""
    ensure_checkpoint_dir(raw.sales.sparkSession)
    parts = stage_table(raw_rollup_parts(raw.sales, raw.inventory, raw.category_map),
                        "rollup_parts")
    sales_agg, inv_agg = split_rollup(combined_rollup_finish(parts))
    return build_master(sales_agg, inv_agg, rules)


def stage_key(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """What a remembered stage belongs to: the session, the folder, and the
    state of the tables in it (files, sizes, times), so replaced tables are
    computed anew in the same session."""
    return spark.sparkContext.applicationId, sf_dir, tables_stamp(spark, sf_dir, tables.SOURCES)


def remember(store: dict, key: tuple[str, str, str], make):
    """The stored value of ``key``, made if absent; values of earlier states of the folder go."""
    if key not in store:
        for old in [k for k in store if k[:2] == key[:2]]:
            del store[old]
        store[key] = make()
    return store[key]


_PARTS: dict[tuple[str, str, str], DataFrame] = {}
_ROLLUPS: dict[tuple[str, str, str], DataFrame] = {}


def staged_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line-level stage's output: additive parts of both roll-ups and the
    number of lines behind each, from the one pass over the line table."""
    def make():
        ensure_checkpoint_dir(spark)
        return stage_table(combined_rollup_parts(tables.line_facts(spark, sf_dir), dict(tables.TESTDATA_CATEGORY_MAP)), "rollup_parts")
    return remember(_PARTS, stage_key(spark, sf_dir), make)


def rollups_from_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(sales_agg, inv_agg) from one pass over the line table
    (``tables.line_facts`` → ``rollups.combined_rollup_parts``, a plain hash
    aggregation of additive parts). That small table is the line-level
    stage's output, written once per session and state of the tables as a
    stage table (and the finished roll-up after it), so the totals, the two
    modes and the J1 join, which all read it, never re-run the line pass."""
    return split_rollup(remember(_ROLLUPS, stage_key(spark, sf_dir), lambda: stage_table(
        combined_rollup_finish(staged_parts(spark, sf_dir)), "rollups")))


def master_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales_agg, inv_agg = rollups_from_tables(spark, sf_dir)
    return build_master(sales_agg, inv_agg)


_STAGED: dict[tuple[str, str, str], DataFrame] = {}


def staged_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master table as a stage output: computed once per session and
    folder and written as a parquet stage table in the session's checkpoint
    folder. It holds one row per month and segment whatever the line
    volume, and every stage-2 step reads it several times (encoding fit,
    split, threshold, quantile, four models); the cut lineage also means a
    lost executor never replays the line-level joins."""
    return remember(_STAGED, stage_key(spark, sf_dir),
                    lambda: stage_table(master_from_tables(spark, sf_dir), "master"))


_FRAMES: dict[tuple[str, str, str], DataFrame] = {}


def staged_model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded modelling frame with split flag, training-median threshold
    and class label (``prep``), written once per session as a stage table: every
    report, summary and dashboard query starts from it (the reference hands
    the same frame over as its predictions file)."""
    from ..ml import prep
    return remember(_FRAMES, stage_key(spark, sf_dir), lambda: stage_table(
        prep.with_class_label(prep.with_split(prep.model_frame(staged_master(spark, sf_dir)))),
        "model_frame"))


def write_master(df: DataFrame, out_dir: str, fmt: str = "parquet") -> str:
    """One file set in the order of segment and month as a whole."""
    return files.write_table(df, f"{out_dir}/master_dataset", fmt, order_by=["Region", "Category", "Month"])
