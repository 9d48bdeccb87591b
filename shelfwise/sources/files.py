"""File sources and sinks (CSV contract inputs, parquet/CSV report outputs)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import nan_to_null
from ..operators.dashboard import with_month_parts
from ..schema import INVENTORY_CSV_SCHEMA, INVENTORY_RENAMES, MISSING_TEXTS, SALES_SCHEMA

# Report tables written by the modelling stage, in write order.
REPORT_NAMES = ["predictions", "monthly_summary", "yearly_summary",
                "improvement_report", "feature_importance", "model_scores"]

# Types of the stage outputs' columns that are not doubles.
OUTPUT_TYPES = {
    **dict.fromkeys(["Month"], "date"),
    **dict.fromkeys(["Region", "Category", "Weather_Mode", "Seasonality", "Predicted_Profit_Class", "Rule_Codes",
                     "Recommendations", "Feature", "Model"], "string"),
    **dict.fromkeys(["Total_Qty_Sold", "Num_Transactions", "New_Customers", "Returning_Customers", "Online_Txn",
                     "Retail_Txn", "Units_Sold_Online", "Units_Ordered", "Holiday_Days", "Year", "MonthNum", "Quarter",
                     "Predicted_Sell_Qty"], "bigint"),
}


class MissingInputError(FileNotFoundError):
    """An expected input is absent; the message says which stage makes it."""


def _guard(read, path: str, hint: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise MissingInputError(f"Input not found at {path}.\n{hint}") from exc
        raise


class ContractError(ValueError):
    """A CSV input lacks columns of its contract; the message names them."""


def _raw_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The contract's columns of a CSV file or folder, by name, as text.
    The header decides the order; other columns are ignored. Every file's
    header is checked against the first's (``enforceSchema`` off)."""
    options = {"header": True, "inferSchema": False, "enforceSchema": False, "nullValue": "", "mode": "FAILFAST"}
    df = spark.read.options(**options).csv(path)
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ContractError(f"{path} lacks the columns {', '.join(missing)}; it has {', '.join(df.columns)}")
    return df.select(*[_present(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields])


#: a date, or a date and a time of day, and nothing else in the cell
DATE_CELL = r"\A\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?\z"


def _present(cell: F.Column, kind: T.DataType) -> F.Column:
    """The cell, NULL for a text that means no value. Blanks around numbers
    and dates are no part of them; a text is kept as delivered (`` East`` and
    ``East`` are two regions)."""
    text = cell if isinstance(kind, T.StringType) else F.trim(cell)
    return F.when(~text.isin(MISSING_TEXTS), text)


def _parsed(name: str, kind: T.DataType) -> F.Column:
    """The cell as its contract type, NULL where the whole cell cannot be read
    as one. Whole numbers may be written with a fraction of zero (``2.0``), a
    date with a time of day."""
    cell = F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.when(cell.rlike(DATE_CELL), cell.try_cast("timestamp_ntz").cast("date"))
    if isinstance(kind, (T.LongType, T.IntegerType)):
        number = cell.try_cast("double")
        whole = F.when(number == F.floor(number), number).try_cast(kind)
        return F.coalesce(cell.try_cast(kind), whole)
    if isinstance(kind, T.DoubleType):
        return nan_to_null(cell.try_cast("double"))
    return cell


def rejected_cells(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(column, cells, example): cells that hold something their contract type
    cannot take, for the columns that have any."""
    raw = _raw_csv(spark, path, schema)
    bad = [(f.name, F.when(F.col(f"`{f.name}`").isNotNull() & _parsed(f.name, f.dataType).isNull(), F.col(f"`{f.name}`")))
           for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    counts = raw.agg(*[F.struct(F.count(c).alias("cells"), F.min(c).alias("example")).alias(n) for n, c in bad])
    long = counts.unpivot([], [F.col(f"`{n}`") for n, _ in bad], "column", "x")
    return long.select("column", "x.cells", "x.example").filter("cells > 0")


def _contract_csv(spark: SparkSession, path: str, schema: T.StructType, on_bad: str) -> DataFrame:
    """``on_bad``: ``raise`` (the default of the readers) fails the read at
    the first cell that its contract type cannot take; ``null`` keeps such
    cells as NULL (``rejected_cells`` counts them)."""
    if on_bad not in ("raise", "null"):
        raise ValueError("on_bad must be raise or null")

    def column(f: T.StructField) -> F.Column:
        cell, value = F.col(f"`{f.name}`"), _parsed(f.name, f.dataType)
        if on_bad == "null" or isinstance(f.dataType, T.StringType):
            return value.alias(f.name)
        said = F.concat(F.lit(f"{path}: column {f.name} cannot take '"), cell, F.lit("'"))
        return F.when(cell.isNull(), F.lit(None)).when(value.isNotNull(), value).otherwise(
            F.raise_error(said).cast(f.dataType)).alias(f.name)
    return _raw_csv(spark, path, schema).select(*[column(f) for f in schema.fields])


def read_sales_csv(spark: SparkSession, path: str, on_bad: str = "raise") -> DataFrame:
    """Sales transactions, columns by name, with the contract's types."""
    return _guard(lambda: _contract_csv(spark, path, SALES_SCHEMA, on_bad),
                  path, "Provide the sales transactions file.")


def read_inventory_csv(spark: SparkSession, path: str, on_bad: str = "raise") -> DataFrame:
    """Inventory records, columns by name, renamed to snake-safe names."""
    return _guard(lambda: _contract_csv(spark, path, INVENTORY_CSV_SCHEMA, on_bad).withColumnsRenamed(INVENTORY_RENAMES),
                  path, "Provide the store inventory file.")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               hint: str = "Run the stage that writes it first.") -> DataFrame:
    """Read a stage output with a missing-input guard. A CSV output's
    columns get the types that the stages write (``OUTPUT_TYPES``; all others
    are doubles), never inferred ones."""
    def read():
        if fmt != "csv":
            return spark.read.format(fmt).load(path)
        df = spark.read.options(header=True, inferSchema=False, enforceSchema=False).csv(path)
        return df.select(*[F.col(f"`{c}`").cast(OUTPUT_TYPES.get(c, "double")).alias(c) for c in df.columns])
    return _guard(read, path, hint)


def load_reports(spark: SparkSession, out_dir: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The six report tables; in the predictions ``Month`` is a date,
    with Year, MonthNum and MonthLabel beside it."""
    hint = "Build the master dataset, then run the modelling stage."
    reports = {name: read_table(spark, f"{out_dir}/{name}", fmt, hint) for name in REPORT_NAMES}
    preds = reports["predictions"]
    reports["predictions"] = with_month_parts(preds.withColumn("Month", F.to_date("Month")))
    return reports


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None, single_file: bool = False, order_by: list[str] | None = None) -> str:
    """Executor-parallel write (the writer creates the folder).

    ``partition_by`` makes a folder for each value; only the folders that
    ``df`` has rows for are replaced, others stay. ``order_by`` puts the whole
    output in order: rows are dealt by key range and sorted, so that files in
    the order of their names hold successive ranges.
    ``single_file`` is for the tiny tables (importances, scores, report); only
    the finished rows meet in one task (a repartition, not a coalesce, which
    would pull the stage above into that task)."""
    if single_file:
        df = df.repartition(1)
    if order_by:
        df = df.orderBy(*order_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def output_counts(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Read each written output back and count its rows, as one table."""
    frames = [
        read_table(spark, path, fmt).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("output"), "rows")
        for name, path in paths.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
