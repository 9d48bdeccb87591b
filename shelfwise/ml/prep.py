"""Modelling-frame preparation: label codes, null drop, split, folds,
leakage-free class threshold (F17-F18, P5, P13, M1, W3, A7/J6/M14).

The modelling frame is the monthly segment table (months × regions ×
categories rows), so its size does not grow with the raw line volume.
Still, nothing here collects rows: fold numbers come from per-segment
counts and offsets instead of one global window.
"""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles
from ..operators.joins import join_dimension
from ..schema import ENCODED_COLS, FEATURE_COLS, SEGMENT, TARGET_COLS, ModelParams

NULL_LABEL = "nan"   # text a missing category gets before encoding (fixed value)


def _label_texts(master: DataFrame) -> DataFrame:
    for c in ENCODED_COLS:
        master = master.withColumn(f"_{c}_txt", F.coalesce(F.col(c), F.lit(NULL_LABEL)))
    return master


def fit_labels(master: DataFrame) -> StringIndexerModel:
    """the code of a value is its position among the sorted distinct
    values (missing → the text ``nan``). StringIndexer collects only the
    distinct labels (a handful per column) to the driver."""
    return StringIndexer(
        inputCols=[f"_{c}_txt" for c in ENCODED_COLS],
        outputCols=[f"{c}_enc" for c in ENCODED_COLS],
        stringOrderType="alphabetAsc", handleInvalid="keep").fit(_label_texts(master))


def encode_labels(master: DataFrame, labels: StringIndexerModel | None = None) -> DataFrame:
    """``<col>_enc`` columns by ``labels``, else by codes fitted on the
    whole master table before any row is dropped. A value that ``labels`` has
    not seen gets the code after the last."""
    out = (labels or fit_labels(master)).transform(_label_texts(master))
    for c in ENCODED_COLS:
        # plain numbers, as the reference's trees see them (no nominal metadata)
        out = out.withMetadata(f"{c}_enc", {}).drop(f"_{c}_txt")
    return out


def label_codes(master: DataFrame) -> DataFrame:
    """The code table behind F17: (column, value, code)."""
    enc = encode_labels(master)
    parts = [enc.select(F.lit(c).alias("column"),
                        F.coalesce(F.col(c), F.lit(NULL_LABEL)).alias("value"),
                        F.col(f"{c}_enc").cast("bigint").alias("code")).distinct()
             for c in ENCODED_COLS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def model_frame(master: DataFrame) -> DataFrame:
    """P5: encoded master without rows missing a feature or a target."""
    return encode_labels(master).na.drop(subset=FEATURE_COLS + TARGET_COLS)


def split_column(params: ModelParams = ModelParams()) -> F.Column:
    """M1: deterministic test flag from a hash of the row key, independent of
    partitioning: first 32 bits of md5(Region|Category|Month) mod 100."""
    key = F.concat_ws("|", "Region", "Category", F.col("Month").cast("string"))
    bucket = F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(100))
    return bucket < F.lit(params.test_pct)


def with_split(df: DataFrame, params: ModelParams = ModelParams()) -> DataFrame:
    return df.withColumn("is_test", split_column(params))


def with_folds(df: DataFrame, k: int = 5) -> DataFrame:
    """Contiguous folds over the (Region, Category, Month) order, sized
    like k-fold without shuffling (the first n mod k folds get one extra
    row). Row positions come from per-segment counts, their running offsets
    (a window over one row per segment) and a row number inside each
    segment — no single-partition window over all rows."""
    seg = df.groupBy(*SEGMENT).agg(F.count(F.lit(1)).alias("_seg_rows"))
    ordered = Window.orderBy(*SEGMENT)
    seg = (seg.withColumn("_offset", F.coalesce(
               F.sum("_seg_rows").over(ordered.rowsBetween(Window.unboundedPreceding, -1)),
               F.lit(0)))
              .withColumn("_n", F.sum("_seg_rows").over(Window.partitionBy())))
    out = join_dimension(df, seg.drop("_seg_rows"), SEGMENT)
    pos = F.col("_offset") + F.row_number().over(
        Window.partitionBy(*SEGMENT).orderBy("Month")) - 1
    out = out.withColumn("_pos", pos)
    n, i = F.col("_n"), F.col("_pos")
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    fold = F.when(i < big, F.floor(i / (q + 1))).otherwise(r + F.floor((i - big) / q))
    return out.withColumn("fold", fold.cast("int")).drop("_offset", "_n", "_pos")


def train_threshold(df_split: DataFrame, target: str = "Net_Profit_Margin") -> DataFrame:
    """Median target over the training rows only (one row)."""
    return exact_quantiles(df_split.filter(~F.col("is_test")), {"Profit_Threshold": (target, 0.5)})


def with_class_label(df_split: DataFrame, target: str = "Net_Profit_Margin") -> DataFrame:
    """1.0 when the target reaches the training median, else 0.0.
    The one-row threshold is broadcast (cross join of a single row)."""
    t = F.broadcast(train_threshold(df_split, target))
    return (df_split.crossJoin(t)
            .withColumn("label_cls", (F.col(target) >= F.col("Profit_Threshold")).cast("double")))


def assembler() -> VectorAssembler:
    """The 23 features as one vector column."""
    return VectorAssembler(inputCols=FEATURE_COLS, outputCol="features")


def feature_medians(train: DataFrame) -> DataFrame:
    """The exact (interpolated) median of each feature over the training
    rows, one row, from one range sort."""
    return exact_quantiles(train, {c: (c, 0.5) for c in FEATURE_COLS})


def fill_features(df: DataFrame, medians: DataFrame) -> DataFrame:
    """A8 in use: the rows that P5 would drop for a missing feature get the
    training rows' medians in its place, so that they can be scored. Features
    become doubles."""
    med = F.broadcast(medians.select(*[F.col(c).cast("double").alias(f"_med_{c}") for c in FEATURE_COLS]))     # one row
    out = df.crossJoin(med)
    return out.select(*[F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")).alias(c) if c in FEATURE_COLS else F.col(c)
                        for c in df.columns])


def median_fill(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Fill NULLs of each column with its exact (interpolated) median.
    After ``model_frame`` drops incomplete rows this changes nothing (as in
    the reference); it is kept for frames scored without that drop. All
    medians come from one sorted pass, broadcast as a single row."""
    cols = FEATURE_COLS if cols is None else cols
    med = F.broadcast(exact_quantiles(df, {f"_med_{i}": (c, 0.5) for i, c in enumerate(cols)}))
    out = df.crossJoin(med)
    out = out.select(*[
        F.coalesce(F.col(c), F.col(f"_med_{cols.index(c)}").cast(t)).alias(c) if c in cols
        else F.col(c)
        for c, t in df.dtypes])
    return out
