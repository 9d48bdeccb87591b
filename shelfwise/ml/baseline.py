"""Segment-mean scorer: a closed-form stand-in for the tree models.

Predicts each target as the mean over the *training* rows of the same
(Region, Category) segment and the class by the segment's training majority.
It gives the dashboard queries a prediction column that SQL can reproduce
exactly (so they are oracle-checked) and is the trivial baseline the tree
models' R² is judged against. One groupBy on the modelling frame plus a
join on the segment key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import davg
from ..operators.joins import join_dimension
from ..schema import SEGMENT, BusinessRules
from .models import derive_predictions


def segment_mean_scores(labelled: DataFrame, rules: BusinessRules = BusinessRules()) -> DataFrame:
    """``labelled`` carries ``is_test`` and ``label_cls`` (prep.with_class_label)."""
    means = (labelled.filter(~F.col("is_test")).groupBy(*SEGMENT).agg(
        davg("Total_Sales_Amount").alias("Predicted_Sales"),
        davg("Net_Profit_Margin").alias("Predicted_Margin_Pct"),
        F.avg("Total_Qty_Sold").alias("_pred_qty"),
        F.avg("label_cls").alias("_cls_rate")))
    scored = join_dimension(labelled, means, SEGMENT, "left")
    scored = scored.withColumn("_pred_cls", (F.col("_cls_rate") >= 0.5).cast("double"))
    return derive_predictions(scored, rules).drop("_pred_qty", "_cls_rate", "_pred_cls")
