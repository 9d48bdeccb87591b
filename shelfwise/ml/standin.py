"""Closed-form Spark ML estimators: group means in place of the tree models.

They go through the same code as the tree models (cross-validation, score
table, scoring, importances), and SQL can say what they predict. A group mean
is also the trivial baseline that the tree models are judged against. Fitting
is one aggregation, scoring one join on the group key.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import davg, np_round
from ..operators.joins import join_dimension
from ..schema import FEATURE_COLS


def _abs_corr(x: F.Column, y: F.Column) -> F.Column:
    """|corr(x, y)|, 0 where it is not defined. Spark's ``corr`` divides by the
    two spreads whatever stands around it, and under ANSI (the default) a
    spread of zero is an error there; so the quotient is written out."""
    both = x.isNotNull() & y.isNotNull()
    spread = F.sqrt(F.var_pop(F.when(both, x)) * F.var_pop(F.when(both, y)))
    return F.coalesce(F.abs(F.nanvl(F.try_divide(F.covar_pop(x, y), spread), F.lit(None).cast("double"))), F.lit(0.0))


class GroupMean(Estimator):
    """Predicts the training mean of ``label`` among the rows of the same
    ``keys``. ``majority``: of a 0/1 label, whether the mean reaches a half.
    ``exact``: the mean by exact sums."""

    def __init__(self, label: str, pred: str, keys: list[str], majority: bool = False, exact: bool = True):
        super().__init__()
        self.label, self.pred, self.keys, self.majority, self.exact = label, pred, keys, majority, exact

    def _fit(self, dataset: DataFrame) -> GroupMeanModel:
        mean = davg(F.col(self.label).cast("double")) if self.exact else F.avg(self.label)
        value = (mean >= 0.5).cast("double") if self.majority else mean
        return GroupMeanModel(dataset.groupBy(*self.keys).agg(value.alias(self.pred)), self.keys, dataset, self.label)


class GroupMeanModel(Model):
    """The groups' means; ``featureImportances`` are the absolute correlations
    of the features with the label in the fitted rows (6 dp; 0 for a constant
    feature)."""

    def __init__(self, means: DataFrame, keys: list[str], fitted_on: DataFrame, label: str):
        super().__init__()
        self.means, self.keys, self.fitted_on, self.label = means, keys, fitted_on, label

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return join_dimension(dataset, self.means, self.keys, "left")

    @property
    def featureImportances(self) -> DenseVector:
        label = F.col(self.label).cast("double")
        row = self.fitted_on.agg(*[np_round(_abs_corr(F.col(f).cast("double"), label), 6).alias(f) for f in FEATURE_COLS]).first()
        return DenseVector([row[f] for f in FEATURE_COLS])
