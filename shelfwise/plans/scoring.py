"""Stage 3: score a master table with models fitted before.

``save`` writes what scoring needs — the four models, the label codes and the
training medians — with Spark ML's own persistence; ``load`` brings them back
in any session. ``score_master`` encodes by the saved codes (new values get a
code of their own), fills or drops rows that lack a feature, and scores.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ml import models, prep
from ..schema import FEATURE_COLS, BusinessRules, ModelParams
from ..sources import files

KINDS = {"sales": RandomForestRegressionModel, "margin": GBTRegressionModel, "qty": RandomForestRegressionModel,
         "cls": RandomForestClassificationModel}
HINT = "Run the modelling stage first."


@dataclass
class Saved:
    models: dict[str, object]
    labels: StringIndexerModel
    medians: DataFrame


def save(fitted: models.Fitted, master: DataFrame, folder: str) -> str:
    """Write the fitted models, the label codes of ``master`` and the medians
    of the training rows."""
    for name in KINDS:
        getattr(fitted, name).write().overwrite().save(f"{folder}/{name}")
    prep.fit_labels(master).write().overwrite().save(f"{folder}/labels")
    medians = prep.feature_medians(fitted.frame.filter(~F.col("is_test")))
    files.write_table(medians, f"{folder}/medians", single_file=True)
    return folder


def load(spark: SparkSession, folder: str) -> Saved:
    medians = files.read_table(spark, f"{folder}/medians", hint=HINT)
    return Saved({name: kind.load(f"{folder}/{name}") for name, kind in KINDS.items()},
                 StringIndexerModel.load(f"{folder}/labels"), medians)


def score_master(saved: Saved, master: DataFrame, fill: bool = False, rules: BusinessRules = BusinessRules()) -> DataFrame:
    """M11 + F19-F23 without fitting. ``fill``: rows that lack a feature are
    scored on the training medians (A8); else they are dropped (P5). Rows that
    lack only a target are scored."""
    frame = prep.encode_labels(master, saved.labels)
    frame = prep.fill_features(frame, saved.medians) if fill else frame.na.drop(subset=FEATURE_COLS)
    fitted = models.Fitted(**saved.models, frame=frame, params=ModelParams())
    return models.score(fitted, rules, prep.assembler().transform(frame))


def run(spark: SparkSession, out_dir: str, fmt: str = "parquet", fill: bool = False) -> str:
    """Score the master table in ``out_dir`` with the models saved there and
    write the predictions, a folder a year."""
    from .modelling import predictions_by_year
    master = files.read_table(spark, f"{out_dir}/master_dataset", fmt, "Build the master dataset first.")
    scored = score_master(load(spark, f"{out_dir}/models"), master, fill)
    return files.write_table(predictions_by_year(scored), f"{out_dir}/predictions", fmt, partition_by=["Year"])
