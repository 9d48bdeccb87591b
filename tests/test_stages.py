"""Remembered stages follow their tables; exact quantiles; the guard on stage folders; models don't depend on the cluster."""
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shelfwise import session
from shelfwise.functions.quantiles import exact_quantiles
from shelfwise.ml import models
from shelfwise.plans import master as mp
from shelfwise.schema import KEY, ModelParams
from shelfwise.sources import tables


def test_replaced_tables_change_the_answer(spark, tmp_path):
    d = str(tmp_path)
    for t in tables.SOURCES:
        shutil.copy(f"{SF_SMALL}/{t}.parquet", f"{d}/{t}.parquet")
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    before = mp.rollups_from_tables(spark, d)[0].agg(F.sum("Num_Transactions")).first()[0]
    (tmp_path / "lineitem.parquet").unlink()
    lines.unionAll(lines).unionAll(lines).write.parquet(f"{d}/lineitem.parquet")
    after = mp.rollups_from_tables(spark, d)[0].agg(F.sum("Num_Transactions")).first()[0]
    assert after == 3 * before
    assert len([k for k in mp._ROLLUPS if k[1] == d]) == 1


@pytest.mark.parametrize("values", [[1.0], [3.0, 1.0], list(np.random.default_rng(0).normal(size=501)), [2.0] * 40 + [5.0] * 3])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(float(v), None) for v in values] + [(None, None)], "a double, b double").repartition(5)
    row = exact_quantiles(df, {"lo": ("a", 0.25), "mid": ("a", 0.5), "hi": ("a", 0.75), "end": ("a", 1.0), "none": ("b", 0.5)}).first()
    want = np.quantile(values, [0.25, 0.5, 0.75, 1.0])
    assert np.allclose([row.lo, row.mid, row.hi, row.end], want, rtol=1e-12, atol=0) and row.none is None


def test_stage_folder_guard(spark, monkeypatch):
    class Fake:
        def __init__(self, master):
            self.sparkContext = self
            self.master = master

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}
    for master in ("local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(Fake(master))
    assert session.is_single_machine(Fake("local")) and session.is_single_machine(Fake("local[*]"))


def test_stage_tables_lie_in_the_applications_folder(spark):
    t = session.stage_table(spark.range(5), "t")
    assert t.count() == 5 and session.stage_folder(spark).split(":")[-1] in t.inputFiles()[0]
    assert spark.sparkContext.applicationId in session.stage_folder(spark)


def test_models_do_not_depend_on_partitions(spark):
    master = mp.staged_master(spark, SF_SMALL)
    p = ModelParams(sales_trees=5)
    found = []
    for n, parts in ((3, "2"), (11, "16")):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        frame = models.training_frame(master.repartition(n), p)
        assert frame.rdd.getNumPartitions() == 1          # one for each ``partition_rows`` rows
        model = models.fit_one(frame, "sales", p)
        found.append(sorted(tuple(r) for r in model.transform(frame).select(*KEY, "Predicted_Sales").collect()))
        frame.unpersist()
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert found[0] == found[1]
