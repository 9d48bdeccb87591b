"""Spark session helpers.

The library never hard-codes cluster settings: on a cluster the session is
built by the caller and its configuration wins. ``local_session`` is for
tests, the bench and the driver smoke check only.
"""

from __future__ import annotations

import atexit
import hashlib
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipelines rely on. Applied by ``local_session`` and checked
# (not forced) by ``ensure_sql_settings`` on an existing session.
SQL_SETTINGS = {
    # pandas and DuckDB timestamps are zone-naive; keep month truncation stable.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce tiny post-aggregation partitions, split
    # skewed join partitions (a single hot customer / part / order key).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "shelfwise") -> SparkSession:
    """Local session for tests and benchmarks (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SHELFWISE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_sql_settings(spark: SparkSession) -> None:
    """Set the session time zone if the caller left it at the JVM default."""
    if spark.conf.get("spark.sql.session.timeZone", None) in (None, ""):
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def is_single_machine(spark: SparkSession) -> bool:
    """``local`` and ``local[...]`` run in one process; ``local-cluster`` and
    all others have executors with folders of their own."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any. A ``file:``
    folder is taken as named: whoever names one on a cluster says that all
    machines mount it."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    return spark.sparkContext.getConf().get("spark.checkpoint.dir") or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the session names. Only a local-mode
    session (tests, the bench) without one gets a scratch folder; a cluster
    session must name a shared folder in ``spark.checkpoint.dir`` — a
    machine-local folder would not survive the loss of that machine."""
    existing = checkpoint_dir(spark)
    if existing:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(existing)
        return existing
    if not is_single_machine(spark):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the "
                           "cluster's distributed file system) before running shelfwise")
    local = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(local)
    return local


def stage_table(df, name: str):
    """Materialise ``df`` as a parquet table under the session's checkpoint
    folder and return the table read back: one job (``checkpoint()``
    without a persisted parent computes its plan twice), a lineage cut,
    and a columnar input for every later step. The folder is the shared
    one the cluster names, so the table survives lost executors."""
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stage_folder(spark: SparkSession) -> str:
    """Where this application's stage tables lie."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/shelfwise-stages/{spark.sparkContext.applicationId}"


def result_folder(spark: SparkSession, kind: str, *state) -> str:
    """A folder for results that outlive the application (fits that a stopped
    run need not do again), named by what they were computed from."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/shelfwise-results/{kind}-{hashlib.sha256(repr(state).encode()).hexdigest()[:32]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove_stages(spark: SparkSession) -> None:
    """Delete this application's stage tables; call it when a run has ended
    and its results are written (frames that read stage tables end with it)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stage_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def tables_stamp(spark: SparkSession, folder: str, tables: tuple[str, ...], suffix: str = ".parquet") -> str:
    """What a remembered result was computed from: of each table its bytes,
    number of files and time of change. A replaced table changes it. Three
    calls a table, however many files it has (the file system adds them up)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for table in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{table}{suffix}")
        fs = path.getFileSystem(conf)
        whole = fs.getContentSummary(path)
        found.append((table, whole.getLength(), whole.getFileCount(), fs.getFileStatus(path).getModificationTime()))
    return repr(sorted(found))
