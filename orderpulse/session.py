"""Session settings and the shared folder that jobs write to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def build_session(app_name: str, **conf: str) -> SparkSession:
    """Session for the jobs. Resource settings belong to spark-submit, not here."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Files of a checkpoint go once nothing refers to it.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir` where it is set.

    Only a local-mode session without that setting gets a folder of its own, which goes when Python ends.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="orderpulse-")
        atexit.register(shutil.rmtree, _local_roots[sc.applicationId], ignore_errors=True)
    return _local_roots[sc.applicationId]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows in the shared checkpoint folder, computed once for all that reads them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours on whatever file system it is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
