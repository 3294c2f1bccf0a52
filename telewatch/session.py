"""Spark session setup shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every telewatch session relies on.  UTC matters for semantics
# (calendar days and ``::date`` casts are UTC in the reference deployment);
# the rest are the scale defaults: AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "telewatch",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with telewatch's defaults.

    ``master`` is left to ``spark-submit`` when None.  The UI is off: it is a
    web server and nothing here needs it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


SEMANTIC_SETTINGS = {"spark.sql.session.timeZone": "UTC"}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings that change *results* on a session someone else built:
    only the session time zone (calendar days are UTC, as the reference's
    database ran).  Performance settings are left to the session's owner."""
    for key, value in SEMANTIC_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only
    a local-mode session may fall back to a fresh temporary folder; on a
    cluster a machine-local folder would not be visible to other executors,
    so an unset value is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/…) "
            "so checkpoints and staged tables survive executor loss"
        )
    root = tempfile.mkdtemp(prefix="telewatch-ckpt-")
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"



def hadoop_fs(spark: SparkSession, path: str):
    """The file system of a path, and the path as that file system's."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return fs.exists(p)
