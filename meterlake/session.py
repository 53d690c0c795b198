"""Spark session defaults and the shared scratch location.

Everything here is plain session configuration: UTC wall clock, ANSI SQL,
adaptive execution (coalescing + skew-join splitting), no UI server.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every query relies on.  They can be applied to a
# session someone else built (the verify driver, a notebook, a cluster job).
RUNTIME_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.caseSensitive": "false",
    # A CSV row with an extra field must be dropped (DROPMALFORMED) by every
    # scan of the file, including scans that read one column only (e.g. the
    # mean used for imputation); with parser column pruning such a scan would
    # not see the extra field and would count the row.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
}


# Settings for a large cluster (hundreds of TB): start shuffles with many
# partitions and let adaptive execution coalesce them to ~256 MB each; split
# skewed partitions above 5x the median (and 256 MB); read ~256 MB scan
# splits.  Applied with ``get_session(profile="cluster")``.
CLUSTER_SQL_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, app_name: str = "meterlake",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None,
                profile: str = "local") -> SparkSession:
    """Build (or join) a session.  ``master`` is only set when given, so the
    same code runs under spark-submit on a cluster; ``profile="cluster"``
    adds the large-scale partition sizing of ``CLUSTER_SQL_CONF``."""
    builder = SparkSession.builder.appName(app_name)
    if profile == "cluster":
        for key, value in CLUSTER_SQL_CONF.items():
            builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    builder = (builder.config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # delete checkpoint files of lookup tables once they are unreferenced
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    for key, value in RUNTIME_SQL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return apply_defaults(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster-shared checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is (an unset value is an error there).  Only in local mode, when it
    is unset (tests), a private folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster "
                             "(a machine-local folder is not visible to executors)")
        configured = tempfile.mkdtemp(prefix="meterlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint directory for
    intermediate tables (stream inputs, written documents, models)."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "meterlake", f"{name}-{uuid.uuid4().hex[:12]}")


def release(spark: SparkSession, *paths: str) -> None:
    """Remove scratch folders made by :func:`scratch_path` that nothing reads
    any more."""
    root = os.path.join(ensure_checkpoint_dir(spark), "meterlake", "")
    for path in paths:
        if not path.startswith(root):
            raise ValueError(f"{path} is not a scratch folder")
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
