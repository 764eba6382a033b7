"""Session and shared-folder helpers.

Lineage is cut with reliable ``checkpoint()`` into ``spark.checkpoint.dir``.
That folder must be shared storage on a cluster; a private folder is only
created when the session runs in local mode and nothing is configured.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "millrace") -> SparkSession:
    """Local session used by tests and the bench (a cluster brings its own)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    Reads ``spark.checkpoint.dir`` (or the one already set on the context).
    Only a local-mode session without one gets a private folder, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running millrace jobs")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for jobs that write first."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """``df``, a scan, dealt to all cores where it has fewer partitions than there are (few files of one row group each).

    Any larger table is left as it is, and so is a plan that shuffles already.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().executedPlan()
    cores = spark.sparkContext.defaultParallelism
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return df
    return df.repartition(cores) if plan.execute().getNumPartitions() < cores else df
