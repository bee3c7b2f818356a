"""Session helpers: a configured SparkSession and the lineage-cutting step."""

from __future__ import annotations

import logging

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Settings this job relies on; everything else is left to the cluster.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "reshift",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (no UI)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**JOB_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any.

    Read from the SparkContext, else from ``spark.checkpoint.dir``; never
    invented here (tests set their own when it is unset). Under Spark Connect
    there is no SparkContext and the session setting is used as is.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: DataFrame.checkpoint uses the server's setting
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    return None


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` before it is consumed more than once.

    With a shared checkpoint folder this is a reliable ``checkpoint()`` (a
    lost executor costs a re-read, not a recomputation from the raw scan).
    Without one the frame is persisted (memory and disk), and lost blocks are
    recomputed from lineage.
    """
    if checkpoint_dir(df.sparkSession):
        return df.checkpoint(eager=True)
    log.warning("spark.checkpoint.dir is unset; persisting instead of checkpointing")
    return df.persist(StorageLevel.MEMORY_AND_DISK)

