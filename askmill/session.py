"""Session settings, and the one shared folder that jobs may write working data to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What a large cluster wants and a laptop does not mind. Shuffle partitions start high and
# AQE merges the small ones, so one number serves both ends.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Parsing pages costs far more than their shuffled bytes suggest: let small stages keep
    # small partitions, so that all cores take part.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Lists of keys this long reach the Bloom filters and statistics of a keyed table.
    "spark.sql.parquet.pushdown.inFilterThreshold": "500",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def session_builder(app_name: str = "askmill", shuffle_partitions: int | None = None):
    """A ``SparkSession.builder`` carrying the recommended settings."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is made, but only for a local master:
    on a cluster such a folder would exist on one machine alone.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        folder = configured
    else:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="askmill-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its terms."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def drop_work(spark: SparkSession) -> None:
    """Remove all working data of finished jobs from the shared folder; results read from it are gone with it."""
    system, place = file_system(spark, f"{shared_folder(spark).rstrip('/')}/work")
    system.delete(place, True)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for a written table or a stream's state."""
    return f"{shared_folder(spark).rstrip('/')}/work/{label}-{uuid.uuid4().hex}"
