"""Session settings and lineage cuts shared by the jobs and operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# The clean tables hold instants written in this zone, so hours and days must be read in it.
DATA_TIME_ZONE = "America/Los_Angeles"


def get_spark(app_name: str, time_zone: str = DATA_TIME_ZONE, **conf: str) -> SparkSession:
    """Session with the data's time zone pinned; cluster sizing is left to spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's spark.checkpoint.dir.

    A local master without the setting gets a temporary folder. A cluster without
    it is an error, because a machine-local folder is lost with its executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="civitally-")
    context.setCheckpointDir(configured)
    return configured


def delete_at_end(spark: SparkSession, folder: str) -> str:
    """``folder``, which has been written, for the session's JVM to remove when it ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write row-level ``df`` once, compressed, to the shared folder and go on from the written rows.

    The folder is removed when the session ends, because a result not yet read may need it until then.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.parquet(delete_at_end(spark, folder))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written rows.

    For aggregates and narrow rows; wide rows are smaller by ``shared_table``.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
