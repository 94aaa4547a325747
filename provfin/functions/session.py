"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are written for; a cluster adds its own sizes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: str = "8", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("provfin")
    settings = {
        **SETTINGS,
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is missing, a temporary folder serves if one process is the whole application; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if spark.sparkContext._jsc.sc().isLocal() is False:
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="provfin-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def working_folder(spark: SparkSession) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_folder(spark)}/provfin/{uuid.uuid4().hex}"
    files, where = hadoop_path(spark, path)
    files.mkdirs(where)
    files.deleteOnExit(where)
    return path


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def stored(df: DataFrame) -> DataFrame:
    """Write a frame as Parquet into the shared folder and read it back: lineage ends there, and a lost executor loses nothing.

    The files go when the application ends.
    """
    spark = df.sparkSession
    path = working_folder(spark)
    df.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame) -> DataFrame:
    """Later steps see the same rows as earlier ones, whatever is lost in between."""
    return stored(df)
