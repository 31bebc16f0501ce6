"""Spark sessions for jobs of this library."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "leadmill", master: str | None = None, shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """UTC, ANSI and adaptive execution.  Partition counts are the cluster's business unless given."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    builder = builder.config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.ansi.enabled", "true")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.  Where it is unset, a local run gets one of its own; a cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="leadmill-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def spread(df: DataFrame, *keys) -> DataFrame:
    """df dealt by keys over all shuffle partitions: where few bytes make much work, the bytes read say nothing about its tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def large(df: DataFrame) -> DataFrame:
    """df as a side of a join that grows with the input: both sides are dealt by the keys and sorted, never sent whole to all tasks through the driver.

    Spark takes the size of stored rows from their compressed files, and takes rows that explode for as many as before, so it would send
    gigabytes for a limit of 10 MB.
    """
    return df.hint("merge")


def kept(df: DataFrame) -> DataFrame:
    """df computed once and written to the shared folder: loops start anew from it, and lost executors cost nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df written to the shared folder and read again, and its path."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/leadmill/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
