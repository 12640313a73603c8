"""What only Spark's classic session offers: size estimates and the file system.  Spark Connect is not served."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def planned_bytes(df: DataFrame) -> int:
    """Spark's own size estimate, the one it decides on broadcasts with."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_bytes(spark: SparkSession) -> int:
    """Up to which size Spark plans to broadcast."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def hadoop(spark: SparkSession, path: str):
    """(path, file system) of Hadoop for a path of any store."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def is_alive(spark: SparkSession) -> bool:
    return spark.sparkContext._jsc is not None
