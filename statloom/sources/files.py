"""Listing and deleting through Hadoop's file systems, for any storage that Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below a path; 0 if there is nothing."""
    system, target = _at(spark, path)
    return system.getContentSummary(target).getLength() if system.exists(target) else 0


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a path."""
    system, target = _at(spark, path)
    if not system.exists(target):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(target))


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a path and all below it; false if there was nothing."""
    system, target = _at(spark, path)
    return system.delete(target, True)
