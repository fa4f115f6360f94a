"""Tables kept in versions on shared storage.

A version is a folder of its own, ``<path>/version=<n>``, written once and complete when
Spark's ``_SUCCESS`` marker is in it. Readers take the newest complete one, so a job that
dies while it writes leaves the table as it was, and a version may be made from the one
before it. One job at a time may write a table. Earlier versions stay until somebody removes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _numbered(spark: SparkSession, path: str, key: str, complete: bool) -> list[int]:
    """Numbers of the folders ``<key>=<n>`` under a path, ascending."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name, _, number = status.getPath().getName().partition("=")
        marker = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name == key and number.isdigit() and (not complete or fs.exists(marker)):
            found.append(int(number))
    return sorted(found)


def next_number(spark: SparkSession, path: str, key: str = "version") -> int:
    """A number that no folder has yet, whether complete or left by a failed job."""
    return max(_numbered(spark, path, key, complete=False), default=0) + 1


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, ascending."""
    return _numbered(spark, path, "version", complete=True)


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version, None if there is none."""
    found = versions(spark, path)
    return spark.read.parquet(f"{path.rstrip('/')}/version={found[-1]}") if found else None


def write_next(df: DataFrame, path: str) -> int:
    """Write ``df`` as the next version; returns its number."""
    n = next_number(df.sparkSession, path)
    df.write.mode("errorifexists").parquet(f"{path.rstrip('/')}/version={n}")
    return n
