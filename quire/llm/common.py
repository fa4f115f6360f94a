"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, lazily; callers select the columns they need."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for staged tables and checkpoints: ``spark.checkpoint.dir``,
    or the directory the context already uses. Only a local session without
    either gets a scratch folder; on a cluster that would be a folder the
    executors cannot share, so it is an error there."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if named is None and current is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="quire-stage-")
    if current is None:
        sc.setCheckpointDir(named)
    return (named or current).rstrip("/")


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A setting of the session that holds meanwhile."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shuffles_removed(spark: SparkSession):
    """Meanwhile Spark removes a query's shuffle files when the query has ended, not when the
    driver happens to collect its garbage: what is staged and its shuffles would else
    lie on disk together."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def staged(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the
    lineage, survives the loss of executors, and later passes read only the
    columns they use."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{label}-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    """Number of shuffle partitions the session is configured for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unstaged(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class WordHashes(dict):
    """64-bit hashes of words, each worked out once while it is remembered; beyond
    ``most`` words all are forgotten."""

    def __init__(self, most: int):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
