"""Book file catalog.

Lists book files under one or more roots with Spark's ``binaryFile`` source;
only path, length and modification time are selected, so file contents are
never read. The glob is case-sensitive, as in the reference ('*.epub' does
not match 'x.EPUB'). A missing root contributes no rows.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

CATALOG_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("root_no", T.IntegerType()),
])

# Default roots in the reference's order: spine-format books first.
DEFAULT_GLOBS = (("epub", "*.epub"), ("pdf", "*.pdf"))


def list_files(spark: SparkSession, root: str, glob: str, root_no: int = 0) -> DataFrame:
    """Files under ``root`` (recursively) whose name matches ``glob``."""
    try:
        df = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true")
            .load(root)
        )
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("book folder not found: %s", root)
        return spark.createDataFrame([], CATALOG_SCHEMA)
    return df.select(
        "path", "length", F.col("modificationTime").alias("modified"), F.lit(root_no).alias("root_no")
    )


def book_catalog(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """Union of the per-format listings, ``roots`` maps a format
    ('epub', 'pdf') to its folder; adds the ``format`` column and
    ``discovery_no``, which grows by root, then path (repeatable, unlike
    file-system order; numbers may have gaps, since the sort is distributed)."""
    parts = []
    for i, (fmt, glob) in enumerate(DEFAULT_GLOBS):
        if fmt in roots and roots[fmt]:
            parts.append(list_files(spark, roots[fmt], glob, i).withColumn("format", F.lit(fmt)))
    if not parts:
        return spark.createDataFrame([], CATALOG_SCHEMA).select(
            "*", F.lit(None).cast("string").alias("format"), F.lit(None).cast("long").alias("discovery_no"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("root_no", "path").withColumn("discovery_no", F.monotonically_increasing_id())


def first_files(catalog: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` files of the catalog by path (a top-n report)."""
    return catalog.orderBy("root_no", "path").limit(n)
