"""Sequence numbers inside groups that may be very large.

``row_number() over (partition by key order by x)`` puts a whole key into one
task. A book (key) of a corpus can hold a large share of all rows, so for keys
without a size bound we number in two levels:

1. rows are cut into buckets ``b = floor(x / width)``; the window runs on
   ``(key, b)``, so no window group has more than ``width`` rows when ``x`` is
   an integer position that is unique within the key;
2. the per-bucket row counts (a small table: one row per key and bucket) give
   each bucket its offset with a running sum over the buckets of a key.

The result equals the plain window exactly. ``order`` should be a dense integer
position (a record number). The big side is shuffled once (by ``key, b``); the offset
table joins on the same keys, so it is the only side that moves again.

``number_once`` is for rows that are costly to work out or whose positions are sparse. It
evaluates them once, into the shared folder. Of the staged rows only the keys and
positions are dealt out by ranges, sorted, and given their partition and place in it. A
distributed prefix sum does the rest: the first place and the count per key and
partition (at most one row per key plus one per partition), a running sum of the counts,
and a subtraction. The numbers join the rows on key and position, which spreads a large
key; no window runs over the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.session import ensure_checkpoint_dir

DEFAULT_WIDTH = 1 << 16


def seq_number(df: DataFrame, keys: Sequence[str], order: str, name: str = "seq",
               width: int = DEFAULT_WIDTH, positions: DataFrame | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row inside its ``keys`` group,
    ordered by the integer column ``order`` (unique within a group).

    ``positions`` may give the same rows' ``keys`` and ``order`` by a cheaper
    plan; the bucket counts are then taken from it."""
    keys = list(keys)
    b = "_seq_bucket"
    bucket = F.floor(F.col(order) / F.lit(width))
    local = df.withColumn(b, bucket).withColumn(
        "_seq_local", F.row_number().over(Window.partitionBy(*keys, b).orderBy(order))
    )
    # Counts come from a partial (map-side) aggregate of the key columns only.
    counts = ((df if positions is None else positions).withColumn(b, bucket)
              .groupBy(*keys, b).agg(F.count(F.lit(1)).alias("_seq_n")))
    offsets = counts.withColumn(
        "_seq_off",
        F.coalesce(
            F.sum("_seq_n").over(
                Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    ).drop("_seq_n")
    return (
        local.join(offsets, keys + [b])
        .withColumn(name, (F.col("_seq_off") + F.col("_seq_local")).cast("int"))
        .drop(b, "_seq_local", "_seq_off")
    )


def number_once(df: DataFrame, keys: Sequence[str], order: str, name: str = "seq") -> DataFrame:
    """As ``seq_number``, for any ``order`` column (sparse positions included), with
    ``df`` evaluated once: its rows are staged in the shared folder.

    ``order`` must be unique within a group; a null ``order`` comes first, as in a
    window. Rows whose keys are null form a group."""
    keys = list(keys)
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/numbered-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/rows")
    staged = spark.read.schema(df.schema).parquet(f"{path}/rows")
    at = F.monotonically_increasing_id()  # partition << 33 | place, of rows already dealt out and sorted
    dealt = staged.select(*keys, order).repartitionByRange(*keys, order).sortWithinPartitions(*keys, order)
    dealt.withColumn("_at", at).withColumn("_part", F.shiftright("_at", 33)).write.parquet(f"{path}/places")
    rows = spark.read.parquet(f"{path}/places")
    parts = rows.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = parts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"),
                          (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    numbers = rows.join(shifts, same).select(*[F.col(c).alias(f"_j{i}") for i, c in enumerate([*keys, order])],
                                             (F.col("_at") + F.col("_shift")).cast("int").alias(name))
    here = F.lit(True)
    for i, c in enumerate([*keys, order]):
        here = here & F.col(c).eqNullSafe(F.col(f"_j{i}"))
    return staged.join(numbers, here).select(*df.columns, name)
