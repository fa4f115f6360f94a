"""Card validation on a stream of model replies.

The reference calls the model one chapter at a time and validates each reply
as it arrives. Here replies land as files (from a batch-inference job) and a
Structured Streaming query validates every new batch with the same operators
as the batch path (``parse_replies`` + ``valid_cards``) and appends the typed
cards to a sink. Reply validation is row-local, so no streaming state is
kept; exactly-once output comes from the checkpoint plus an idempotent
per-batch write (the batch id is part of the output partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators import cards as C

REPLY_SCHEMA = "reply_id long, book_id string, chapter_title string, response_text string"


def reply_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Reply files (parquet) appearing under ``source_dir``."""
    return (
        spark.readStream.schema(REPLY_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source_dir)
    )


def _write_batch(out_dir: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        cards = C.valid_cards(C.parse_replies(batch)).withColumn("batch_id", F.lit(batch_id))
        # Overwriting the batch's own partition makes a replayed batch
        # idempotent.
        (cards.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_dir))

    return run


def start_card_stream(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str,
                      available_now: bool = False) -> StreamingQuery:
    """Validate replies continuously (or once over what is there with
    ``available_now``) and append typed cards under ``out_dir``."""
    w = reply_stream(spark, source_dir).writeStream.foreachBatch(_write_batch(out_dir)).option(
        "checkpointLocation", checkpoint_dir)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
