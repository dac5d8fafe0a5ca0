"""Streaming ingest (an extension): new page files are segmented as they arrive.

A publication must arrive whole in one file or one trigger. Each batch is
written under its own number, so that a batch tried again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from palimpsest.operators import segment
from palimpsest.sources.pages import PAGES

STREAM = PAGES + ", extracted_at timestamp_ntz"


def segment_stream(spark: SparkSession, folder: str, docs: DataFrame, out: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Watch a folder of Parquet page files; records of each batch go to ``out/batch=N``."""
    pages = spark.readStream.schema(STREAM).parquet(folder)

    def write(batch: DataFrame, number: int) -> None:
        segment.records(batch, docs).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def line_counts_stream(spark: SparkSession, folder: str, checkpoint: str, name: str) -> StreamingQuery:
    """Lines per publication and day of extraction, late pages dropped after two days, kept in memory for tests."""
    from pyspark.sql import functions as F

    pages = spark.readStream.schema(STREAM).parquet(folder).withColumn("at", F.col("extracted_at").cast("timestamp"))
    counts = pages.withWatermark("at", "2 days").groupBy(F.window("at", "1 day"), "source_file").agg(F.sum(F.size("lines")).alias("n_lines"))
    return counts.writeStream.outputMode("append").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
