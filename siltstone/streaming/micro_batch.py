"""Micro-batch forms of the corpus steps: the same transforms on a stream, exact dedup as keyed state, checkpoint after commit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import text as t


def gated_stream(source: DataFrame) -> DataFrame:
    """Hash, measure and gate a stream of ``documents`` rows; all steps are stateless."""
    return t.with_quality_metrics(source).where(F.size(t.gate_reasons()) == 0).withColumn("content_sha256", F.sha2("text", 256))


def first_seen(stream: DataFrame, key: str = "content_sha256") -> DataFrame:
    """The first row of each key; the state holds keys only."""
    return stream.dropDuplicates([key])


def drain(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> int:
    """Process all that is there in micro-batches; an offset is committed after its batch is in the sink. Returns the rows read.

    Draining again with the same checkpoint goes on where the last one ended.
    """
    query = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def windowed_counts(events: DataFrame, size: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Extension: events by type and tumbling window, with a watermark."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def parquet_stream(spark: SparkSession, path: str, files: int = 32) -> DataFrame:
    """The table at ``path``, a file or a folder of files, so many files in a micro-batch, which keep as many cores busy."""
    schema = spark.read.parquet(path).schema
    # A plain path has to be a folder; a pattern, here of one character, may also match a file.
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{path[:-1]}[{path[-1]}]")
