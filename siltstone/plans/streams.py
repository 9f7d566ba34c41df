"""Streaming forms run to completion over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siltstone.plans.registry import query
from siltstone.plans.text import GATE_SQL
from siltstone.session import ensure_checkpoints
from siltstone.streaming import micro_batch as m


def _drained(spark, stream, name: str, schema: str):
    folder = f"{ensure_checkpoints(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/out")
    m.drain(stream, lambda df, _: df.write.mode("append").parquet(f"{folder}/out"), f"{folder}/checkpoint")
    return spark.read.schema(schema).parquet(f"{folder}/out")


@query("SELECT sha256(text) AS content_sha256, length(text)::INT AS chars FROM (SELECT DISTINCT text FROM documents)")
def stream_exact_dedup(spark, sf_dir):
    source = m.parquet_stream(spark, f"{sf_dir}/documents.parquet").select(F.sha2("text", 256).alias("content_sha256"), F.length("text").alias("chars"))
    return _drained(spark, m.first_seen(source), "stream-dedup", "content_sha256 string, chars int")


@query(GATE_SQL)
def stream_gate(spark, sf_dir):
    """The quality gate on a stream gives the batch gate's rows."""
    source = m.parquet_stream(spark, f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return _drained(spark, m.gated_stream(source).select("doc_id", "word_count", "alpha_ratio"), "stream-gate", "doc_id long, word_count long, alpha_ratio double")


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*)::BIGINT AS n, round(sum(value), 2) AS total, 0::BIGINT AS read_again FROM events GROUP BY ALL")
def stream_windows(spark, sf_dir):
    """Extension: counts by day and type with a watermark; a second run from the same checkpoint reads nothing again."""
    folder = f"{ensure_checkpoints(spark).rstrip('/')}/stream-windows-{uuid.uuid4().hex}"

    def run() -> int:
        source = m.parquet_stream(spark, f"{sf_dir}/events.parquet")
        return m.drain(m.windowed_counts(source), lambda df, _: df.write.mode("overwrite").parquet(f"{folder}/out"), f"{folder}/checkpoint", "complete")

    run()
    again = run()
    out = spark.read.parquet(f"{folder}/out")
    return out.select(F.col("window.start").alias("day"), "event_type", "n", F.round("total", 2).alias("total"), F.lit(again).cast("long").alias("read_again"))
