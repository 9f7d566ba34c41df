"""Contiguous shards of about equal bytes, by global prefix sums from per-partition totals. DataFrame operations only.

Rows are put in ranges of ascending ids once, without their texts. Bytes and rows are summed within each range and over
the ranges' totals; a row belongs to the shard in which the middle of its bytes falls when the whole is cut at equal
targets. Sizes so differ from the target by at most the largest row.

Nulls and edges: a null text has size 1, as an empty one; null ids come first; rows with equal ids stay separate, in the
order of their input, so a single id may fill several ranges; a row larger than a target, as a very long text, leaves a
shard without rows; an empty table gives no rows; other columns than doc_id and text are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import staged, with_prefix_sums

SHARDS = 16


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange(ranges, F.col("doc_id").asc_nulls_first(), "row")
    rows = staged(rows.withColumn("range", F.spark_partition_id()), "sized-rows")
    total = rows.agg(F.sum("size")).first()[0] or 1
    placed = with_prefix_sums(rows.withColumn("one", F.lit(1)), "range", ["doc_id", "row"], {"bytes_before": "size", "rows_before": "one"})
    placed = placed.withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"(2 * bytes_before + size) * {shards} div {2 * total}")).cast("int"))
    # One row for each shard, so never more than ``shards``.
    first = placed.groupBy("shard").agg(F.min("rows_before").alias("first"))
    out = placed.join(F.broadcast(first), "shard")
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("rows_before") - F.col("first")).alias("slot"))
