"""Runs a declarative pipeline: source, normalise, gate, dedup, write, manifest and counts. Each stage is a lazy transform."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.config import Dedup, Normalise, Output, Pipeline, Quality
from siltstone.extensions import SINKS
from siltstone.functions import text as t
from siltstone.operators import dedup
from siltstone.sources import writers


def read_source(spark: SparkSession, source: dict) -> DataFrame:
    """(id, content) and whatever else the source has; ``seq`` is the order in which the first of equals is chosen."""
    df = spark.read.format(source.get("format", "parquet")).load(source["path"])
    return df.select(F.col(source.get("id", "id")).alias("id"), F.coalesce(F.col(source.get("text", "content")), F.lit("")).alias("content")).withColumn("seq", F.col("id"))


def normalised(df: DataFrame, c: Normalise) -> DataFrame:
    out = df.withColumn("raw_sha256", F.sha2("content", 256)).withColumn("content", t.normalise(F.col("content"), c.max_breaks))
    return out.withColumn("normalized_sha256", F.sha2("content", 256))


def gated(df: DataFrame, c: Quality) -> DataFrame:
    limits = {k: v for k, v in asdict(c).items() if k in t.GATE}
    measured = t.with_quality_metrics(df, "content").withColumn("reasons", t.gate_reasons(limits))
    measured = measured.withColumn("quality_metrics", F.struct(*t.METRICS)).drop(*t.METRICS)
    if c.action == "drop":
        return measured.where(F.size("reasons") == 0).drop("reasons")
    return measured.withColumns({"quality_passed": F.size("reasons") == 0, "quality_veto_reasons": F.when(F.size("reasons") > 0, F.col("reasons"))}).drop("reasons")


def deduplicated(df: DataFrame, c: Dedup) -> DataFrame:
    """By the normalised hash if there is one. Near dedup works on (seq, content) alone and joins its verdicts back."""
    key = F.col("normalized_sha256") if "normalized_sha256" in df.columns else F.sha2("content", 256)
    if c.near:
        found = dedup.near_greedy(df.select(F.col("seq").alias("doc_id"), F.col("content").alias("text")), c.hamming)
        flags = df.join(found, F.col("seq") == F.col("doc_id")).drop("doc_id")
    else:
        flags = dedup.flag_exact(df.withColumn("__dedup", key), "__dedup", "seq").drop("__dedup")
    return flags if c.action == "flag" else flags.where(~F.col("is_duplicate")).drop("is_duplicate", "duplicate_type", "duplicate_match")


def plan(spark: SparkSession, p: Pipeline) -> DataFrame:
    """All stages of a pipeline, nothing run yet."""
    df = read_source(spark, p.source)
    for stage, run in ((p.normalise, normalised), (p.quality, gated), (p.dedup, deduplicated)):
        if stage is not None and stage.enabled:
            df = run(df, stage)
    return df


def write(df: DataFrame, c: Output) -> None:
    settings = {k: v for k, v in asdict(c).items() if k not in ("format", "path")}
    SINKS.named(c.format)(df, c.path, **settings)


def run(spark: SparkSession, p: Pipeline) -> dict:
    """Write the pipeline's rows; returns its state, counts and manifest. A failure is told in the result, not raised."""
    try:
        write(plan(spark, p), p.output)
        files = [r.asDict() for r in writers.manifest(p.output.path, spark).orderBy("file").collect()]
        back = {"jsonl": "json", "csv": "csv"}.get(p.output.format, "parquet")
        reader = spark.read.format(back)
        reader = reader.option("header", "true").option("multiLine", "true").option("escape", '"') if back == "csv" else reader
        return {"name": p.name, "state": "COMPLETED", "records": reader.load(p.output.path).count(), "files": files}
    except Exception as e:  # noqa: BLE001
        return {"name": p.name, "state": "FAILED", "error": str(e).splitlines()[0][:500]}
