"""Sinks: JSON lines, RFC 4180 CSV, Parquet with a manifest, partitioned shards, and checks of what was written."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from siltstone.sources.files import hashes


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_json_array(df: DataFrame, path: str, order: str) -> None:
    """One file with a JSON array of all rows, in order. The one file is the feature, so its rows pass through one task, a batch at a time."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": ["["]})
        mark = "  "
        for b in batches:
            if len(b):
                yield pd.DataFrame({"value": [f"{mark}{b['value'].iloc[0]}", *(f", {x}" for x in b["value"].iloc[1:])]})
                mark = ", "
        yield pd.DataFrame({"value": ["]"]})

    rows = df.orderBy(order).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    rows.coalesce(1).mapInPandas(lines, "value string").write.mode("overwrite").text(path)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def append_log(df: DataFrame, path: str) -> None:
    """Append rows to a log of JSON lines; what was written is never touched."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def put_objects(df: DataFrame, root: str) -> DataFrame:
    """Store ``df(content)`` under the contents' hashes, equal ones once; returns (sha256, path, bytes).

    A name tells its content, so writing again or by two tasks does no harm.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from siltstone.sources.files import open_uri

        for b in batches:
            out = []
            for sha, content in zip(b["sha256"], b["content"]):
                uri = f"{root}/{sha[:2]}/{sha}"
                fs, path = open_uri(uri)
                fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(path, compression=None) as f:
                    f.write(bytes(content))
                out.append((sha, uri, len(content)))
            yield pd.DataFrame(out, columns=["sha256", "path", "bytes"])

    once = df.select(F.sha2("content", 256).alias("sha256"), "content").groupBy("sha256").agg(F.first("content").alias("content"))
    return once.mapInPandas(run, "sha256 string, path string, bytes long")


def list_objects(spark: SparkSession, root: str) -> DataFrame:
    """(sha256, path, bytes, intact) of a store; ``intact`` tells whether the content still has its name's hash."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.element_at(F.split("path", "/"), -1)
    return found.select(name.alias("sha256"), "path", F.col("length").alias("bytes"), (F.sha2("content", 256) == name).alias("intact"))


def write_csv(df: DataFrame, path: str) -> None:
    """Header, CRLF, quotes doubled, nulls empty, nested values as JSON."""
    nested = {f.name: F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType))}
    df.withColumns(nested).write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", nullValue="", lineSep="\r\n")


def write_shards(df: DataFrame, path: str, order: str, shards: int, most_rows: int | None = None, codec: str = "zstd") -> None:
    """Parquet shards of contiguous ranges of ``order``; ``most_rows`` rolls a file over."""
    ranged = df.repartitionByRange(shards, order).sortWithinPartitions(order)
    writer = ranged.write.mode("overwrite").option("compression", codec)
    (writer.option("maxRecordsPerFile", most_rows) if most_rows else writer).parquet(path)


def write_partitioned(df: DataFrame, path: str, *keys: str) -> None:
    """One folder for each key; rows of a hot key stay spread over the tasks that hold them."""
    df.write.mode("overwrite").partitionBy(*keys).parquet(path)


def manifest(df_path: str, spark: SparkSession) -> DataFrame:
    """(file, bytes, sha256) of the files under a path."""
    return hashes(spark, df_path).select("file", "bytes", "sha256")


def verify(listed: DataFrame, found: DataFrame) -> DataFrame:
    """Listed files against found ones: verified, corrupted or missing."""
    f = found.select(F.col("file").alias("f"), F.col("sha256").alias("s"))
    verdict = F.when(F.col("f").isNull(), "missing").when(F.col("s") == F.col("sha256"), "verified").otherwise("corrupted")
    return listed.join(f, F.col("f") == F.col("file"), "left").select("file", verdict.alias("verdict"))
