"""Readers: JSON lines or plain text, wiki dumps, Q&A dumps, archives, delimited text, and paged services."""

from __future__ import annotations

import gzip
import io
import json
import re
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

#: Limits that guard against archive bombs.
MOST_BYTES, MOST_FILES, MOST_RATIO = 100 << 20, 500, 100


def json_lines_or_text(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """(id, title, text): a line in braces that parses is an object, any other is text; missing ids are numbered over non-blank lines.

    Lines are numbered by file name, then place: splits are ordered by their file and first byte, and order is kept in a split.
    """
    place = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"))
    lines = spark.read.text(path).select(F.trim("value").alias("line"), place.alias("p"), F.monotonically_increasing_id().alias("place")).where("line <> ''")
    counts = lines.groupBy("p").agg(F.count("*").alias("n"))
    # One row for each split of a file meets here; lines are numbered within their splits.
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = lines.join(before.select(F.col("p").alias("q"), "before"), F.col("p") == F.col("q"))
    numbered = numbered.withColumn("ordinal", F.col("before") + F.row_number().over(Window.partitionBy("p").orderBy("place")))
    parsed = F.when(F.col("line").startswith("{") & F.col("line").endswith("}"), F.from_json("line", "text string, content string, title string, id string, doc_id string, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"}))
    rows = numbered.withColumn("o", parsed)
    bad = F.col("o").isNull() | F.col("o._corrupt_record").isNotNull()
    none = lambda c: F.nullif(F.col(c), F.lit(""))
    name = F.concat(F.lit(f"{dataset}-"), F.lpad(F.col("ordinal").cast("string"), 8, "0"))
    return rows.select(F.when(bad, name).otherwise(F.coalesce(none("o.id"), none("o.doc_id"), name)).alias("id"), F.when(~bad, F.coalesce("o.title", F.lit(""))).otherwise("").alias("title"), F.when(bad, F.col("line")).otherwise(F.coalesce(none("o.text"), none("o.content"), F.lit(""))).alias("text"))


def wiki_extracts(spark: SparkSession, path: str) -> DataFrame:
    """(id, url, title, text) of extracted articles in JSON lines; those with an empty title or text go."""
    rows = spark.read.schema("id string, url string, title string, text string").json(path)
    return rows.where((F.trim(F.coalesce("title", F.lit(""))) != "") & (F.trim(F.coalesce("text", F.lit(""))) != ""))


def manifest_partitions(spark: SparkSession, path: str) -> DataFrame:
    """(place, url, records, bytes) of the files that a JSON manifest lists; one without entries is an error when read."""
    entries = spark.read.schema("entries array<struct<url: string, meta: struct<record_count: long, content_length: long>>>").json(path)
    listed = entries.select(F.when(F.size("entries") > 0, F.col("entries")).otherwise(F.raise_error(F.lit("a manifest without entries"))).alias("e"))
    return listed.select(F.posexplode("e").alias("place", "e")).select("place", "e.url", F.col("e.meta.record_count").alias("records"), F.col("e.meta.content_length").alias("bytes"))


def _elements(spark: SparkSession, path: str, tag: str, schema: StructType) -> DataFrame:
    """Elements of XML files, one document in each. What follows a second root or a cut would be lost unseen, so it is an error."""
    raw = "_corrupt_record"
    rows = spark.read.format("xml").option("rowTag", tag).option("columnNameOfCorruptRecord", raw).schema(StructType([*schema.fields, StructField(raw, StringType())])).load(path)
    broken = F.col(raw).isNotNull() & F.coalesce(*(F.col(f.name).cast("string") for f in schema.fields)).isNull()
    error = F.raise_error(F.concat(F.lit("not one XML document: "), F.col("_metadata.file_path"))).cast("boolean")
    return rows.where(F.when(broken, error).otherwise(True)).select(*schema.names)


def wiki_pages(spark: SparkSession, path: str, least: int = 0) -> DataFrame:
    """(id, title, text, timestamp) of articles: no other namespaces, no redirects by element or by text."""
    pages = _elements(spark, path, "page", _parse_datatype_string("id long, title string, ns int, redirect struct<_title: string>, revision struct<timestamp: string, text: struct<_VALUE: string>>"))
    text = F.col("revision.text._VALUE")
    kept = pages.where((F.col("ns") == 0) & F.col("redirect").isNull() & (F.coalesce("title", F.lit("")) != "") & (F.length(text) >= max(1, least)))
    return kept.where(~F.lower(F.trim(text)).rlike("^#(redirect|yönlendir)")).select("id", "title", text.alias("text"), F.col("revision.timestamp").alias("timestamp"))


def qa_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``row`` elements of a Q&A dump; attributes become columns."""
    plain = _parse_datatype_string(schema)
    attributes = StructType([StructField(f"_{f.name}", f.dataType) for f in plain.fields])
    rows = _elements(spark, path, "row", attributes)
    return rows.select(*(F.col(f"_{f.name}").alias(f.name) for f in plain.fields))


def archive_members(name: str, data: bytes) -> Iterator[tuple[str, bytes]]:
    """Files of a ZIP, TAR or GZIP, within the bomb guard's limits."""
    total = 0

    def guard(k: int, size: int) -> None:
        nonlocal total
        total += size
        if k >= MOST_FILES or total > MOST_BYTES or total > MOST_RATIO * max(1, len(data)):
            raise ValueError(f"{name}: more than an archive may hold")

    if data[:4] == b"PK\x03\x04":
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            for k, m in enumerate(i for i in z.infolist() if not i.is_dir()):
                guard(k, m.file_size)
                yield m.filename, z.read(m)
    elif data[:2] == b"\x1f\x8b" and not name.endswith((".tar.gz", ".tgz")):
        out = gzip.GzipFile(fileobj=io.BytesIO(data)).read(MOST_BYTES + 1)
        guard(0, len(out))
        yield name.rsplit("/", 1)[-1].removesuffix(".gz"), out
    else:
        with tarfile.open(fileobj=io.BytesIO(data)) as tar:
            for k, m in enumerate(x for x in tar if x.isfile()):
                guard(k, m.size)
                yield m.name, tar.extractfile(m).read()


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, member, content) of all archives under ``path``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(p, m, c) for p, d in zip(b["path"], b["content"]) for m, c in archive_members(p, d)]
            yield pd.DataFrame(rows, columns=["path", "member", "content"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, member string, content binary")


def detect_delimiter(text: str) -> str:
    """Of comma, tab, semicolon and bar the one that stands in each of the first ten lines equally, and there most often; else the comma.

    What stands between quotes is passed over.
    """
    bare = re.sub(r'"[^"]*"', "", text)
    lines = [x for x in bare.splitlines() if x.strip()][:10]
    counts = {d: {x.count(d) for x in lines} for d in ",\t;|"}
    even = {d: min(c) for d, c in counts.items() if len(c) == 1 and min(c)}
    return max(even, key=lambda d: (even[d], -",\t;|".index(d))) if even else ","


class PagedSource(DataSource):
    """``format("siltstone-pages")``: items of a paged JSON service, here served from a folder of page files.

    Options: ``path`` with ``{page}`` in it, ``pages``, ``items`` (the array's key). One partition for each page.
    """

    @classmethod
    def name(cls) -> str:
        return "siltstone-pages"

    def schema(self) -> str:
        return "page int, place int, item string"

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path, self.n, self.items = options["path"], int(options["pages"]), options.get("items", "")

    def partitions(self):
        return [InputPartition(k) for k in range(1, self.n + 1)]

    def read(self, partition):
        with open(self.path.format(page=partition.value), encoding="utf-8") as f:
            data = json.load(f)
        rows = data if isinstance(data, list) else next((data[k] for k in (self.items, "data", "items", "results", "articles", "questions") if isinstance(data.get(k), list)), [data])
        for k, item in enumerate(rows):
            yield partition.value, k, json.dumps(item, ensure_ascii=False)
