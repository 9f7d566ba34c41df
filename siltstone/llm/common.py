"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Bytes of text that a Python stage handles at once, whatever the Arrow batch holds.
CHUNK_BYTES = 4 << 20


#: Rows of an Arrow batch, at most, on its way to Python: texts may be long, and a batch is held whole on both sides.
BATCH_ROWS = 1000
#: Rows of the batches that Python joins from smaller ones, at most.
JOINED_ROWS = 8000


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's limit of rows in a batch to ``BATCH_ROWS``; a lower one stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where none is named and all runs in one machine (a local master, as in tests) a temporary folder is made and
    removed at exit; on a cluster that is an error, as executors would not see the driver's folder.
    """
    bounded_batches(spark)
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="siltstone-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        named = f"file://{own}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again: cuts lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reserved(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no such column, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def own_columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, also those with dots or quotes in their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def map_in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType) -> DataFrame:
    """``df.mapInArrow`` for columns of any name: they are called by their places in between.

    ``run`` gets and gives batches with the names of ``df`` and ``schema``.
    """
    bounded_batches(df.sparkSession)
    names, after = df.columns, schema.names

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(b.rename_columns(names) for b in batches):
            yield out.rename_columns([f"c{k}" for k in range(len(after))])

    placed = StructType([StructField(f"c{k}", f.dataType, f.nullable) for k, f in enumerate(schema.fields)])
    return df.toDF(*(f"c{k}" for k in range(len(names)))).mapInArrow(plain, placed).toDF(*after)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal few rows that each mean much work over as many tasks as the session has shuffle partitions.

    With the number given, adaptive execution doesn't join the small partitions into one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_blob(uri: str, parts: list[bytes]) -> None:
    """Write a new file whole: to a name of this attempt's own, so a lost or repeated task leaves no half file in use."""
    fs, path = filesystem(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    with fs.open_output_stream(path, compression=None) as out:
        for p in parts:
            out.write(p)


def read_blob(uri: str) -> bytes:
    fs, path = filesystem(uri)
    with fs.open_input_file(path) as f:
        return f.read()


def read_range(uri: str, offset: int, length: int) -> bytes:
    fs, path = filesystem(uri)
    with fs.open_input_file(path) as f:
        f.seek(offset)
        return f.read(length)


def text_chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``limit`` bytes of text, and one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        at = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > limit:
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += int(n)
        yield batch.slice(at)


def joined_batches(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES, rows: int = JOINED_ROWS) -> Iterator[pa.RecordBatch]:
    """Join small Arrow batches to ones of about ``limit`` bytes of text and ``rows`` rows, for work that has a price for each call."""
    held: list[pa.RecordBatch] = []
    size = n = 0
    for batch in batches:
        more = pa.compute.sum(pa.compute.binary_length(batch.column(text))).as_py() or 0
        if held and (size + more > limit or n + batch.num_rows > rows):
            yield pa.concat_batches(held)
            held, size, n = [], 0, 0
        held.append(batch)
        size, n = size + more, n + batch.num_rows
    if held:
        yield pa.concat_batches(held)


def free_memory() -> None:
    """Give memory that a Python worker no longer uses back to the machine, as the worker lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library, without this call
        pass


def with_prefix_sums(df: DataFrame, part: str, order: list[str], sums: dict[str, str]) -> DataFrame:
    """Exclusive global prefix sums in two levels: within each part, and over the parts' totals.

    ``part`` numbers the parts in global order; only one row for each part meets in one task.
    ``sums`` maps new columns to the columns that they add up.
    """
    inner = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(part).agg(*(F.sum(v).alias(f"__t_{k}") for k, v in sums.items()))
    bases = totals.select(F.col(part).alias("__part"), *(F.coalesce(F.sum(f"__t_{k}").over(outer), F.lit(0)).alias(f"__b_{k}") for k in sums))
    within = df.withColumns({f"__w_{k}": F.coalesce(F.sum(v).over(inner), F.lit(0)) for k, v in sums.items()})
    joined = within.join(bases, within[part] == bases["__part"])
    return joined.select(*(within[c] for c in df.columns), *((F.col(f"__w_{k}") + F.col(f"__b_{k}")).cast("long").alias(k) for k in sums))
