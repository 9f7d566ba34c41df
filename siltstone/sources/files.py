"""Files written and read by tasks themselves: rolling Parquet and TAR shards with hashes, and hashes in pieces."""

from __future__ import annotations

import hashlib
import io
import tarfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST = "part int, place int, path string, records long, bytes long, sha256 string, md5 string"
#: A shard's ceiling, rows of a row group, and the codec's level.
MOST_BYTES, ROW_GROUP, LEVEL = 512 << 20, 5000, 6
PIECE = 8 << 20


def open_uri(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


class HashedFile(io.RawIOBase):
    """A new file that knows the length and hashes of what has been written."""

    def __init__(self, uri: str) -> None:
        fs, path = open_uri(uri)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(path, compression=None)
        self.size, self.sha256, self.md5 = 0, hashlib.sha256(), hashlib.md5()

    def writable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.size

    def write(self, data) -> int:
        view = memoryview(data).cast("B")
        self.out.write(view)
        self.sha256.update(view)
        self.md5.update(view)
        self.size += len(view)
        return len(view)

    def close(self) -> None:
        if not self.closed:
            self.out.close()
        super().close()


def _row(part: int, place: int, uri: str, records: int, f: HashedFile) -> pa.RecordBatch:
    values = [[part], [place], [uri], [records], [f.size], [f.sha256.hexdigest()], [f.md5.hexdigest()]]
    kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], [x.split()[0] for x in MANIFEST.split(", ")])


def named(manifest: DataFrame, dataset: str, first: int = 1) -> DataFrame:
    """The manifest with each shard's index in global order and its name. One row for each file meets here, never data."""
    index = F.row_number().over(Window.orderBy("part", "place")) + (first - 1)
    return manifest.withColumn("shard_index", index).withColumn("file", F.format_string(f"{dataset}-part-%05d", F.col("shard_index")))


def roll_parquet(df: DataFrame, folder: str, order: list[str | Column], most_bytes: int = MOST_BYTES, most_rows: int | None = None, row_group: int = ROW_GROUP, level: int = LEVEL) -> DataFrame:
    """Write ranges of ``order`` as Parquet files that roll over once they have ``most_bytes`` or ``most_rows``; returns their manifest.

    After each row group the file's size is looked at, so a file exceeds the limit by one row group at most. Tasks
    write under names of their own, and only files of tasks that ended well are in the manifest.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        waiting = records = place = 0
        part, uri, f, writer = None, "", None, None

        def flush(n: int) -> Iterator[pa.RecordBatch]:
            nonlocal held, waiting, records, place, uri, f, writer
            table = pa.Table.from_batches(held)
            group, rest = table.slice(0, n), table.slice(n)
            if writer is None:
                uri = f"{folder}/{uuid.uuid4().hex}.parquet"
                f = HashedFile(uri)
                writer = pq.ParquetWriter(f, group.schema, compression="zstd", compression_level=level)
            writer.write_table(group, row_group_size=n)
            records, held, waiting = records + n, rest.to_batches(), rest.num_rows
            if f.size >= most_bytes or (most_rows and records >= most_rows):
                yield close()

        def close() -> pa.RecordBatch:
            nonlocal records, place, writer
            writer.close()
            f.close()
            out = _row(part, place, uri, records, f)
            records, place, writer = 0, place + 1, None
            return out

        for batch in batches:
            part = batch.column("__part")[0].as_py() if batch.num_rows else part
            held.append(batch.drop_columns(["__part"]))
            waiting += batch.num_rows
            while waiting >= (n := min(row_group, most_rows - records) if most_rows else row_group):
                yield from flush(n)
        if waiting:
            yield from flush(waiting)
        if writer is not None:
            yield close()

    ranged = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()).sortWithinPartitions(*order)
    return _kept(ranged.mapInArrow(write, MANIFEST), folder)


def roll_tar(df: DataFrame, folder: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Write ``df(name, content)`` as TAR files that roll over at ``most_bytes``; returns their manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = place = 0
        part, uri, f, tar = None, "", None, None

        def close() -> pa.RecordBatch:
            nonlocal records, place, tar
            tar.close()
            f.close()
            out = _row(part, place, uri, records, f)
            records, place, tar = 0, place + 1, None
            return out

        for batch in batches:
            for part, name, content in zip(*(batch.column(c).to_pylist() for c in ("__part", "name", "content"))):
                if tar is None:
                    uri = f"{folder}/{uuid.uuid4().hex}.tar"
                    f = HashedFile(uri)
                    tar = tarfile.open(fileobj=f, mode="w|")
                info = tarfile.TarInfo(name)
                info.size = len(content)
                tar.addfile(info, io.BytesIO(content))
                records += 1
                if f.size >= most_bytes:
                    yield close()
        if tar is not None:
            yield close()

    rows = df.select("name", "content").withColumn("__part", F.spark_partition_id())
    return _kept(rows.mapInArrow(write, MANIFEST), folder)


def _kept(manifest: DataFrame, folder: str) -> DataFrame:
    """Run the writing tasks once: their rows are a table of its own, read by whatever follows."""
    path = f"{folder}-manifest-{uuid.uuid4().hex}"
    manifest.write.parquet(path)
    return manifest.sparkSession.read.schema(MANIFEST).parquet(path)


def hashes(spark: SparkSession, path: str, pattern: str = "part-*", whole: int = 1 << 30) -> DataFrame:
    """(file, path, bytes, sha256) of the files under a path; files beyond ``whole`` bytes are hashed piece by piece."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for uri in batch.column("path").to_pylist():
                fs, own = open_uri(uri)
                h = hashlib.sha256()
                with fs.open_input_stream(own, compression=None) as f:
                    while piece := f.read(PIECE):
                        h.update(piece)
                found.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("bytes"), pa.array(found, pa.string())], ["path", "bytes", "sha256"])

    small = files.where(F.col("length") <= whole).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > whole).select("path", F.col("length").alias("bytes")).mapInArrow(pieces, "path string, bytes long, sha256 string")
    return small.unionByName(large).select(F.element_at(F.split("path", "/"), -1).alias("file"), "path", "bytes", "sha256")
