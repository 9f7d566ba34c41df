"""Token counts by a separator scan over flat token files that have no index.

A file is nothing but ids (little-endian uint16, or uint32 for larger vocabularies), each document followed by the
separator id. Files are cut into blocks of equal length that tasks scan on their own; a document that crosses block
borders is stitched together by a prefix scan over the blocks: the running count of separators numbers the documents,
and the running maximum of their places says where the first document of a block began.

Nulls and edges: an empty or null text has zero tokens (two separators in a row); ids after a file's last separator are
a document of their own with ``closed`` false; very long texts cross as many blocks as they need; an empty file has no documents; a block without separators only passes on
what lies before it. Null, repeated and tied document ids are kept, one row for each input row; other columns than doc_id and text are not
looked at, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import free_memory, fresh_path, joined_batches, read_range, spread, staged, text_chunks, write_blob
from siltstone.llm.tokenizing import encoder as encoder_of
from siltstone.llm.tokenizing import id_type

BLOCK_BYTES = 4 << 20
#: A new file begins once one has so many ids; files hold whole documents.
FILE_IDS = 8 << 20
#: Or so many documents, as a file's document ids are one row of its manifest.
FILE_DOCUMENTS = 1 << 19


def id_width(tokenizer_path: str, separator: int) -> int:
    """Bytes of an id."""
    return 2 if max(id_type(tokenizer_path)[1], separator + 1) <= 1 << 16 else 4


def write_flat_tokens(docs: DataFrame, folder: str, tokenizer_path: str, separator: int = 49408, file_ids: int = FILE_IDS) -> DataFrame:
    """Write ``docs(doc_id, text)`` as flat files; returns (path, bytes, doc_ids), one row for each file.

    Ids are uint16, or uint32 where the vocabulary or the separator needs it (``id_width``).
    """
    kind = f"<u{id_width(tokenizer_path, separator)}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, held, ids, n = encoder_of(tokenizer_path), [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal held, ids, n
            path = f"{folder}/{uuid.uuid4().hex}.bin"
            write_blob(path, [x.tobytes() for x in held])
            out = pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n * int(kind[-1])], pa.int64()), pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64()))], ["path", "bytes", "doc_ids"])
            held, ids, n = [], [], 0
            return out

        for batch in text_chunks(joined_batches(batches)):
            flat, sizes = encoder.encode(batch.column("text"))
            out = np.empty(len(flat) + len(sizes), kind)
            stops = np.cumsum(sizes + 1) - 1
            inner = np.ones(len(out), bool)
            inner[stops] = False
            out[inner], out[stops] = flat, separator
            held.append(out)
            ids.append(batch.column("doc_id").cast(pa.int64()))
            n += len(out)
            if n >= file_ids or sum(map(len, ids)) >= FILE_DOCUMENTS:
                yield flush()
        if n:
            yield flush()
        free_memory()

    return staged(docs.select("doc_id", "text").mapInArrow(write, "path string, bytes long, doc_ids array<long>"), "token-files")


def scan_separators(files: DataFrame, separator: int = 49408, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents of the flat files ``files(path, bytes)``: (path, ordinal, start, n_tokens, closed).

    ``start`` counts ids from the file's beginning, separators included.
    """
    kind = {2: "<u2", 4: "<u4"}[width]
    block_bytes -= block_bytes % width

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path, block, size in zip(*(batch.column(c).to_pylist() for c in ("path", "block", "bytes"))):
                offset = block * block_bytes
                ids = np.frombuffer(read_range(path, offset, min(block_bytes, size - offset)), kind)
                found.append(np.flatnonzero(ids == separator) + offset // width)
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("block"), batch.column("bytes"), pa.array([x.tolist() for x in found], pa.list_(pa.int64()))], ["path", "block", "bytes", "at"])

    blocks = files.select("path", "bytes", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("bytes") / block_bytes).cast("int") - 1))).alias("block"))
    scanned = blocks.where("bytes > 0").transform(spread, "path", "block").mapInArrow(scan, "path string, block int, bytes long, at array<long>")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scanned = scanned.select(
        "*",
        F.coalesce(F.sum(F.size("at")).over(before), F.lit(0)).alias("seen"),
        F.coalesce(F.max(F.element_at(F.col("at"), F.when(F.size("at") > 0, -1))).over(before), F.lit(-1)).alias("last"),
    )
    closed = scanned.select("path", "seen", "last", "at", F.posexplode("at").alias("k", "stop"))
    begins = F.when(F.col("k") == 0, F.col("last")).otherwise(F.element_at("at", F.greatest(F.col("k"), F.lit(1)))) + 1
    closed = closed.select("path", (F.col("seen") + F.col("k")).alias("ordinal"), begins.alias("start"), (F.col("stop") - begins).alias("n_tokens"), F.lit(True).alias("closed"))
    ends = scanned.where(F.col("block") == F.ceil(F.col("bytes") / block_bytes) - 1)
    after = F.greatest(F.col("last"), F.coalesce(F.element_at(F.col("at"), F.when(F.size("at") > 0, -1)), F.lit(-1))) + 1
    rest = ends.select("path", (F.col("seen") + F.size("at")).alias("ordinal"), after.alias("start"), (F.floor(F.col("bytes") / width) - after).alias("n_tokens"), F.lit(False).alias("closed")).where("n_tokens > 0")
    return closed.unionByName(rest)


def count_tokens(docs: DataFrame, tokenizer_path: str, separator: int = 49408) -> DataFrame:
    """Write ``docs`` as flat token files, scan them, and give each document its count: (doc_id, n_tokens, path, start)."""
    files = write_flat_tokens(docs, fresh_path(docs.sparkSession, "flat-tokens"), tokenizer_path, separator)
    found = scan_separators(files.select("path", "bytes"), separator, id_width(tokenizer_path, separator))
    names = files.select("path", F.posexplode("doc_ids").alias("ordinal", "doc_id"))
    # Both sides grow with the documents, though the planner takes the lists for small: never broadcast one.
    joined = found.join(names.hint("merge"), (found["path"] == names["path"]) & (found["ordinal"] == names["ordinal"]))
    return joined.select(names["doc_id"], found["n_tokens"].cast("long"), found["path"], found["start"].cast("long"))
