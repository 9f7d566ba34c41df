"""Quality by cross-document line frequency, after a few base rules on each text.

Lines are normalised (A-Z lower-cased, runs of ASCII blanks as one space), hashed, and counted for each host: in how many
documents a line occurs, copies among them (``texts=True`` counts different texts instead). Lines above the limit are
removed, and a document that loses more than its share of words is rejected.

Nulls and edges: a null or empty text has no words and fails the base rules; a null host is a host of its own; null and
repeated ids stay separate rows, each a document; lines of blanks are no lines; very long texts are read whole, one at a
time; an empty table gives no rows; other columns than the id, text and host are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import free_memory, staged, text_chunks

#: Documents of a host that may share a line.
LIMIT = 20
#: Percent of a document's words that may be removed.
MOST_REMOVED = 50

_BLANK_OR_TAIL = bytes([0x20, *range(9, 14), *range(0x80, 0xC0)])
_SYMBOLS = b"#*$%&|<>"


def text_metrics(text: bytes) -> tuple[int, int, int, int, int, list[int], list[int], int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, line hashes, words of these lines, text hash."""
    from xxhash import xxh64_intdigest

    words = text.split()
    n = len(words)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    repeated = 0
    if n >= 3 and len(number) < n:
        k = len(number)
        pairs = np.unique(ids[:-1] * k + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * np.int64(k) + ids[2:]
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
        at = np.flatnonzero(counts[inverse] > 1)
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[at + shift] = True
        repeated = int(covered.sum())
    seen: set[bytes] = set()
    duplicates = 0
    lines: dict[int, int] = {}
    for line in text.split(b"\n"):
        own = line.split()
        if own:
            duplicates += line in seen
            seen.add(line)
            h = xxh64_intdigest(b" ".join(own).lower())
            lines[h] = lines.get(h, 0) + len(own)
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    return n, len(text.translate(None, _BLANK_OR_TAIL)), symbols, duplicates, repeated, list(lines), list(lines.values()), xxh64_intdigest(text)


def measure(docs: DataFrame, host: str) -> DataFrame:
    """One row for each document, without its text: the base columns, and its lines' hashes and words."""
    fixed = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<long>, line_words array<long>, text_hash long"
    names = [x.split()[0] for x in fixed.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            rows = [text_metrics(t) for t in pc.fill_null(batch.column("text"), "").cast(pa.large_binary()).to_pylist()]
            columns = list(zip(*rows))
            longs = [pa.array(c, pa.int64()) for c in columns[:5]]
            signed = [np.array(x, np.uint64).astype(np.int64).tolist() for x in columns[5]]
            lists = [pa.array(signed, pa.list_(pa.int64())), pa.array(columns[6], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("host"), *longs, *lists, pa.array(np.array(columns[7], np.uint64).astype(np.int64))], ["doc_id", "host", *names])
        free_memory()

    docs = docs.select("doc_id", "text", F.col(host).cast("string").alias("host"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, host string, {fixed}")


def line_quality(docs: DataFrame, host: str = "source", limit: int = LIMIT, most_removed: int = MOST_REMOVED, texts: bool = False) -> DataFrame:
    """Base columns, base_failed, removed_words and kept of every row of ``docs(doc_id, text, <host>)``."""
    rows = staged(measure(docs, host).withColumn("row", F.monotonically_increasing_id()), "line-hashes")
    # A row names each of its lines once.
    lines = rows.select("host", "text_hash", F.explode("lines").alias("line"))
    found = F.count_distinct("text_hash") if texts else F.count("*")
    common = lines.groupBy("host", "line").agg(found.alias("found")).where(F.col("found") > limit)
    common = staged(common.select(F.col("host").alias("common_host"), F.col("line").alias("common_line")), "common-lines")
    each = rows.select("row", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("x")).select("row", "host", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words"))
    gone = each.join(common, each["host"].eqNullSafe(common["common_host"]) & (each["line"] == common["common_line"])).groupBy("row").agg(F.sum("words").alias("removed"))
    out = rows.join(gone.withColumnRenamed("row", "gone_row"), rows["row"] == F.col("gone_row"), "left").withColumn("removed_words", F.coalesce("removed", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = 100 * F.col("removed_words") > most_removed * F.col("n_words")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "removed_words")
