"""Exact and near dedup with the first row in order kept.

Near dedup is greedy: a row goes if a *kept* earlier row is within the bits. Fingerprints are cut in one block more than bits
may differ, so that all close pairs meet in an equi-join; what is close forms small components, and each is scanned in order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from siltstone.session import ensure_checkpoints

_NOT_WORD = regex.compile(r"[^\p{L}\p{N}\s]")
_MASK = (1 << 64) - 1
#: FNV-1a with 64 bits.
FNV_OFFSET, FNV_PRIME = 0xCBF29CE484222325, 0x100000001B3


def _key_of(df: DataFrame, key: str, order: str) -> Column:
    """The key, or for null keys, which are no copies of each other, one of the row's own."""
    return F.when(F.col(key).isNull(), F.struct(F.lit(None).cast(df.schema[key].dataType).alias("k"), F.col(order).alias("o"))).otherwise(F.struct(F.col(key).alias("k"), F.lit(None).cast(df.schema[order].dataType).alias("o")))


def drop_exact(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key in ``order``; rows with a null key all stay.

    A partial aggregate keeps one row of a key in each task before anything is shuffled, so hot keys don't meet in one. Columns that
    are not needed afterwards, texts above all, should be dropped before.
    """
    rest = [c for c in df.columns if c != order]
    first = df.groupBy(_key_of(df, key, order).alias("__key")).agg(F.min(F.struct(F.col(order), F.struct(*rest).alias("__rest"))).alias("__first"))
    return first.select(F.col(f"__first.{order}").alias(order), "__first.__rest.*").select(*df.columns)


def flag_exact(df: DataFrame, key: str, order: str) -> DataFrame:
    """Only keys and orders are shuffled; the first of a key comes from a partial aggregate, so hot keys don't meet in one task.

    Rows with a null key are no copies.
    """
    first = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.min(order).alias("__first"))
    joined = df.join(first, F.col(key) == F.col("__key"), "left")
    copy = F.coalesce(F.col("__first") != F.col(order), F.lit(False))
    return joined.select(*df.columns, copy.alias("is_duplicate"), F.when(copy, "exact").alias("duplicate_type"), F.when(copy, F.col("__first")).alias("duplicate_match"))


def fnv1a64(text: str) -> int:
    """Over UTF-16 code units."""
    h = FNV_OFFSET
    data = text.encode("utf-16-le")
    for k in range(0, len(data), 2):
        h = ((h ^ (data[k] | data[k + 1] << 8)) * FNV_PRIME) & _MASK
    return h


def fnv1a64_all(texts: list[str]) -> np.ndarray:
    """FNV-1a of many strings at once, one code unit of each in every step."""
    raw = [np.frombuffer(x.encode("utf-16-le"), "<u2") for x in texts]
    sizes = np.array([len(x) for x in raw], np.int64)
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    units = np.concatenate(raw).astype(np.uint64) if len(raw) else np.empty(0, np.uint64)
    h = np.full(len(raw), FNV_OFFSET, np.uint64)
    falling = -sizes[order]
    for t in range(int(sizes.max()) if len(sizes) else 0):
        n = int(np.searchsorted(falling, -t, "left"))
        h[:n] = (h[:n] ^ units[starts[:n] + t]) * np.uint64(FNV_PRIME)
    out = np.empty_like(h)
    out[order] = h
    return out


def simhash_of(text: str) -> int:
    words = [w for w in regex.split(r"\s+", _NOT_WORD.sub("", text.lower())) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else words
    hashes = fnv1a64_all(shingles).astype("<u8")
    votes = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def simhash64(s: pd.Series) -> pd.Series:
    return pd.Series(np.array([simhash_of(x or "") for x in s], np.uint64).astype(np.int64), index=s.index)


def blocks(fp: Column, bits: int) -> Column:
    cuts = [64 * k // (bits + 1) for k in range(bits + 2)]
    return F.array(*(F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value")) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))))


def close_pairs(fps: DataFrame, bits: int) -> DataFrame:
    """(a, b, distance) of all pairs of ``fps(id, fp)`` within ``bits``, a < b."""
    one = fps.select("id", "fp", F.inline(blocks(F.col("fp"), bits)))
    two = one.select(F.col("id").alias("b"), F.col("fp").alias("fb"), F.col("block").alias("kb"), F.col("value").alias("vb"))
    near = one.join(two, (F.col("block") == F.col("kb")) & (F.col("value") == F.col("vb")) & (F.col("id") < F.col("b")))
    return near.select(F.col("id").alias("a"), "b", F.bit_count(F.col("fp").bitwiseXOR(F.col("fb"))).alias("distance")).where(F.col("distance") <= bits).distinct()


def near_greedy(docs: DataFrame, bits: int = 3, least_chars: int = 50) -> DataFrame:
    """(doc_id, simhash_64, is_duplicate, duplicate_type, duplicate_match) of ``docs(doc_id, text)`` in order of ids.

    A row with no closer earlier neighbour is kept; a row next to a kept one goes; repeated until all are decided. Every
    round decides at least the first undecided row of each component, and in practice nearly all. Null texts are no copies.
    """
    spark = docs.sparkSession
    ensure_checkpoints(spark)
    marked = flag_exact(docs.select("doc_id", F.length("text").alias("n"), F.sha2("text", 256).alias("key"), simhash64(F.col("text")).alias("fp")), "key", "doc_id").checkpoint()
    first = marked.where(~F.col("is_duplicate") & (F.col("n") >= least_chars))
    pairs = close_pairs(first.select(F.col("doc_id").alias("id"), "fp"), bits).checkpoint()
    went = spark.createDataFrame([], "gone long, match long")
    open_ = pairs
    while not open_.isEmpty():
        later = open_.select(F.col("b").alias("later")).distinct()
        kept = open_.select("a").distinct().join(later, F.col("a") == F.col("later"), "left_anti")
        gone = open_.join(kept.select(F.col("a").alias("k")), F.col("a") == F.col("k")).groupBy(F.col("b").alias("gone")).agg(F.min("a").alias("match")).checkpoint()
        went = went.unionByName(gone)
        dead = gone.select(F.col("gone").alias("x"))
        settled = kept.select(F.col("a").alias("x"))
        open_ = open_.join(dead, F.col("a") == F.col("x"), "left_anti").join(dead, F.col("b") == F.col("x"), "left_anti").join(settled, F.col("a") == F.col("x"), "left_anti").checkpoint()
    out = marked.join(went, F.col("doc_id") == F.col("gone"), "left")
    # An exact copy of a near copy that went counts as near too, and points to the same kept row.
    origin = went.select(F.col("gone").alias("origin"), F.col("match").alias("kept"))
    out = out.join(origin, F.col("duplicate_match") == F.col("origin"), "left")
    kind = F.when(F.col("gone").isNotNull() | F.col("kept").isNotNull(), "near").otherwise(F.col("duplicate_type"))
    return out.select("doc_id", F.when(F.col("n") >= least_chars, F.lower(F.lpad(F.hex("fp"), 16, "0"))).alias("simhash_64"), (F.col("is_duplicate") | F.col("gone").isNotNull()).alias("is_duplicate"), kind.alias("duplicate_type"), F.coalesce("match", "kept", "duplicate_match").alias("duplicate_match"))
