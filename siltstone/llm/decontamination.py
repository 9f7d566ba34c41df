"""Benchmark passages in documents: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

DataFrame operations only. Words are lower-cased runs of letters and digits; shingles are five words, with repeats.

1. A window as long as a benchmark item can only be similar to one if it shares a shingle with it. Every shingle of every
   document is looked up among the items' shingles; a hit at place p of a document and q of an item opens the window that
   begins at p - q. All other windows have similarity zero, so none is lost. A document has at most one window for each of
   its places and each length of items, however often a shingle repeats.
2. Windows get a 64-bit SimHash over their shingles. It is cut in four blocks of 16 bits; of two fingerprints within a radius
   of 15, one block differs in three bits at most. Items are entered under all values within so many bits of theirs,
   windows look up their own four values, so an equi-join on (size, block, value) finds all pairs within the radius, and
   two unrelated ones meet with a chance of 4 %.
3. Pairs within the radius are verified by the exact weighted Jaccard similarity of their shingles (weights: how often each
   occurs), 0.8 or more.

Items of one to four words are one shingle of all their words; a window of so many words is similar to one only if it is
equal, so they are found by that shingle alone.

The items' shingles are broadcast only when they are counted to be few (``BROADCAST_SHINGLES``); otherwise the documents'
shingles are joined by a shuffle.

Nulls and edges: null, empty and blank texts or items match nothing; null document ids are reported as null; equal ids are
reported together, each pair (document, item) once with its best window (``leaking_rows`` keeps rows apart); repeated items
are reported each; very long texts are read whole; empty tables give no rows; other columns than ids and texts are not
looked at, whatever their names. A window that begins before a document's first word or ends after its last one is moved
inside it, and a document shorter than the item is compared as a whole.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import staged

SIZE = 5
RADIUS = 15
BLOCKS = 4
SIMILARITY = 0.8
#: Items' shingles up to which they are sent to every executor: 24 bytes each, so 48 MB at most.
BROADCAST_SHINGLES = 2_000_000
_LANES = 0x0001000100010001
_WORD = r"[\p{L}\p{N}]+"


def with_words(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the words ``w`` in place of its text."""
    rest = [c for c in df.columns if c != text]
    # explode(array(x)) makes the optimizer compute x once, not again for each of its uses.
    return df.select(*rest, F.explode(F.array(F.regexp_extract_all(F.lower(F.col(text)), F.lit(_WORD), F.lit(0)))).alias("w"))


def _hashes(size: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size("w") - (size - 1)), lambda i: F.xxhash64(*(F.get("w", i - 1 + k) for k in range(size))))


def with_shingles(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``sh`` in place of its text: the hashes of its five-word shingles, in order."""
    rest = [c for c in df.columns if c != text]
    return with_words(df, text).where(F.size("w") >= SIZE).select(*rest, F.explode(F.array(_hashes(SIZE))).alias("sh"))


def with_simhash(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fp) of ``df(keys, sh)``. Lanes hold 65,535 shingles; longer runs are counted in parts first."""
    each = df.select(*keys, F.posexplode("sh").alias("at", "h")).withColumn("part", F.expr("at div 60000"))
    lanes = [F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(_LANES))).alias(f"s{k}") for k in range(16)]
    counted = each.groupBy(*keys, "part").agg(F.count("*").alias("n"), *lanes)
    counts = [F.sum(F.shiftrightunsigned(f"s{k}", 16 * j).bitwiseAND(F.lit(0xFFFF))).alias(f"b{k + 16 * j}") for j in range(4) for k in range(16)]
    summed = counted.groupBy(*keys).agg(F.sum("n").alias("n"), *counts)
    fp = F.lit(0).cast("long")
    for b in range(64):
        fp = fp.bitwiseOR(F.when(F.col(f"b{b}") * 2 > F.col("n"), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return summed.select(*keys, fp.alias("fp"))


def _values(fp: str) -> list[tuple[int, Column]]:
    width = 64 // BLOCKS
    return [(k, F.shiftrightunsigned(fp, width * k).bitwiseAND(F.lit((1 << width) - 1))) for k in range(BLOCKS)]


def _own_values(fp: str) -> Column:
    return F.explode(F.array(*(F.struct(F.lit(k).alias("block"), v.alias("value")) for k, v in _values(fp))))


def _near_values(fp: str, radius: int) -> Column:
    """Every value that a fingerprint within ``radius`` may have in a block that differs least."""
    width, most = 64 // BLOCKS, radius // BLOCKS
    flips = F.lit([sum(1 << b for b in bits) for n in range(most + 1) for bits in combinations(range(width), n)]).cast("array<long>")

    def around(block: int, own: Column) -> Column:
        return F.transform(flips, lambda x: F.struct(F.lit(block).alias("block"), own.bitwiseXOR(x).alias("value")))

    return F.explode(F.concat(*(around(k, v) for k, v in _values(fp))))


def _short_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of ``docs(r1, r2, doc_id, text)`` and the ``items(item, w)`` of fewer than SIZE words."""
    sizes = sorted(r.k for r in items.select(F.size("w").alias("k")).distinct().collect())  # at most SIZE - 1 rows
    known = items.select("item", F.size("w").alias("ik"), F.xxhash64("w").alias("known"))
    words = with_words(docs, "text")
    found = None

    def runs(k: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size("w") - (k - 1)), lambda i: F.xxhash64(F.slice("w", i, F.lit(k))))

    for k in sizes:
        each = words.where(F.size("w") >= k).select("r1", "r2", "doc_id", F.lit(k).alias("k"), F.posexplode(runs(k)).alias("at", "h"))
        found = each if found is None else found.unionByName(each)
    if found is None:
        return docs.where("false").select("r1", "r2", "doc_id", F.lit(0).cast("long").alias("item"), F.lit(0).alias("start"), F.lit(1.0).alias("similarity"), F.lit(0).alias("distance"))
    met = found.join(known, (F.col("h") == F.col("known")) & (F.col("k") == F.col("ik")))
    return met.groupBy("r1", "r2", "doc_id", "item").agg(F.min("at").alias("start")).select("r1", "r2", "doc_id", "item", "start", F.lit(1.0).alias("similarity"), F.lit(0).alias("distance"))


def row_marks() -> list[Column]:
    return [F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("r2")]


def leaking_rows(docs: DataFrame, items: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY) -> DataFrame:
    """(r1, r2, doc_id, item, item_id, start, similarity, distance) of ``docs(doc_id, text)``: verified windows.

    ``r1`` and ``r2`` are the row's marks (``row_marks``): 128 bits of hashes of its id and text, the same in every reading
    whatever the order of rows; rows equal in both are one here.
    """
    docs = docs.select(*row_marks(), "doc_id", "text")
    items = items.select("item_id", F.monotonically_increasing_id().alias("item"), "text")
    names = staged(with_words(items, "text").where(F.size("w") > 0), "items")
    items = names.where(F.size("w") >= SIZE).select("item", F.explode(F.array(_hashes(SIZE))).alias("sh")).withColumn("m", F.size("sh"))
    items = staged(items, "item-shingles")
    known = items.select(F.posexplode("sh").alias("q", "h"), "m")
    known = known.distinct().select(F.col("h").alias("known"), "q", "m")
    few = known.count() <= BROADCAST_SHINGLES
    hits = with_shingles(docs, "text").select("r1", "r2", F.size("sh").alias("n"), F.posexplode("sh").alias("p", "h"))
    hits = hits.join(F.broadcast(known) if few else known, F.col("h") == F.col("known"))
    begin = F.greatest(F.lit(0), F.least(F.col("p") - F.col("q"), F.col("n") - F.col("m")))
    windows = staged(hits.select("r1", "r2", begin.alias("start"), "m").distinct(), "windows")

    # A row's list is bounded by its places times the items' lengths.
    lists = windows.groupBy("r1", "r2").agg(F.collect_list(F.struct("start", "m")).alias("all"))
    near = docs.join(windows.select("r1", "r2").distinct(), ["r1", "r2"], "left_semi").groupBy("r1", "r2").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    cut = with_shingles(near, "text").join(lists, ["r1", "r2"]).select("r1", "r2", "doc_id", "sh", F.explode("all").alias("x"))
    cut = cut.select("r1", "r2", "doc_id", F.col("x.start").alias("start"), F.col("x.m").alias("m"), F.expr("slice(sh, x.start + 1, x.m)").alias("sh"))
    cut = staged(cut.where(F.size("sh") > 0), "window-shingles")

    keys = ["r1", "r2", "start", "m"]
    prints = staged(with_simhash(cut, keys), "window-prints")
    item_prints = staged(with_simhash(items, ["item", "m"]), "item-prints")
    one = prints.select("m", "fp").distinct().select("m", "fp", _own_values("fp").alias("b")).select("m", "fp", "b.block", "b.value")
    two = item_prints.select(F.col("m").alias("im"), F.col("fp").alias("ifp")).distinct()
    two = two.select("im", "ifp", _near_values("ifp", radius).alias("b")).select("im", "ifp", F.col("b.block").alias("iblock"), F.col("b.value").alias("ivalue"))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp")))
    # The planner takes the items' values for as small as the items; there are thousands for each, so they are shuffled.
    close = one.join(two.hint("merge"), (F.col("m") == F.col("im")) & (F.col("block") == F.col("iblock")) & (F.col("value") == F.col("ivalue")))
    close = close.select(F.col("m").alias("cm"), F.col("fp").alias("cfp"), "ifp", distance.alias("distance")).where(F.col("distance") <= radius).distinct()
    close = close.join(item_prints.select("item", F.col("m").alias("im"), F.col("fp").alias("jfp")), (F.col("cm") == F.col("im")) & (F.col("ifp") == F.col("jfp"))).select("cm", "cfp", "item", "distance")
    pairs = prints.join(close, (F.col("m") == F.col("cm")) & (F.col("fp") == F.col("cfp"))).select(*keys, "item", "distance")

    shingles = cut.select(*keys, F.explode("sh").alias("h")).groupBy(*keys, "h").agg(F.count("*").alias("c"))
    own = items.select(F.col("item").alias("i"), F.explode("sh").alias("ih")).groupBy("i", "ih").agg(F.count("*").alias("ic"))
    common = pairs.join(shingles, keys).join(own, (F.col("item") == F.col("i")) & (F.col("h") == F.col("ih")))
    common = common.groupBy(*keys, "item", "distance").agg(F.sum(F.least("c", "ic")).alias("shared"))
    lengths = cut.select(*keys, "doc_id", F.size("sh").alias("n"))
    scored = common.join(lengths, keys).withColumn("similarity", F.col("shared") / (F.col("n") + F.col("m") - F.col("shared"))).where(F.col("similarity") >= similarity)
    found = ["r1", "r2", "doc_id", "item", "start", "similarity", "distance"]
    scored = scored.select(*found).unionByName(_short_leaks(docs, names.where(F.size("w") < SIZE)).select(*found))
    return scored.join(names.select("item_id", F.col("item").alias("i")), F.col("item") == F.col("i")).select("r1", "r2", "doc_id", "item", "item_id", "start", "similarity", "distance")


def benchmark_leaks(docs: DataFrame, items: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY, text: str = "text") -> DataFrame:
    """(doc_id, item_id, start, similarity, distance): each document's benchmark passages, at their best window."""
    found = leaking_rows(docs.select("doc_id", F.col(text).alias("text")), items, radius, similarity)
    best = found.groupBy("doc_id", "item", "item_id").agg(F.max(F.struct("similarity", (-F.col("distance")).alias("d"), (-F.col("start")).alias("s"))).alias("b"))
    return best.select("doc_id", "item_id", (-F.col("b.s")).cast("long").alias("start"), F.col("b.similarity").alias("similarity"), (-F.col("b.d")).cast("int").alias("distance"))
