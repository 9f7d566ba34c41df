"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, three-word shingles with repeats (fewer words: the whole
sequence; none: zero), XXH64 with seed 42; a bit is set if it is set in over half of the hashes.

Join: distinct fingerprints stand in binary tries. Two tries' nodes are traversed together from the root; each level adds
one differing bit or none, and a pair of nodes is dropped once its bits differ more often than the budget allows. To deal
the join out, the 64 bits are cut in ``budget + 1`` blocks; two fingerprints within the budget agree in one block at
least, so for each block a trie that begins with it needs only its equal top nodes paired with themselves. These top
nodes are the tasks' units. A unit with too many fingerprints is cut again in the same way by its remaining bits, so none
grows without bound. A unit hands on a spanning forest of its links, never all pairs.

Components: alternating large-star and small-star steps over the forests' edges, with minima only, so no node's neighbours
are gathered in one place; every step is written to the shared folder.

Nulls and edges: a null or empty text, or one of blanks, has fingerprint zero and links like any other; a null document id
takes part with its fingerprint, and its component is the smallest id that is not null (null if there is none); repeated
ids stay separate rows; very long texts are read whole; an empty table gives no rows; other columns than doc_id and text are
not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import free_memory, staged, text_chunks

SHINGLE = 3
SEED = 42
BUDGET = 2
#: Fingerprints of a top node beyond which it is cut again.
UNIT_LIMIT = 20_000


def fingerprint_words(words: list[bytes], size: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a sequence of words."""
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    if len(words) <= size:
        return xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1]
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist())], "<u8")
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, and with ``fp``: the fingerprint's bits as a signed long."""
    kept = [f for f in docs.schema.fields if f.name != text]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, text):
            texts = pc.fill_null(batch.column(text), "").cast(pa.large_binary()).to_pylist()
            fps = np.array([fingerprint_words(t.lower().split()) for t in texts], np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(fps)], [*(f.name for f in kept), "fp"])
        free_memory()

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "fp long"])
    return docs.mapInArrow(mark, schema)


def _split(free: list[int], n: int) -> list[int]:
    """Bit masks of ``n`` blocks that ``free`` bits are cut in."""
    cuts = [len(free) * k // n for k in range(n + 1)]
    return [sum(1 << bit for bit in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def trie_roots(values: np.ndarray, units: np.ndarray, budget: int, bits: int = 64) -> np.ndarray:
    """For each place the smallest place of its unit that links within ``budget`` connect it with.

    Both are sorted by (unit, value), and values are distinct in a unit. All units' tries are traversed level by level
    together; a node is a run of the sorted values, cut where its next bit turns to one. Part of a level is carried down
    to the leaves before the rest, so memory follows the part; pairs of nodes whose leaves are all connected already are
    dropped, so a dense group costs far fewer steps than it has links.
    """
    root = np.arange(len(values))
    if len(values) < 2:
        return root
    starts = np.flatnonzero(np.concatenate([[True], units[1:] != units[:-1]]))
    stops = np.append(starts[1:], len(units))
    big = stops - starts > 1
    lo, hi = starts[big], stops[big]
    ones: dict[int, np.ndarray] = {}

    def middle(lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1), dtype=np.int32)])
        return hi - (ones[bit][hi] - ones[bit][lo])

    stack = [(lo, hi, lo, hi, np.zeros(len(lo), np.int8), bits - 1)] if len(lo) else []
    while stack:
        *pairs, bit = stack.pop()
        a0, a1, b0, b1, spent = pairs
        turns = np.concatenate([[0], np.cumsum(root[1:] != root[:-1])])
        apart = (turns[a1 - 1] != turns[a0]) | (turns[b1 - 1] != turns[b0]) | (root[a0] != root[b0])
        pairs = [x[apart] for x in pairs]
        if len(pairs[0]) > 200_000:
            closest_last = np.argsort(-pairs[4], kind="stable")
            stack += [(*(x[closest_last[k : k + 100_000]] for x in pairs), bit) for k in range(0, len(closest_last), 100_000)]
            continue
        a0, a1, b0, b1, spent = pairs
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            i, j = a0[single], b0[single]
            near = np.bitwise_count(values[i] ^ values[j]) <= budget
            root = _union(root, i[near], j[near])
            a0, a1, b0, b1, spent = (x[~single] for x in pairs)
        if not len(a0) or bit < 0:
            continue
        am, bm = middle(a0, a1, bit), middle(b0, b1, bit)
        other = a0 != b0  # of a node paired with itself, one of the two mixed pairs is enough
        below = ((a0, am, b0, bm, spent), (am, a1, bm, b1, spent), (a0, am, bm, b1, spent + 1), tuple(x[other] for x in (am, a1, b0, bm, spent + 1)))
        a0, a1, b0, b1, spent = (np.concatenate(x) for x in zip(*below))
        live = (spent <= budget) & (a1 > a0) & (b1 > b0) & ~((a0 == b0) & (a1 - a0 == 1))
        if live.any():
            stack.append((*(x[live] for x in (a0, a1, b0, b1, spent)), bit - 1))
    return root


def _union(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    while True:
        i, j = root[i], root[j]
        open_ = i != j
        if not open_.any():
            return root
        i, j = i[open_], j[open_]
        np.minimum.at(root, np.maximum(i, j), np.minimum(i, j))
        while not np.array_equal(up := root[root], root):
            root = up


def link_fingerprints(fps: DataFrame, budget: int = BUDGET, unit_limit: int = UNIT_LIMIT) -> DataFrame:
    """Edges (a, b) that connect the distinct ``fps(fp)`` exactly as all links within ``budget`` do.

    A unit is a mask of bits and the value that its fingerprints have there.
    """
    n = budget + 1
    children = {0: _split(list(range(64)), n)}
    masks = [0]
    units = fps.select("fp", F.lit(0).cast("long").alias("mask"))
    done: DataFrame | None = None
    while True:
        for m in masks:
            children[m] = _split([b for b in range(64) if not m >> b & 1], n)
        under = F.create_map(*(x for m in masks for x in (F.lit(_signed(m)).cast("long"), F.array(*(F.lit(_signed(m | c)).cast("long") for c in children[m])))))
        units = units.select("fp", F.explode(under[F.col("mask")]).alias("mask")).withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = units.groupBy("mask", "value").agg(F.count("*").alias("size")).where("size > 1")
        units = staged(units.join(sizes, ["mask", "value"]), "trie-units")
        masks = [m | c for m in masks for c in children[m]]
        last = min(64 - m.bit_count() for m in masks) < n
        small = units if last else units.where(F.col("size") <= unit_limit)
        done = small if done is None else done.unionByName(small)
        units = units.where(F.col("size") > unit_limit)
        if last or units.isEmpty():
            break

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by unit; many whole units are traversed together."""

        def run(table: pa.Table) -> pa.RecordBatch:
            unit, value = table.column("unit").to_numpy(), table.column("fp").to_numpy().astype(np.uint64)
            order = np.lexsort((value, unit))
            unit, value = unit[order], value[order]
            keep = np.concatenate([[True], (unit[1:] != unit[:-1]) | (value[1:] != value[:-1])])
            unit, value = unit[keep], value[keep]
            root = trie_roots(value, unit, budget)
            at = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(value[at].astype(np.int64)), pa.array(value[root[at]].astype(np.int64))], ["a", "b"])

        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 4 * UNIT_LIMIT:
                table = pa.Table.from_batches(held).combine_chunks()
                unit = table.column("unit").to_numpy()
                first = int(np.searchsorted(unit, unit[-1]))
                if first:
                    yield run(table.slice(0, first))
                    table = table.slice(first)
                held, rows = table.to_batches(), table.num_rows
        if rows:
            yield run(pa.Table.from_batches(held))

    dealt = done.select("fp", F.xxhash64("mask", "value").alias("unit")).repartition("unit").sortWithinPartitions("unit")
    return dealt.mapInArrow(join, "a long, b long")


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) of every node in ``edges(a, b)``: root is the component's smallest node, by alternating stars."""
    edges = staged(edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "stars")
    for _ in range(most):
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).where("lo <> hi").distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        small = small.select(F.col("m").alias("lo"), "hi").unionByName(small.select(F.col("m").alias("lo"), F.col("lo").alias("hi"))).where("lo <> hi").distinct()
        after = staged(small, "stars")
        # Stars all: every node hangs from one root, and no root hangs from another.
        roots, nodes = after.select("lo").distinct(), after.select("hi")
        if nodes.count() == nodes.distinct().count() and roots.join(nodes, roots["lo"] == nodes["hi"], "left_semi").isEmpty():
            edges = after
            break
        edges = after
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def near_duplicates(docs: DataFrame, text: str = "text", budget: int = BUDGET, unit_limit: int = UNIT_LIMIT) -> DataFrame:
    """(doc_id, fp, component_id) of ``docs(doc_id, text)``: fp as a signed long, component_id the smallest id reachable."""
    marked = staged(with_fingerprints(docs.select("doc_id", text), text), "fingerprints")
    classes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    rooted = components(link_fingerprints(classes.select("fp"), budget, unit_limit))
    grouped = classes.join(rooted, classes["fp"] == rooted["node"], "left").select(classes["fp"], "least", F.coalesce("root", classes["fp"]).alias("root"))
    # A table of its own: both sides of the join are then plain shuffles, of which a large group's can be split.
    grouped = staged(grouped, "rooted-classes")
    least = staged(grouped.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    named = grouped.join(least, "root").select(F.col("fp").alias("own"), "component_id")
    return marked.join(named, marked["fp"] == named["own"]).select(marked["doc_id"], marked["fp"], "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
