"""Lexical retrieval packing: windows filled with BM25 neighbours of a seed document.

1. Documents are encoded and routed by content. A tree of a few splits along the main directions of the term frequencies
   (``Router``, fitted on about ``SAMPLE`` documents) gives a leaf, two weighted MinHash values of a document's terms an order in
   it, so related documents and copies stand side by side in one global order. All documents are routed; the sample
   decides the order alone, never a weight or a result's completeness.
2. That order is cut into ranges and these into shards of about ``SHARD_IDS`` ids. Ties of the order are broken by ids,
   contents and places, so a large group of copies fills as many ranges as it needs.
3. Each shard has an inverted index of its own (token id to documents, with BM25 weights); document frequencies, their
   number and their mean length are those of all documents, not of the shard. The first unused document seeds a window; all
   terms of the seed but its end id are looked up, and unused neighbours fill the window greedily in order of their scores,
   ties by the shard's order. A seed asks the index of its own shard only, so neighbours in other shards are not found. When no
   unused neighbour is left, the next unused document in the shard's order goes on as a seed of its own.
4. A document that does not fit is cut at the window's end and its rest opens the next one, so all windows but a shard's
   last are full. The last, of any length, is cut into pieces of powers of two, which need no padding.

Nulls and edges: a null or empty text is the end id alone; an empty table gives no rows; null, repeated and tied ids stay
separate rows (nulls first among equal places of the order); very long texts span many windows; other columns than doc_id and
text are not looked at, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import BATCH_ROWS, free_memory, joined_batches, staged, text_chunks
from siltstone.llm.tokenizing import encoder as encoder_of
from siltstone.llm.tokenizing import id_type

WINDOW = 4096
#: Ids in a shard, about: what is indexed and packed at once.
SHARD_IDS = 750_000
K1, B = 1.2, 0.75
#: Documents that the router is fitted on, about; the terms that it looks at; how often it splits.
SAMPLE, FEATURES, SPLITS = 1024, 1024, 6

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
ENCODED = "leaf int, first int, second int, doc_id long, ids binary"


class Router(NamedTuple):
    """Terms' places among the features, their weights, the tree's splits by node number, and two orders of all terms."""

    feature: np.ndarray
    weight: np.ndarray
    directions: np.ndarray
    cuts: np.ndarray
    orders: np.ndarray

    def vectors(self, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Unit vectors of weighted term frequencies; ``flat`` has all documents' ids, each with its end id."""
        n, f = len(sizes), len(self.weight)
        at = self.feature[flat]
        at[np.cumsum(sizes) - 1] = -1
        seen = at >= 0
        x = np.bincount(np.repeat(np.arange(n) * f, sizes)[seen] + at[seen], minlength=n * f).reshape(n, f) * self.weight
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        sides = vectors @ self.directions.T > self.cuts
        leaf = np.ones(len(vectors), np.int64)
        for _ in range(SPLITS):
            leaf = 2 * leaf + sides[np.arange(len(leaf)), leaf]
        return leaf

    def places(self, flat: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Leaf and MinHash values of each document."""
        stops = np.cumsum(sizes)
        some = [slice(i, i + BATCH_ROWS) for i in range(0, len(sizes), BATCH_ROWS)]
        out = [np.concatenate([self.leaves(self.vectors(flat[(stops - sizes)[s][0] : stops[s][-1]], sizes[s])) for s in some])]
        for order in self.orders:
            h = order[flat]
            h[stops - 1] = len(order)
            out.append(np.minimum.reduceat(h, stops - sizes))
        return out


def _split(x: np.ndarray, node: int, directions: np.ndarray, cuts: np.ndarray) -> None:
    """Cut the rows of ``x`` where two groups along their main direction leave the least variance, and go on below."""
    if node >= len(cuts) or len(x) < 32:
        return
    centred = x - x.mean(axis=0)
    v = np.linspace(1, 2, x.shape[1])
    for _ in range(30):
        v = centred.T @ (centred @ v)
        norm = np.linalg.norm(v)
        if not norm:
            return
        v /= norm
    along = x @ v
    ordered = np.sort(along)
    n, sums = len(ordered), np.cumsum(ordered)
    left = np.arange(1, n)
    gain = sums[:-1] ** 2 / left + (sums[-1] - sums[:-1]) ** 2 / (n - left)
    edge = n // 20
    best = edge + int(np.argmax(gain[edge : len(gain) - edge]))
    directions[node], cuts[node] = v, (ordered[best] + ordered[best + 1]) / 2
    _split(x[along <= cuts[node]], 2 * node, directions, cuts)
    _split(x[along > cuts[node]], 2 * node + 1, directions, cuts)


def fit_router(sample: DataFrame, kind: str, vocabulary: int, features: int = FEATURES) -> Router:
    """Fit on ``sample(ids)``, of which each document becomes one vector of ``features`` numbers."""
    n, _, df = corpus_statistics(sample, kind, vocabulary)
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    chosen = np.argsort(-df * idf, kind="stable")[:features]
    feature = np.full(vocabulary, -1, np.int32)
    feature[chosen] = np.arange(len(chosen))
    # Orders by exponential races: a term comes first with a chance in proportion to its weight.
    race = np.random.default_rng(0).exponential(size=(2, vocabulary)) / np.maximum(idf, 1e-3)
    nodes = 1 << SPLITS
    empty = Router(feature, idf[chosen], np.zeros((nodes, len(chosen))), np.full(nodes, np.inf), race.argsort(axis=1).argsort(axis=1).astype(np.int32))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            documents = [np.frombuffer(x, kind) for x in batch.column("ids").to_pylist()]
            x = [empty.vectors(d, np.array([len(d)]))[0].tolist() for d in documents]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float32()))], ["x"])

    got = np.array([r.x for r in sample.select("ids").mapInArrow(look, "x array<float>").collect()], float).reshape(-1, len(chosen))
    _split(got[np.lexsort(got.T[:8])] if len(got) else got, 1, empty.directions, empty.cuts)
    return empty


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int, kind: str, router: Router | None = None) -> DataFrame:
    """(leaf, first, second, doc_id, ids as little-endian ``kind``) of ``docs(doc_id, text)``; without a router all at one place."""
    shared = docs.sparkSession.sparkContext.broadcast(router)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        for batch in text_chunks(joined_batches(batches)):
            flat, sizes = encoder.encode(batch.column("text"))
            out = np.empty(len(flat) + len(sizes), kind)
            stops = np.cumsum(sizes + 1)
            inner = np.ones(len(out), bool)
            inner[stops - 1] = False
            out[inner], out[stops - 1] = flat, end_id
            places = [np.zeros(len(sizes))] * 3 if shared.value is None else shared.value.places(out, sizes + 1)
            offsets = pa.py_buffer((np.concatenate([[0], stops]) * out.itemsize).astype(np.int32))
            ids = pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, offsets, pa.py_buffer(out)])
            columns = [*(pa.array(p.astype(np.int32)) for p in places), batch.column("doc_id").cast(pa.int64()), ids]
            yield pa.RecordBatch.from_arrays(columns, ["leaf", "first", "second", "doc_id", "ids"])
        free_memory()

    return docs.select("doc_id", "text").mapInArrow(encode, ENCODED)


def corpus_statistics(encoded: DataFrame, kind: str = "<u2", vocabulary: int = 1 << 16) -> tuple[int, float, np.ndarray]:
    """Number of documents, mean length and each id's document frequency over ``encoded(ids)``, end ids apart."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, length = np.zeros(vocabulary, np.int64), 0, 0
        place = np.zeros(vocabulary, np.int32)
        for batch in batches:
            for blob in batch.column("ids").to_numpy(zero_copy_only=False):
                ids = np.frombuffer(blob, kind)[:-1]
                at = np.arange(len(ids), dtype=np.int32)
                place[ids] = at
                df[ids[place[ids] == at]] += 1  # each id at one of its places
                n, length = n + 1, length + len(ids)
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *term.tolist()], pa.int32()), pa.array([n, length, *df[term].tolist()], pa.int64())], ["term", "k"])

    # At most as many rows as the vocabulary has ids.
    sums = {r.term: r.k for r in encoded.select("ids").mapInArrow(count, "term int, k long").groupBy("term").agg(F.sum("k").alias("k")).collect()}
    n, length = sums.pop(-2, 0), sums.pop(-1, 0)
    df = np.zeros(vocabulary, np.int64)
    df[list(sums)] = list(sums.values())
    return n, length / max(1, n), df


class ShardIndex:
    """Inverted index of one shard: postings by term, with BM25 weights. A document's last id, its end, is no term.

    ``corpus`` has the statistics of all documents; without it the shard's own count.
    """

    def __init__(self, documents: list[np.ndarray], corpus: tuple[int, float, np.ndarray] | None = None) -> None:
        n = len(documents)
        documents = [d[:-1] for d in documents]
        lengths = np.array([len(d) for d in documents], np.int64)
        owner = np.repeat(np.arange(n, dtype=np.uint64), lengths)
        tokens = np.concatenate(documents).astype(np.uint64) if n else np.empty(0, np.uint64)
        codes = np.sort((tokens << np.uint64(32)) | owner)
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
        tf = np.diff(first, append=len(codes)).astype(np.float32)
        codes = codes[first]
        term, self.doc = (codes >> np.uint64(32)).astype(np.int64), (codes & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.empty(0, np.int64)
        df = np.diff(starts, append=len(term))
        total, mean, everywhere = (n, lengths.mean() if n else 1.0, df) if corpus is None else (corpus[0], corpus[1], corpus[2][term[starts]])
        idf = np.log1p((total - everywhere + 0.5) / (everywhere + 0.5)).astype(np.float32)
        which = np.repeat(np.arange(len(starts)), df)
        norm = K1 * (1 - B + B * lengths / max(1.0, mean))
        self.weight = idf[which] * tf * (K1 + 1) / (tf + norm[self.doc].astype(np.float32))
        self.starts, self.df, self.n = starts, df, n
        # A document's own terms, without those that no other document has.
        shared = df[which] > 1
        order = np.argsort(self.doc[shared], kind="stable")
        self.own_term = which[shared][order]
        self.own_start = np.searchsorted(self.doc[shared][order], np.arange(n + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard against all of the seed's terms."""
        own = self.own_term[self.own_start[seed] : self.own_start[seed + 1]]
        if not len(own):
            return np.zeros(self.n)
        sizes = self.df[own]
        stops = np.cumsum(sizes)
        at = np.repeat(self.starts[own] - (stops - sizes), sizes) + np.arange(stops[-1])
        return np.bincount(self.doc[at], self.weight[at], self.n)


def fill_windows(lengths: list[int], index: ShardIndex, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that cover every document once."""
    n = len(lengths)
    unused = np.ones(n, bool)
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = filled = next_seed = 0
    rest: tuple[int, int] | None = None
    while True:
        if rest is None:
            while next_seed < n and not unused[next_seed]:
                next_seed += 1
            if next_seed == n:
                break
            rest = (next_seed, 0)
            unused[next_seed] = False
        seed = rest[0]
        queue: list[int] | None = None
        at = 0
        while rest is not None:
            doc, start = rest
            take = min(window - filled, lengths[doc] - start)
            pieces.append((doc, start, take, sequence, filled))
            filled += take
            rest = (doc, start + take) if start + take < lengths[doc] else None
            if filled == window:
                sequence, filled = sequence + 1, 0
                break
            if rest is None:
                if queue is None:
                    scores = index.scores(seed)
                    scores[~unused] = 0
                    near = np.flatnonzero(scores)
                    queue = near[np.lexsort((near, -scores[near]))].tolist()
                while at < len(queue) and not unused[queue[at]]:
                    at += 1
                if at < len(queue):
                    rest = (queue[at], 0)
                    unused[queue[at]] = False
    if not filled:
        return pieces
    # The last sequence: powers of two, largest first.
    last = [p for p in pieces if p[3] == sequence]
    pieces = pieces[: len(pieces) - len(last)]
    bits = [1 << k for k in range(filled.bit_length() - 1, -1, -1) if filled >> k & 1]
    used = 0
    for doc, start, length, _, _ in last:
        while length:
            take = min(length, bits[0] - used)
            pieces.append((doc, start, take, sequence, used))
            start, length, used = start + take, length - take, used + take
            if used == bits[0]:
                bits.pop(0)
                sequence, used = sequence + 1, 0
    return pieces


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, window: int = WINDOW, shard_ids: int = SHARD_IDS, sample: int = SAMPLE) -> DataFrame:
    """Pack ``docs(doc_id, text)``; one row for each piece, with its ids as little-endian uint32."""
    kind, vocabulary = id_type(tokenizer_path)
    # An end id beyond the vocabulary needs a place of its own.
    vocabulary = max(vocabulary, end_id + 1)

    def pack_shard(part: int, sequence: int, ids: list[int | None], blobs: list[bytes]) -> tuple[pa.RecordBatch, int]:
        documents = [np.frombuffer(x, kind) for x in blobs]
        rows = fill_windows([len(d) for d in documents], ShardIndex(documents, corpus.value), window)
        own = [documents[d][s : s + k].astype("<u4").tobytes() for d, s, k, _, _ in rows]
        base = (part << 40) + sequence
        columns = [
            pa.array([ids[d] for d, *_ in rows], pa.int64()),
            pa.array([s for _, s, _, _, _ in rows], pa.int64()),
            pa.array([k for _, _, k, _, _ in rows], pa.int64()),
            pa.array([zlib.crc32(x) for x in own], pa.int64()),
            pa.array([len(documents[d]) for d, *_ in rows], pa.int64()),
            pa.array([base + q for _, _, _, q, _ in rows], pa.int64()),
            pa.array([o for *_, o in rows], pa.int64()),
            pa.array(own, pa.binary()),
        ]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
        return pa.RecordBatch.from_arrays(columns, names), sequence + 1 + max(q for _, _, _, q, _ in rows)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = sequence = held = 0
        ids: list[int | None] = []
        blobs: list[bytes] = []
        for batch in batches:
            for p, doc, blob in zip(batch.column("part").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids").to_numpy(zero_copy_only=False)):
                part = p
                ids.append(doc)
                blobs.append(blob)
                held += len(blob)
                if held >= shard_ids * np.dtype(kind).itemsize:
                    out, sequence = pack_shard(part, sequence, ids, blobs)
                    ids, blobs, held = [], [], 0
                    yield out
        if blobs:
            yield pack_shard(part, sequence, ids, blobs)[0]
        free_memory()

    docs = docs.select("doc_id", "text")
    one_in = -(-docs.count() // sample)
    some = docs.where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(1, one_in))) == 0)
    router = fit_router(staged(encode_documents(some, tokenizer_path, end_id, kind), "router-sample"), kind, vocabulary)
    encoded = staged(encode_documents(docs, tokenizer_path, end_id, kind, router), "encoded-documents")
    corpus = docs.sparkSession.sparkContext.broadcast(corpus_statistics(encoded, kind, vocabulary))
    place = ["leaf", "first", "second", F.col("doc_id").asc_nulls_first()]
    ordered = encoded.withColumn("content", F.xxhash64("ids")).repartitionByRange(*place, "content", F.monotonically_increasing_id())
    ordered = ordered.withColumn("part", F.spark_partition_id()).sortWithinPartitions(*place, "content")
    return ordered.select("part", "doc_id", "ids").mapInArrow(pack, PIECES)
