"""Token ids on disk under Re-Pair grammars: one grammar for each shard file, with random access to any document.

A shard's ids are one sequence in which each document ends with a mark beyond the vocabulary (the end id itself may also
be an ordinary word piece); reading turns the mark into the end id. Frequent neighbouring pairs become
nonterminals, round after round; a nonterminal never spans a mark, so every document is a run of whole symbols.
Each round counts all pairs by one sort (in a run of one id every second place), takes the most frequent ones and replaces
those occurrences that are more frequent than their neighbours (so that replacements never overlap). Rounds go on until no pair has enough uses to be
worth a rule, or all 16-bit symbols are taken.

Layout of a shard file, little-endian: magic ``RPG1``, then six uint32 (documents, rules, symbols, base id, end id, 0),
then int64 document ids, uint32 symbol offsets (documents + 1), uint32 token counts, uint16 left and right sides of the
rules, uint32 expansion lengths of the rules, uint16 symbols.

Nulls and edges: a null text counts as empty and has the end id alone; a null document id is stored as the least int64
and read as null (nulls first); an empty table writes no file; repeated ids stay separate rows in the order of their
texts' hashes; very long texts make a shard as long as they need; other columns than doc_id and text are not looked at.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import free_memory, fresh_path, joined_batches, read_blob, spread, staged, text_chunks, with_prefix_sums, write_blob
from siltstone.llm.tokenizing import encoder as encoder_of

MAGIC = b"RPG1"
#: Stands for a null document id.
NO_ID = -(1 << 63)
#: Ids of a shard before compression, about; a shard holds whole documents.
SHARD_IDS = 1 << 20
RULES_A_ROUND = 2500
#: A rule takes 8 bytes and each of its uses saves 2.
LEAST_USES = 5

MANIFEST = "part int, shard int, path string, documents long, tokens long, symbols long, rules long"


def pairs_to_rules(seq: np.ndarray, end: int, base: int, rules_a_round: int = RULES_A_ROUND, least: int = LEAST_USES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair over ``seq`` (ids below ``base``): the symbols left, and the rules' left and right sides.

    Symbols must stay below 65536, so at most ``65536 - base`` rules are made.
    """
    seq = seq.astype(np.uint32)
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    made = 0
    while True:
        room = min(rules_a_round, (1 << 16) - base - made)
        if room <= 0 or len(seq) < 2:
            break
        code = (seq[:-1] << np.uint32(16)) | seq[1:]
        open_ = (seq[:-1] != end) & (seq[1:] != end)
        again = np.concatenate([[False], code[1:] == code[:-1]])
        if again.any():
            # In a run of one id its pairs overlap: every second place is one.
            place = np.arange(len(code))
            open_ &= ((place - np.maximum.accumulate(np.where(again, 0, place))) & 1) == 0
        ordered = np.sort(code[open_])
        if not len(ordered):
            break
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        uses = np.diff(first, append=len(ordered))
        often = np.flatnonzero(uses >= least)
        if not len(often):
            break
        often = often[np.argsort(-uses[often], kind="stable")][:room]
        pairs = ordered[first[often]]
        # Pairs by a hash of 16 bits; where two meet, the more frequent one is kept and the other waits for the next round.
        slot = (pairs * np.uint32(2654435761)) >> np.uint32(16)
        table = np.full(1 << 16, len(pairs), np.uint32)
        table[slot[::-1]] = np.arange(len(pairs), dtype=np.uint32)[::-1]
        known = np.append(pairs, 0)
        rank = table[(code * np.uint32(2654435761)) >> np.uint32(16)]
        rank[(known[rank] != code) | ~open_] = len(pairs)
        here = rank < len(pairs)
        here[1:] &= rank[1:] < rank[:-1]
        here[:-1] &= rank[:-1] <= rank[1:]
        at = np.flatnonzero(here)
        if not len(at):
            break
        taken, number = np.unique(rank[at], return_inverse=True)
        left.append((pairs[taken] >> np.uint32(16)).astype(np.uint32))
        right.append(pairs[taken] & np.uint32(0xFFFF))
        seq[at] = (base + made + number).astype(np.uint32)
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq = seq[stay]
        made += len(taken)
    empty = np.empty(0, np.uint32)
    return seq, np.concatenate([empty, *left]), np.concatenate([empty, *right])


def expansions(left: np.ndarray, right: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and offsets, in one pool of ids, of what the rules expand to; rules name earlier rules only."""
    lengths = np.ones(base + len(left), np.int64)
    for k, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        lengths[base + k] = lengths[a] + lengths[b]
    return lengths, np.concatenate([[0], np.cumsum(lengths)])


def expand(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, base: int) -> np.ndarray:
    """All ids of ``symbols``, by replacing every nonterminal with its two sides until none is left."""
    ids = symbols.astype(np.uint32)
    while True:
        inner = ids >= base
        if not inner.any():
            return ids
        size = 1 + inner
        start = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.uint32)
        out[start[~inner]] = ids[~inner]
        rules = ids[inner] - base
        out[start[inner]] = left[rules]
        out[start[inner] + 1] = right[rules]
        ids = out


def expand_all(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """``expand`` for many symbols: every rule is expanded once, and its ids are copied to each of its places."""
    if not len(left):
        return symbols.astype(np.uint32)
    pool = expand(np.arange(base, base + len(left)), left, right, base)
    lengths = lengths.astype(np.int64)
    inner = symbols >= base
    rules = symbols[inner].astype(np.int64) - base
    size = np.ones(len(symbols), np.int64)
    size[inner] = lengths[rules]
    out = np.repeat(symbols.astype(np.uint32), size)
    start = np.cumsum(size) - size
    own = lengths[rules]
    stops = np.cumsum(own)
    within = np.arange(int(stops[-1]) if len(stops) else 0) - np.repeat(stops - own, own)
    first = (np.cumsum(lengths) - lengths)[rules]
    out[np.repeat(start[inner], own) + within] = pool[np.repeat(first, own) + within]
    return out


def encode_shard(doc_ids: np.ndarray, tokens: np.ndarray, counts: np.ndarray, base: int, end: int) -> tuple[bytes, int, int]:
    """The file's bytes, and how many symbols and rules it has. ``tokens`` ends each document with ``base - 1``."""
    symbols, left, right = pairs_to_rules(tokens, base - 1, base)
    stops = np.flatnonzero(symbols == base - 1) + 1
    lengths = expansions(left, right, base)[0][base:]
    head = np.array([len(doc_ids), len(left), len(symbols), base, end, 0], "<u4")
    parts = [head, doc_ids.astype("<i8"), np.concatenate([[0], stops]).astype("<u4"), counts.astype("<u4"), left.astype("<u2"), right.astype("<u2"), lengths.astype("<u4"), symbols.astype("<u2")]
    return MAGIC + b"".join(x.tobytes() for x in parts), len(symbols), len(left)


class ShardFile:
    """A shard file's bytes, with random access by a document's place in the shard."""

    def __init__(self, blob: bytes) -> None:
        if blob[:4] != MAGIC:
            raise ValueError("not a grammar shard")
        n, rules, symbols, self.base, self.end, _ = (int(x) for x in np.frombuffer(blob, "<u4", 6, 4))
        at = 28

        def take(kind: str, k: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, k, at)
            at += out.nbytes
            return out

        self.doc_ids, self.offsets, self.counts = take("<i8", n), take("<u4", n + 1), take("<u4", n)
        self.left, self.right, self.rule_lengths, self.symbols = take("<u2", rules).astype(np.uint32), take("<u2", rules).astype(np.uint32), take("<u4", rules), take("<u2", symbols)

    def document(self, k: int) -> np.ndarray:
        return self._ended(expand(self.symbols[self.offsets[k] : self.offsets[k + 1]], self.left, self.right, self.base))

    def _ended(self, ids: np.ndarray) -> np.ndarray:
        ids[ids == self.base - 1] = self.end
        return ids

    def token(self, k: int, position: int) -> int:
        """One id of a document, by the expansion lengths alone, without expanding the rest."""
        symbols = self.symbols[self.offsets[k] : self.offsets[k + 1]].astype(np.int64)
        lengths = np.ones(len(symbols), np.int64)
        lengths[symbols >= self.base] = self.rule_lengths[symbols[symbols >= self.base] - self.base]
        stops = np.cumsum(lengths)
        i = int(np.searchsorted(stops, position, "right"))
        position -= int(stops[i] - lengths[i])
        s = int(symbols[i])
        while s >= self.base:
            a, b = int(self.left[s - self.base]), int(self.right[s - self.base])
            n = int(self.rule_lengths[a - self.base]) if a >= self.base else 1
            s, position = (a, position) if position < n else (b, position - n)
        return self.end if s == self.base - 1 else s

    def all_tokens(self) -> np.ndarray:
        return self._ended(expand_all(self.symbols, self.left, self.right, self.rule_lengths, self.base))


def write_grammar_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, vocabulary: int = 49408, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode ``docs(doc_id, text)`` in ascending order of ids; returns the manifest, one row for each shard file.

    The manifest names only files of tasks that ended well; a lost task's files are never read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ids, held, counts, n, shard = encoder_of(tokenizer_path), [], [], [], 0, 0
        own, part = uuid.uuid4().hex, None

        def flush() -> pa.RecordBatch:
            nonlocal ids, held, counts, n, shard
            path = f"{folder}/{part:06d}-{shard:06d}-{own}.rpg"
            tokens = np.concatenate(held)
            blob, symbols, rules = encode_shard(np.concatenate(ids), tokens, np.concatenate(counts), vocabulary + 1, end_id)
            write_blob(path, [blob])
            row = [[part], [shard], [path], [sum(map(len, counts))], [len(tokens)], [symbols], [rules]]
            ids, held, counts, n, shard = [], [], [], 0, shard + 1
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4])], ["part", "shard", "path", "documents", "tokens", "symbols", "rules"])

        for batch in text_chunks(joined_batches(batches)):
            part = batch.column("part")[0].as_py()
            flat, sizes = encoder.encode(batch.column("text"))
            out = np.empty(len(flat) + len(sizes), np.uint32)
            stops = np.cumsum(sizes + 1)
            out[stops - 1] = vocabulary
            inner = np.ones(len(out), bool)
            inner[stops - 1] = False
            out[inner] = flat
            ids.append(pa.compute.fill_null(batch.column("doc_id").cast(pa.int64()), NO_ID).to_numpy())
            held.append(out)
            counts.append(sizes + 1)
            n += len(out)
            if n >= shard_ids:
                yield flush()
        if n:
            yield flush()
        free_memory()

    # Rows of one id, null ids among them, are dealt on by their texts and at last by their place, so they may fill many tasks.
    key = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = docs.select("doc_id", "text").repartitionByRange(*key)
    ordered = ordered.withColumn("part", F.spark_partition_id()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return staged(ordered.mapInArrow(write, MANIFEST), "grammar-manifest")


def read_grammar_shards(manifest: DataFrame) -> DataFrame:
    """Every document of the files in ``manifest``: its id, place among all ids, number of ids and their crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                shard = ShardFile(read_blob(path))
                tokens, counts = shard.all_tokens().astype("<u4"), shard.counts.astype(np.int64)
                stops = np.cumsum(counts)
                crcs = [zlib.crc32(tokens[b - n : b]) for b, n in zip(stops.tolist(), counts.tolist())]
                ids = pa.array(shard.doc_ids.astype(np.int64), mask=shard.doc_ids == NO_ID)
                yield pa.RecordBatch.from_arrays([ids, pa.array(start + stops - counts), pa.array(counts), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = with_prefix_sums(manifest, "part", ["shard"], {"before": "tokens"})
    return placed.select("path", "before", "part", "shard").transform(spread, "part", "shard").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def grammar_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Write ``docs`` as grammar shards in the shared folder and read every document back from them."""
    return read_grammar_shards(write_grammar_shards(docs, fresh_path(docs.sparkSession, "grammar"), tokenizer_path, end_id))
