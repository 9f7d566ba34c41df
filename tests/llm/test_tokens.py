"""Token files, grammar shards and packing against plain encoding."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from siltstone.llm.common import joined_batches
from siltstone.llm.packing import ShardIndex, corpus_statistics, encode_documents, fill_windows, fit_router, pack_documents
from siltstone.llm.queries import word_bpe
from siltstone.llm.repair_store import ShardFile, encode_shard, expand, grammar_round_trip, pairs_to_rules
from siltstone.llm.token_counts import count_tokens, scan_separators
from siltstone.llm.tokenizing import PieceEncoder


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_bpe())


def ids_of(whole, text):
    return whole.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_ids_of_whole_texts(whole, rows):
    texts = [r[1] for r in rows] + ["hello...\nworld., x.!", "x　y \x00z", "ΑΣ Σ. İx", "H̱ ẖ", "a.b.c, 'tis don't", "x. y. z"]
    encoder = PieceEncoder(word_bpe(), memo_pieces=50)
    for _ in range(2):
        flat, counts = encoder.encode(texts)
        parts = np.split(flat, np.cumsum(counts)[:-1])
        assert [p.tolist() for p in parts] == [ids_of(whole, t) for t in texts]


def test_memo_keeps_what_earlier_calls_used(whole):
    encoder, learned = PieceEncoder(word_bpe(), memo_pieces=60), Counter()
    learn = encoder._learn

    def counted(pieces, *more):
        learned.update(pieces.tolist())
        return learn(pieces, *more)

    encoder._learn = counted
    often = [f"{a}{b}often" for a in "abcde" for b in "fgh"]
    for k in range(10):
        # Often used words in every third call, between them always new ones that overflow the memo.
        text = " ".join(often if k < 4 or k % 3 == 0 else [f"w{k}x{j}" for j in range(70)])
        assert encoder.encode([text])[0].tolist() == ids_of(whole, text)
    assert {learned[w] for w in often} == {1}


def test_short_texts_are_encoded_together():
    batches = [pa.record_batch({"doc_id": [k, None], "text": ["ab", None]}) for k in range(50)]
    got = list(joined_batches(iter(batches), limit=20))
    assert [b.num_rows for b in got] == [20] * 5 and pa.Table.from_batches(got) == pa.Table.from_batches(batches).combine_chunks()
    assert [b.num_rows for b in joined_batches(iter(batches), rows=30)] == [30, 30, 30, 10]
    assert [b.num_rows for b in joined_batches(iter(batches), limit=1)] == [2] * 50 and not list(joined_batches(iter([])))


def test_routing_of_a_large_batch_is_that_of_its_parts(spark):
    every = [np.append(np.random.default_rng(k).integers(3, 90, k % 40), 2).astype("<u2") for k in range(2100)]
    sample = spark.createDataFrame([(d.tobytes(),) for d in every[:300]], "ids binary")
    router, sizes = fit_router(sample, "<u2", 100, 50), np.array([len(d) for d in every])
    whole, single = router.places(np.concatenate(every), sizes), [router.places(d, np.array([len(d)])) for d in every]
    assert all(w.tolist() == [s[i][0] for s in single] for i, w in enumerate(whole))


def test_grammar_round_trip(spark, docs, empty, rows, whole):
    got = [tuple(r) for r in grammar_round_trip(docs, word_bpe()).collect()]
    want, at = [], 0
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*ids_of(whole, r[1]), 1]
        want.append((r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted((g[0] is not None, g[0] or 0, g[2], g[3]) for g in got) == sorted((w[0] is not None, w[0] or 0, w[1], w[2]) for w in want)
    spans = sorted((g[1], g[2], g[0] is not None, g[0] or 0) for g in got)
    assert [s[0] for s in spans] == [0, *np.cumsum([s[1] for s in spans])[:-1].tolist()] and sum(s[1] for s in spans) == at
    assert [s[2:] for s in spans] == sorted(s[2:] for s in spans)
    assert grammar_round_trip(empty, word_bpe()).count() == 0


def test_grammar_random_access():
    rng = np.random.default_rng(0)
    documents = [np.append(rng.choice([5, 6, 7, 1], rng.integers(0, 400), p=[0.5, 0.3, 0.1, 0.1]), 100) for _ in range(40)]
    blob, symbols, rules = encode_shard(np.arange(40), np.concatenate(documents), np.array([len(d) for d in documents]), 101, 1)
    shard = ShardFile(blob)
    assert rules > 0 and symbols < sum(map(len, documents))
    for k, d in enumerate(documents):
        full = [*d[:-1].tolist(), 1]
        assert shard.document(k).tolist() == full
        assert [shard.token(k, p) for p in range(len(full))] == full
    assert shard.all_tokens().tolist() == [x for d in documents for x in [*d[:-1].tolist(), 1]]


def test_rules_never_span_a_mark():
    seq = np.array([3, 4, 9, 3, 4, 9, 3, 4, 9] * 30)
    symbols, left, right = pairs_to_rules(seq, 9, 10, least=2)
    assert 9 not in left and 9 not in right and expand(symbols, left, right, 10).tolist() == seq.tolist()


def test_separator_scan_stitches_blocks(spark, tmp_path):
    rng = np.random.default_rng(1)
    files, want = [], []
    for f in range(3):
        sizes = rng.integers(0, 50, 40).tolist() + [0, 0, 300]
        flat = np.concatenate([np.append(rng.integers(0, 90, n), 99) for n in sizes] + ([rng.integers(0, 90, 7)] if f else []))
        (tmp_path / f"{f}.bin").write_bytes(flat.astype("<u2").tobytes())
        files.append((f"file://{tmp_path}/{f}.bin", 2 * len(flat)))
        want += [(files[-1][0], k, n, True) for k, n in enumerate(sizes)] + ([(files[-1][0], len(sizes), 7, False)] if f else [])
    (tmp_path / "none.bin").write_bytes(b"")
    files.append((f"file://{tmp_path}/none.bin", 0))
    df = spark.createDataFrame(files, "path string, bytes long")
    for block in (2, 64, 1 << 20):
        got = [(r.path, r.ordinal, r.n_tokens, r.closed) for r in scan_separators(df, separator=99, block_bytes=block).collect()]
        assert sorted(got) == sorted(want)


def test_count_tokens(docs, empty, rows, whole):
    got = sorted((r.doc_id or -1, r.n_tokens) for r in count_tokens(docs, word_bpe()).collect())
    assert got == sorted((r[0] or -1, len(ids_of(whole, r[1]))) for r in rows)
    assert count_tokens(empty, word_bpe()).count() == 0


def test_packing_covers_every_id_once(docs, empty, rows, whole):
    pieces = pack_documents(docs, word_bpe(), shard_ids=20_000).collect()
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [0, *np.cumsum([p.length for p in own])[:-1].tolist()]
        total = sum(p.length for p in own)
        assert total <= 4096 and total & (total - 1) == 0
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append((p.start, p.length, bytes(p.ids)))
    for r in rows:
        if r[0] is not None and r[0] != 10:
            own = sorted(by_doc[r[0]])
            assert np.frombuffer(b"".join(x[2] for x in own), "<u4").tolist() == [*ids_of(whole, r[1]), 2]
    assert sum(p.length for p in pieces) == sum(len(ids_of(whole, r[1])) + 1 for r in rows)
    assert pack_documents(empty, word_bpe()).count() == 0


def test_windows_take_the_nearest_neighbour_first():
    alike = [np.array([7, 8, 9, 2]), np.array([1, 3, 4, 2]), np.array([7, 8, 9, 2]), np.array([5, 6, 11, 2])]
    pieces = fill_windows([len(a) for a in alike], ShardIndex(alike), window=8)
    assert [p[0] for p in pieces if p[3] == 0] == [0, 2]


def test_windows_use_all_neighbours_and_all_terms():
    end = [2]
    copies, others = [np.array([50, 51, 52, 53, *end])] * 200, [np.array([60 + k, 61 + k, 62 + k, 63 + k, *end]) for k in range(0, 800, 4)]
    mixed = [d for pair in zip(copies, others) for d in pair]
    pieces = fill_windows([len(d) for d in mixed], ShardIndex(mixed), window=1000)
    assert [p[0] for p in pieces if p[3] == 0] == list(range(0, 400, 2))  # all 200 copies, and no other document
    # Of 41 terms only the commonest is shared with the third document; the second shares none.
    many = [np.array([*range(100, 140), 9, *end]), np.array([7, 8, *end]), np.array([9, 5, *end]), *(np.array([*range(100, 140), *end]) for _ in range(2)), *(np.array([9, 300 + k, *end]) for k in range(30))]
    index = ShardIndex(many)
    assert index.scores(0)[2] > 0 and index.scores(0)[1] == 0


def test_weights_are_those_of_all_documents(spark):
    every = [np.array([5, 6, 6, 2], "<u2"), np.array([5, 7, 2], "<u2"), np.array([5, 2], "<u2"), np.array([2], "<u2")]
    encoded = spark.createDataFrame([(d.tobytes(),) for d in every], "ids binary").repartition(3)
    n, mean, df = corpus_statistics(encoded)
    assert (n, mean, df[[2, 5, 6, 7]].tolist()) == (4, 1.5, [0, 3, 1, 1])
    own, shard = ShardIndex(every), ShardIndex(every[:2], (n, mean, df))
    assert np.allclose(shard.scores(0), own.scores(0)[:2])


def test_grammar_of_copies_has_a_few_symbols_each():
    text = np.append(np.random.default_rng(0).integers(0, 40_000, 4096), 49408)
    symbols, left, right = pairs_to_rules(np.tile(text, 50), 49408, 49409)
    assert len(symbols) <= 50 * 8 and expand(symbols, left, right, 49409).tolist() == np.tile(text, 50).tolist()


def plain_scores(documents, seed):
    """BM25 of every document against all distinct terms of the seed, by the formula."""
    bare = [d[:-1].tolist() for d in documents]
    n, mean = len(bare), sum(map(len, bare)) / len(bare)
    df = Counter(t for d in bare for t in set(d))
    out = []
    for d in bare:
        tf = Counter(d)
        out.append(sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(d) / mean)) for t in set(bare[seed]) if tf[t]))
    return out


def plain_windows(documents, window):
    """Documents in the order in which windows take them up."""
    unused, order, filled = set(range(len(documents))), [], 0

    def take(k):
        unused.discard(k)
        order.append(k)

    seed = rest = None
    while unused or rest:
        if rest is None:
            seed = min(unused)
            take(seed)
            rest = len(documents[seed])
        scores = plain_scores(documents, seed)
        while rest:
            used = min(rest, window - filled)
            filled, rest = filled + used, rest - used
            if filled == window:
                filled = 0
                seed = order[-1]
                break
            near = [k for k in unused if scores[k] > 1e-9]
            if not rest and near:
                k = min(near, key=lambda k: (-round(scores[k], 4), k))
                take(k)
                rest = len(documents[k])
        rest = rest or None
    return order


def test_scores_and_order_match_plain_bm25():
    rng = np.random.default_rng(3)
    for _ in range(6):
        documents = [np.append(rng.zipf(1.4, rng.integers(0, 40)) % 60 + 3, 2) for _ in range(60)]
        documents += documents[:10]
        index = ShardIndex(documents)
        for seed in range(0, 70, 9):
            got, want = index.scores(seed), np.array(plain_scores(documents, seed))
            want[seed] = got[seed]  # a seed's own score is never used
            assert np.allclose(got, want, rtol=1e-4, atol=1e-4)
        pieces = fill_windows([len(d) for d in documents], index, window=64)
        assert list(dict.fromkeys(p[0] for p in pieces)) == plain_windows(documents, 64)


def test_routing_puts_like_documents_side_by_side(spark):
    rng = np.random.default_rng(5)
    tongues = [["".join(rng.choice(list("bcdfglmnprst"), 3)) + v for _ in range(150)] for v in "aeiu"]
    texts = [" ".join(rng.choice(tongues[k % 4], 60)) for k in range(240)]
    texts += texts[:8]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sample = encode_documents(docs, word_bpe(), 2, "<u2").persist()
    router = fit_router(sample, "<u2", 49408)
    places = {r.doc_id: (r.leaf, r["first"], r.second) for r in encode_documents(docs, word_bpe(), 2, "<u2", router).collect()}
    order = sorted(places, key=places.get)
    turns = sum(a % 4 != b % 4 for a, b in zip([k - 240 if k >= 240 else k for k in order], [k - 240 if k >= 240 else k for k in order[1:]]))
    assert turns <= 12  # in any order of chance some 180
    assert all(places[k] == places[240 + k] for k in range(8))


def test_wide_ids_are_kept():
    from siltstone.llm import token_counts

    assert token_counts.id_width(word_bpe(), 49408) == 2 and token_counts.id_width(word_bpe(), 1 << 16) == 4


def textbook_grammar(seq, end, base, least):
    """Re-Pair one pair at a time: symbols and rules left."""
    seq, rules = list(seq), 0
    while True:
        counts, last = Counter(), {}
        for k, pair in enumerate(zip(seq, seq[1:])):
            if end not in pair and last.get(pair) != k - 1:
                counts[pair] += 1
                last[pair] = k
        if not counts or max(counts.values()) < least:
            return len(seq), rules
        pair = max(counts, key=lambda p: (counts[p], p))
        out, k = [], 0
        while k < len(seq):
            if tuple(seq[k : k + 2]) == pair:
                out.append(base + rules)
                k += 2
            else:
                out.append(seq[k])
                k += 1
        seq, rules = out, rules + 1


@pytest.mark.parametrize("case", ["random", "runs", "one", "two", "copies"])
def test_grammar_is_about_as_small_as_the_textbook_one(case):
    rng = np.random.default_rng(9)
    seq = {
        "random": rng.zipf(1.5, 4000) % 50,
        "runs": np.repeat(rng.integers(0, 6, 300), rng.integers(1, 40, 300)),
        "one": np.full(5000, 5),
        "two": np.tile([5, 6], 2500),
        "copies": np.tile(np.append(rng.integers(0, 90, 150), 99), 30),
    }[case]
    symbols, left, right = pairs_to_rules(seq, 99, 100)
    assert expand(symbols, left, right, 100).tolist() == seq.tolist()
    n, rules = textbook_grammar(seq.tolist(), 99, 100, 5)
    assert len(symbols) + 2 * len(left) <= 1.2 * (n + 2 * rules) + 10
