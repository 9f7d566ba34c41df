"""Whole-text token ids by the ``tokenizers`` library, with a bounded memo of pieces of text.

The vocabulary's normaliser and splitter never look across an ASCII blank or line end, so a text's ids are those of
its blank-separated pieces, in order. Pieces repeat; each distinct one is encoded once and looked up afterwards.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct pieces that a worker remembers; beyond it those that few calls used are forgotten. Bounds memory, never results.
#: Arrow indexes them anew for each call, so more of them cost time as well, and calls should have some MB of text.
MEMO_PIECES = 250_000

#: A text with other characters than Latin-1 keeps its case here: only the vocabulary's own normaliser treats it.
_WIDE = r"[^\x{00}-\x{ff}]"
#: ASCII marks between a letter and a blank are a run of their own for the vocabulary's splitter. Those of which special
#: tokens are made are left out.
_MARK = r"([a-z\x{df}-\x{f6}\x{f8}-\x{ff}])([.,;:!?%*&$#()\"-]+)( |$)"
_LETTERS = r"^[a-z\x{df}-\x{f6}\x{f8}-\x{ff}]+$"
#: Byte-level vocabularies spell bytes that print nothing as characters from 256 on, in order; of the bytes of these
#: letters in UTF-8 only three are such.
_SPELT = [(chr(b), chr(256 + [*range(33), *range(127, 161), 173].index(b))) for b in (0x9F, 0xA0, 0xAD)]


@lru_cache(maxsize=1)
def encoder(path: str, memo_pieces: int = MEMO_PIECES) -> PieceEncoder:
    """One encoder for all tasks of a worker process, so that they share its memo; another one takes its place."""
    return PieceEncoder(path, memo_pieces)


@lru_cache(maxsize=8)
def id_type(path: str) -> tuple[str, int]:
    """The numpy type that holds the vocabulary's ids, and how many ids there are."""
    from tokenizers import Tokenizer

    size = 1 + max(Tokenizer.from_file(path).get_vocab().values())
    return ("<u2" if size <= 1 << 16 else "<u4"), size


class PieceEncoder:
    """``encode(texts)`` gives one flat uint16/uint32 array of ids and each text's count."""

    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        spec = json.loads(open(path, encoding="utf-8").read())
        self.letters = None
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        if spec["model"].get("end_of_word_suffix") and len(steps) == 2 and steps[0].get("type") == "Split" and steps[1].get("type") == "ByteLevel":
            # Of lower-case Latin-1 letters alone, the normaliser changes nothing and the splitter finds one word.
            spec["normalizer"], spec["pre_tokenizer"] = None, {"type": "WhitespaceSplit"}
            self.letters = Tokenizer.from_str(json.dumps(spec))
            suffix = spec["model"]["end_of_word_suffix"]
            vocab = self.whole.get_vocab()
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        special = {t["content"]: t["id"] for t in spec.get("added_tokens") or [] if t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"])}
        self.mark = next(iter(special.items()), None) if not any(t.get("normalized") for t in spec.get("added_tokens") or []) else None
        self.memo_pieces = memo_pieces
        # The memo: pieces, their ids as bytes, and in how many calls each was used.
        self.keys, self.ids, self.uses = pa.array([], pa.large_string()), pa.array([], pa.large_binary()), np.zeros(0, np.int32)

    def _forget(self) -> None:
        """Keep the half of the memo that most calls have used; earlier calls count half."""
        keep = np.sort(np.argsort(-self.uses, kind="stable")[: self.memo_pieces // 2])
        self.keys, self.ids, self.uses = self.keys.take(pa.array(keep)), self.ids.take(pa.array(keep)), self.uses[keep] // 2

    def _learn(self, pieces: pa.Array) -> None:
        """Encode and remember ``pieces``, each of them new."""
        found: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []  # pieces, their ids, and where each one's stop
        left = pieces
        if self.letters is not None:
            plain = pc.match_substring_regex(pieces, _LETTERS)
            words = pieces.filter(plain)
            if len(words):
                cuts = np.append(np.arange(0, len(words), 512), len(words)).astype(np.int32)
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words.cast(pa.string())), " ").to_pylist()
                joined = [x.encode().decode("latin-1") for x in joined]
                for byte, spelt in _SPELT:
                    joined = [x.replace(byte, spelt) for x in joined]
                ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.letters.encode_batch_fast(joined, add_special_tokens=False)])
                stops = np.flatnonzero(self.ends[ids]) + 1
                if len(stops) == len(words) and stops[-1] == len(ids):
                    found.append((words, ids, stops))
                    left = pieces.filter(pc.invert(plain))
        rest = left.to_pylist()
        if self.mark is not None:
            # A special token between pieces parts them before anything else looks at the text.
            name, number = self.mark
            free, rest = [p for p in rest if name not in p], [p for p in rest if name in p]
            for i in range(0, len(free), 512):
                some = free[i : i + 512]
                ids = np.array(self.whole.encode(name.join(["", *some, ""]), add_special_tokens=False).ids, np.uint32)
                marks = np.flatnonzero(ids == number)
                if len(marks) == len(some) + 1:
                    found.append((pa.array(some, pa.large_string()), ids[ids != number], marks[1:] - np.arange(1, len(marks))))
                else:
                    rest += some
        if rest:
            each = [np.array(e.ids, np.uint32) for e in self.whole.encode_batch_fast(rest, add_special_tokens=False)]
            found.append((pa.array(rest, pa.large_string()), np.concatenate(each), np.cumsum([len(x) for x in each])))
        blobs = []
        for some, ids, stops in found:
            offsets = np.concatenate([[0], stops]).astype(np.int64) * ids.itemsize
            blobs.append(pa.Array.from_buffers(pa.large_binary(), len(some), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]))
        self.keys, self.ids = pa.concat_arrays([self.keys, *(some for some, _, _ in found)]), pa.concat_arrays([self.ids, *blobs])
        self.uses = np.concatenate([self.uses, np.zeros(len(pieces), np.int32)])

    def encode(self, texts: pa.Array | pa.ChunkedArray | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has. A null or empty text has none."""
        if len(self.keys) > self.memo_pieces:
            self._forget()
        column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else pc.cast(texts, pa.large_string())
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column, "")
        if not len(column):
            return np.empty(0, np.uint32), np.zeros(0, np.int64)
        column = pc.if_else(pc.match_substring_regex(column, _WIDE), column, pc.utf8_lower(column))
        for blank in "\n\t\r":
            column = pc.replace_substring(column, blank, " ")
        column = pc.replace_substring_regex(column, _MARK, r"\1 \2\3")
        lists = pc.split_pattern(column, " ")
        pieces, known = lists.flatten(), len(self.keys)
        found = pc.index_in(pieces, self.keys)
        at = np.array(pc.fill_null(found, 0))
        if found.null_count:
            gaps = found.is_null()
            new = pieces.filter(gaps).dictionary_encode()
            self._learn(new.dictionary)
            places = known + pc.index_in(new.dictionary, self.keys.slice(known)).to_numpy()
            at[gaps.to_numpy(zero_copy_only=False)] = places[new.indices.to_numpy()]
        used = np.zeros(len(self.keys), bool)
        used[at] = True
        self.uses += used
        taken = self.ids.take(pa.array(at))
        _, offsets, data = taken.buffers()
        stops = np.frombuffer(offsets, np.int64, len(at) + 1) // 4
        flat = np.frombuffer(data, np.uint32, int(stops[-1])) if stops[-1] else np.empty(0, np.uint32)
        text_stops = stops[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return flat, np.diff(text_stops)
