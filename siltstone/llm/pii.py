"""Personal data: base patterns, and a linear-chain conditional random field over word shapes.

Base kinds (leftmost, non-overlapping for each kind) are found by patterns and checks. The field adds spans that have no
fixed form: secrets, names after a title or a cue, and street addresses. Its features are a word's shape, its length, the
cue it holds, and the same of its neighbours. It is trained on a small table labelled by hand (``pii_labels``; every fourth
sentence is held out and measured, see ``scores_by_kind``) and on lines without personal data, by gradient descent on the
exact likelihood, and decoded by Viterbi in numpy batches.

Most words are so surely no part of a span that every best path takes them as such, whatever stands beside them: their
margin exceeds what two transitions can give. Paths are cut there, exactly, and only the short rest is decoded.

Nulls and edges: null and empty texts have no spans; a match that fails its check is dropped without another try; spans of
the field that touch a base span are dropped; offsets are code points, ends exclusive; null, tied and repeated ids stay
separate rows; very long texts are read whole, at one time if they are a single row; an empty table gives no rows;
``find_personal_data`` looks at no other columns than doc_id and text, ``redact_documents`` returns them unchanged.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from siltstone.llm.common import bounded_batches, free_memory, map_in_arrow, text_chunks
from siltstone.llm.pii_labels import SENTENCES

BASE_KINDS = ("email", "ip", "card", "phone")
FIELD_KINDS = ("secret", "name", "address")
KINDS = BASE_KINDS + FIELD_KINDS

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match that begins inside a run of digits ends as one from its beginning does, so only beginnings are tried.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c)
        if k % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    at = done = 0
    while (at := text.find("@", at)) >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", begin, m.end()))
            at = done = m.end()
        else:
            at += 1
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (part.lstrip("0") for part in m[0].split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# --- the field -------------------------------------------------------------------------------------------------------

LABELS = ("O", "B-secret", "I-secret", "B-name", "I-name", "B-address", "I-address")
CUES = {
    "secret": "password passwd pwd secret token apikey credential credentials bearer passphrase passwort contraseña",
    "title": "mr mrs ms dr prof mr. mrs. ms. dr. prof. herr frau señor señora sr. sra. monsieur madame mme",
    "named": "named name name's nombre prénom vorname signed firmado signé",
    "street": "street st. st avenue ave. ave road rd. rd boulevard lane drive square straße strasse calle rue platz",
}
_CUE = {w: c for c, ws in CUES.items() for w in ws.split()}
_EDGE = "\"'.,;:!?()[]{}<>"
_PARTS = re.compile(r"[\W_]+")


def shape(word: str) -> str:
    """Upper and lower case, digits and other characters as classes, runs as one; words of more than eight runs are one class."""
    runs = re.sub(r"(.)\1+", r"\1", "".join("X" if c.isupper() else "x" if c.isalpha() else "d" if c.isdigit() else c for c in word), flags=re.S)
    return runs if len(runs) <= 8 else "long"


def names_secret(head: str) -> bool:
    """Whether a name such as ``DB_PASSWORD`` or ``api-key`` is one of a secret."""
    parts = _PARTS.split(head.lower())
    return any(_CUE.get(p) == "secret" for p in parts) or any(a in ("api", "access", "private", "secret") and b == "key" for a, b in zip(parts, parts[1:]))


def word_features(word: str) -> tuple[str, ...]:
    bare = word.strip(_EDGE)
    lower = word.lower()
    head, sign, tail = bare.partition("=") if "=" in bare else bare.partition(":")
    digits = sum(c.isdigit() for c in bare)
    upper = sum(c.isupper() for c in bare)
    out = ["any", f"shape={shape(bare)}", f"len={min(len(bare) // 4, 8)}"]
    if not bare.isalnum():
        out.append("symbols")
    cue = _CUE.get(lower.rstrip(":,;\"'")) or _CUE.get(bare.lower())
    if cue is None and not sign and names_secret(bare):
        cue = "secret"
    if cue:
        out.append(f"cue={cue}")
        if word[-1] in ":=":
            out.append(f"sets={cue}")
    if sign and tail and names_secret(head):
        out.append("assigned")
    if word in ("=", ":"):
        out.append("sign")
    if digits >= 3 and digits < len(bare) and len(bare) >= 14 and bare.isalnum():
        out.append("mixed")
    if digits and digits < len(bare):
        out.append("some digits")
    if re.fullmatch(r"[0-9a-f]{16,}", tail.strip(_EDGE) or bare) and digits >= 2:
        out.append("hex")
    if re.fullmatch(r"(AKIA|ASIA)[A-Z0-9]{12,}|(ghp_|sk-|xox[bp]-)[A-Za-z0-9_-]{12,}", bare):
        out.append("keyform")
    if len(bare) >= 16 and bare.isalnum() and upper + digits == len(bare) and digits and upper:
        out.append("upper-mixed")
    if word[:1] in "\"'":
        out.append("quoted")
    if bare[:1].isupper() and bare[1:].islower():
        out.append("capital")
    if lower.strip(_EDGE).endswith(("straße", "strasse")):
        out.append("street ending")
    if bare.isdigit():
        out.append(f"number={min(len(bare), 6)}")
    return tuple(out)


_MARK = re.compile(r"\{(\w+):([^{}]*)\}")


def labelled(sentence: str) -> list[tuple[str, str]]:
    """(word, label) of a sentence with its spans marked as ``{kind:words}``."""
    plain, spans, at = "", [], 0
    for m in _MARK.finditer(sentence):
        plain += sentence[at : m.start()]
        spans.append((m[1], len(plain), len(plain) + len(m[2])))
        plain, at = plain + m[2], m.end()
    plain += sentence[at:]
    row, open_ = [], None
    for m in re.finditer(r"\S+", plain):
        own = next((s for s in spans if s[1] < m.end() and m.start() < s[2]), None)
        row.append((m[0], "O" if own is None else f"{'I' if own is open_ else 'B'}-{own[0]}"))
        open_ = own
    return row


def labelled_table(held_out: bool = False) -> list[list[tuple[str, str]]]:
    """The labelled sentences that are trained on, or every fourth, which is not."""
    return [labelled(x) for k, x in enumerate(SENTENCES.splitlines()) if (k % 4 == 3) == held_out]


def background() -> list[list[tuple[str, str]]]:
    """Lines without personal data, made by rule: invented words, numbers, marks, repeated words, hashes, addresses of the base kinds."""
    rng = np.random.default_rng(7)
    syllables = "an er on the in ti th ou re ed st at ha nd or as en le qu eau ent ung sch lich que ado ción ra es de la".split()

    def filler(n: int) -> list[str]:
        out = []
        for k in range(n):
            w = "".join(rng.choice(syllables, rng.integers(1, 5)))
            if k == 0 or rng.random() < 0.15:
                w = w.capitalize()
            if rng.random() < 0.1:
                w += str(rng.choice([".", ",", ".", ";", "?"]))
            if rng.random() < 0.03:
                w = str(rng.integers(0, 10 ** int(rng.integers(1, 6))))
            out.append(w)
        return out

    def hexa(n: int) -> str:
        return "".join(rng.choice(list("0123456789abcdef"), n))

    plain = [f"{hexa(6)}@mail.example.com", "10.20.30.40", "+1 (555) 555-0100", "4111111111111111", "http://example.com/a?b=1", "|", "<b>", "##", "a=b", "x=1"]
    plain_cues = "st road street avenue lane calle rue straße is was es est key the la in der token password".split()
    marks = ["%%%", "***", "&&&", "$$$", "###", "!!", "<>", "|", "--", "...", "©"]
    rows = []
    for k in range(300):
        row = filler(int(rng.integers(1, 10)))
        if k % 6 == 0:
            row += str(rng.choice(plain)).split(" ")
        elif k % 6 == 1:
            row += [row[0].strip(".,;?")] * int(rng.integers(3, 9))
        elif k % 6 == 2:
            row = [w + str(rng.choice(marks)) if rng.random() < 0.7 else str(rng.choice(marks)) for w in row]
        elif k % 6 == 3:
            row = [f"{w[: int(rng.integers(1, 6))].capitalize()}{rng.choice(['', '.', ','])}" for w in row]
        elif k % 6 == 4:
            row = [w.upper() + str(rng.choice(["", "!!"])) for w in row] if k % 12 == 4 else [*row, hexa(int(rng.choice([32, 40, 64])))]
        if k % 5 == 0:
            # Words of addresses and of other cues without what makes them one.
            row += [str(rng.choice(plain_cues)) + str(rng.choice(["", "."])), filler(1)[0].capitalize()]
        rows.append([(w, "O") for w in row + filler(int(rng.integers(0, 7)))])
    return rows


#: Places of a word that an emission sees: itself, the one before, the one after, the one before that.
SIDES = 4
#: Where training starts from, and what it is drawn to: an ordinary word's own weight for no label.
PRIOR = {"0any": 4.0, "0shape=x": 6.0, "0symbols": 2.0}


class Field:
    """Weights of a trained linear chain, and the emissions of words."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, transitions: np.ndarray, begin: np.ndarray) -> None:
        self.index, self.weights, self.transitions, self.begin = index, weights, transitions, begin
        # What label y may gain over O from the transitions on both sides, at most.
        into = np.vstack([transitions, begin]) - np.append(transitions[:, 0], begin[0])[:, None]
        self.gain = into.max(axis=0) + np.maximum((transitions - transitions[0]).max(axis=1), 0)
        self.memo: dict[tuple[str, ...], np.ndarray] = {}
        self.plain = self._rows(word_features("word"))

    def _rows(self, features: tuple[str, ...]) -> np.ndarray:
        """(SIDES, labels): what a word adds to its own, the next, the previous and the next but one word's emissions."""
        if (row := self.memo.get(features)) is None:
            row = np.zeros((SIDES, len(LABELS)))
            for side in range(SIDES):
                for f in features:
                    if (k := self.index.get(f"{side}{f}")) is not None:
                        row[side] += self.weights[k]
            if len(self.memo) < 200_000:
                self.memo[features] = row
        return row

    def emissions(self, rows: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(words, labels) of words whose rows are ``rows[at]``; ``starts`` marks the first word of each line."""
        e = rows[at, 0]
        ahead = ~np.append(starts[1:], True)
        e[1:][~starts[1:]] += rows[at[:-1][~starts[1:]], 1]
        e[:-1][ahead[:-1]] += rows[at[1:][ahead[:-1]], 2]
        both = ~(starts[2:] | starts[1:-1])
        e[2:][both] += rows[at[:-2][both], 3]
        return e

    def decode(self, e: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The best label of every word."""
        n = len(e)
        labels = np.zeros(n, np.int8)
        if not n:
            return labels
        sure = (e[:, :1] - e[:, 1:] > self.gain[1:]).all(axis=1)
        open_ = np.flatnonzero(~sure)
        if not len(open_):
            return labels
        first = np.concatenate([[True], (np.diff(open_) > 1) | starts[open_[1:]]])
        begins = open_[first]
        stops = np.append(open_[np.flatnonzero(first)[1:] - 1], open_[-1]) + 1
        lengths = stops - begins
        order = np.argsort(-lengths, kind="stable")
        for k in range(0, len(order), 4096):
            some = order[k : k + 4096]
            self._viterbi(e, starts, begins[some], lengths[some], labels)
        return labels

    def _viterbi(self, e: np.ndarray, starts: np.ndarray, begins: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> None:
        """Segments, longest first. A neighbour outside a segment but in its line has the label O."""
        a = self.transitions
        last = begins + lengths
        closed = (last < len(e)) & ~starts[np.minimum(last, len(e) - 1)]
        score = e[begins] + np.where(starts[begins][:, None], self.begin, a[0])
        back = []
        alive = len(begins)
        for t in range(1, int(lengths[0])):
            alive = int(np.searchsorted(-lengths, -t, "left"))
            total = score[:alive, :, None] + a
            best = total.argmax(axis=1)
            score[:alive] = np.take_along_axis(total, best[:, None, :], 1)[:, 0] + e[begins[:alive] + t]
            back.append(best)
        score += np.where(closed[:, None], a[:, 0], 0)
        label = score.argmax(axis=1)
        labels[begins + lengths - 1] = label
        for t in range(int(lengths[0]) - 1, 0, -1):
            some = back[t - 1]
            k = len(some)
            label[:k] = some[np.arange(k), label[:k]]
            labels[begins[:k] + t - 1] = label[:k]


def train(rows: list[list[tuple[str, str]]], rounds: int = 90, rate: float = 0.4, decay: float = 1e-3) -> Field:
    """Maximum likelihood by forward and backward sums over all rows at once, with AdaGrad."""
    s = len(LABELS)
    index: dict[str, int] = {}
    longest = max(map(len, rows))
    active, gold = [], np.full((len(rows), longest), -1)
    for i, row in enumerate(rows):
        features = [word_features(w) for w, _ in row]
        for t, (_, label) in enumerate(row):
            gold[i, t] = LABELS.index(label)
            near = [(0, t), (1, t - 1), (2, t + 1), (3, t - 2)]
            active += [(i, t, index.setdefault(f"{side}{f}", len(index))) for side, at in near if 0 <= at < len(row) for f in features[at]]
    i, t, f = np.array(active).T
    lengths = np.array([len(r) for r in rows])
    w, a, b = np.zeros((len(index), s)), np.zeros((s, s)), np.zeros(s)
    for feature, start in PRIOR.items():
        if feature in index:
            w[index[feature], 0] = start
    centre = w.copy()
    gw, ga, gb = np.full_like(w, 1e-6), np.full_like(a, 1e-6), np.full_like(b, 1e-6)
    there = gold >= 0
    want = np.zeros((len(rows), longest, s))
    np.put_along_axis(want, np.maximum(gold, 0)[:, :, None], there[:, :, None].astype(float), 2)
    want_a = np.einsum("rti,rtj->ij", want[:, :-1], want[:, 1:])
    lse = lambda x, axis: np.log(np.exp(x - (m := x.max(axis=axis, keepdims=True))).sum(axis=axis)) + m.squeeze(axis)
    for _ in range(rounds):
        e = np.zeros((len(rows), longest, s))
        np.add.at(e, (i, t), w[f])
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0] + b
        for k in range(1, longest):
            alpha[:, k] = np.where(there[:, k, None], lse(alpha[:, k - 1, :, None] + a, 1) + e[:, k], alpha[:, k - 1])
        for k in range(longest - 2, -1, -1):
            beta[:, k] = np.where(there[:, k + 1, None], lse(a + (e[:, k + 1] + beta[:, k + 1])[:, None, :], 2), 0)
        z = lse(alpha[np.arange(len(rows)), lengths - 1], 1)
        p = np.exp(alpha + beta - z[:, None, None]) * there[:, :, None]
        pair = np.exp(alpha[:, :-1, :, None] + a + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]) * there[:, 1:, None, None]
        d = want - p
        dw = np.zeros_like(w)
        np.add.at(dw, f, d[i, t])
        for x, g, dx in ((w, gw, dw - decay * (w - centre)), (a, ga, want_a - pair.sum(axis=(0, 1)) - decay * a), (b, gb, d[:, 0].sum(axis=0) - decay * b)):
            g += dx * dx
            x += rate * dx / np.sqrt(g)
    return Field(index, w, a, b)


@lru_cache(maxsize=1)
def default_field() -> Field:
    return train(labelled_table() + background())


def scores_by_kind(field: Field, rows: list[list[tuple[str, str]]]) -> dict[str, tuple[float, float]]:
    """Precision and recall of whole spans by kind, on labelled rows."""
    right, found, wanted = Counter(), Counter(), Counter()
    for row in rows:
        words = [w for w, _ in row]
        features = np.array([field._rows(word_features(w)) for w in words])
        starts = np.zeros(len(words), bool)
        starts[0] = True
        got = [LABELS[k] for k in field.decode(field.emissions(features, np.arange(len(words)), starts), starts)]
        spans = []
        for labels in (got, [label for _, label in row]):
            own: list[list] = []
            for k, label in enumerate(labels):
                if label[0] == "I" and own and own[-1][2] == k - 1 and own[-1][0] == label[2:]:
                    own[-1][2] = k
                elif label != "O":
                    own.append([label[2:], k, k])
            spans.append({tuple(x) for x in own})
        found.update(k for k, *_ in spans[0])
        wanted.update(k for k, *_ in spans[1])
        right.update(k for k, *_ in spans[0] & spans[1])
    return {k: (right[k] / max(1, found[k]), right[k] / max(1, wanted[k])) for k in FIELD_KINDS}


_NAMED = re.compile(r"([^\s=:]*)[=:]")
_ORDINARY = re.compile(r"[a-zß-öø-ÿ]{2,}[.,;:!?]?\Z")


def field_spans(texts: list[str], field: Field) -> list[list[Span]]:
    """Spans of the field in each text."""
    column = pa.array(texts, pa.large_string())
    for blank in "\t\r\v\f":
        column = pc.replace_substring(column, blank, " ")
    # A line's end is a word of its own, so that lines and blanks are told apart after the split.
    lists = pc.split_pattern(pc.replace_substring(column, "\n", " \n "), " ")
    pieces = lists.flatten()
    encoded = pieces.dictionary_encode()
    own = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
    rows = np.empty((len(own), SIDES, len(LABELS)))
    known = field.plain
    for k, w in enumerate(own):
        if _ORDINARY.match(w) and w.rstrip(".,;:!?") not in _CUE and w not in _CUE and "stra" not in w:
            # A lower-case word: only the buckets of its length differ.
            rows[k] = field._rows(("any", "shape=x", f"len={min(len(w.strip(_EDGE)) // 4, 8)}"))
        else:
            rows[k] = known if w in ("", "\n") else field._rows(word_features(w))
    codes = encoded.indices.to_numpy()
    kinds = np.array([0 if w == "" else 2 if w == "\n" else 1 for w in own], np.int8)[codes]
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    # Code points before each piece: pieces are one blank apart; a line end stands for one character, not three.
    sizes = np.array([len(w) for w in own], np.int64)[codes]
    step = np.where(kinds == 2, 0, sizes + 1)
    word = np.flatnonzero(kinds == 1)
    if not len(word):
        return [[] for _ in texts]
    before = np.cumsum(step) - step
    line = np.cumsum(kinds == 2)
    text_of = np.searchsorted(offsets, word, "right") - 1
    base = np.append(before, before[-1] + step[-1])[offsets[text_of]]
    # Around a line end the split left one blank before it; that blank is the line end's own character.
    place = before[word] - base
    starts = np.concatenate([[True], (line[word][1:] != line[word][:-1]) | (text_of[1:] != text_of[:-1])])
    e = field.emissions(rows, codes[word], starts)
    labels = field.decode(e, starts)
    out: list[list[Span]] = [[] for _ in texts]
    hit = np.flatnonzero(labels)
    open_: tuple[int, str, int, int] | None = None  # text, kind, first and last word
    found = []
    for h in hit.tolist():
        name = LABELS[labels[h]]
        kind, doc = name[2:], int(text_of[h])
        if open_ and name[0] == "I" and open_[1] == kind and open_[3] == h - 1 and open_[0] == doc and not starts[h]:
            open_ = (doc, kind, open_[2], h)
        else:
            if open_:
                found.append(open_)
            open_ = (doc, kind, h, h)
    if open_:
        found.append(open_)
    for doc, kind, a, b in found:
        begin, end = int(place[a]), int(place[b] + sizes[word[b]])
        own_text = texts[doc][begin:end]
        if kind == "secret" and (m := _NAMED.match(own_text)) and names_secret(m[1]):
            begin = min(end - 1, begin + m.end())
        if kind == "secret" and texts[doc][begin] in "\"'" and (close := texts[doc].find(texts[doc][begin], begin + 1, end)) > 0:
            end = close
        while begin < end and texts[doc][begin] in _EDGE:
            begin += 1
        while end > begin and texts[doc][end - 1] in _EDGE:
            end -= 1
        if begin < end:
            out[doc].append((kind, begin, end))
    return out


def all_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text; all spans by kind, then start."""
    out = []
    for text, extra in zip(texts, field_spans(texts, field)):
        base = base_spans(text)
        free = extra
        if base and extra:
            # The furthest end of all base spans that begin before a place tells whether one of them reaches beyond it.
            ordered = sorted((a, b) for _, a, b in base)
            begins, reach = [a for a, _ in ordered], list(accumulate((b for _, b in ordered), max))
            free = [s for s in extra if not (k := bisect_left(begins, s[2])) or reach[k - 1] <= s[1]]
        out.append((base, sorted(base + free, key=lambda s: (KINDS.index(s[0]), s[1]))))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in brackets; of overlapping spans the first one's."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a < at:
            at = max(at, b)
            continue
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row of ``docs(doc_id, text)``."""
    field = default_field()
    bounded_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, limit=1 << 20):
            rows = []
            for base, every in all_spans(pc.fill_null(batch.column("text"), "").to_pylist(), field):
                rows.append((*(sum(s[0] == k for s in base) for k in BASE_KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every)))
            kinds = [*[pa.int64()] * 4, pa.string(), pa.string()]
            names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))], names)
        free_memory()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans replaced by their kinds in ``text``, and ``n_chars`` (where it exists) of the new text."""
    field = default_field()
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, limit=1 << 20):
            texts = batch.column("text").to_pylist()
            spans = all_spans([t or "" for t in texts], field)
            new = [t if t is None else redact(t, every) for t, (_, every) in zip(texts, spans)]
            columns = dict(zip(names, batch.columns))
            columns["text"] = pa.array(new, batch.schema.field("text").type)
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in new], batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)
        free_memory()

    return map_in_arrow(docs, run, docs.schema)
