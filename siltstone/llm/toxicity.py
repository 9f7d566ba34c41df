"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become classes: insult and threat words, targets, negations, verbs of reported speech. Five small transducers read
these classes (one each for insult, threat, target, negation and reported speech) and are composed into one automaton
whose states are the tuples of theirs; at a clause's end its state names the pattern that matched, such as a directed,
negated or reported insult. A document's score is logistic in the weights of its matched clauses; no word counts but through its clause.

The insult lexicon holds a few general words and stems learned from labels: beginnings of words that occur far more often
in toxic texts, weighted by their log odds. Stems and pattern weights are fitted on at most ``SAMPLE`` labelled ids, those with
the smallest hashes, and one text of each; rows whose crc32(doc_id) is divisible by five are never used. Scoring reads the
text alone.

Nulls and edges: null and empty texts score as texts without matches; unlabelled or empty label tables leave the lexicon
and weights at their priors; labels of one id count once, as toxic if any says so; null ids in labels are ignored; of the
documents of one id that with the smallest hash of its text is learned from, and each is scored; very long texts are read
whole; an empty table gives no rows; columns of a scored table keep their names, and the two new ones may be named.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from siltstone.llm.common import free_memory, map_in_arrow, staged, text_chunks

#: Labelled rows that lexicon and weights are fitted on, at most.
SAMPLE = 8000
#: Stems are word beginnings of these lengths.
STEM_LENGTHS = (4, 5, 6, 7, 8, 9)
MOST_STEMS = 4000
LEAST_DOCUMENTS = 6
LEAST_LOG_ODDS = 2.0
#: Log odds that count as one whole match.
FULL_ODDS = 4.0

WORDS = {
    "I": "idiot idiots moron morons stupid worthless pathetic scum loser losers disgusting imbecile dumbass idiote imbécile crétin stupide idiota imbécil estúpido dummkopf trottel",
    "H": "kill hurt destroy murder strangle stab shoot beat burn töten umbringen schlagen tuer frapper détruire matar golpear destruir",
    "T": "you your yours they them their he him she her ye du dich dir ihr euch sie tu toi vous te ils elles tú ti usted ustedes ellos ellas",
    "N": "not no never nobody none isn't aren't don't nicht kein keine nie niemals pas jamais aucun nunca jamás tampoco",
    "R": "said says say told tells claimed wrote quoted reported asked sagte sagt schrieb dit disait écrit dijo dice escribió",
}
#: Clause pattern -> prior weight of a clause with it.
PATTERNS = ("strongest directed insult", "insult", "directed insult", "negated insult", "reported insult", "threat", "directed threat", "negated threat", "reported threat")
PRIOR = np.array([2.0, 2.0, 1.0, -1.0, -1.0, 0.5, 2.0, -1.0, -1.0])
PRIOR_BIAS = -3.0
NEGATION_REACH = 3

CLASSES = "OIHTNR"


class Transducer(NamedTuple):
    """``step[state][class]`` is the next state; ``emits[state]`` what the state tells at a clause's end."""

    step: list[list[int]]
    emits: list[str]


def seen(symbol: str, name: str) -> Transducer:
    return Transducer([[1 if c == symbol else 0 for c in CLASSES], [1] * len(CLASSES)], ["", name])


def negation(reach: int = NEGATION_REACH) -> Transducer:
    """States 0 to reach count down after a negation; the last one remembers a negated insult or threat."""
    step = []
    for left in range(reach + 1):
        step.append([reach if c == "N" else reach + 1 if c in "IH" and left else max(0, left - 1) for c in CLASSES])
    step.append([reach + 1] * len(CLASSES))
    return Transducer(step, [""] * (reach + 1) + ["negated"])


def reported() -> Transducer:
    """A verb of speech before an insult or threat."""
    return Transducer([[1 if c == "R" else 0 for c in CLASSES], [2 if c in "IH" else 1 for c in CLASSES], [2] * len(CLASSES)], ["", "", "reported"])


def compose(parts: list[Transducer]) -> Transducer:
    """The automaton that runs all parts at once; only states that can be reached are made."""
    start = tuple(0 for _ in parts)
    number, order, step = {start: 0}, [start], []
    for state in order:
        row = []
        for k in range(len(CLASSES)):
            nxt = tuple(p.step[s][k] for p, s in zip(parts, state))
            if nxt not in number:
                number[nxt] = len(order)
                order.append(nxt)
            row.append(number[nxt])
        step.append(row)
    return Transducer(step, [" ".join(e for p, s in zip(parts, state) if (e := p.emits[s])) for state in order])


GRAMMAR = compose([seen("I", "insult"), seen("H", "threat"), seen("T", "directed"), negation(), reported()])
#: Pattern counts that a clause adds, by the state it ends in.
STATE_PATTERNS = np.array([[1.0 if kind in (e := emit.split()) and (how == "" or how in e) else 0.0 for kind in ("insult", "threat") for how in ("", "directed", "negated", "reported")] for emit in GRAMMAR.emits])
#: States of a directed insult or threat that is neither negated nor reported.
STATE_PLAIN = ["directed" in (e := emit.split()) and "negated" not in e and "reported" not in e and ("insult" in e or "threat" in e) for emit in GRAMMAR.emits]


class Model(NamedTuple):
    stems: dict[str, float]
    weights: np.ndarray
    bias: float


def _bare(word: str) -> str:
    return word.strip(".,;:!?\"'()[]{}<>«»“”„¿¡-")


class Reader:
    """Pattern counts of texts. Keeps the class of every word it has met, up to a bound."""

    def __init__(self, stems: dict[str, float], memo: int = 120_000) -> None:
        self.known = {w: CLASSES.index(c) for c, ws in WORDS.items() for w in ws.split()}
        self.stems, self.memo_size = stems, memo
        self.memo: dict[str, tuple[int, float]] = {}

    def _class(self, word: str) -> tuple[int, float]:
        """Class, plus 8 if the word ends a clause, and the weight of its arc."""
        bare = _bare(word)
        c = self.known.get(bare, 0)
        weight = 1.0 if c else 0.0
        if c < 2:
            odds = max((self.stems.get(bare[:k], 0.0) for k in STEM_LENGTHS if len(bare) >= k), default=0.0)
            if odds:
                c, weight = 1, max(weight, odds / FULL_ODDS)
        return c + 8 * (word[-1:] in ".!?;:" and word != ""), weight

    def features(self, column: pa.Array) -> np.ndarray:
        """(texts, patterns): the strongest directed insult or threat, neither negated nor reported, and the summed weights of matched clauses."""
        column = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
        column = pc.replace_substring(pc.replace_substring(pc.replace_substring(column, "\n", " . "), "\t", " "), "\r", " ")
        lists = pc.split_pattern(column, " ")
        words = lists.flatten().dictionary_encode()
        if len(self.memo) > self.memo_size:
            self.memo = {}
        own = words.dictionary.to_numpy(zero_copy_only=False)
        classes, weights = np.empty(len(own), np.uint8), np.empty(len(own), np.float32)
        for i, w in enumerate(own):
            if (c := self.memo.get(w)) is None:
                c = self.memo[w] = self._class(w)
            classes[i], weights[i] = c
        at = words.indices.to_numpy()
        codes, weights = classes[at], weights[at]
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        out = np.zeros((len(column), len(PATTERNS)))
        # Only clauses with an insult or threat word can match; they are read from their beginning to their end.
        hot = np.flatnonzero(((codes & 7) == 1) | ((codes & 7) == 2))
        if not len(hot):
            return out
        ends = np.flatnonzero(codes >= 8)
        owner = np.searchsorted(offsets, hot, "right") - 1
        before = np.searchsorted(ends, hot, "left")
        begin = np.maximum(np.where(before > 0, ends[np.maximum(before - 1, 0)] + 1 if len(ends) else 0, 0), offsets[owner])
        finish = np.minimum(np.where(before < len(ends), ends[np.minimum(before, len(ends) - 1)] + 1 if len(ends) else len(codes), len(codes)), offsets[owner + 1])
        step = GRAMMAR.step
        for doc, a, b in dict.fromkeys(zip(owner.tolist(), begin.tolist(), finish.tolist())):
            state = 0
            for c in (codes[a:b] & 7).tolist():
                state = step[state][c]
            inside = (codes[a:b] & 7 == 1) | (codes[a:b] & 7 == 2)
            weight = float(weights[a:b][inside].max())
            out[doc, 1:] += STATE_PATTERNS[state] * weight
            if STATE_PLAIN[state]:
                out[doc, 0] = max(out[doc, 0], weight)
        return out


def squash(counts: np.ndarray) -> np.ndarray:
    return np.log1p(counts)


def fit_weights(features: np.ndarray, labels: np.ndarray, rounds: int = 25, ridge: float = 0.5) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's method, with the prior weights as the centre of its ridge."""
    centre = np.append(PRIOR, PRIOR_BIAS)
    w = centre.copy()
    if len(labels):
        x = np.hstack([features, np.ones((len(labels), 1))])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (p - labels) + ridge * (w - centre)
            curvature = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
            step = np.linalg.solve(curvature, gradient)
            w = w - step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
    return w[:-1], float(w[-1])


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(toxic, text) of the training sample, ``sample`` rows at most, written to the shared folder."""
    name = F.col("doc_id").cast("string")
    open_ = labels.select("doc_id", "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (F.crc32(name) % 5 != 0))
    chosen = open_.groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(sample)
    chosen = staged(chosen, "toxicity-ids")
    # At most ``sample`` rows of an id and a label; and one text of each id, chosen before any meet.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    first = texts.groupBy("id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first"))
    return staged(first.select("toxic", "first.text"), "toxicity-sample")


def learn_stems(rows: DataFrame) -> dict[str, float]:
    """Word beginnings with their log odds of toxic against clean texts; at most ``MOST_STEMS``."""
    n1, n0 = (r := rows.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first())[0], r[1]
    if not n1 or not n0:
        return {}
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{%d,}" % STEM_LENGTHS[0]), F.lit(0)))
    each = rows.select("toxic", F.explode(F.array(words)).alias("w"))
    stems = F.explode(F.array_distinct(F.flatten(F.array(*(F.transform(F.filter("w", lambda x: F.length(x) >= k), lambda x: F.substring(x, 1, k)) for k in STEM_LENGTHS)))))
    counts = each.select("toxic", stems.alias("stem")).groupBy("stem").agg(F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") != 1).alias("b"))
    odds = F.log((F.col("a") + 0.5) / (n1 + 1.0)) - F.log((F.col("b") + 0.5) / (n0 + 1.0))
    best = counts.where(F.col("a") >= LEAST_DOCUMENTS).select("stem", odds.alias("odds")).where(F.col("odds") >= LEAST_LOG_ODDS)
    return {r.stem: r.odds for r in best.orderBy(F.desc("odds"), "stem").limit(MOST_STEMS).collect()}


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = training_rows(docs, labels, sample)
    stems = learn_stems(rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(stems)
        for batch in text_chunks(batches):
            counts = reader.features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("toxic").cast(pa.int32()), pa.array(counts.tolist(), pa.list_(pa.float64()))], ["toxic", "f"])

    got = rows.mapInArrow(read, "toxic int, f array<double>").collect()
    features = squash(np.array([r.f for r in got], float).reshape(len(got), len(PATTERNS)))
    return Model(stems, *fit_weights(features, np.array([float(r.toxic == 1) for r in got])))


def toxicity_scores(docs: DataFrame, model: Model, score_name: str = "score", clauses_name: str = "clauses") -> DataFrame:
    """``docs`` with a score, 0 to 1, and the matched clauses' weights by pattern, under names that ``docs`` has not."""
    schema = StructType([*docs.schema.fields, StructField(score_name, DoubleType()), StructField(clauses_name, ArrayType(DoubleType()))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.stems)
        for batch in text_chunks(batches, limit=1 << 20):
            counts = reader.features(batch.column("text"))
            p = 1 / (1 + np.exp(-(squash(counts) @ model.weights + model.bias)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array(counts.tolist(), pa.list_(pa.float64()))], [*batch.schema.names, score_name, clauses_name])
        free_memory()

    return map_in_arrow(docs, score, schema)


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs(doc_id, text)``."""
    scored = toxicity_scores(docs.select("doc_id", "text"), fit(docs, labels, sample))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
