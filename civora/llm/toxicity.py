"""Toxicity by a weighted finite-state pattern grammar.

A lexicon transducer turns the words of a clause into symbols: insult, threat,
target, negation, reporting verb, quotation mark, other. Insults and threats
carry weights: log-odds of words and word stems learned from labelled rows,
with the longest known stem standing in for a word never seen. Four more
transducers read the symbols and multiply weights: a target nearby raises, a
negation just before lowers, reported or quoted speech lowers, and a threat
counts in full only when it has a target. They are composed into machines whose
transitions are built once and then looked up; targets are read in both directions. A clause's score is the
sum of its path's weights; a document's score is a logistic function, fitted on
labelled rows the lexicon has not seen, of its clauses' scores.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civora.llm.common import portions, record_batch, shared_table, tidy

#: Bound of the labelled rows the model is fitted on.
MAX_LABELS = 12_000
#: Bound of the learned lexicon.
MAX_LEXICON = 4_000

_TOKEN = re.compile(r"[^\W\d_]+|[\"“”«»„]")
_WORD = re.compile(r"[^\W\d_]{3,}")
_CLAUSE = re.compile(r"[.!?;:\n]+")
_STEMS = range(4, 9)

# Word classes of the grammar in English, French, German and Spanish.
INSULT = frozenset(
    "idiot idiots moron morons stupid loser losers trash scum clown pathetic worthless disgusting imbecile dumb fool "
    "bastard bastards crap filthy freak jerk pig vermin parasite parasites cretin crétin abruti connard salaud ordure "
    "idiote stupide minable dégoûtant blödmann trottel abschaum dumm dämlich wertlos ekelhaft arschloch versager idiota "
    "estúpido estúpida imbécil basura asqueroso patético inútil payaso".split())
THREAT = frozenset(
    "kill hurt beat shoot stab strangle destroy murder slaughter burn tuer frapper détruire égorger töten schlagen "
    "umbringen vernichten erschießen matar golpear destruir quemar".split())
TARGET = frozenset(
    "you your yours yourself u ya they them their he she him her his people tu toi vous te ton ta tes votre vos ils "
    "elles eux du dich dir dein deine euch ihr ihnen sie tú ti usted ustedes vosotros tus ellos ellas".split())
NEGATION = frozenset(
    "not no never none neither nor isn aren wasn weren don doesn didn won without ne pas jamais aucun sans nicht kein "
    "keine keinen nie niemals ohne nunca jamás ni sin".split())
REPORT = frozenset(
    "said says say told tells wrote writes claimed claims called calls quoted reported alleged dit disait écrit "
    "affirme appelle rapporté sagte sagt schrieb behauptet nannte dijo dice escribió afirmó llamó".split())
QUOTE = frozenset('"“”«»„')

NEGATED, REPORTED, TARGETED, UNTARGETED_THREAT = 0.35, 0.5, 1.25, 0.3
_REACH_NEGATION, _REACH_TARGET = 3, 4


# Transducers: start state, and step(state, symbol) -> (state, factor). Symbols: I, H (threat), T, N, R, Q, O.

def _negation(state: int, symbol: str) -> tuple[int, float]:
    if symbol == "N":
        return _REACH_NEGATION, 1.0
    return max(0, state - 1), NEGATED if state and symbol in "IH" else 1.0


def _reported(state: int, symbol: str) -> tuple[int, float]:
    if symbol == "R":
        return state | 1, 1.0
    if symbol == "Q":
        return state ^ 2, 1.0
    return state, REPORTED if state and symbol in "IH" else 1.0


def _target(state: int, symbol: str) -> tuple[int, float]:
    if symbol == "T":
        return _REACH_TARGET, 1.0
    return max(0, state - 1), TARGETED if state and symbol == "I" else 1.0


def _threat(state: int, symbol: str) -> tuple[int, float]:
    if symbol == "T":
        return _REACH_TARGET, 1.0
    return max(0, state - 1), UNTARGETED_THREAT if not state and symbol == "H" else 1.0


class Machine:
    """Composition of transducers: states are tuples, factors multiply, transitions are kept."""

    def __init__(self, *parts):
        self.parts, self.start, self.arcs = parts, (0,) * len(parts), {}

    def step(self, state: tuple, symbol: str) -> tuple[tuple, float]:
        arc = self.arcs.get((state, symbol))
        if arc is None:
            after = [p(s, symbol) for p, s in zip(self.parts, state)]
            arc = self.arcs[state, symbol] = (tuple(s for s, _ in after), math.prod(f for _, f in after))
        return arc

    def run(self, symbols: list[str]) -> list[float]:
        """The factor on each symbol of the path that reads them."""
        state, out = self.start, []
        for s in symbols:
            state, factor = self.step(state, s)
            out.append(factor)
        return out


@dataclass
class Model:
    """Lexicon (words, and stems marked by a trailing *) and the logistic weights."""

    lexicon: dict[str, float] = field(default_factory=dict)
    beta: tuple[float, ...] = (-4.0, 1.0, 0.5, 0.5, 0.5)

    def __post_init__(self):
        seeds = {w: 4.0 for w in INSULT} | {w: 3.0 for w in THREAT}
        self.weights = seeds | self.lexicon
        self.heads = {w[:3] for w in self.weights}
        self.memo: dict[str, float] = {}
        self.frame = Machine(_negation, _reported)
        self.aim = Machine(_target, _threat)  # read in both directions: a target may follow

    def weight(self, word: str) -> float:
        """Weight of the word, else of its longest known stem, else 0."""
        w = self.memo.get(word)
        if w is None:
            w = self.weights.get(word)
            if w is None:
                w = next((self.weights[s] for n in reversed(_STEMS) if n < len(word)
                          and (s := word[:n] + "*") in self.weights), 0.0)
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[word] = w
        return w

    def _symbol(self, word: str) -> tuple[str, float]:
        if word in QUOTE:
            return "Q", 0.0
        for symbol, words in (("N", NEGATION), ("T", TARGET), ("R", REPORT)):
            if word in words:
                return symbol, 0.0
        w = self.weight(word)
        if w > 0:
            return ("H" if word in THREAT else "I"), w
        return "O", 0.0

    def clause(self, symbols: list[str], weights: list[float]) -> float:
        """Weight of a clause: each hit times its frame and the better of its two aims."""
        before, after = self.aim.run(symbols), self.aim.run(symbols[::-1])[::-1]
        return sum(w * f * max(x, y) for w, f, x, y in zip(weights, self.frame.run(symbols), before, after))

    def clauses(self, text: str) -> list[tuple[str, float]]:
        """Clauses with a matched pattern and their scores."""
        out = []
        for clause in _CLAUSE.split(text.lower()):
            words = _TOKEN.findall(clause)
            if any(w[:3] in self.heads and self.weight(w) > 0 for w in words):
                symbols, weights = zip(*map(self._symbol, words))
                if (score := self.clause(symbols, weights)) > 0:
                    out.append((clause.strip(), score))
        return out

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        """Sum and maximum of the clause scores, matched clauses, score per word (all damped)."""
        low = (text or "").lower()
        words = _WORD.findall(low)
        heads = self.heads
        if not any(self.weight(w) > 0 for w in set(words) if w[:3] in heads):
            return 0.0, 0.0, 0.0, 0.0
        scores = [s for _, s in self.clauses(low)]
        if not scores:
            return 0.0, 0.0, 0.0, 0.0
        total = sum(scores)
        return math.log1p(total), min(max(scores), 12.0) / 4, math.log1p(len(scores)), math.log1p(50 * total / len(words))

    def score(self, text: str | None) -> float:
        z = self.beta[0] + sum(b * x for b, x in zip(self.beta[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Newton steps for ridge logistic regression; the first column is the constant."""
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, bound: int = MAX_LABELS) -> DataFrame:
    """(text, y, fold) of at most ``bound`` training rows, the ids with the smallest hashes.

    The ids are bounded by ``bound``, which is what is broadcast.
    """
    ids = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
           .withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(3)).cast("int")))
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "y", "fold")


def _stems(words: set[str]) -> set[str]:
    return words | {w[:n] + "*" for w in words for n in _STEMS if n < len(w)}


def learn_lexicon(rows: DataFrame, bound: int = MAX_LEXICON) -> dict[str, float]:
    """Log-odds of words and stems between toxic and clean rows, the best ``bound`` of them."""

    def count(batches):
        toxic, clean = Counter(), Counter()
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                (toxic if y else clean).update(_stems(set(_WORD.findall((text or "").lower()))) | {""})
        keys = list(toxic.keys() | clean.keys())
        for i in range(0, len(keys), 10_000):
            yield record_batch([(k, toxic[k], clean[k]) for k in keys[i:i + 10_000]], "word string, t long, c long")

    counts = (rows.select("text", "y").mapInArrow(tidy(count), "word string, t long, c long")
              .groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where("t >= 3 or word = ''"))
    counts = shared_table(counts, "toxic-words")
    total = counts.where("word = ''").first()
    if total is None or not total["t"] or not total["c"]:
        return {}
    nt, nc = total["t"], total["c"]
    odds = F.log(((F.col("t") + 0.5) / (nt + 1)) / ((F.col("c") + 0.5) / (nc + 1)))
    stem = F.col("word").endswith("*")
    good = (counts.withColumn("w", odds)
            .where((F.col("word") != "") & F.when(stem, (F.col("t") >= 8) & (F.col("w") >= 2)).otherwise(F.col("w") >= 2))
            .orderBy((F.col("t") * F.col("w")).desc(), "word").limit(bound))
    return {r["word"]: min(6.0, r["w"]) for r in good.collect()}


_FEATURES = "y int, a double, b double, c double, d double"


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = MAX_LABELS) -> Model:
    """Lexicon from two thirds of the training rows, logistic weights from the rest.

    Without labels of both kinds the built-in word classes and default weights
    are used.
    """
    rows = shared_table(labelled(docs, labels, label, bound), "toxic-train")
    model = Model(learn_lexicon(rows.where("fold < 2")))
    fresh = Model(model.lexicon)

    def features(batches):
        for b in batches:
            yield record_batch([(y, *fresh.features(t)) for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())],
                               _FEATURES)

    data = np.array([tuple(r) for r in rows.where("fold = 2").select("text", "y")
                     .mapInArrow(tidy(features), _FEATURES).collect()], float)  # at most ``bound`` rows
    if len(data) and 0 < data[:, 0].sum() < len(data):
        x = np.column_stack([np.ones(len(data)), data[:, 1:]])
        return Model(model.lexicon, tuple(float(b) for b in logistic(x, data[:, 0])))
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """Every row of ``docs`` with its score in (0, 1).

    A null text scores like an empty one: the base rate of texts without a
    match. Repeated rows score alike, very long texts are read whole, an empty
    table gives no rows, a column already called like ``out`` is replaced.
    """
    from pyspark.sql import types as T
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    at = docs.columns.index(text_col)
    lexicon, beta = model.lexicon, model.beta

    def run(batches):
        import pyarrow as pa
        own = Model(lexicon, beta)
        for b in batches:
            scores = pa.array([own.score(t.as_py()) for t in b.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, scores], names=schema.names)

    return docs.mapInArrow(tidy(run), schema)


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more.

    Rows are dropped inside the task that scores them; no column is added, so
    no name can clash. Nulls, empty and repeated rows are as in ``score``.
    """
    model = train(docs, labels)
    at = docs.columns.index(text_col)
    lexicon, beta = model.lexicon, model.beta

    def run(batches):
        import pyarrow as pa
        own = Model(lexicon, beta)
        for b in batches:
            for p in portions(b, at):
                yield p.filter(pa.array([own.score(t.as_py()) < threshold for t in p.column(at)], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
