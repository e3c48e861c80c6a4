"""Toxicity by a weighted finite-state pattern grammar.

Words pass through a cascade of transducers: the lexicon turns a word into a symbol
(insult or threat with a weight, target, negation, reported speech, end of clause);
negation and reported speech weaken what they govern; the clause machine adds up what
is left, more if a target is addressed, and closes at the end of a clause. A document
is scored by its matched clauses, not by its words.

The weights are learned: a word, or a stem that begins several words, becomes an
insult by how much likelier it is in toxic training documents. A clause matches by an
insult or a threat only, so a document in which an Aho-Corasick automaton finds neither
has no clause, and isn't parsed (tests hold this against a parse of every text).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from math import exp, log, log1p

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidefeed.llm.labelled import TRAINING_ROWS, remainder, training_labels
from tidefeed.llm.storage import cut, ship

# Closed word classes in English, German, French and Spanish.
TARGETS = frozenset("you your yours yourself u he she they him them du dich dir ihr euch sie er tu toi te vous il elle ils tú usted ustedes ti vosotros él ella ellos".split())
NEGATIONS = frozenset("not no never isn't aren't wasn't don't neither nor without nicht kein keine keinen nie niemals ohne pas jamais aucun aucune sans nunca jamás tampoco sin ningún".split())
REPORTS = frozenset("said says called calls wrote writes quoted quotes reported claims claimed allegedly sagte schrieb nannte zitierte angeblich dit écrit appelé cité dijo escribió llamó citó".split())
THREATS = frozenset("kill hurt destroy beat punch stab shoot burn töten schlagen vernichten verbrennen tuer frapper détruire brûler matar golpear destruir quemar".split())

STEM_SIZES = (4, 5, 6, 7)
#: A lexicon entry occurs in so many and such a share of the toxic training documents at least, and has such log odds at
#: least. The share bounds the terms that reach the driver: at most 1 / LEAST_SHARE times those of a mean toxic document.
LEAST_DOCS, LEAST_SHARE, LEAST_ODDS = 4, 0.005, 2.5
THREAT_WEIGHT, TARGET_BONUS, NEGATED, REPORTED, REACH = 0.5, 0.5, 0.25, 0.5, 3

_TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n]")


@dataclass(frozen=True)
class Lexicon:
    """Learned insults: whole words and stems, with log odds."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)

    def symbol(self, token: str) -> tuple[str, float]:
        if token in ".!?;:\n":
            return "end", 0
        weight = self.words.get(token)
        if weight is None:
            weight = max((self.stems[token[:k]] for k in STEM_SIZES if token[:k] in self.stems), default=None)
        if weight is not None:
            return "insult", weight
        for name, words in (("threat", THREATS), ("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS)):
            if token in words:
                return name, THREAT_WEIGHT if name == "threat" else 0
        return "other", 0

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for w in {*self.words, *self.stems, *THREATS}:
            found.add_word(w, w)
        found.make_automaton()
        return found


# Transducers: (state, symbol, weight) -> (state, symbol, weight). A cascade composes them.


def negation(left: int, symbol: str, weight: float) -> tuple[int, str, float]:
    """A negation weakens insults and threats among the next REACH words of its clause."""
    if symbol == "end":
        return 0, symbol, weight
    if symbol == "negation":
        return REACH, "other", 0
    return max(left - 1, 0), symbol, weight * NEGATED if left and symbol in ("insult", "threat") else weight


def reported_speech(on: int, symbol: str, weight: float) -> tuple[int, str, float]:
    """A verb of saying weakens what follows in its clause."""
    if symbol == "end":
        return 0, symbol, weight
    if symbol == "report":
        return 1, "other", 0
    return on, symbol, weight * REPORTED if on else weight


def threat(target: int, symbol: str, weight: float) -> tuple[int, str, float]:
    """A threat counts only beside a target: within REACH words after one, or before one."""
    if symbol == "end":
        return 0, symbol, weight
    if symbol == "target":
        return (0, "threatened", THREAT_WEIGHT) if target < 0 else (REACH, symbol, weight)
    if symbol == "threat":
        return (0, "threatened", weight) if target > 0 else (-REACH, "other", 0)
    return target - (target > 0) + (target < 0), symbol, weight


CASCADE = (negation, reported_speech, threat)


def clauses(symbols: Iterable[tuple[str, float]]) -> Iterator[tuple[float, int]]:
    """(weight, number of insults and threats) of each clause that matches."""
    states = [0] * len(CASCADE)
    total, matched, addressed = 0.0, 0, False
    for symbol, weight in (*symbols, ("end", 0)):
        for i, machine in enumerate(CASCADE):
            states[i], symbol, weight = machine(states[i], symbol, weight)
        if symbol in ("insult", "threatened"):
            total, matched = total + weight, matched + 1
        elif symbol == "target":
            addressed = True
        elif symbol == "end":
            if matched:
                yield total * (1 + TARGET_BONUS * addressed), matched
            total, matched, addressed = 0.0, 0, False


def lowered(text: str) -> str:
    """In small letters, with one kind of apostrophe."""
    return text.lower().replace("’", "'")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(lowered(text))


N_FEATURES = 5
#: Texts that are held as Python strings at a time.
ROWS = 500


def features(text: str, lexicon: Lexicon, automaton: ahocorasick.Automaton) -> list[float]:
    low = lowered(text)
    if next(automaton.iter(low), None) is None:
        return [0.0] * N_FEATURES
    found = list(clauses(map(lexicon.symbol, _TOKEN.findall(low))))
    if not found:
        return [0.0] * N_FEATURES
    weights = [w for w, _ in found]
    return [1.0, log1p(sum(weights)), max(weights), log1p(len(found)), log1p(sum(n for _, n in found))]


def _terms(text: str) -> tuple[set[str], set[str]]:
    words = {w for w in tokens(text) if len(w) > 2}
    return words, {w[:k] for w in words for k in STEM_SIZES if len(w) > k}


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """From ``(text, label)``, of bounded size: two passes count terms by partition, first those of toxic documents."""
    n = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    n_toxic, n_clean = n.get(1.0, 0), sum(v for k, v in n.items() if k != 1.0)
    if not n_toxic or not n_clean:
        return Lexicon()

    def counted(wanted: frozenset[tuple[str, str]] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count: Counter = Counter()
            for b in batches:
                for t in b.column(0).to_pylist():
                    words, stems = _terms((t or b"").decode("utf-8", "replace"))
                    pairs = {("w", w) for w in words} | {("s", s) for s in stems}
                    count.update(pairs if wanted is None else pairs & wanted)
            yield pa.record_batch([pa.array([k[0] for k in count], pa.string()), pa.array([k[1] for k in count], pa.string()), pa.array(count.values(), pa.int64())], names=["kind", "term", "n"])

        return lambda part: part.select("text").mapInArrow(run, "kind string, term string, n long").groupBy("kind", "term").agg(F.sum("n").alias("n"))

    least = max(LEAST_DOCS, int(n_toxic * LEAST_SHARE))
    often = counted(None)(rows.where("label = 1")).where(F.col("n") >= least).collect()
    wanted = frozenset((r[0], r[1]) for r in often)
    clean = {(r[0], r[1]): r[2] for r in counted(wanted)(rows.where("label != 1")).collect()}
    odds = {}
    for kind, term, k in often:
        a, b = (k + 0.5) / (n_toxic + 1), (clean.get((kind, term), 0) + 0.5) / (n_clean + 1)
        if (value := log(a / b)) >= LEAST_ODDS:
            odds[kind, term] = value
    return Lexicon({t: v for (k, t), v in odds.items() if k == "w"}, {t: v for (k, t), v in odds.items() if k == "s"})


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights and intercept by Newton's method, the weights held down by ``ridge``."""
    x = np.hstack([x, np.ones((len(x), 1))])
    hold = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, x.T @ (y - p) - hold @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, x: list[float]) -> float:
        return 1 / (1 + exp(-max(-30.0, min(30.0, float(np.dot(self.weights[:-1], x) + self.weights[-1])))))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, bound: int = TRAINING_ROWS) -> ToxicityModel | None:
    """Learns from the labelled rows whose crc32(doc_id) mod ``folds`` isn't ``held``; None without labels of both classes."""
    ship(docs.sparkSession)
    known = training_labels(labels, "toxic", remainder(folds) != held, bound)
    rows = cut(docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(known), "doc_id").select("text", "label"), "training")
    lexicon = learn_lexicon(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for b in batches:
            x = [features((t or b"").decode("utf-8", "replace"), lexicon, automaton) for t in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array(x, pa.list_(pa.float64())), b.column(1)], names=["x", "label"])

    # Rows with equal features count together; so what reaches the driver is bounded by the training rows.
    pairs = rows.mapInArrow(run, "x array<double>, label double").collect()
    y = np.array([p[1] for p in pairs])
    if len(set(y.tolist())) < 2:
        return None
    return ToxicityModel(lexicon, logistic(np.array([p[0] for p in pairs]), y))


def with_score(docs: DataFrame, model: ToxicityModel | None, output: str = "score", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs``, or their columns ``keep``, with a double of 0 to 1, higher: toxic likelier.

    Null and empty texts have no clause; no model, 0.5. A column named like ``output`` is replaced.
    """
    ship(docs.sparkSession)
    docs = docs.select(*[c for c in docs.columns if c != output and (keep is None or c in (*keep, "text"))])
    kept = docs.select(*[c for c in docs.columns if keep is None or c in keep])
    places, text = [docs.columns.index(c) for c in kept.columns], docs.columns.index("text")
    schema = kept.schema.add(output, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.lexicon.automaton() if model else None
        for b in (b.slice(lo, ROWS) for b in batches for lo in range(0, b.num_rows, ROWS)):
            texts = b.column(text).cast(pa.binary()).to_pylist()
            scores = [model.score(features((t or b"").decode("utf-8", "replace"), model.lexicon, automaton)) if model else 0.5 for t in texts]
            yield pa.record_batch([*map(b.column, places), pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, bound: int = TRAINING_ROWS) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``; a null id isn't held out.

    Equal texts get equal scores, repeated rows their own row each; null and empty texts
    that of a text without a clause. Without labels of both classes every score is 0.5.
    Other columns are ignored, whatever their names; an empty table gives an empty one.
    """
    scored = with_score(docs, fit(docs, labels, folds, held, bound), keep=["doc_id"])
    return scored.select("doc_id", F.coalesce(remainder(folds) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
