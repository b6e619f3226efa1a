"""Toxicity by a weighted grammar of clauses: insult and threat, target, negation, reported speech.

Four small transducers read a clause's words. The lexical one names each word: an insult, a threat, one who
is meant, a negation, a verb of saying, or other. The negation transducer marks what follows a negation
closely, the report transducer what follows a verb of saying, the target transducer whether someone is
meant. They are composed into one machine, whose output for a clause is its matches: what kind (an insult, a
threat, or a word that is an insult only now and then), negated or not, reported or not, aimed at someone or
not. A text's score is a logistic of the counts of these patterns and of its length, so a negated or
reported insult weighs as the labels say, not as the word alone would.

Learned from a bounded sample of labelled rows: the insults, as word beginnings that stand in toxic texts
and hardly in others (so that inflected forms count), and the patterns' weights, held near a stated prior
that decides where the labels are silent. A beginning needs support by distinct texts and distinct
neighbours, so that copies of one text do not make its words insults.

Decided cases: a null text is empty; a text without matches gets the score of no evidence. Without labels
the fixed words and the prior weights hold. Rows without a doc_id are scored but never held out. Rows are
scored singly, so repeated rows get equal results. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import product

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import arrow
from .labels import SAMPLE, held_out, sample
from .workspace import ship

INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "bastard", "dumb")
THREATS = ("kill", "murder", "hurt", "destroy", "strangle", "stab", "shoot")
TARGETS = ("you", "your", "yours", "yourself", "he", "she", "they", "him", "them", "his", "her", "their", "people")
NEGATIONS = ("not", "never", "no", "without", "isn't", "aren't", "wasn't", "don't", "doesn't", "won't", "nicht", "kein", "jamais")
SAYING = ("said", "says", "say", "wrote", "writes", "called", "claimed", "reported", "quoted", "shouted")

#: Words that a negation reaches; lengths of learned beginnings; the least evidence for one.
SCOPE, SHORTEST, LONGEST_STEM = 3, 3, 8
LEAST_TEXTS = 3
#: The log ratio of a beginning's share in toxic and in clean texts: of a doubtful one, of a certain one;
#: and the share of its texts that a longer beginning must keep to stand for it.
DOUBTFUL_RATIO, CERTAIN_RATIO, KEEPS = 2.5, 5.0, 0.9
#: Prior logits: no evidence, a match, a doubtful one, aimed, negated, reported; and how firmly they hold.
PRIOR, MATCH, DOUBTFUL_MATCH, AIMED, NEGATED, REPORTED, HOLD = -3.0, 5.0, 1.0, 1.0, -5.0, -3.0, 0.05

INSULT, THREAT, DOUBTFUL, TARGET, NEGATION, REPORT, OTHER = SYMBOLS = range(7)
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE_END = re.compile(r"[.!?;:,\n\r()]")
#: Every pattern: (kind, negated, reported, aimed); the kinds are the first three symbols.
PATTERNS = list(product((INSULT, THREAT, DOUBTFUL), (0, 1), (0, 1), (0, 1)))


def beginnings_of(word: str) -> list[str]:
    """What a word is learned and looked up by: its beginnings of some letters, and all of it if it is longer."""
    short = [word[:n] for n in range(SHORTEST, min(len(word), LONGEST_STEM) + 1)]
    return [*short, word] if len(word) > LONGEST_STEM else short


@dataclass(frozen=True)
class Transducer:
    """A start state, moves by (state, symbol), and what each move puts out."""

    start: int
    moves: dict[tuple[int, int], int]
    puts: dict[tuple[int, int], int]

    def then(self, other: Transducer) -> Transducer:
        """Both machines on the same input, as one; outputs are pairs, packed."""
        names: dict[tuple[int, int], int] = {(self.start, other.start): 0}
        moves, puts, todo = {}, {}, [(self.start, other.start)]
        width = 1 + max(other.puts.values())
        while todo:
            a, b = todo.pop()
            for symbol in SYMBOLS:
                to = self.moves[a, symbol], other.moves[b, symbol]
                if to not in names:
                    names[to] = len(names)
                    todo.append(to)
                moves[names[a, b], symbol] = names[to]
                puts[names[a, b], symbol] = self.puts[a, symbol] * width + other.puts[b, symbol]
        return Transducer(0, moves, puts)


def _machine(states: int, move, put) -> Transducer:
    keys = list(product(range(states), SYMBOLS))
    return Transducer(0, {k: move(*k) for k in keys}, {k: put(*k) for k in keys})


#: 0 nothing, else one more than the kind.
MATCHER = _machine(1, lambda s, x: 0, lambda s, x: x + 1 if x in (INSULT, THREAT, DOUBTFUL) else 0)
#: The state counts the words still reached.
NEGATING = _machine(SCOPE + 1, lambda s, x: SCOPE if x == NEGATION else max(0, s - 1), lambda s, x: int(s > 0))
REPORTING = _machine(2, lambda s, x: int(s or x == REPORT), lambda s, x: s)
AIMING = _machine(2, lambda s, x: int(s or x == TARGET), lambda s, x: int(x == TARGET))
GRAMMAR = MATCHER.then(NEGATING).then(REPORTING).then(AIMING)


def clause_patterns(symbols: Iterable[int]) -> list[int]:
    """The patterns (numbers in PATTERNS) that a clause of any length matches."""
    state, matches, aimed = GRAMMAR.start, [], 0
    for symbol in symbols:
        put = GRAMMAR.puts[state, symbol]
        state = GRAMMAR.moves[state, symbol]
        aimed |= put & 1
        if put >> 3:
            matches.append(((put >> 3) - 1, put >> 2 & 1, put >> 1 & 1))
    return [PATTERNS.index((*match, aimed)) for match in matches]


@dataclass
class ToxicityModel:
    stems: dict[str, bool]
    """Learned beginnings, and whether they are certain."""
    base: float
    weights: np.ndarray

    def lexicon(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for stem in [*self.stems, *INSULTS, *THREATS]:
            found.add_word(stem, stem)
        found.make_automaton()
        return found

    def symbol(self, word: str) -> int:
        if word in THREATS or any(word == t + end for t in THREATS for end in ("s", "ed", "ing")):
            return THREAT
        if word in TARGETS:
            return TARGET
        if word in NEGATIONS:
            return NEGATION
        if word in SAYING:
            return REPORT
        if word.startswith(INSULTS):
            return INSULT
        known = [self.stems[stem] for stem in beginnings_of(word) if stem in self.stems]
        return INSULT if any(known) else DOUBTFUL if known else OTHER

    def patterns(self, text: str, lexicon: ahocorasick.Automaton) -> Counter:
        """How often each pattern occurs; only clauses that hold a listed beginning are read
        word by word, each once and whole."""
        lowered = text.lower()
        found, upto = Counter(), 0
        for last, stem in lexicon.iter(lowered):
            begin = last - len(stem) + 1
            if begin < upto or (begin and (lowered[begin - 1].isalpha())):
                continue
            for end in _CLAUSE_END.finditer(lowered, upto, begin):
                upto = end.end()
            end = _CLAUSE_END.search(lowered, last)
            low, upto = upto, end.start() if end else len(lowered)
            found.update(clause_patterns(self.symbol(word.group()) for word in _WORD.finditer(lowered, low, upto)))
        return found

    def score(self, counts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.base + np.log1p(counts) @ self.weights, -30, 30)))


def prior_weights() -> np.ndarray:
    """Of each pattern, and of the text's length."""
    found = [
        (DOUBTFUL_MATCH if kind == DOUBTFUL else MATCH) + AIMED * aimed + NEGATED * negated + REPORTED * reported
        for kind, negated, reported, aimed in PATTERNS]
    return np.array([*found, 0.0])


def _counts(model: ToxicityModel, lexicon: ahocorasick.Automaton, texts: list[str | None]) -> np.ndarray:
    """A row a text: how often each pattern occurs, and the text's length in thousands of characters."""
    out = np.zeros((len(texts), len(PATTERNS) + 1))
    for row, text in enumerate(texts):
        out[row, -1] = len(text or "") / 1000
        for pattern, n in model.patterns(text or "", lexicon).items():
            out[row, pattern] = n
    return out


def learn_stems(marked: DataFrame) -> dict[str, bool]:
    """Word beginnings that tell toxic texts, from (text, label) rows of the bounded sample; whether surely."""

    def beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for text in rows.column("text").to_pylist():
                words = _WORD.findall(text.lower())
                around = zip(["", *words], words, [*words[1:], ""])
                seen = {(stem, f"{a} {b}") for a, w, b in around for stem in beginnings_of(w)}
                once: dict[str, str] = {}
                for stem, neighbours in sorted(seen):
                    once.setdefault(stem, neighbours)
                yield arrow.batch(stem=pa.array(list(once), pa.string()), around=pa.array(list(once.values()), pa.string()))

    texts = marked.where("text IS NOT NULL").select("text", "label").distinct()
    sizes = {r.label: r.n for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return {}
    found = texts.where("label = 1").select("text").mapInArrow(beginnings, "stem string, around string")
    counted = found.groupBy("stem").agg(F.least(F.count("*"), F.count_distinct("around")).alias("n"))
    candidates = {r.stem: r.n for r in counted.where(F.col("n") >= LEAST_TEXTS).collect()}  # of the sample's words

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for rows in batches:
            for text in rows.column("text").to_pylist():
                words = set(_WORD.findall(text.lower()))
                held.update({stem for w in words for stem in beginnings_of(w)} & candidates.keys())
        yield arrow.batch(stem=pa.array(list(held), pa.string()), n=pa.array(list(held.values()), pa.int64()))

    others = texts.where("label = 0").select("text").mapInArrow(elsewhere, "stem string, n long")
    clean_of = {r.stem: r.n for r in others.groupBy("stem").agg(F.sum("n").alias("n")).collect()}
    share = toxic / (toxic + clean)
    children: dict[str, list[str]] = {}
    for stem in sorted(candidates):
        children.setdefault(stem[: min(len(stem) - 1, LONGEST_STEM)], []).append(stem)

    def ratio(stem: str) -> float:
        return math.log((candidates[stem] + 0.5) / (toxic + 1)) - math.log((clean_of.get(stem, 0) + 0.5) / (clean + 1))

    def telling(stem: str) -> bool:
        """More of its texts are toxic than accident would give for any of the words looked at."""
        n, of = candidates[stem], candidates[stem] + clean_of.get(stem, 0)
        excess = n * math.log(n / of / share) + (of - n) * math.log(max((1 - n / of) / (1 - share), 1e-300)) if of > n else n * -math.log(share)
        return ratio(stem) >= DOUBTFUL_RATIO and excess >= math.log(len(candidates) + 1) + 2

    chosen: dict[str, int] = {}
    open_ = [s for s in candidates if len(s) == SHORTEST]
    while open_:
        stem = open_.pop()
        longer = children.get(stem, [])
        heir = max(longer, key=lambda s: candidates[s], default=None)
        if heir and candidates[heir] >= KEEPS * candidates[stem]:
            open_ += longer  # the longer one says as much, and more surely
        elif telling(stem) and (ratio(stem) >= CERTAIN_RATIO or not any(telling(s) and ratio(s) >= CERTAIN_RATIO for s in longer)):
            chosen[stem] = candidates[stem]
        else:
            open_ += longer
    return {stem: ratio(stem) >= CERTAIN_RATIO for stem in sorted(chosen, key=lambda s: (-chosen[s], s))}


def fit_weights(counts: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Newton's method on the logistic loss, with a pull towards the prior weights."""
    prior = np.r_[PRIOR, prior_weights()]
    if not len(y):
        return PRIOR, prior[1:]
    x = np.column_stack([np.ones(len(y)), np.log1p(counts)])
    hold = np.r_[0.01, np.full(len(prior) - 1, HOLD)] * math.sqrt(len(y))
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + hold * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold), gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), w[1:]


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held: int = 0, most: int = SAMPLE) -> ToxicityModel:
    """``most``: labelled rows that the model is fitted to."""
    ship(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = docs.join(F.broadcast(sample(labels, label, folds, held, most)), "doc_id").select("doc_id", "text", "label")
    model = ToxicityModel(learn_stems(marked), PRIOR, prior_weights())

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = model.lexicon()
        for rows in batches:
            found = _counts(model, lexicon, rows.column("text").to_pylist())
            yield arrow.batch(label=rows.column("label"), counts=pa.array(list(found), pa.list_(pa.float64())))

    kinds = marked.mapInArrow(features, "label int, counts array<double>").groupBy("label", "counts").count().collect()
    kinds.sort(key=lambda r: (r.label, r.counts))
    times = np.array([r["count"] for r in kinds], dtype=np.int64)
    counts = np.repeat(np.array([r.counts for r in kinds]).reshape(-1, len(PATTERNS) + 1), times, axis=0)
    model.base, model.weights = fit_weights(counts, np.repeat(np.array([float(r.label) for r in kinds]), times))
    return model


def score(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score, predicted."""
    ship(documents.sparkSession)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = model.lexicon()
        for rows in batches:
            yield arrow.batch(doc_id=rows.column("doc_id"), score=model.score(_counts(model, lexicon, rows.column("text").to_pylist())))

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = docs.mapInArrow(scored, "doc_id long, score double")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents, with all their columns, that score below one half."""
    ship(documents.sparkSession)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = model.lexicon()
        for rows in batches:
            yield rows.filter(pa.array(model.score(_counts(model, lexicon, rows.column("text").to_pylist())) < 0.5))

    return documents.mapInArrow(keep, documents.schema)


def classify(documents: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held: int = 0, most: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    found = score(documents, fit(documents, labels, label, folds, held, most))
    return found.select("doc_id", held_out(folds, held).alias("held_out"), "score", "predicted")
