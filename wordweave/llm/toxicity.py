"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

The lexicon holds stems: beginnings of words that mark toxic documents.  All stems sit
in one trie.  A Levenshtein automaton, run on the trie itself, finds the words of a text
that begin with a stem, misspelled by at most one edit (two from ``LONG`` characters
on); its states are made when a word first needs them.  A word that clean training
documents use is no misspelling.  What stands around a hit (quote marks on both sides, an
address to the reader, further hits) separates quotation from abuse, for misspelled hits
too, which weigh less by their edits.  A logistic model over these counts gives the score.

Lexicon, known words and model are fitted on at most about ``MAX_TRAIN`` labelled rows; the
lexicon has at most ``MAX_STEMS`` stems, those with the largest support (ties: the least).
Null and empty texts have no hits.  Long texts are read whole.  Rows that repeat each other
get the same score each; of several labels of a document the largest counts.  An empty
table gives an empty result.  Other columns play no part, whatever their names.  Without a toxic label to learn from every score is 0.
Labels, ``lang``, ``source`` and ``doc_id`` are no inputs of a score.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordweave.llm.common import fold, labelled_ids, map_rows, text_or_empty

# Parameters of the fit: rows, length of stems, least support and purity, number of stems.
MAX_TRAIN = 20_000
STEM = (4, 10)
MIN_SUPPORT = 5
MIN_PURITY = 0.97
MAX_STEMS = 5000
MIN_KNOWN = 2
LONG = 9
WINDOW = 5
FEATURES = ("any", "exact", "weight", "share", "quoted", "addressed", "crowded")

# Marks and words of the context windows, in the languages of the corpus.
QUOTES = "\"'“”„‚‘’«»‹›"
ADDRESS = frozenset("you your you're du dich dir dein ihr euch tú tu usted ustedes te vous toi votre ton".split())
EDGES = "\"'“”„‚‘’«»‹›.,;:!?()[]{}<>#%&*$|-–—_…/\\~+="


class Automaton:
    """Levenshtein automata of all stems, intersected with the trie of the stems."""

    def __init__(self, stems: list[str], known_words: list[str] | tuple = ()):
        self.known_words = frozenset(known_words)
        self.children: list[dict[str, int]] = [{}]
        self.final: list[int] = [0]
        self.allowed: list[int] = [0]
        for stem in stems:
            edits = 0 if len(stem) < 5 else 1 if len(stem) < LONG else 2
            at = 0
            self.allowed[0] = max(self.allowed[0], edits)
            for c in stem:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.final.append(0)
                    self.allowed.append(0)
                at = self.children[at][c]
                self.allowed[at] = max(self.allowed[at], edits)
            self.final[at] = len(stem)
            self.allowed[at] = edits
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.best: list[int | None] = []
        self.moves: list[dict[str, int]] = []
        self.known: dict[str, int | None] = {}
        self.start = self._state({(0, 0)})

    def _state(self, places: set[tuple[int, int]]) -> int:
        """Number of the state; places are (trie node, edits so far), closed under skipping a letter of a stem."""
        todo = list(places)
        least: dict[int, int] = {}
        while todo:
            node, edits = todo.pop()
            if edits > self.allowed[node] or least.get(node, 99) <= edits:
                continue
            least[node] = edits
            todo += [(child, edits + 1) for child in self.children[node].values()]
        key = frozenset(least.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            ends = [e for node, e in key if self.final[node]]
            self.best.append(min(ends) if ends else None)
            self.moves.append({})
        return self.states[key]

    def _move(self, state: int, c: str) -> int:
        places: set[tuple[int, int]] = set()
        for node, edits in self.sets[state]:
            places.add((node, edits + 1))
            for letter, child in self.children[node].items():
                places.add((child, edits + (letter != c)))
        return self._state(places)

    def edits(self, word: str) -> int | None:
        """Edits between a stem and the beginning of the word, None if no stem is near."""
        state, best = self.start, None
        for c in word:
            nxt = self.moves[state].get(c)
            if nxt is None:
                nxt = self.moves[state][c] = self._move(state, c)
            state = nxt
            if not self.sets[state]:
                break
            if self.best[state] is not None and (best is None or self.best[state] < best):
                best = self.best[state]
                if best == 0:
                    break
        return best

    def token(self, token: str) -> int | None:
        """``edits`` of a token without the marks at its ends, remembered in a bounded table."""
        if token not in self.known:
            if len(self.known) > 500_000:
                self.known.clear()
            word = token.strip(EDGES)
            edits = self.edits(word)
            self.known[token] = None if edits and word in self.known_words else edits
        return self.known[token]


def features(text: str, automaton: Automaton) -> list[float]:
    """The counts that :data:`FEATURES` names."""
    tokens = text.lower().split()
    find = automaton.token
    hits = [(i, e) for i, t in enumerate(tokens) if (e := find(t)) is not None]
    exact = sum(e == 0 for _, e in hits)
    quoted = addressed = crowded = weight = 0.0
    for place, (i, e) in enumerate(hits):
        before, after = tokens[max(0, i - WINDOW) : i + 1], tokens[i : i + WINDOW + 1]
        one = 1 / (1 + e)
        weight += one
        if any(q in t[:1] for t in before for q in QUOTES) and any(q in t.rstrip(".,;:!?")[-1:] for t in after for q in QUOTES):
            quoted += one
        if any(t.strip(EDGES) in ADDRESS for t in before + after):
            addressed += one
        if place > 0 and i - hits[place - 1][0] <= WINDOW:
            crowded += one
    whole = weight or 1.0
    # ``any`` and ``weight`` don't shrink with the length of the text.
    return [
        float(bool(hits)),
        float(bool(exact)),
        math.log1p(weight),
        min(1.0, 10.0 * weight / max(1, len(tokens))),
        quoted / whole,
        addressed / whole,
        crowded / whole,
    ]


def _stem_counts(rows: DataFrame) -> DataFrame:
    """``(stem, label, n)``: labelled documents with a word that begins with the stem."""
    low, high = STEM

    def start():
        counts: Counter = Counter()

        def flush() -> list[tuple]:
            out = [(stem, label, n) for (stem, label), n in counts.items()]
            counts.clear()
            return out

        def one(row: dict) -> list[tuple]:
            words = {t.strip(EDGES) for t in set(row["text"].lower().split())}
            counts.update((s, row["label"]) for s in {w[:k] for w in words for k in range(low, min(high, len(w)) + 1)})
            return flush() if len(counts) > 300_000 else []

        one.finish = flush
        return one

    return map_rows(rows, "stem string, label int, n long", start)


def learn_stems(rows: DataFrame) -> list[str]:
    """Stems that hardly occur outside toxic documents, as long as their support lets them be."""
    n = lambda label: F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0))
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not totals.get(1):
        return []
    counts = _stem_counts(rows).groupBy("stem").agg(n(1).alias("toxic"), n(0).alias("clean"))
    # Purity at equal numbers of toxic and clean documents.
    scaled = F.col("clean") * (totals[1] / max(1, totals.get(0, 0)))
    pure = counts.where((F.col("toxic") >= MIN_SUPPORT) & (F.col("toxic") >= MIN_PURITY * (F.col("toxic") + scaled)))
    found = pure.orderBy(F.desc("toxic"), "stem").limit(MAX_STEMS).collect()
    toxic = {r["stem"]: r["toxic"] for r in found}
    longer_by_one: dict[str, list[str]] = {}
    for stem in toxic:
        longer_by_one.setdefault(stem[:-1], []).append(stem)
    kept: set[str] = set()
    for stem in sorted(toxic, key=lambda s: (len(s), s)):
        if any(stem[:k] in kept for k in range(STEM[0], len(stem))):
            continue
        longer = stem
        while True:  # the longest stem with nearly the same support
            more = [s for s in longer_by_one.get(longer, []) if toxic[s] >= 0.95 * toxic[stem]]
            if not more:
                break
            longer = more[0]
        kept.add(longer)
    # A short stem that grew longer covers its other continuations no more; they stay if they have support.
    return sorted(kept)


def learn_known_words(rows: DataFrame, stems: list[str]) -> list[str]:
    """Words near a stem, but without it, that are in ``MIN_KNOWN`` clean documents and not mostly in toxic ones."""

    def start():
        automaton = Automaton(stems)

        def one(row: dict) -> list[tuple]:
            words = {t.strip(EDGES) for t in set(row["text"].lower().split()) if automaton.token(t)}
            return [(word, row["label"]) for word in words]

        return one

    near = map_rows(rows, "word string, label int", start).groupBy("word")
    counts = near.agg(F.sum(F.col("label")).alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    return [r["word"] for r in counts.where((F.col("clean") >= MIN_KNOWN) & (F.col("clean") >= F.col("toxic"))).collect()]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression by Newton's method, the bias last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class Model:
    stems: list[str]
    weights: list[float]
    known_words: list[str] | tuple = ()

    def automaton(self) -> Automaton:
        return Automaton(self.stems, self.known_words)

    def score(self, x: list[float]) -> float:
        if not self.stems:
            return 0.0
        z = sum(w * v for w, v in zip(self.weights, [*x, 1.0], strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN) -> Model:
    """Learn from labels of documents outside fold 0 of 5."""
    ids = labelled_ids(labels, "toxic", fold(5) != 0, max_rows)
    # About ``max_rows`` rows of two numbers, so they can be broadcast.
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(ids), "doc_id")
    stems = learn_stems(rows)
    if not stems:
        return Model([], [])
    known_words = learn_known_words(rows, stems)
    columns = ", ".join(f"`{name}` double" for name in FEATURES)

    def start():
        automaton = Automaton(stems, known_words)
        return lambda r: [(r["label"], *features(r["text"], automaton))]

    table = np.array(map_rows(rows, f"label int, {columns}", start).collect(), float)
    return Model(stems, fit_logistic(table[:, 1:], table[:, 0]).tolist(), known_words)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` but ``text``, which becomes ``tox_score`` (in the place of a column of this name)."""
    kept = [c for c in docs.columns if c.lower() not in ("text", "tox_score")]
    rows = docs.select(*kept, text_or_empty().alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def start():
        automaton = model.automaton()
        return lambda r: [(*[r[c] for c in kept], model.score(features(r["text"], automaton)))]

    return map_rows(rows, ", ".join([*(f"`{c}` {kinds[c]}" for c in kept), "tox_score double"]), start)


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold."""
    at = docs.columns.index("text")

    def start():
        automaton = model.automaton()

        def one(row: dict) -> list[tuple]:
            values = tuple(row.values())
            return [values] if model.score(features(values[at] or "", automaton)) < threshold else []

        return one

    return map_rows(docs, _ddl(docs), start)


def _ddl(docs: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)


def op6_toxicity(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long"), "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model)
    return scored.select(
        "doc_id",
        (fold(5) == 0).alias("held_out"),
        F.col("tox_score").alias("score"),
        (F.col("tox_score") >= 0.5).cast("int").alias("predicted"),
    )
