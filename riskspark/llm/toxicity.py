"""Toxicity: misspelled lexicon terms by Levenshtein automata, weighed by context.

The lexicon is a trie of seed terms and of words that mark toxic documents in a bounded labelled sample. The automata of all
terms run over a word at once: a state is the set of trie nodes still within reach, each with its edit row, and states
and their steps are built when first met. Terms under 5 letters allow no edit, under 9 one, longer ones two; a swap of neighbouring
letters is one edit. A word with punctuation inside is matched whole and by its parts. A hit counts less
per edit and less where its window speaks about the term: in quotation marks or next to a reporting word. Logistic
regression turns the sums into a score. Words that the lexicon reaches by edits but that clean training documents use are excluded.

Nulls and ties: null text is empty; a text without hits gets one low score. Null ids are scored and count as held out.
Repeated rows get equal scores. Without labelled rows the seed terms score with fixed weights. Further columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.labelled import held_out, training_texts
from riskspark.llm.words import utf8
from riskspark.session import stored

# Terms of abuse known beforehand, and words that report what others say.
SEEDS = "idiot moron stupid loser scum trash pathetic worthless disgusting clown imbecile scumbag dumbass asshole bastard bitch retard subhuman vermin"
REPORTING = "said says saying called calls wrote writes quoted quotes quote word words term terms insult insults slur meaning means"

REPORTING_WORDS = frozenset(REPORTING.split())
QUOTES = re.compile(r"[\"“”„«»]|(?<!\w)[‘’]|[‘’](?!\w)")
INNER = re.compile(r"[\W_]+")
CONTEXT = 4
WORD_CACHE = 200_000
FEATURES = 6


def budget(term: str) -> int:
    """Edits that a term allows."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Matcher:
    """Nearest lexicon term of a word: the trie and the edit rows of its nodes, stepped together."""

    def __init__(self, terms: list[str]):
        self.letters: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.reach = [0]  # largest budget below the node
        for term in sorted(terms):
            node = 0
            self.reach[0] = max(self.reach[0], budget(term))
            for letter in term:
                if letter not in self.letters[node]:
                    self.letters[node][letter] = len(self.letters)
                    self.letters.append({})
                    self.term.append(None)
                    self.reach.append(0)
                node = self.letters[node][letter]
                self.reach[node] = max(self.reach[node], budget(term))
            self.term[node] = term
        self.alphabet = frozenset("".join(terms))
        self.real = len(self.letters)
        # Nodes that wait for the first of two swapped letters, by the node before both and the letter read; they allow no edit.
        self.swaps: list[dict[str, list[int]]] = [{} for _ in self.letters]
        for node in range(self.real):
            for first, below in list(self.letters[node].items()):
                for second, end in list(self.letters[below].items()):
                    if first != second and self.reach[end]:
                        self.swaps[node].setdefault(second, []).append(len(self.letters))
                        self.letters.append({first: end})
                        self.term.append(None)
                        self.reach.append(self.reach[end])
        self.reset()

    def reset(self) -> None:
        """States by number, met so far: their nodes, steps and nearest term. State 0 is the dead one, 1 the start."""
        self.states: list[tuple] = [(), self.closed({0: 0})]
        self.numbers = {state: number for number, state in enumerate(self.states)}
        self.steps: list[dict[str, int]] = [{}, {}]
        self.accepts: list[tuple[str, int] | None] = [None, self.accepted(self.states[1])]

    def accepted(self, state: tuple) -> tuple[str, int] | None:
        found = [(cost, self.term[node]) for node, cost in state if self.term[node] is not None and cost <= budget(self.term[node])]
        return (min(found)[1], min(found)[0]) if found else None

    def numbered(self, state: tuple) -> int:
        number = self.numbers.setdefault(state, len(self.states))
        if number == len(self.states):
            self.states.append(state)
            self.steps.append({})
            self.accepts.append(self.accepted(state))
        return number

    def closed(self, costs: dict[int, int]) -> tuple:
        """Adds the nodes reached by leaving out letters of the term; drops nodes beyond their budget."""
        todo = sorted(costs, key=costs.get)
        while todo:
            node = todo.pop(0)
            if costs[node] >= self.reach[node] or node >= self.real:
                continue  # no edit left below
            for below in self.letters[node].values():
                cost = costs[node] + 1
                if cost <= self.reach[below] and cost < costs.get(below, 99):
                    costs[below] = cost
                    todo.append(below)
        return tuple(sorted((n, c) for n, c in costs.items() if c <= self.reach[n]))

    def step(self, state: tuple, letter: str) -> tuple:
        costs: dict[int, int] = {}
        for node, cost in state:
            if cost >= self.reach[node] or node >= self.real:  # only the letter itself goes on
                below = self.letters[node].get(letter)
                if below is not None and cost <= self.reach[below] and cost < costs.get(below, 99):
                    costs[below] = cost
                continue
            for at, price in [(node, cost + 1), *((below, cost + (letter != own)) for own, below in self.letters[node].items()), *((at, cost + 1) for at in self.swaps[node].get(letter, ()))]:
                if price <= self.reach[at] and price < costs.get(at, 99):
                    costs[at] = price
        return self.closed(costs)

    def nearest(self, word: str) -> tuple[str, int] | None:
        if len(self.states) > 50_000:
            self.reset()
        at, steps, alphabet = 1, self.steps, self.alphabet
        for letter in word:
            following = steps[at].get(letter)
            if following is None:
                known = letter if letter in alphabet else "\0"
                following = self.numbered(self.step(self.states[at], known))
                steps[at][letter] = following
            if not following:
                return None
            at = following
        return self.accepts[at]


_MATCHERS: dict[tuple, Matcher] = {}


def matcher_of(terms: list[str]) -> Matcher:
    """The worker process keeps the matcher of its latest lexicon, so states are built once a process and not once a task."""
    key = tuple(sorted(terms))
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(list(key))
    return _MATCHERS[key]


def plain(raw: bytes) -> str:
    """A word in lower case without what is not a letter at its ends."""
    word = raw.decode().lower()
    if word.isalpha():
        return word
    letters = [i for i, c in enumerate(word) if c.isalpha()]
    return word[letters[0] : letters[-1] + 1] if letters else ""


def parts(word: str) -> list[str]:
    """The words between punctuation inside a plain word; none if there is no such punctuation."""
    if word.isalnum():
        return []
    found = [plain(part.encode()) for part in INNER.split(word)]
    return [part for part in found if part]


@dataclass
class Model:
    weights: dict[str, float]
    excluded: frozenset[str] = frozenset()
    beta: np.ndarray = field(default_factory=lambda: np.array([-4.0, 2.0, 0.5, 1.0, 0.5, 0.5, 0.0]))


class Scanner(dict):
    """Hits, as (term, edits), of a raw word; none for most. Remembers a bounded number of words."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.matcher = model, matcher_of(list(model.weights))

    def nearest(self, word: str) -> tuple[str, int] | None:
        hit = self.matcher.nearest(word) if word else None
        return None if hit and hit[1] and word in self.model.excluded else hit

    def __missing__(self, raw: bytes):
        if len(self) >= WORD_CACHE:
            self.clear()
        word = plain(raw)
        whole = self.nearest(word)
        found = tuple(filter(None, map(self.nearest, parts(word))))
        if whole and (not found or whole[1] < min(edits for _, edits in found)):
            found = (whole,)
        if len(raw) < 64:
            self[raw] = found
        return found

    def hits(self, text: bytes) -> tuple[int, list[tuple[int, str, int, bool]]]:
        """Number of words, and place, term, edits and whether it is spoken about, of every hit."""
        words = text.split()
        found = list(map(self.__getitem__, words))
        if not any(found):
            return len(words), []
        out = []
        for at, own_hits in enumerate(found):
            if own_hits:
                near = [w.decode().lower() for w in words[max(0, at - CONTEXT) : at + CONTEXT + 1]]
                own = words[at].decode()
                about = bool(QUOTES.search(own)) or any(w.strip(".,:;") in REPORTING_WORDS for w in near)
                out += [(at, *hit, about) for hit in own_hits]
        return len(words), out

    def features(self, text: bytes) -> list[float]:
        n, hits = self.hits(text)
        abuse, quoted, most, terms, fuzzy = 0.0, 0.0, 0.0, set(), 0.0
        for _, term, edits, about in hits:
            weight = self.model.weights[term] * 0.7**edits
            quoted += weight * about
            abuse += weight * (0.3 if about else 1.0)
            fuzzy += weight * (edits > 0)
            most = max(most, weight * (0.3 if about else 1.0))
            terms.add(term)
        return [math.log1p(abuse), math.log1p(100 * abuse / max(n, 1)), most, math.log1p(len(terms)), math.log1p(fuzzy), math.log1p(quoted)]


_SCANNERS: dict[tuple, Scanner] = {}


def scanner_of(model: Model) -> Scanner:
    """The scanner, with the words it remembers, also outlives a task."""
    key = (tuple(sorted(model.weights.items())), model.excluded)
    if key not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[key] = Scanner(model)
    return _SCANNERS[key]


def training_words(sample: DataFrame) -> DataFrame:
    """word, toxic and clean: numbers of documents of the sample that use it."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, labels = [], []
            for text, label in zip(utf8(batch.column("text")), batch.column("label").to_pylist(), strict=True):
                whole = {plain(raw) for raw in set(text.split())}
                own = whole.union(*map(parts, whole)) - {""}
                words += own
                labels += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(labels, pa.int32())], names=["word", "label"])

    pairs = sample.select("text", "label").mapInArrow(distinct, "word string, label int")
    return pairs.groupBy("word").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))


def near_clean_words(words: DataFrame, terms: list[str]) -> frozenset[str]:
    """Words of clean documents that are an edit or two away from a term, not equal to one."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = matcher_of(terms)
        for batch in batches:
            own = [w for w in batch.column("word").to_pylist() if (hit := matcher.nearest(w)) and hit[1]]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string())], names=["word"])

    found = words.filter("clean > 0 AND clean >= toxic").select("word").mapInArrow(near, "word string")
    return frozenset(r["word"] for r in found.toLocalIterator())  # a part of the sample's words


def logistic(rows: np.ndarray, labels: np.ndarray, rounds: int = 30, ridge: float = 0.1) -> np.ndarray:
    """Newton's method; classes weigh alike to half their imbalance."""
    x = np.column_stack([np.ones(len(rows)), rows])
    beta = np.zeros(x.shape[1])
    weight = np.where(labels == 1, math.sqrt((labels == 0).sum() / max((labels == 1).sum(), 1)), 1.0)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (labels - p)) - ridge * beta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(bend, grad)
        beta += np.clip(step, -5, 5)
        if abs(step).max() < 1e-6:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = 20_000, least: int = 4, most_terms: int = 1_000) -> Model:
    """Learns terms, exclusions and weights from at most `sample` labelled documents; at most `most_terms` learned terms."""
    rows = training_texts(docs, labels, label, sample)
    words = stored(training_words(rows))  # read for the terms and for the exclusions
    share = (F.col("toxic") + 0.05) / (F.col("toxic") + F.col("clean") + 1.0)
    learned = words.filter((F.length("word") >= 4) & (F.col("toxic") >= least) & (share >= 0.75)).select("word", share.alias("share"))
    weights = {term: 1.0 for term in SEEDS.split()}
    weights |= {r["word"]: float(r["share"]) for r in learned.orderBy(F.desc("share"), "word").limit(most_terms).collect()}
    model = Model(weights, near_clean_words(words, list(weights)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = scanner_of(model)
        for batch in batches:
            found = [scanner.features(text) for text in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column("label")], names=["features", "label"])

    found = rows.select("text", "label").mapInArrow(measure, "features array<double>, label int").toPandas()
    if found["label"].nunique() == 2:
        model.beta = logistic(np.array(found["features"].tolist()), found["label"].to_numpy(np.float64))
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Per input row: doc_id, held_out, score, predicted, and how many hits count as abuse or are spoken about."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = scanner_of(model)
        for batch in batches:
            rows = np.array([scanner.features(text) for text in utf8(batch.column("text"))]).reshape(batch.num_rows, FEATURES)
            margin = model.beta[0] + rows @ model.beta[1:]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(margin, -30, 30))))], names=["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(of, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
