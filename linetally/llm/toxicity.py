"""Toxicity by a classifier chain.

Categories are predicted one after the other, in a given order.  Each link is a logistic
regression on the features of a text (its words and how they begin, so that inflected and joined
forms count) and on the log-odds of all earlier categories.  In training those come from models
fitted without the document's fold, so that later links learn from predictions as uncertain as
they will meet.  The same predictions choose each category's threshold, the one of the best F1.

The chain is fitted on a sample of at most ``SAMPLE_DOCS`` labelled documents (those with the
least hash of doc_id), the only bounded part; scoring reads every whole text of all documents.
The vocabulary (the ``VOCABULARY`` features that depend most on some category by chi-square,
among those in ``MIN_DOCS`` sampled documents or more) and the weights go to every task.

Defined cases: a null or empty text has no known feature and gets the scores of the intercepts.
Labels that are null for the first category leave a document out of the sample, others out of
their own link alone; several labels of one doc_id count as their maximum.  Without labelled
documents all scores are 0, and nearly so those of a category that no sampled document has a label
of.  Repeated rows are scored each by itself; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.llm.pretokens import text_slices
from linetally.llm.workers import shipped

SAMPLE_DOCS = 4_000
VOCABULARY = 1_000
MIN_DOCS = 4
FOLDS = 3
STEPS, RATE, RIDGE = 200, 0.1, 1.0
SEED = 7
NEVER = -30.0  # log-odds of a category without labels
SLOTS = 1 << 22
CHARS_AT_ONCE = 1_000_000
START_LENGTHS = (3, 4, 5, 6)
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(words: set[str]) -> set[str]:
    """The words, and the starts of longer words with a star."""
    starts = ({word[:n] for word in words if len(word) > n} for n in START_LENGTHS)
    return words.union(*({f"{start}*" for start in some} for some in starts))


def _slots(features: list[str]) -> np.ndarray:
    return np.fromiter((hash(feature) % SLOTS for feature in features), np.int64, len(features))


def chosen_features(documents: list[set[str]], labels: np.ndarray) -> list[str]:
    """The features that depend most on some category, by chi-square; documents as words.

    A category only counts documents with a label of it.  Features are made anew in each pass instead of being kept.  The first pass counts them in a
    table of slots, so that the second need not hold the many that are too rare.
    """
    in_slot = np.zeros(SLOTS, np.int32)
    for words in documents:
        in_slot[_slots(list(features_of(words)))] += 1
    seen, among, unknown = Counter(), [Counter() for _ in labels.T], [Counter() for _ in labels.T]
    for words, row in zip(documents, labels, strict=True):
        features = list(features_of(words))
        frequent = in_slot[_slots(features)] >= MIN_DOCS
        own = [feature for feature, often in zip(features, frequent.tolist(), strict=True) if often]
        seen.update(own)
        for counter, without, y in zip(among, unknown, row, strict=True):
            (without if np.isnan(y) else counter).update(own if y else ())
    names = sorted(feature for feature, n in seen.items() if n >= MIN_DOCS)
    best = np.zeros(len(names))
    for column, counter, without in zip(labels.T, among, unknown, strict=True):
        positive, total = np.nansum(column), len(documents) - np.isnan(column).sum()
        if not 0 < positive < total:
            continue
        count = np.array([seen[name] - without[name] for name in names], float)
        expected = np.maximum(count * positive / total, np.finfo(float).tiny)
        distance = (np.array([counter[name] for name in names]) - expected) ** 2 / expected
        best = np.maximum(best, distance * total / (total - positive) * total / np.maximum(total - count, 1))
    return [names[i] for i in np.argsort(-best, kind="stable")[:VOCABULARY]]


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which on calling documents positive has the best F1; 0.5 without any."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order])
    f1 = 2 * right / (np.arange(1, len(y) + 1) + y.sum()) if y.sum() else np.zeros(len(y))
    if not len(f1) or not f1.max() > 0:
        return 0.5
    last = int(np.argmax(f1))
    following = p[order[last + 1]] if last + 1 < len(order) else 0.0
    return float(p[order[last]] + following) / 2


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Presence:
    """Which features the documents have: places in a vocabulary, document after document."""

    places: np.ndarray
    counts: np.ndarray
    size: int

    @classmethod
    def of(cls, documents: Iterable[set[str]], vocabulary: dict[str, int]) -> Presence:
        """For documents as words."""
        known = vocabulary.keys()
        found = [sorted(vocabulary[feature] for feature in features_of(words) & known) for words in documents]
        places = np.array([p for x in found for p in x], np.int64)
        return cls(places, np.array([len(x) for x in found], np.int64), len(vocabulary))

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights[self.places], len(self.counts))

    def gather(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.places, np.repeat(errors, self.counts), self.size)

    def pick(self, documents: np.ndarray) -> Presence:
        keep = documents[self.owner]
        return Presence(self.places[keep], self.counts[documents], self.size)


@dataclass
class Link:
    """One logistic regression: words, earlier categories, intercept."""

    words: np.ndarray
    earlier: np.ndarray
    intercept: float

    def log_odds(self, x: Presence, earlier: np.ndarray) -> np.ndarray:
        return x.times(self.words) + earlier @ self.earlier + self.intercept

    @classmethod
    def fit(cls, x: Presence, earlier: np.ndarray, y: np.ndarray) -> Link:
        """Ridge logistic regression by Adam over the whole sample."""
        n_words, n_earlier = x.size, earlier.shape[1]
        weights = np.zeros(n_words + n_earlier + 1)
        first, second = np.zeros_like(weights), np.zeros_like(weights)
        penalty = np.r_[np.full(n_words + n_earlier, RIDGE), 0.0]
        link = cls(weights[:n_words], weights[n_words:-1], 0.0)
        for step in range(1, STEPS + 1):
            errors = _sigmoid(link.log_odds(x, earlier)) - y
            slope = np.r_[x.gather(errors), errors @ earlier, errors.sum()] + penalty * weights
            first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
            rate = RATE * (1 - step / (STEPS + 1))
            weights = weights - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            link = cls(weights[:n_words], weights[n_words:-1], float(weights[-1]))
        return link


@dataclass
class Chain:
    categories: list[str]
    vocabulary: dict[str, int]
    links: list[Link]
    thresholds: list[float]

    @classmethod
    def fit(cls, documents: list[set[str]], labels: np.ndarray, categories: list[str]) -> Chain:
        """The chain for documents as sets of words and labels (documents, categories) of 0, 1 and nan."""
        if not documents:
            return cls(categories, {}, [], [0.5] * len(categories))
        vocabulary = {feature: i for i, feature in enumerate(chosen_features(documents, labels))}
        x = Presence.of(documents, vocabulary)
        # Copies of a text share a fold: what held-out documents are judged by has not seen them.
        texts: dict[frozenset[str], int] = {}
        of_text = np.array([texts.setdefault(frozenset(words), len(texts)) for words in documents], int)
        fold = (np.random.default_rng(SEED).permutation(len(texts)) % FOLDS)[of_text]
        links, thresholds, earlier = [], [], np.zeros((len(documents), 0))
        for column in range(len(categories)):
            y = labels[:, column].astype(float)
            known, outside = ~np.isnan(y), np.zeros(len(documents))
            for k in range(FOLDS):
                held = fold == k
                others = ~held & known
                if others.any():
                    link = Link.fit(x.pick(others), earlier[others], y[others])
                    outside[held] = link.log_odds(x.pick(held), earlier[held])
            if known.any():
                links.append(Link.fit(x.pick(known), earlier[known], y[known]))
            else:  # later links get no weight on it, as it is 0 for all while they learn
                links.append(Link(np.zeros(x.size), np.zeros(column), NEVER))
            thresholds.append(best_threshold(_sigmoid(outside[known]), y[known]))
            earlier = np.column_stack([earlier, outside])
        return cls(categories, vocabulary, links, thresholds)

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """(texts, categories)"""
        if not self.links:
            return np.zeros((len(texts), len(self.categories)))
        x = Presence.of(map(words_of, texts), self.vocabulary)
        earlier = np.zeros((len(texts), 0))
        for link in self.links:
            earlier = np.column_stack([earlier, link.log_odds(x, earlier)])
        return _sigmoid(earlier)


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], sample: int = SAMPLE_DOCS) -> Chain:
    """The chain for categories given as boolean columns over ``labels``, in their order.

    The driver gets the distinct words of at most ``sample`` documents.
    """
    names = list(categories)
    known = (
        labels.select(F.col("doc_id").cast("long"), *[c.cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())])
        .dropna(subset=["doc_id", "y0"])
        .groupBy("doc_id")
        .agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(names))])
        .orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id")
        .limit(sample)
    )
    text = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    joined = text.join(F.broadcast(known), "doc_id").groupBy("doc_id", *[f"y{i}" for i in range(len(names))])
    rows = joined.agg(F.min("text").alias("text"))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pa.array([sorted(words_of(t)) for t in batch.column("text").to_pylist()], pa.list_(pa.string()))
            yield batch.drop_columns(["text"]).append_column("words", words)

    schema = "doc_id long, " + ", ".join(f"y{i} int" for i in range(len(names))) + ", words array<string>"
    found = sorted(shipped(rows).mapInArrow(distinct, schema).collect(), key=lambda row: row.doc_id)
    y = np.array([[row[f"y{i}"] for i in range(len(names))] for row in found], float).reshape(len(found), len(names))
    same: dict[str, str] = {}  # one object per word
    documents = []
    for i, row in enumerate(found):
        documents.append({same.setdefault(word, word) for word in row.words})
        found[i] = None
    return Chain.fit(documents, y, names)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, p_<category> for every category, and <category> as a verdict by its threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = chain.categories

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, CHARS_AT_ONCE):
                p = shared.value.probabilities(texts.to_pylist())
                scores = {f"p_{name}": pa.array(p[:, i]) for i, name in enumerate(names)}
                verdicts = {name: pa.array(p[:, i] >= shared.value.thresholds[i]) for i, name in enumerate(names)}
                yield pa.RecordBatch.from_pydict({"doc_id": rows.column("doc_id"), **scores, **verdicts})

    schema = ", ".join(["doc_id long", *[f"p_{x} double" for x in names], *[f"{x} boolean" for x in names]])
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return shipped(texts).mapInArrow(rate, schema)
