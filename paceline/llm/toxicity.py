"""Toxicity by classifier chains.

The categories stand in an order. A linear model (logistic regression on the presence of words and word beginnings) is
fitted for each; the model of a category also sees the probabilities that the models before it gave. Those inputs are
out-of-fold while fitting: a row's come from models fitted on the other folds, whose features are chosen without it, too, so
later models learn from predictions as uncertain as they will meet. At scoring time the chain runs from front to back.

Fitting takes a bounded sample of labelled rows; scoring reads every whole text in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.common import claim, give_back, hashed_sample, id_and_text, materialize

#: Labelled rows that the chain is fitted on, at most: those of the least hashes of doc_id. Features for each category.
SAMPLE, FEATURES, FOLDS, STEPS, RIDGE = 8000, 600, 3, 200, 0.3
#: Places by hash for the features of the sample, a byte each, twice.
SLOTS = 1 << 22
#: Lengths of the word beginnings that count as features, besides whole words.
BEGINNINGS = (4, 5, 6)
#: A document is rejected from this probability of the last category on.
THRESHOLD = 0.3

_word = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> set[str]:
    return set(_word(text.lower()))


def features_of_word(word: str) -> list[str]:
    return [f"={word}", *[word[:n] for n in BEGINNINGS if len(word) > n]]


class Numbered:
    """Features as numbers, given out as they are met; a word's features are worked out once. `texts`: only features that may
    occur in several of them get a number, as no other can tell anything; most words are in one text, and are not held."""

    def __init__(self, texts: list[str]):
        self.numbers: dict[str, int] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        once, self.several = np.zeros(SLOTS, bool), np.zeros(SLOTS, bool)  # by hash; of features that share one, all stay
        for text in texts:
            at = np.fromiter({hash(f) % SLOTS for w in words_of(text) for f in features_of_word(w)}, np.int64)
            self.several[at[once[at]]] = True
            once[at] = True

    def __call__(self, text: str) -> np.ndarray:
        """The features of a text, ascending."""
        found: set[int] = set()
        for w in words_of(text):
            of = self.words.get(w)
            if of is None:
                named = features_of_word(w)
                of = tuple([self.numbers.setdefault(f, len(self.numbers)) for f in named if self.several[hash(f) % SLOTS]])
                if self.several[hash(named[0]) % SLOTS]:
                    self.words[w] = of
            found.update(of)
        return np.array(sorted(found), np.int32)


@dataclass
class Rows:
    """Sparse presence features: the features of row i are at starts[i] to starts[i + 1]."""

    index: np.ndarray
    starts: np.ndarray

    def dot(self, w: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(w[self.index])])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def back(self, r: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(self.index, np.repeat(r, np.diff(self.starts)), n)

    def take(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.starts)[rows]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(starts[-1]) - np.repeat(starts[:-1], sizes) + np.repeat(self.starts[:-1][rows], sizes)
        return Rows(self.index[at], starts)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_linear(x: Rows, extra: np.ndarray, y: np.ndarray, n: int, steps: int = STEPS, ridge: float = RIDGE) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the features, then of the extra inputs and the constant: ridge logistic regression by accelerated
    gradient steps, each coordinate scaled by a bound on its curvature."""
    dense = np.concatenate([extra, np.ones((len(y), 1))], axis=1)
    width = np.maximum(np.diff(x.starts), 1) + (np.abs(dense) > 0).sum(1)
    scale_w = ridge + 0.25 * x.back(width.astype(float), n)
    scale_v = ridge + 0.25 * (dense**2 * width[:, None]).sum(0)
    w, v = np.zeros(n), np.zeros(dense.shape[1])
    pw, pv, t = w, v, 1.0
    for _ in range(steps):
        grown = (1 + (1 + 4 * t * t) ** 0.5) / 2
        lw, lv = w + (t - 1) / grown * (w - pw), v + (t - 1) / grown * (v - pv)
        r = sigmoid(x.dot(lw) + dense @ lv) - y
        pw, pv, t = w, v, grown
        w = lw - (x.back(r, n) + ridge * lw) / scale_w
        v = lv - (dense.T @ r + ridge * np.append(lv[:-1], 0)) / scale_v
    return w, v


@dataclass
class Chain:
    categories: list[str]
    vocabulary: dict[str, int]
    models: list[tuple[np.ndarray, np.ndarray]]

    def rows(self, found: list[list[int]]) -> Rows:
        return Rows(np.array([i for x in found for i in x], np.int64), np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64))

    def chained(self, x: Rows) -> np.ndarray:
        """Probabilities of each category, from front to back."""
        out = np.zeros((len(x.starts) - 1, 0))
        for w, v in self.models:
            out = np.concatenate([out, sigmoid(x.dot(w) + out @ v[:-1] + v[-1])[:, None]], axis=1)
        return out

    def probabilities(self, texts: list[str]) -> np.ndarray:
        known = _known(self)
        return self.chained(self.rows([sorted({i for w in words_of(t) for i in known[w]}) for t in texts]))


class _Known(dict):
    """Word to the numbers of its features, bounded."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 200_000:
            self.clear()
        found = self[word] = tuple(self.vocabulary[f] for f in features_of_word(word) if f in self.vocabulary)
        return found


_caches: dict[int, _Known] = {}


def _known(chain: Chain) -> _Known:
    claim("toxicity", _caches.clear)
    key = hash((tuple(chain.categories), tuple(chain.vocabulary)))
    if key not in _caches:
        _caches.clear()
        _caches[key] = _Known(chain.vocabulary)
    return _caches[key]


def _telling(found: list[np.ndarray], names: list[str], y: np.ndarray, n: int) -> list[str]:
    """The n features whose presence tells most about y, by the likelihood ratio; ties by name."""
    total, ones = len(y), int(y.sum())
    if not names or not 0 < ones < total:
        return []
    a, b = np.zeros(len(names)), np.zeros(len(names))
    for f, v in zip(found, y, strict=True):
        (a if v else b)[f] += 1  # a text has a feature once
    seen, share = a + b, ones / total

    def part(k: np.ndarray, p: float) -> np.ndarray:
        return np.where(k > 0, k * np.log(np.maximum(k, 1e-9) / np.maximum(seen * p, 1e-9)), 0)

    ratio = np.where(seen > 1, part(a, share) + part(b, 1 - share), -1)
    best = np.flatnonzero(ratio >= max(0, np.partition(ratio, -min(n, len(ratio)))[-min(n, len(ratio))]))
    return [names[i] for i in sorted(best.tolist(), key=lambda i: (-ratio[i], names[i]))[:n]]


def fit_chain(texts: list[str], labels: dict[str, np.ndarray], features: int = FEATURES, folds: int = FOLDS, steps: int = STEPS, ridge: float = RIDGE) -> Chain:
    """labels: 0 and 1 of each category, in the chain's order. Without rows every probability is nearly 0."""
    numbered = Numbered(texts)
    found = [numbered(t) for t in texts]
    listed = list(numbered.numbers)
    del numbered

    def chosen(rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The features that tell most about any category within these rows, and the place of each feature among them."""
        of = [found[i] for i in rows]
        names = sorted({f for y in labels.values() for f in _telling(of, listed, y[rows], features)})
        at = {f: i for i, f in enumerate(names)}
        return names, np.array([at.get(f, -1) for f in listed], np.int64)

    def of_rows(rows: np.ndarray, place: np.ndarray) -> Rows:
        kept = [np.sort(p[p >= 0]) for p in (place[found[r]] for r in rows)]
        return Rows(np.concatenate(kept), np.concatenate([[0], np.cumsum([len(p) for p in kept])]).astype(np.int64))

    every = np.arange(len(texts))
    names, place = chosen(every)
    chain = Chain(list(labels), {f: i for i, f in enumerate(names)}, [])
    if not texts:
        chain.models = [(np.zeros(0), np.append(np.zeros(k), -35.0)) for k in range(len(labels))]
        return chain
    x = of_rows(every, place)
    splits = []
    for k in range(folds if len(labels) > 1 else 0):
        learn, held = every[every % folds != k], every[every % folds == k]
        if len(learn) and len(held):
            own, at = chosen(learn)
            splits.append((learn, held, len(own), of_rows(learn, at), of_rows(held, at)))
    del found, listed
    out_of_fold = np.zeros((len(texts), 0))
    for y in labels.values():
        y = y.astype(float)
        chain.models.append(fit_linear(x, out_of_fold, y, len(names), steps, ridge))
        if len(chain.models) < len(labels):
            p = np.full(len(texts), y.mean())  # where there is nothing to learn from: the share of all rows
            for learn, held, n, x_learn, x_held in splits:
                w, v = fit_linear(x_learn, out_of_fold[learn], y[learn], n, steps, ridge)
                p[held] = sigmoid(x_held.dot(w) + out_of_fold[held] @ v[:-1] + v[-1])
            out_of_fold = np.concatenate([out_of_fold, p[:, None]], axis=1)
    return chain


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, str], sample: int = SAMPLE) -> Chain:
    """A chain fitted on at most `sample` labelled rows. categories: name to an SQL condition on the columns of labels, in
    the chain's order; rows where a condition is null are not used, nor are null ids and texts. Of rows that share an id one
    is used."""
    named = [F.expr(c).cast("int").alias(f"__c{k}") for k, c in enumerate(categories.values())]
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *named).dropna()
    texts = id_and_text(docs.where(F.col("text").isNotNull()))
    chosen = materialize(hashed_sample(known, "doc_id", sample, known.count()), "chosen")
    rows = texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).collect()  # at most `sample`
    rows.sort(key=lambda r: (r["__h"], r.doc_id))
    y = {c: np.array([r[f"__c{k}"] for r in rows], np.int64) for k, c in enumerate(categories)}
    texts = [r.text for r in rows]
    del rows
    chain = fit_chain(texts, y)
    del texts
    give_back()
    return chain


#: The chain's categories, from the table of labels: junk first, as what tells junk apart then helps with toxic texts.
CATEGORIES = {"junk": "quality = 0", "toxic": "toxic = 1"}


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, p_<category> for each category, rejected, for each row of docs; null texts are empty ones, which are judged by
    the models' constants. Repeated rows give repeated results, an empty table an empty one; very long texts count each word
    once; ties at the threshold are rejected."""
    names = [f"p_{c}" for c in chain.categories]
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # at most len(categories) * FEATURES features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part = batch.slice(lo, 512)
                p = shared.value.probabilities(part.column(1).to_pylist())
                yield pa.record_batch([part.column(0), *[pa.array(p[:, k], pa.float64()) for k in range(len(names))]], ["doc_id", *names])

    scored = id_and_text(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"`{n}` double" for n in names))
    return scored.withColumn("rejected", F.col(f"`{names[-1]}`") >= threshold)


def keep_clean(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score() doesn't reject, all columns as they are, repeated rows and rows without an id or a text
    among them; an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        out: list[bool] = []
        for lo in range(0, len(texts), 512):
            p = shared.value.probabilities([t or "" for t in texts.slice(lo, 512).to_pylist()])
            out += (p[:, -1] < threshold).tolist()
        return pa.array(out, pa.bool_())

    return docs.where(clean(F.col("text").cast("string")))
