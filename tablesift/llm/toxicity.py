"""Toxicity classifier with counterfactual regularisation.

**Features.** Indicators of a text's lower-case words, without signs at their ends, and of
the first 4, 5 and 6 letters of longer words (compounds and endings). Of the indicators in
the sample the ``FEATURES`` with the greatest chi-square for the label (``LEAST_CHI`` at
least) are used, and those of the identity terms always.

**Model.** Logistic regression. For every labelled sentence that holds an identity term,
the term is swapped for every other of its list; the squared change of the linear score under
each swap is a penalty, so a group's mention moves the score as any other group's does and
is not held against a neutral text. Accelerated gradient steps on the penalised loss; the weights of
identity terms are thereby pulled to a common value, and the loss decides on that value.

**Sample.** The fit uses at most ``SAMPLE`` labelled rows, those of smallest hash of
doc_id; scoring runs over every row. What reaches the driver are the chosen indicators of
the sample's rows and its swaps, never texts.

Null and empty texts have no indicator and get the score of the bias. Rows without a label
or doc_id are not learned from. Without rows of both classes every score is the share of
label 1 (0.5 without rows). Repeated rows are scored one by one; columns of ``docs`` are
passed through, ``score`` is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import labelled_sample

SAMPLE = 20_000
FEATURES = 4096
LEAST_CHI = 27.0  # chi-square an indicator must have, about four rows that all have the label
RIDGE = 0.001
SWAP_PENALTY = 5.0
CACHED = 200_000
#: Lists of group names; terms of one list take each other's place.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("disabled", "deaf", "blind", "old", "young"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "einheimische"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "réfugiés"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "refugiados"),
)
ENDS = re.compile(r"^[^\w]+|[^\w]+$")
SENTENCE = re.compile(r"[.!?\n]+")


def word_features(word: str) -> tuple[str, ...]:
    """The indicators of one white-space word."""
    bare = ENDS.sub("", word.lower())
    if not bare:
        return ()
    return (bare, *[f"{bare[:k]}-" for k in (4, 5, 6) if len(bare) > k])


class Known(dict):
    """Word to those of its indicators that are in a vocabulary (any, if there is none)."""

    def __init__(self, vocabulary=None):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) >= CACHED:
            self.clear()
        found = word_features(word)
        if self.vocabulary is not None:
            found = tuple(k for k in found if k in self.vocabulary)
        self[word] = found
        return found


def indicators(text: str | None, known: Known) -> set[str]:
    out: set[str] = set()
    for found in map(known.__getitem__, set((text or "").split())):
        if found:
            out.update(found)
    return out


def swapped(text: str | None, others: dict[str, list[str]]) -> Iterator[tuple[str, str]]:
    """(word, other term) for the identity terms of each sentence of a text."""
    for sentence in SENTENCE.split(text or ""):
        for word in set(sentence.split()):
            for other in others.get(ENDS.sub("", word.lower()), ()):
                yield word, other


def identity_swaps(terms: Sequence[Sequence[str]]) -> dict[str, list[str]]:
    """Each term with the other terms of its list."""
    return {t: [*group[i + 1:], *group[:i]] for group in terms for i, t in enumerate(group)}


class Model:
    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def score(self, found: set[str]) -> float:
        z = self.bias + sum(self.weights[k] for k in found if k in self.weights)
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def fit(rows: list[list[str]], labels: list[int], swaps: Counter, vocabulary: list[str]) -> Model:
    """``swaps``: how often the indicators of one term (a tuple) took the place of another's."""
    y = np.array(labels, float)
    if len(y) == 0 or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
        return Model({}, float(np.log(share / (1 - share))))
    names = {k: i for i, k in enumerate(vocabulary)}
    index = [np.array([names[k] for k in r if k in names], np.int64) for r in rows]
    at = np.concatenate([np.full(len(k), i) for i, k in enumerate(index)])
    col = np.concatenate(index) if index else np.empty(0, np.int64)
    d = len(names)
    changes = []
    for (old, new), times in swaps.items():
        delta = np.zeros(d)
        for k in new:
            delta[names[k]] += k in names
        for k in old:
            if k in names:
                delta[names[k]] -= 1
        changes.append(delta * np.sqrt(times))
    change = np.array(changes).reshape(-1, d) * np.sqrt(SWAP_PENALTY / len(y))
    w, bias = np.zeros(d), float(np.log(y.mean() / (1 - y.mean())))
    momentum, rate, v = 0.9, 0.9, np.zeros(d + 1)
    # accelerated gradient steps, scaled by a bound of each indicator's curvature
    often = np.bincount(col, minlength=d)
    scale = 0.25 * often / len(y) * 8 + RIDGE / np.sqrt(len(y)) + 2 * (np.abs(change) * np.abs(change).sum(axis=1)[:, None]).sum(axis=0) + 1e-4
    for _ in range(400):
        look, look_bias = w + momentum * v[:d], bias + momentum * v[d]
        z = look_bias + np.bincount(at, look[col], len(y))
        miss = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) / len(y)
        gradient = np.bincount(col, miss[at], d) + RIDGE / np.sqrt(len(y)) * look + 2 * change.T @ (change @ look)
        v[:d] = momentum * v[:d] - rate * gradient / scale
        v[d] = momentum * v[d] - rate * miss.sum()
        w, bias = w + v[:d], bias + v[d]
        if np.abs(v).max() < 1e-5:
            break
    return Model({k: float(w[i]) for k, i in names.items() if w[i]}, float(bias))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 4, fold: int = 2, sample: int = SAMPLE,
          terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> Model:
    spark = docs.sparkSession
    rows = labelled_sample(docs, labels, label, folds, fold, sample)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known, both = Known(), (Counter(), Counter())
            for text, y in zip(batch["text"], batch["label"], strict=True):
                both[y].update(indicators(text, known))
            for y, counts in enumerate(both):
                yield pd.DataFrame({"feature": list(counts), "n": list(counts.values()), "label": y})

    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return fit([], [1] * min(n1, 1) + [0] * min(n0, 1), Counter(), [])
    one = F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0))
    zero = F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0))
    stats = rows.select("text", "label").mapInPandas(counted, "feature string, n long, label int").groupBy("feature").agg(one.alias("a"), zero.alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    difference = a * (n0 - b) - b * (n1 - a)
    chi = difference * difference / ((a + b) * (n1 + n0 - a - b) + 1)
    chosen = stats.where(chi >= LEAST_CHI).orderBy(chi.desc(), "feature").limit(FEATURES).select("feature")
    others = identity_swaps(terms)
    vocabulary = sorted({r["feature"] for r in chosen.collect()} | {k for t in others for k in word_features(t)})
    shared = spark.sparkContext.broadcast(frozenset(vocabulary))

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Known(shared.value)
        for batch in batches:
            found = [sorted(indicators(t, known)) for t in batch["text"]]
            swaps = [[f"{' '.join(word_features(w))}\t{' '.join(word_features(o))}" for w, o in swapped(t, others)] for t in batch["text"]]
            yield pd.DataFrame({"h": batch["_h"], "label": batch["label"], "found": found, "swaps": swaps})

    got = rows.mapInPandas(described, "h long, label int, found array<string>, swaps array<string>").orderBy("h", "label", "found").limit(sample).toPandas()
    swaps: Counter = Counter()
    for each in got["swaps"]:
        for old, new in (s.split("\t") for s in each):
            swaps[tuple(old.split(" ")), tuple(new.split(" "))] += 1
    return fit([list(x) for x in got["found"]], got["label"].tolist(), swaps, vocabulary)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score: the probability of label 1."""
    ready = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        chosen = ready.value
        known = Known(chosen.weights)
        for batch in texts:
            yield pd.Series([chosen.score(indicators(t, known)) for t in batch], dtype="float64")

    return docs.withColumn("score", score("text"))
