"""Quality classifier: naive Bayes support vectors over word-shape n-grams.

**Features.** Each white-space word becomes its shape (runs of capitals ``A``, small
letters ``a``, digits ``0``, other signs once each), or ``=`` if it repeats the word before
it. Indicators are the shape 1-, 2- and 3-grams that occur, and for each 1-gram and for
the distinct words the power of two that its share of all words reaches.

**Model.** An indicator's value is its log-count ratio between the two classes (add-one
smoothing); a linear hinge-loss model over these values, rows scaled to unit length, is
fitted by dual coordinate descent. Its margins are turned into probabilities by a logistic
curve, fitted on a fifth of the sample that the descent doesn't see.

**Sample.** The fit uses at most ``SAMPLE`` labelled rows, those of smallest hash of
doc_id, all of them while there are fewer; scoring runs over every row. Indicators are
counted and numbered in Spark: what reaches the driver are the names that enter the model and, for each row
of the sample, their numbers.

Null and empty texts have the single indicator "empty" and are scored like others. Rows
without a label or doc_id are not learned from. Without rows of both classes every score
is the share of label 1 (0.5 without rows). Repeated rows are scored one by one; columns
of ``docs`` are passed through, ``score`` is replaced.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import require, saved

SAMPLE = 20_000
LEAST_ROWS = 3  # rows of the sample an indicator must occur in
EPOCHS = 12
COST = 1.0
CACHED = 200_000  # words a Python worker remembers the shapes of


class Shapes(dict):
    """Word to shape; forgets all when it is full."""

    def __missing__(self, word: str) -> str:
        if len(self) >= CACHED:
            self.clear()
        out, last = [], ""
        for c in word:
            sign = ("A" if c.isupper() else "a") if c.isalpha() else "0" if c.isdigit() else c
            if sign != last:
                out.append(sign)
                last = sign
        shape = self[word] = "".join(out)
        return shape


_shapes = Shapes()


def _level(share: float) -> int:
    return int(-np.log2(share)) if share > 0 else 99


def indicators(text: str | None) -> set[str]:
    """The indicators of a text."""
    words = (text or "").split()
    if not words:
        return {"empty"}
    shapes = list(map(_shapes.__getitem__, words))
    shapes[1:] = ["=" if a == b else s for a, b, s in zip(words, words[1:], shapes[1:], strict=False)]
    grams = set(zip(shapes, shapes[1:], strict=False))
    grams.update(zip(shapes, shapes[1:], shapes[2:], strict=False))
    out = set(map(" ".join, grams))
    counts, n = Counter(shapes), len(words)
    out.update(counts)
    out.update(f"{s} #{_level(k / n)}" for s, k in counts.items())
    out.add(f"distinct #{_level(len(set(words)) / n)}")
    return out


@dataclass
class Model:
    """Weights of indicators, a bias and the logistic curve of the margin."""

    weights: dict = field(default_factory=dict)
    bias: float = 0.0
    slope: float = 0.0
    offset: float = 0.0

    def margin(self, found: set[str]) -> float:
        weights = self.weights
        known = [k for k in found if k in weights]
        values = [weights[k] for k in known]
        if not values:
            return self.bias
        scaled = sum(w for w, _ in values)
        norm = sum(r2 for _, r2 in values)
        return self.bias + scaled / max(norm, 1e-12) ** 0.5

    def score(self, found: set[str]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.offset, -50, 50))))


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, size: int, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear L1-loss support vector machine (bias as a constant feature)."""
    w, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    norms = np.array([float(v @ v) + 1.0 for _, v in rows])
    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in order.permutation(len(rows)):
            k, v = rows[i]
            slack = signs[i] * (float(w[k] @ v) + bias) - 1.0
            new = min(max(alpha[i] - slack / norms[i], 0.0), COST)
            if step := (new - alpha[i]) * signs[i]:
                w[k] += step * v
                bias += step
                moved = max(moved, abs(step))
            alpha[i] = new
        if moved < 1e-3:
            break
    return w, bias


def fit_logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with smoothed targets."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    targets = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([margins, np.ones(len(margins))])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        gradient = x.T @ (p - targets) + 1e-3 * beta
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(found: list[set[str]], labels: list[int]) -> Model:
    """The model of labelled indicator sets."""
    often = Counter(k for s in found for k in s)
    names = sorted(k for k, n in often.items() if n >= min(LEAST_ROWS, len(found)))
    place = {k: i for i, k in enumerate(names)}
    index = [sorted(place[k] for k in s if k in place) for s in found]
    return fit_places(names, np.array([i for k in index for i in k], np.int64), np.array([len(k) for k in index], np.int64), np.array(labels, int))


def fit_places(names: list[str], places: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> Model:
    """The model of labelled rows; ``places`` (in ``names``) are those of the first row, the second and so on, ``sizes`` of each."""
    if len(y) == 0 or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(offset=float(np.log(share / (1 - share))))
    counts = np.array([1 + np.bincount(places[np.repeat(y, sizes) == label], minlength=len(names)) for label in (0, 1)], float)
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    values = ratios[places]
    ends = np.cumsum(sizes)
    rows = []
    for start, end in zip(ends - sizes, ends, strict=True):
        v = values[start:end]
        v /= max(float(np.sqrt(v @ v)), 1e-6)
        rows.append((places[start:end], v))
    apart = np.arange(len(y)) % 5 == 4
    if len({*y[apart]}) < 2 or len({*y[~apart]}) < 2:
        apart[:] = False
    signs = np.where(y > 0, 1.0, -1.0)
    seen = np.flatnonzero(~apart)
    w, bias = dual_coordinate_descent([rows[i] for i in seen], signs[seen], len(names))
    held = np.flatnonzero(apart) if apart.any() else seen
    margins = np.array([float(w[rows[i][0]] @ rows[i][1]) + bias for i in held])
    slope, offset = fit_logistic(margins, y[held])
    weights = {name: (float(w[i] * ratios[i]), float(ratios[i] ** 2)) for i, name in enumerate(names)}
    return Model(weights, bias, slope, offset)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True if crc32 of doc_id as text leaves that remainder; false for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, sample: int) -> DataFrame:
    """text and label (0 or 1) of the ``sample`` labelled rows outside the fold with the smallest hashes."""
    require(docs, "doc_id", "text")
    require(labels, "doc_id", label)
    keys = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label"))
    keys = keys.where((F.col("label").isin(0, 1)) & F.col("_id").isNotNull() & ~held_out(F.col("_id"), folds, fold))
    keys = keys.withColumn("_h", F.xxhash64("_id")).orderBy("_h", "_id", "label").limit(sample)
    return docs.select("doc_id", "text").join(F.broadcast(keys), F.col("doc_id") == F.col("_id")).select("_h", "doc_id", "text", "label")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, fold: int = 0, sample: int = SAMPLE) -> Model:
    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([list(indicators(t)) for t in texts])

    key = ["_h", "doc_id", "label"]
    rows = labelled_sample(docs, labels, label, folds, fold, sample)
    rows = saved(rows.select(*key, found("text").alias("found")).orderBy(*key).limit(sample), "indicators")
    often = rows.select(F.explode("found").alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    often = often.where(F.col("n") >= F.lit(min(LEAST_ROWS, rows.count()))).toArrow()
    names = sorted(often.column("name").to_pylist())
    shared = docs.sparkSession.sparkContext.broadcast({k: i for i, k in enumerate(names)})

    @F.pandas_udf("array<int>")
    def placed(sets: pd.Series) -> pd.Series:
        place = shared.value
        return pd.Series([sorted(place[k] for k in s if k in place) for s in sets])

    # numbers in Arrow buffers: some MB for the whole sample, where its indicators as strings take some hundred
    got = rows.select(*key, placed("found").alias("places")).orderBy(*key).select("label", "places").toArrow().combine_chunks()
    places = got.column("places").combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.int32()))
    sizes = pc.list_value_length(places).to_numpy(zero_copy_only=False).astype(np.int64)
    return fit_places(names, places.flatten().to_numpy(zero_copy_only=False).astype(np.int64), sizes, got.column("label").to_numpy().astype(int))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score: the probability of label 1."""
    ready = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        chosen = ready.value
        return pd.Series([chosen.score(indicators(t)) for t in texts], dtype="float64")

    return docs.withColumn("score", score("text"))
