"""Approximate nearest neighbours by cosine with a hierarchical k-means tree.

**Index.** A tree of k-means splits is fitted on at most ``SAMPLE`` unit vectors, those of
smallest hash of vec_id, until a leaf stands for about ``LEAF_ROWS`` rows of the table. All
rows are then taken down the tree to a leaf. The tree (bounded by the sample) is broadcast.

**Search.** A query goes best-bin-first: a priority queue holds tree nodes by their
distance from the query, the nearest is taken off, an inner node's children are put on, a
leaf is visited. How many leaves are visited is calibrated: for ``TRIALS`` queries the true
neighbours are found by brute force over all rows, and visits are widened until ``RECALL``
of them lie in visited leaves. Visited rows are scored exactly.

**Scale.** (leaf, query) pairs are joined with the leaf's rows in blocks of ``BLOCK`` rows
and batches of ``QUERIES`` queries, so a leaf that holds a third of all rows is many tasks.
Each task gives its k best for each query, whose best are then taken in a second step.

Vectors that are null, zero or hold null or non-finite components take no part; neither do
rows with a null id. Vectors that differ in length are an error that names both. Rows that share an id
are candidates of their own, but never for a query with that id; of equal results
(query, id, score) each is returned. Without queries the result is empty.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitsliced import best, one_length, usable
from .common import require, saved

SAMPLE = 20_000
LEAF_ROWS = 256
BRANCHES = 12
ROUNDS = 8
TRIALS = 200
RECALL = 0.96
BLOCK = 4096
QUERIES = 512


@dataclass
class Tree:
    """Centres of the nodes; children of a node, none for a leaf; the leaf's number."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def add(self, centre: np.ndarray) -> int:
        self.centres.append(centre)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.centres) - 1


def k_means(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """The cluster of each point."""
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(ROUNDS):
        own = (points @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=k)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return own


def fit_tree(points: np.ndarray, rows: int, seed: int = 0) -> Tree:
    """A tree over unit vectors that stand for ``rows`` rows."""
    rng, tree = np.random.default_rng(seed), Tree()
    least = max(LEAF_ROWS * len(points) / max(rows, 1), 8)

    def grow(part: np.ndarray) -> int:
        node = tree.add(part.mean(axis=0) if len(part) else np.zeros(points.shape[1]))
        if len(part) > least * 1.5:
            k = int(min(BRANCHES, max(2, np.ceil(len(part) / least))))
            own = k_means(part, k, rng)
            groups = [part[own == c] for c in range(k) if (own == c).any()]
            if len(groups) > 1:
                tree.children[node] = [grow(g) for g in groups]
                return node
        tree.leaf[node] = tree.leaves
        tree.leaves += 1
        return node

    grow(points)
    return tree


def leaf_of(tree: Tree, points: np.ndarray) -> np.ndarray:
    """The leaf each point is taken down to."""
    out = np.empty(len(points), np.int64)
    todo = [(0, np.arange(len(points)))]
    while todo:
        node, at = todo.pop()
        if not tree.children[node]:
            out[at] = tree.leaf[node]
            continue
        centres = np.array([tree.centres[c] for c in tree.children[node]])
        own = (points[at] @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
        todo += [(child, at[own == i]) for i, child in enumerate(tree.children[node]) if (own == i).any()]
    return out


def best_bins(tree: Tree, query: np.ndarray, visits: int) -> list[int]:
    """The first ``visits`` leaves, best bin first."""
    queue, out = [(0.0, 0)], []
    while queue and len(out) < visits:
        _, node = heapq.heappop(queue)
        if not tree.children[node]:
            out.append(tree.leaf[node])
            continue
        for child in tree.children[node]:
            gap = query - tree.centres[child]
            heapq.heappush(queue, (float(gap @ gap), child))
    return out


def _matrix(values) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in values])


def _unit(points: np.ndarray) -> np.ndarray:
    return points / np.sqrt((points * points).sum(axis=1))[:, None]


def nearest(values: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> Iterator[tuple]:
    """(query_id, vec_id, score) of the k rows of largest cosine for each query, ties to smaller ids."""
    norms, query_norms = np.sqrt((values * values).sum(axis=1)), np.sqrt((queries * queries).sum(axis=1))
    rough = (queries @ values.T) / query_norms[:, None] / norms
    for row, query, norm, q in zip(rough, queries, query_norms, query_ids, strict=True):
        row[ids == q] = -np.inf
        room = min(k, len(row))
        last = np.partition(row, len(row) - room)[len(row) - room]
        at = np.flatnonzero((row >= last - 1e-9) & (ids != q))
        # summed row by row, so that equal vectors get equal scores wherever they stand
        score = (values[at] * query).sum(axis=1) / (norms[at] * norm)
        for i in np.lexsort((ids[at], -score))[:k]:
            yield int(q), int(ids[at[i]]), float(score[i])


def _brute_force(rows: DataFrame, trials: list, k: int) -> dict[int, list[int]]:
    """The true neighbours' leaves of a bounded list of (vec_id, vector)."""
    ids, queries = np.array([t[0] for t in trials]), _matrix([t[1] for t in trials])

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            leaf = dict(zip(batch["vec_id"], batch["leaf"], strict=True))
            found = [(q, v, s, leaf[v]) for q, v, s in nearest(_matrix(batch["vector"]), batch["vec_id"].to_numpy(), queries, ids, k)]
            yield pd.DataFrame(found, columns=["query_id", "vec_id", "score", "leaf"])

    found = rows.select("vec_id", "vector", "leaf").mapInPandas(scored, "query_id long, vec_id long, score double, leaf long")
    true = best(found, k).join(rows.select(F.col("vec_id").alias("v"), "leaf"), F.col("vec_id") == F.col("v"))
    out: dict[int, list[int]] = {}
    for r in true.select("query_id", "leaf").collect():  # k rows a trial
        out.setdefault(r["query_id"], []).append(r["leaf"])
    return out


def calibrated_visits(tree: Tree, rows: DataFrame, trials: list, k: int, recall: float = RECALL) -> int:
    """The fewest visits that put ``recall`` of the trials' true neighbours in visited leaves."""
    true = _brute_force(rows, trials, k)
    places = []
    for q, vector in trials:
        order = {leaf: i for i, leaf in enumerate(best_bins(tree, _unit(_matrix([vector]))[0], tree.leaves))}
        places += [order[leaf] + 1 for leaf in true.get(q, [])]
    if not places:
        return tree.leaves
    return int(np.sort(places)[min(len(places) - 1, int(np.ceil(recall * len(places))) - 1)])


def search(vectors: DataFrame, query_rows: Column, k: int = 5, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for each row that ``query_rows`` marks."""
    require(vectors, "vec_id", "embedding")
    spark = vectors.sparkSession
    vector = F.transform("embedding", lambda x: x.cast("double"))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.where(usable(F.col("embedding")) & some & F.col("vec_id").isNotNull())
    rows = saved(rows.select(F.col("vec_id").cast("long").alias("vec_id"), query_rows.alias("is_query"), vector.alias("vector")), "vectors")
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    one_length(rows, "vector")
    sample = rows.select("vector", F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(SAMPLE).toPandas()
    tree = fit_tree(_unit(_matrix(sample["vector"])), total)
    shared = spark.sparkContext.broadcast(tree)

    @F.pandas_udf("long")
    def leaf(part: pd.Series) -> pd.Series:
        return pd.Series(leaf_of(shared.value, _unit(_matrix(part))) if len(part) else [], dtype="int64")

    rows = saved(rows.withColumn("leaf", leaf("vector")), "leaves")
    queries = rows.where("is_query").select("vec_id", "vector").distinct()
    trials = [tuple(r) for r in queries.orderBy(F.xxhash64(F.lit(1), "vec_id"), "vec_id").limit(TRIALS).collect()]
    visits = calibrated_visits(tree, rows, trials, k, recall)

    @F.pandas_udf("array<long>")
    def bins(part: pd.Series) -> pd.Series:
        return pd.Series([best_bins(shared.value, q, visits) for q in _unit(_matrix(part))] if len(part) else [])

    blocks = {r["leaf"]: -(-r["n"] // BLOCK) for r in rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a leaf
    split = spark.createDataFrame(list(blocks.items()), "split long, blocks int")
    dealt = rows.join(F.broadcast(split), F.col("leaf") == F.col("split"))
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks"))
    blocked = dealt.groupBy("leaf", block.alias("block")).agg(F.collect_list("vector").alias("values"), F.collect_list("vec_id").alias("ids"))
    asked = queries.select("vec_id", "vector", F.explode(bins("vector")).alias("bin"))
    batches = max(1, -(-queries.count() // QUERIES))
    batch = F.pmod(F.xxhash64("vec_id"), F.lit(batches))
    batched = asked.groupBy("bin", batch.alias("batch")).agg(F.collect_list("vector").alias("queries"), F.collect_list("vec_id").alias("query_ids"))
    tasks = saved(blocked, "blocks").join(saved(batched, "batches"), F.col("leaf") == F.col("bin"))

    def searched(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in groups:
            for values, ids, asked, asked_ids in zip(part["values"], part["ids"], part["queries"], part["query_ids"], strict=True):
                found = nearest(_matrix(values), np.asarray(ids), _matrix(asked), np.asarray(asked_ids), k)
                yield pd.DataFrame(list(found), columns=["query_id", "vec_id", "score"])

    spread = tasks.repartition("leaf", "block", "batch").select("values", "ids", "queries", "query_ids")
    return best(spread.mapInPandas(searched, "query_id long, vec_id long, score double"), k)
