"""Exact top-k search by inner product over a bit-sliced index.

**Index.** Components are quantised to whole numbers (floor(scale * x)). Rows are dealt
into blocks of ``BLOCK`` rows; a block holds, for each component, the bitmaps of the bits
of (value - the component's minimum in the block): its slices. Equal vectors enter once,
with their ids. The index is a table of one row for each block, built once.

**Search.** A query's score is a weighted sum of components. A weight is written with digits
-1, 0 and 1; for each digit the component's slices are added, shifted, to a bit-sliced sum with
ripple-carry bitmap arithmetic, one sum for digits of 1 and one for those of -1. The sum of positive
ones plus the complement of the other is the score, up to a constant, for all rows of the
block at once. From its most significant slice down a bitmap of rows surely in the top k
and one of rows still tied are narrowed; the rows tied at the boundary are resolved exactly
by score (read from the slices of the sum) and id.

**Scale.** Every block is searched by every query, in tasks of one block and ``QUERIES``
queries, which give k rows for each query; the k best of all are an aggregate over these.
The number of queries, known from the data, times the number of blocks is the work, as
exact search needs. A bitmap operation serves a block's 65,536 rows at once, so its cost is
the arithmetic, not the call. No task holds more than a block and a batch of queries.

Vectors that are null or hold null or non-finite components take no part; neither do rows
with a null id. Vectors that differ in length are an error that names both lengths. Rows that share an id are
candidates of their own, but never for a query with that id. Without queries or
candidates the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import require, saved

BLOCK = 65_536
QUERIES = 128
SCALE = 256
INDEX = "block long, rows int, low array<long>, bits array<int>, slices binary, ids array<array<long>>"


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & fine, F.lit(False))


def one_length(rows: DataFrame, vector: str) -> None:
    """Ends the job with an error if vectors differ in length."""
    least, most = rows.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    if least != most:
        raise ValueError(f"vectors of {least} and of {most} components in one table")


def signed_digits(weight: int) -> list[tuple[int, int]]:
    """(shift, sign) of the non-adjacent form of a whole number: the fewest digits of -1 and 1."""
    out, shift = [], 0
    while weight:
        if weight & 1:
            sign = 2 - (weight & 3)
            out.append((shift, sign))
            weight -= sign
        weight >>= 1
        shift += 1
    return out


def add_slices(total: np.ndarray, slices: np.ndarray, shift: int) -> None:
    """total += slices << shift, bit by bit over all rows. ``total`` has a bitmap for each bit of the result."""
    half, over, carry = (np.empty_like(total[0]) for _ in range(3))
    for k, x in enumerate(slices, shift):
        t = total[k]
        if k == shift:
            np.bitwise_and(t, x, out=carry)
            np.bitwise_xor(t, x, out=t)
            continue
        np.bitwise_xor(t, x, out=half)
        np.bitwise_and(t, x, out=over)
        np.bitwise_xor(half, carry, out=t)
        np.bitwise_and(half, carry, out=half)
        np.bitwise_or(over, half, out=carry)
    for t in total[shift + len(slices):] if len(slices) else ():
        if not carry.any():
            break
        np.bitwise_and(t, carry, out=over)
        np.bitwise_xor(t, carry, out=t)
        carry, over = over, carry


class SlicedBlock:
    """The slices of a block's components: a bitmap of rows for each bit of (value - the component's minimum)."""

    def __init__(self, rows: int, low: np.ndarray, bits: np.ndarray, slices: bytes):
        self.rows, self.low = rows, np.asarray(low, np.int64)
        ends = np.cumsum(bits)
        words = -(-rows // 64)
        bitmaps = np.frombuffer(slices, np.uint64).reshape(-1, words)
        self.slices = [bitmaps[e - b:e] for b, e in zip(bits, ends, strict=True)]
        self.every = _bitmap(np.ones(rows, np.uint8))

    @classmethod
    def stored(cls, values: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, bytes]:
        """The arguments of a block of rows x components of whole numbers."""
        low = values.min(axis=0)
        above = (values - low).astype(np.uint64)
        bits = np.array([int(x).bit_length() for x in above.max(axis=0)], np.int32)
        slices = [_bitmap(((column >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)) for column, n in zip(above.T, bits, strict=True) for b in range(n)]
        return len(values), low, bits, b"".join(x.tobytes() for x in slices)

    def sums(self, weights: np.ndarray) -> tuple[np.ndarray, int]:
        """Slices of weights @ values, less the returned constant, for every row."""
        digits = [signed_digits(w) for w in weights.tolist()]
        widths = []
        for side in (1, -1):
            most = sum(((1 << len(x)) - 1) << shift for d, x in zip(digits, self.slices, strict=True) for shift, sign in d if sign == side)
            widths.append(most.bit_length())
        width = max(widths)
        up, down = np.zeros((width + 1, len(self.every)), np.uint64), np.zeros((width, len(self.every)), np.uint64)
        for d, slices in zip(digits, self.slices, strict=True):
            for shift, sign in d:
                if len(slices):
                    add_slices(up if sign > 0 else down, slices, shift)
        constant = int(weights @ self.low)
        if widths[1]:
            # up - down = up + ~down + 1 - 2^width
            add_slices(up, down ^ self.every, 0)
            constant += 1 - (1 << width)
        return up, constant

    def top(self, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows surely among the k largest or tied for the last places, and their scores."""
        slices, constant = self.sums(weights)
        sure, tied, need = np.zeros_like(self.every), self.every.copy(), k
        for bits in slices[::-1]:
            ones = tied & bits
            n = int(np.bitwise_count(ones).sum())
            if n >= need:
                tied = ones
                if n == need:
                    break
            else:
                sure |= ones
                need -= n
                tied = tied & ~bits
        at = np.flatnonzero(np.unpackbits((sure | tied).view(np.uint8), bitorder="little")[:self.rows])
        ones = (slices[:, at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
        return at, (ones.astype(np.int64) << np.arange(len(slices))[:, None]).sum(axis=0) + constant


def _bitmap(ones: np.ndarray) -> np.ndarray:
    return np.packbits(np.pad(ones, (0, -len(ones) % 64)), bitorder="little").view(np.uint64)


def _search_block(block: SlicedBlock, ids: list[np.ndarray], queries: np.ndarray, query_ids: np.ndarray, k: int) -> Iterator[tuple]:
    """(query_id, vec_id, score): the k best of the block for each query, ties to smaller ids."""
    first = np.array([x[0] for x in ids])
    for q, weights in zip(query_ids.tolist(), queries, strict=True):
        # one more, as the query itself may be among them
        at, scores = block.top(weights, min(k + 1, block.rows))
        order = np.lexsort((first[at], -scores))
        last = scores[order[min(k, len(order) - 1)]]
        found = []
        for i in order:
            if scores[i] < last:
                break
            found += [(-int(scores[i]), int(v)) for v in ids[at[i]] if v != q]
        for score, v in sorted(found)[:k]:
            yield q, v, -score


def _numbers(vectors: pd.Series) -> np.ndarray:
    return np.concatenate([np.asarray(v) for v in vectors]).reshape(len(vectors), -1).astype(np.int64)


def _sliced(part: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame([(int(part["block"].iloc[0]), *SlicedBlock.stored(_numbers(part["values"])), list(part["ids"]))],
                        columns=["block", "rows", "low", "bits", "slices", "ids"])


def _searched(part: pd.DataFrame, k: int) -> pd.DataFrame:
    out = []
    for _, r in part.iterrows():  # one block and one batch of queries
        block = SlicedBlock(r["rows"], r["low"], r["bits"], r["slices"])
        out += _search_block(block, [np.asarray(x) for x in r["ids"]], _numbers(r["queries"]), np.asarray(r["query_ids"]), k)
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def distinct_vectors(vectors: DataFrame, value: str, keep: int) -> DataFrame:
    """Each distinct ``value`` with ``ids``, its ``keep`` smallest ids, in order.

    Ids are first ranked within ranges of their hash, so that a vector which a third of
    all rows hold is not gathered in one task.
    """
    salted = vectors.groupBy(value, F.pmod(F.xxhash64("vec_id"), F.lit(256)).alias("salt")).agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
    alone = salted.groupBy(value).agg(F.sum("n").alias("n"), F.min("least").alias("least")).where(F.col("n") == 1)
    single = alone.select(value, F.array("least").alias("ids"))
    repeated = vectors.join(alone.select(F.col(value).alias("_v")), F.col(value) == F.col("_v"), "left_anti")
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(256))
    ranked = repeated.withColumn("salt", salt).withColumn("r", F.row_number().over(Window.partitionBy(value, "salt").orderBy("vec_id")))
    few = ranked.where(F.col("r") <= keep).groupBy(value).agg(F.slice(F.sort_array(F.collect_list("vec_id")), 1, keep).alias("ids"))
    return single.unionByName(few)


def best(found: DataFrame, k: int, descending: bool = True) -> DataFrame:
    """query_id, rank, vec_id and score: the k best of (query_id, vec_id, score)."""
    score = F.col("score").desc() if descending else F.col("score")
    order = Window.partitionBy("query_id").orderBy(score, "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, query_rows: Column, k: int = 5, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score of the k largest integer inner products for each query row.

    ``vectors``: vec_id and embedding; ``query_rows``: which of its rows are queries.
    """
    require(vectors, "vec_id", "embedding")
    numbers = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = saved(rows.select("vec_id", query_rows.alias("is_query"), numbers.alias("values")), "vectors")
    one_length(rows, "values")
    distinct = saved(distinct_vectors(rows.select("vec_id", "values"), "values", k + 1), "distinct")
    blocks = max(1, -(-distinct.count() // BLOCK))
    block = F.pmod(F.xxhash64("values"), F.lit(blocks))
    index = saved(distinct.withColumn("block", block).groupBy("block").applyInPandas(_sliced, INDEX), "slices")
    queries = rows.where("is_query").select("vec_id", "values").distinct()
    batches = max(1, -(-queries.count() // QUERIES))
    batch = F.pmod(F.xxhash64("vec_id", "values"), F.lit(batches))
    batched = queries.groupBy(batch.alias("batch")).agg(F.collect_list("values").alias("queries"), F.collect_list("vec_id").alias("query_ids"))
    # every batch meets every block: a stated query set against all rows
    batched = batched.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    tasks = index.join(batched, "block").repartition(min(blocks * batches, 4096), "block", "batch")
    found = tasks.groupBy("block", "batch").applyInPandas(lambda part: _searched(part, k), "query_id long, vec_id long, score long")
    return best(found, k)
