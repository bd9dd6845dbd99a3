"""SimHash near-duplicates through a segment-popcount embedding.

A text's 64-bit fingerprint has bit *k* set if more than half of its word shingles'
XXH64 hashes have it set. Two fingerprints are linked at 4 or fewer differing bits, and
linked documents form groups.

**Embedding.** The 64 bits are cut into 32 segments of two bits; a fingerprint becomes
the vector of its segments' bit counts. One differing bit changes one count by one, so
the Manhattan distance of two vectors never exceeds the Hamming distance.

**Grid range join.** The vector is cut into two slabs of 16 counts. Of a pair at
distance 4 or less, the first slab is at distance 2 or less or the second at 1 or less.
Each slab is a grid of unit cells: in the first a fingerprint registers in its own cell
and the 32 around it (two vectors at distance 2 share one of them), in the second in its
own and the 16 that are one count higher. Fingerprints that share a cell are candidates,
and all candidates are tested by their exact Hamming distance.

**Scale.** Only distinct fingerprints enter the join, so exact copies cost nothing. A
cell with more than ``BLOCK`` fingerprints is split: they are dealt into blocks and each
pair of blocks is a group of its own, so no task holds more than ``2 * BLOCK`` of them.
From each group only links that connect it (at most one per fingerprint) are returned,
never all pairs. Unequal fingerprints meet by chance in ``50 n`` cells with about
``1.7e-4 n`` others each: this is the term that grows with the square of the input, and
it stays below the cost of hashing up to some ten million distinct fingerprints.

Null and empty texts have fingerprint zero and are linked like any other. Rows with equal
``doc_id`` are separate rows; a null ``doc_id`` keeps its links but never names a group
(``component_id`` is null if a group has no other). Other columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import connected_groups
from .common import require, saved, single_rows

BLOCK = 2048
MAX_BITS = 4
SEED = 42
SMALL = 24  # fingerprints of a cell up to which all its pairs are tested in one sweep
PIECE = 1 << 16  # shingles whose bits are counted at once


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """The XXH64 hashes of the text's word shingles; a shorter text is one shingle, an empty one has none."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(parts), SEED)]
    else:
        joined = b" ".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        starts = [0, *ends[: len(parts) - words].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[words - 1:] - 1).tolist(), strict=True)]
    return np.array(hashes, np.uint64)


def fingerprint_of(text: str | None, words: int) -> int:
    """The fingerprint as a signed 64-bit number."""
    return fingerprint_of_hashes(shingle_hashes(text, words))


def fingerprint_of_hashes(values: np.ndarray) -> int:
    if not len(values):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), PIECE):
        bits = np.unpackbits(values[at:at + PIECE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view(np.int64)[0])


@lru_cache(None)
def fingerprint_udf(words: int):
    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, words) for t in texts], dtype="int64")

    return fingerprint


def _segment_counts(half: Column) -> Column:
    """A long of 16 nibbles: 1 + the bit count of each two-bit segment of 32 bits."""
    v = half - F.shiftright(half, 1).bitwiseAND(F.lit(0x55555555).cast("long"))
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return v + F.lit(0x1111111111111111)


def grid_cells(first: Column, second: Column) -> Column:
    """The cells of a pair of slab vectors, as an array of longs; those of the second slab are negative."""
    steps = [1 << (4 * i) for i in range(16)]
    near = [first, *[first + F.lit(s) for s in steps], *[first - F.lit(s) for s in steps]]
    far = [second, *[second + F.lit(s) for s in steps]]
    return F.array(*near, *[F.bitwise_not(c) for c in far])


def _connect(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected among the fingerprints: each to the first of its group."""
    left = np.arange(len(fps))
    a, b = [], []
    while len(left):
        group, front = left[:1], left[:1]
        left = left[1:]
        while len(front) and len(left):
            hit = np.zeros(len(left), bool)
            for at in range(0, len(front), 256):
                part = front[at:at + 256]
                hit |= (np.bitwise_count(fps[left][None, :] ^ fps[part][:, None]) <= MAX_BITS).any(axis=0)
            front, left = left[hit], left[~hit]
            group = np.concatenate([group, front])
        a.append(np.repeat(fps[group[:1]], len(group) - 1))
        b.append(fps[group[1:]])
    return np.concatenate(a), np.concatenate(b)


def _links(keys: np.ndarray, fps: np.ndarray) -> pd.DataFrame:
    """Links within the runs of equal keys; keys are sorted."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    a, b = [], []
    at = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SMALL), sizes))
    for k in range(1, SMALL):
        at = at[at + k < len(keys)]
        at = at[keys[at] == keys[at + k]]
        if not len(at):
            break
        near = at[np.bitwise_count(fps[at] ^ fps[at + k]) <= MAX_BITS]
        a.append(fps[near])
        b.append(fps[near + k])
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        x, y = _connect(fps[s:s + n])
        a.append(x)
        b.append(y)
    if not a:
        return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
    out = pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})
    return out.drop_duplicates()


def _link_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of (group, fp) sorted by group, which may go on in the next batch."""
    keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in batches:
        keys = np.concatenate([keys, batch["group"].to_numpy()])
        fps = np.concatenate([fps, batch["fp"].to_numpy().view(np.uint64)])
        if len(keys) < 200_000:
            continue
        whole = int(np.searchsorted(keys, keys[-1]))
        if whole:
            yield _links(keys[:whole], fps[:whole])
            keys, fps = keys[whole:], fps[whole:]
    if len(keys):
        yield _links(keys, fps)


def fingerprint_links(fingerprints: DataFrame) -> DataFrame:
    """(a, b): links whose connected groups are those of all pairs of fingerprints at 4 or fewer bits.

    ``fingerprints`` has a column ``fp`` of distinct longs.
    """
    vectors = fingerprints.select(
        "fp", _segment_counts(F.shiftrightunsigned("fp", 32)).alias("first"),
        _segment_counts(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))).alias("second"))
    cells = vectors.select("fp", F.explode(grid_cells(F.col("first"), F.col("second"))).alias("cell"))
    crowded = saved(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK), "cells")
    crowded = crowded.select(F.col("cell").alias("full"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    dealt = cells.join(crowded, F.col("cell") == F.col("full"), "left").withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))))
    other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("other")
    pairs = dealt.select("cell", "fp", "own", "blocks", other)
    # one number per (cell, pair of blocks): the cell itself unless it is split
    group = F.when(F.col("blocks").isNull(), F.col("cell")).otherwise(
        F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")))
    rows = pairs.select(group.alias("group"), "fp").repartition("group").sortWithinPartitions("group")
    return rows.mapInPandas(_link_sorted, "a long, b long")


def near_duplicate_groups(docs: DataFrame, words: int = 5) -> DataFrame:
    """All columns of ``docs`` but its text, with ``fingerprint`` and ``component_id``.

    ``docs`` needs doc_id and text; of further columns only those with these names are replaced.
    """
    require(docs, "doc_id", "text")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "fingerprint", "component_id")]
    # the columns in one, so that none of them can clash with those that are added
    prints = saved(docs.select(F.struct(*kept).alias("held"), "doc_id", fingerprint_udf(words)(F.col("text")).alias("fp")), "prints")
    distinct = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct")
    links = saved(fingerprint_links(distinct.select("fp")).distinct(), "links")
    groups = connected_groups(links).select(F.col("id").alias("member"), "group")
    linked = distinct.join(groups, distinct["fp"] == groups["member"]).select("fp", "group", "first_doc")
    named = linked.groupBy(F.col("group").alias("g")).agg(F.min("first_doc").alias("named"))
    linked = linked.join(named, F.col("group") == F.col("g")).select(F.col("fp").alias("f"), "named")
    classes = distinct.join(linked, F.col("fp") == F.col("f"), "left").select(
        F.col("fp").alias("key"), F.when(F.col("f").isNull(), F.col("first_doc")).otherwise(F.col("named")).alias("component_id"))
    classes = saved(classes, "classes")  # apart from the join below, so that a hot fingerprint's rows can be split there
    text = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(classes, F.col("fp") == F.col("key")).select(
        "held.*", text, "component_id")


def one_per_group(docs: DataFrame, words: int = 5) -> DataFrame:
    """The rows of ``docs`` that stand for their group of near-duplicates: its smallest doc_id.

    Of rows that share that doc_id, one stays; a group without any doc_id keeps one row.
    """
    held = single_rows(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("held")), "_row", "rows")
    rows = held.select("_row", "held.doc_id", "held.text")
    groups = near_duplicate_groups(rows.select(F.struct(F.col("doc_id").isNull(), "doc_id", "_row").alias("doc_id"), "text"), words)
    first = groups.where(F.col("component_id") == F.col("doc_id")).select(F.col("doc_id._row").alias("_row"))
    return held.join(first, "_row", "left_semi").select("held.*")
