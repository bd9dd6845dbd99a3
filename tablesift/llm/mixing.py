"""Mixing sources to target weights by Pfair scheduling of their blocks.

Each source's rows are put in a pseudo-random order and cut into blocks. Target weights
are rounded to shares ``a / slots``. Block *i* of a source is released at slot
``floor(i * slots / a)`` and due by ``ceil((i + 1) * slots / a)``; each slot goes to the
released block with the earliest deadline. At any slot a source then has had its share to
within less than one block. After ``slots`` slots every source has had exactly ``a``
blocks, so the schedule repeats, and one period (a table bounded by ``slots`` and the
number of weights) places any number of blocks. When a source has no block left, the
others go on by their weights among themselves: a new phase with a schedule of its own.

Only the block counts of the named sources reach the driver. Sources without a weight,
null ones included, form one pool with the weight ``other``. Every row is placed once:
none is dropped or repeated. Rows of a source are numbered in ranges of the random order
(``key_rank``), so a source that holds a third of all rows is not in one task. Rows equal
in all columns are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import key_rank, require, saved

SLOTS = 1000
BLOCK_ROWS = 16
POOL = "*"
ADDED = ("stream", "block", "block_position", "position")
RANGES = 10  # bits of the hash that name a range


def shares(weights: Mapping[str, float], slots: int) -> dict[str, int]:
    """Whole numbers of slots, at least one each, that add up to ``slots``; largest remainders first."""
    if len(weights) > slots:
        raise ValueError(f"{len(weights)} sources need at least as many slots")
    total, free = sum(weights.values()), slots - len(weights)
    exact = {s: max(w / total * slots - 1, 0.0) for s, w in weights.items()}
    scale = free / (sum(exact.values()) or 1.0)
    exact = {s: x * scale for s, x in exact.items()}
    out = {s: 1 + int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[:slots - sum(out.values())]:
        out[s] += 1
    return out


def one_period(share: Mapping[str, int], slots: int) -> dict[str, list[int]]:
    """The slots each source gets in a period: earliest deadline first among released blocks."""
    got: dict[str, list[int]] = {s: [] for s in share}
    for slot in range(slots):
        ready = [(-(-(len(got[s]) + 1) * slots // a), s) for s, a in share.items() if len(got[s]) < a and len(got[s]) * slots // a <= slot]
        got[min(ready)[1]].append(slot)
    return got


def phases(blocks: Mapping[str, int], weights: Mapping[str, float], slots: int = SLOTS) -> list[tuple]:
    """(source, first block, end block, first position, slots of a period) for each phase and source."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done, start, rows = dict.fromkeys(left, 0), 0, []
    while left:
        # a source alone needs no schedule
        length = slots if len(left) > 1 else 1
        period = one_period(shares({s: weights[s] for s in left}, length), length)
        ends = {s: (n - 1) // len(period[s]) * length + period[s][(n - 1) % len(period[s])] + 1 for s, n in left.items()}
        span = min(ends.values())
        for s in list(left):
            served = span // length * len(period[s]) + sum(x < span % length for x in period[s])
            rows.append((s, done[s], done[s] + served, start, length, period[s]))
            done[s] += served
            left[s] -= served
            if not left[s]:
                del left[s]
        start += span
    return rows


def mix(docs: DataFrame, weights: Mapping[str, float], other: float = 0.05, block_rows: int = BLOCK_ROWS,
        slots: int = SLOTS, seed: int = 0) -> DataFrame:
    """``docs`` with stream, block (its number in the stream), block_position and position.

    Ordering by position gives the mixture; block_position numbers the blocks of all
    streams from 0 without gaps. Columns of these names are replaced.
    """
    rows, plan = _streams(docs, weights, other, block_rows, slots, ADDED)
    # under names of their own, so that none can clash and those that nobody asks for are not shuffled
    names = {f"_held{i}": c for i, c in enumerate(c for c in docs.columns if c not in ADDED)}
    columns = [F.col(f"held.`{c}`").alias(own) for own, c in names.items()]
    rows = rows.select("stream", *columns).withColumn("_hash_of_row", F.xxhash64(F.lit(seed), *names))
    placed = _placed(key_rank(rows, ["stream"], F.col("_hash_of_row"), [], few_groups=True), plan, block_rows)
    return placed.select(*[F.col(own).alias(c) for own, c in names.items()], "stream", "block", "block_position", "position")


def _streams(docs: DataFrame, weights: Mapping[str, float], other: float, block_rows: int, slots: int,
             replaced: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The rows (``held``: their columns) with their stream, and the phases of the schedule."""
    require(docs, "source")
    weights = {s: float(w) for s, w in weights.items() if w > 0} | {POOL: float(other)}
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in replaced]
    listed = F.col("source").isin(*[s for s in weights if s != POOL])
    stream = F.when(listed, F.col("source")).otherwise(F.lit(POOL))
    # the columns in one, so that none of them can clash with those that are added
    rows = docs.select(F.struct(*kept).alias("held"), stream.alias("stream"))
    counts = {r["stream"]: -(-r["n"] // block_rows) for r in rows.groupBy("stream").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = phases(counts, weights, slots)
    schema = "_s string, _first long, _end long, _start long, _length long, _period array<int>"
    return rows, docs.sparkSession.createDataFrame(plan, schema)


def _placed(ranked: DataFrame, plan: DataFrame, block_rows: int) -> DataFrame:
    """Adds block, block_position and position to rows with their rank in the stream."""
    ranked = ranked.withColumn("block", F.floor(F.col("rank") / block_rows).cast("long"))
    placed = ranked.join(F.broadcast(plan), (F.col("stream") == F.col("_s")) & (F.col("block") >= F.col("_first")) & (F.col("block") < F.col("_end")))
    at = F.expr("_start + (block - _first) div size(_period) * _length + _period[cast((block - _first) % size(_period) as int)]")
    placed = placed.withColumn("block_position", at.cast("long"))
    placed = placed.withColumn("position", F.col("block_position") * block_rows + F.col("rank") % block_rows)
    return placed.drop(*plan.columns)


def in_mixed_order(docs: DataFrame, weights: Mapping[str, float], other: float = 0.05, block_rows: int = BLOCK_ROWS,
                   slots: int = SLOTS, seed: int = 0) -> DataFrame:
    """The columns of ``docs``, with rows in the order of the mixture, also across the files of a written table.

    Whole rows are exchanged once. The (stream, hash) of the rows alone is ranked first;
    from it come the parts into which the order is cut (as many as the session has shuffle
    partitions) and, for each stream and range of the hash, the hashes at which a part
    begins: a table bounded by streams, ranges and parts. Rows equal in all columns stay
    in one part.
    """
    spark = docs.sparkSession
    rows, plan = _streams(docs, weights, other, block_rows, slots)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = F.xxhash64(F.lit(seed), "held")
    thin = saved(rows.select("stream", every.alias("_h")), "hashes")
    thin = _placed(key_rank(thin, ["stream"], F.col("_h"), [], few_groups=True, tied=True), plan, block_rows)
    each = -(-(thin.agg(F.max("position")).first()[0] or 0) // parts) + 1
    part, piece = F.floor(F.col("position") / each), F.shiftright("_h", 64 - RANGES)
    cuts = thin.groupBy("stream", piece.alias("_piece"), part.alias("_part")).agg(F.min("_h").alias("lo"), F.min("rank").alias("start"))
    cuts = saved(cuts, "cuts")
    starts = cuts.groupBy(F.col("stream").alias("_s1"), F.col("_part").alias("_p1")).agg(F.min("start").alias("_from"))
    cuts = cuts.groupBy(F.col("stream").alias("_s2"), F.col("_piece").alias("_p2")).agg(F.collect_list(F.struct("lo", "_part")).alias("_cuts"))
    named = rows.select(F.col("held").alias("row"), "stream", every.alias("_h"))
    dealt = named.join(F.broadcast(cuts), (F.col("stream") == F.col("_s2")) & (piece == F.col("_p2")))
    dealt = dealt.select("row", "stream", "_h", F.array_max(F.filter("_cuts", lambda c: c["lo"] <= F.col("_h")))["_part"].alias("_part"))
    inner = F.row_number().over(Window.partitionBy("_part", "stream").orderBy("_h")) - 1
    ranked = dealt.repartitionByRange("_part").withColumn("_inner", inner)
    ranked = ranked.join(F.broadcast(starts), (F.col("stream") == F.col("_s1")) & (F.col("_part") == F.col("_p1")))
    placed = _placed(ranked.withColumn("rank", F.col("_from") + F.col("_inner")), plan, block_rows)
    return placed.sortWithinPartitions("position").select("row.*")
