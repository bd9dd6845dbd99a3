"""Best-fit packing of token pieces into sequences of bounded length.

**Pieces.** A document is its token ids and a separator id. Only documents longer than
``capacity`` are cut, into pieces of that length; the first piece takes what is left over
and may be shorter. Null and empty texts are one separator.

**Plan.** Only the histogram of piece lengths (at most ``capacity`` rows) reaches the
driver. The configuration linear program has one variable for each way to fill a sequence
and one row for each length. Multiplicative weights solve it: the price of a length is its
size, slightly more for long ones (which fit in fewer places), times exp(ETA * share still
unserved). In a round one knapsack dynamic program gives the configuration of greatest price for
every length; those near the greatest are used, in steps that leave most of each length for
later prices, so that all lengths are served together. Steps are rounded down to whole
sequences. What is left is placed best-fit, longest first, again on the histogram, and
a plan that takes more sequences than best-fit of everything is not used. ``ROUNDS`` bounds
the pricing rounds; lengths left then are placed best-fit too, so every piece is placed for any input.

**Assignment.** The plan is a table of slots: for each configuration and length, the first
and last slot of that length. Its size depends on ``capacity`` and ``ROUNDS`` only, so it
is broadcast. Pieces are numbered within their length (``key_rank``: no length is ever in
one task) and number k takes slot k.

**Order.** ``pack`` places pieces without regard to an order. ``pack_in_order`` cuts the
ordered documents into windows of ``WINDOW``, makes a plan for each, numbers the pieces of a
length by their place and the sequences by the smallest place in them. So the
sequences up to any sequence_id hold a prefix of the order, to within one window.

Repeated rows are packed as often as they occur. Columns of the pieces are passed through, whatever
their names; only sequence_id and offset are replaced. An empty table gives an empty one.
"""

from __future__ import annotations

import base64
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import key_rank, require, saved

CAPACITY = 2048
SEPARATOR = 0
ROUNDS = 200
STEP = 0.5  # share of a length that a round serves
NEAR = 0.03  # share of the greatest price that a configuration may lack
TILT = 0.3  # power of a length's share of the capacity in its price
ETA = 0.01
REST = 0.05  # share of the pieces that is left to best-fit
PASSES = 5
WINDOW = 4096  # documents of an order that are packed together


class Encoder:
    """Token ids (little-endian unsigned 32-bit) of a text under a byte-level BPE.

    The two files hold one vocabulary: ranks for tiktoken, which is five times as fast
    here, and the JSON form for tokenizers, which encodes texts with special tokens.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]

    def __call__(self, text: str | None) -> bytes:
        if any(s in (text or "") for s in self.special):
            ids = self.exact.encode(text, add_special_tokens=False).ids
        else:
            ids = self.plain.encode_ordinary(text or "")
        return np.array(ids, "<u4").tobytes()


@lru_cache(2)
def encoder(json_path: str, ranks_path: str, pattern: str) -> Encoder:
    return Encoder(json_path, ranks_path, pattern)


def tokenize(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, capacity: int = CAPACITY, place: str | None = None) -> DataFrame:
    """doc_id, piece (from 0), start, length and ids (binary, 4 bytes each) of each piece, and the long ``place`` of its document."""
    require(docs, "doc_id", "text")
    cut = 4 * capacity
    end = np.array([SEPARATOR], "<u4").tobytes()

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(json_path, ranks_path, pattern)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part, rows = batch.iloc[at:at + 500], []
                for doc, text, *more in zip(*[part[c] for c in names], strict=True):
                    ids = encode(text) + end
                    first = len(ids) % cut or cut
                    bounds = [0, *range(first, len(ids) + 1, cut)]
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                        rows.append((doc, k, a // 4, (b - a) // 4, ids[a:b], *more))
                out = pd.DataFrame(rows, columns=schema.names)
                yield out.astype({"doc_id": part["doc_id"].dtype})

    names = ["doc_id", "text"] + ([place] if place else [])
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
                           *([T.StructField(place, T.LongType())] if place else [])])
    return docs.select(*names).mapInPandas(pieces, schema)


class Priced:
    """The multisets of lengths of greatest total price for every room; a knapsack dynamic program."""

    def __init__(self, prices: dict[int, float], capacity: int):
        self.prices = np.full(capacity + 1, -np.inf)
        self.prices[list(prices)] = list(prices.values())
        self.best = np.zeros(capacity + 1)
        self.taken = np.full(capacity + 1, -1)
        for room in range(min(prices), capacity + 1):
            worth = self.prices[1:room + 1] + self.best[room - 1::-1]
            k = int(worth.argmax())
            self.best[room], self.taken[room] = worth[k], k + 1

    def with_length(self, length: int, left: dict[int, int]) -> Counter:
        """A configuration of great price that holds ``length``, of pieces that are ``left``."""
        out, room = Counter([length]), len(self.best) - 1 - length
        while self.taken[room] > 0:
            k = int(self.taken[room])
            if out[k] >= left.get(k, 0):
                worth = self.prices[1:room + 1] + self.best[room - 1::-1]
                worth[[x - 1 for x, m in out.items() if x <= room and m >= left.get(x, 0)]] = -np.inf
                k = int(worth.argmax()) + 1
                if out[k] >= left.get(k, 0):
                    break
            out[k] += 1
            room -= k
        return out


def solve_configurations(counts: dict[int, int], capacity: int, weights: dict[int, float]) -> Counter:
    """How often each configuration is used in a rounded solution of the configuration program, by multiplicative weights.

    A round prices each length and takes, for each, the best configuration that holds it,
    if its price is within ``NEAR`` of the greatest. No length loses more than ``STEP`` of what is left of it in a round.
    """
    left = {k: v for k, v in counts.items() if v > 0}
    used: Counter = Counter()
    few = REST * sum(left.values())
    for _ in range(ROUNDS):
        if sum(left.values()) <= few:
            break
        priced = Priced({k: k * (k / capacity) ** TILT * weights[k] * float(np.exp(ETA * v / counts[k])) for k, v in left.items()}, capacity)
        prices = priced.prices.copy()
        lengths = np.array(sorted(left))
        worth = prices[lengths] + priced.best[capacity - lengths]
        least, allowed, some = (1 - NEAR) * worth.max(), {k: max(1, int(v * STEP)) for k, v in left.items()}, False
        for at in np.argsort(-worth, kind="stable"):
            if worth[at] < least:
                break
            length = int(lengths[at])
            if allowed[length] <= 0 or length not in left:
                continue
            pattern = priced.with_length(length, left)
            if some and (sum(prices[k] * m for k, m in pattern.items()) < least or any(allowed[k] <= 0 for k in pattern)):
                continue
            some = True
            times = max(1, min(allowed[k] // m for k, m in pattern.items()))
            for k, m in pattern.items():
                left[k] -= m * times
                allowed[k] -= m * times
                if not left[k]:
                    del left[k]
                    priced.prices[k] = -np.inf
            used[tuple(sorted(pattern.elements(), reverse=True))] += times
    return used


def best_fit(counts: dict[int, int], capacity: int) -> Counter:
    """Best-fit decreasing on a histogram: how often each configuration is used."""
    open_: dict[int, Counter] = defaultdict(Counter)  # room left: configurations
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            room = min((r for r, group in open_.items() if r >= length and group), default=None)
            if room is None:
                copies = min(n, capacity // length)
                bins = n // copies
                open_[capacity - copies * length][(length,) * copies] += bins
                n -= bins * copies
                continue
            pattern, there = next(iter(open_[room].items()))
            bins = min(n, there)
            open_[room][pattern] -= bins
            if not open_[room][pattern]:
                del open_[room][pattern]
            open_[room - length][(*pattern, length)] += bins
            n -= bins
    return sum(open_.values(), Counter())


def _one_plan(counts: dict[int, int], capacity: int, weights: dict[int, float]) -> Counter:
    out, left = solve_configurations(counts, capacity, weights), Counter(counts)
    for pattern, times in out.items():
        for length in pattern:
            left[length] -= times
    return out + best_fit({k: v for k, v in left.items() if v > 0}, capacity)


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> Counter:
    """How often each configuration (a tuple of lengths) is used; covers the counts exactly.

    Until a plan is within a five-hundredth of the bound that the token count or the lengths over
    half the capacity give, or ``PASSES`` are made, the weight of each length is
    multiplied up by the room its sequences left, and a new plan made. The smallest of these plans is
    used, or best-fit of everything where that takes fewer sequences.
    """
    bound = max(-(-sum(k * v for k, v in counts.items()) // capacity), sum(v for k, v in counts.items() if 2 * k > capacity))
    weights, best = dict.fromkeys(counts, 1.0), None
    for _ in range(PASSES):
        plan = _one_plan(counts, capacity, weights)
        if best is None or sum(plan.values()) < sum(best.values()):
            best = plan
        if sum(best.values()) <= bound * 1.002:
            break
        room: Counter = Counter()
        for pattern, times in plan.items():
            for length in pattern:
                room[length] += times * (1 - sum(pattern) / capacity)
        for length in counts:
            weights[length] *= float(np.exp(4 * room[length] / max(counts[length], 1)))
    plain = best_fit(counts, capacity)
    return plain if best is None or sum(plain.values()) < sum(best.values()) else best


def slot_rows(plan: Counter) -> list[tuple]:
    """(length, first slot, end slot, copies in a sequence, first sequence, offset of the first copy)."""
    rows, base, used = [], 0, Counter()
    for pattern, times in sorted(plan.items()):
        offset = 0
        for length, copies in sorted(Counter(pattern).items(), reverse=True):
            rows.append((length, used[length], used[length] + times * copies, copies, base, offset))
            used[length] += times * copies
            offset += length * copies
        base += times
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` of 1 to ``capacity``.

    Pieces of null or zero length get neither; longer ones are an error.
    """
    require(pieces, "length")
    spark = pieces.sparkSession
    rows = saved(_held(pieces, ["sequence_id", "offset"]), "pieces")
    histogram = rows.where("length > 0").groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    histogram = histogram.withColumn("length", F.when(F.col("length") <= capacity, F.col("length")).otherwise(
        F.raise_error(F.lit(f"a piece is longer than {capacity}")).cast("long")))
    counts = {r["length"]: r["n"] for r in histogram.collect()}
    schema = "_length long, _first long, _end long, _copies long, _base long, _offset long"
    slots = spark.createDataFrame(slot_rows(plan_sequences(counts, capacity)), schema)
    placed = key_rank(rows.where("length > 0"), ["length"], F.xxhash64("_row"), [F.col("_row")])
    slot = F.col("rank") - F.col("_first")
    placed = placed.join(F.broadcast(slots), (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("_first")) & (F.col("rank") < F.col("_end")))
    placed = placed.withColumn("sequence_id", F.col("_base") + F.expr("(rank - _first) div _copies")).withColumn(
        "offset", F.col("_offset") + slot % F.col("_copies") * F.col("length"))
    rest = rows.where("length IS NULL OR length <= 0").withColumns(
        {"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    names = ["held.*", "sequence_id", "offset"]
    return placed.select(*names).union(rest.select(*names))


def _held(pieces: DataFrame, replaced: list[str], *more: Column) -> DataFrame:
    """The columns in one, ``held``, so that none of them can clash with those that are added; length, ``more`` and ``_row``, a number of the row."""
    kept = [F.col(f"`{c}`") for c in pieces.columns if c not in replaced]
    return pieces.select(F.struct(*kept).alias("held"), F.col("length").cast("long").alias("length"), *more, F.monotonically_increasing_id().alias("_row"))


def pack_in_order(pieces: DataFrame, place: str, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces with a ``length`` of 1 to ``capacity``; ids follow the column ``place``.

    ``place`` numbers the documents from 0; it is dropped. Only lengths and places are ranked,
    other columns are exchanged once.
    """
    require(pieces, "length", place)

    def plans(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        rows = slot_rows(plan_sequences(dict(zip(part["length"].tolist(), part["n"].tolist(), strict=True)), capacity))
        out = pd.DataFrame(rows, columns=["_length", "_first", "_end", "_copies", "_base", "_offset"])
        return out.assign(_w=key[0])

    rows = saved(_held(pieces, ["sequence_id", "offset", place], F.col(f"`{place}`").cast("long").alias("_place")), "pieces")
    window = F.floor(F.col("_place") / WINDOW).cast("long")
    size = F.when(F.col("length") <= capacity, F.col("length")).otherwise(
        F.raise_error(F.lit(f"a piece is longer than {capacity}")).cast("long"))
    thin = rows.where("length > 0").select("_row", "_place", window.alias("_window"), size.alias("_size"))
    histogram = thin.groupBy("_window", F.col("_size").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    # a named number of partitions, as a window's plan takes time that its few bytes don't show
    windows = (rows.agg(F.max("_place")).first()[0] or 0) // WINDOW + 1
    histogram = histogram.repartition(min(2 * windows, 8192), "_window")
    slots = saved(histogram.groupBy("_window").applyInPandas(
        plans, "_length long, _first long, _end long, _copies long, _base long, _offset long, _w long"), "slots")
    # a window holds at most WINDOW documents, so each partition is bounded by their pieces
    rank = F.row_number().over(Window.partitionBy("_window", "_size").orderBy("_place", "_row")) - 1
    placed = thin.withColumn("rank", rank).join(slots, (F.col("_window") == F.col("_w")) & (F.col("_size") == F.col("_length"))
                                                & (F.col("rank") >= F.col("_first")) & (F.col("rank") < F.col("_end")))
    placed = placed.select(
        "_row", "_place", "_window", (F.col("_base") + F.expr("(rank - _first) div _copies")).alias("_local"),
        (F.col("_offset") + (F.col("rank") - F.col("_first")) % F.col("_copies") * F.col("_size")).alias("offset"))
    placed = saved(placed, "placed")
    firsts = saved(placed.groupBy("_window", "_local").agg(F.min("_place").alias("_least")), "sequences")
    before = Window.orderBy("_w").rowsBetween(Window.unboundedPreceding, -1)
    starts = firsts.groupBy(F.col("_window").alias("_w")).agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_w", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inner = F.row_number().over(Window.partitionBy("_window").orderBy("_least", "_local")) - 1
    firsts = firsts.withColumn("_inner", inner).join(starts, F.col("_window") == F.col("_w"))
    firsts = firsts.select(F.col("_window").alias("_w"), F.col("_local").alias("_l"), (F.col("_start") + F.col("_inner")).alias("sequence_id"))
    found = placed.join(firsts, (F.col("_window") == F.col("_w")) & (F.col("_local") == F.col("_l"))).select(
        F.col("_row").alias("_r"), "sequence_id", "offset")
    return rows.join(found, F.col("_row") == F.col("_r"), "left").select("held.*", "sequence_id", "offset")
