"""Compression of vectors to codes of product codebooks, with metric trees of the anchors hierarchy.

**Codes.** Components become integers floor(``SCALE`` x); a vector is cut into ``PARTS`` equal
parts, and each part position has a codebook of ``ENTRIES`` entries, fitted by ``ROUNDS``
rounds of k-means from the parts of the smallest vec_ids. All sums are integers, so the
result depends neither on the partitions nor on the order of the rows.

**Trees.** Rows are gathered in blocks of at most ``BLOCK_VALUES`` components. A block gets one
metric tree for each part position, built middle-out: about sqrt(n) anchors are chosen, each
the point farthest from its anchor, and each new anchor takes the points that are nearer
to it, looking only at points that are farther from their anchor than half the distance of the two
anchors. The anchors are joined upwards, each time the two whose common ball is smallest, and each is divided
downwards by the same procedure, to leaves of ``LEAF`` points. Points are stored in the
order of the leaves, so a ball is a range of points; it caches its count, sums and radius. A block is one row of a
saved table, with all trees.

**Rounds.** A round is one Spark job over the saved trees, with the codebooks (``PARTS`` x
``ENTRIES`` entries) broadcast. A ball inherits the entries its parent left open and drops
each that some other entry beats at every point of the ball: e loses to b where
|m - e|^2 - |m - b|^2 > 2 r |e - b|, for the ball's middle m and radius r. A ball with one
entry left is owned wholly and gives its cached sums; an open leaf is decided point by point, in integers, ties to the lower
index. Balls of one depth are worked on together. Each task returns one row for each entry; Spark adds them up.

**Odd rows.** Vectors that are null or hold null or non-finite components are dropped. An
empty table gives no rows. Fewer rows than ``ENTRIES`` give as many entries; a null vec_id
comes last in their order, equal vec_ids are ordered by the vector. Repeated rows each get
their code. Usable vectors of different lengths, a length that ``PARTS`` does not divide and
components of ``LIMIT`` or more are errors that say so. Other columns are kept; columns named
code or error are replaced. Empty vectors have empty parts: their code is all zeros.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import require, saved

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LEAF = 8
BLOCK_VALUES = 1 << 18
BLOCK_ROWS = 8192
WHOLE = "_integers of the vector"
LIMIT = 1 << 25  # of an integer component; squares of differences then add up exactly


@dataclass
class Tree:
    """Balls over points; ball k holds the points first[k] up to end[k], and the balls left[k], right[k] (-1: a leaf)."""

    points: np.ndarray  # n x d, in the order of the leaves
    order: np.ndarray  # the row of the block that each point is of
    first: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray
    radius: np.ndarray
    sums: np.ndarray  # balls x d


def _gap(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    difference = (points - point).astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", difference, difference))


def anchors(points: np.ndarray, at: np.ndarray, most: int) -> list[np.ndarray]:
    """The points ``at``, divided among at most ``most`` anchors."""
    mine = points[at]
    gap = _gap(mine, mine[0])
    owner, pivots = np.zeros(len(at), np.int64), [0]
    while len(pivots) < most:
        pivot = int(gap.argmax())
        if gap[pivot] == 0:
            break  # only equal points are together
        # a point nearer to its anchor than half way cannot be nearer to the new one
        seen = np.flatnonzero(gap > _gap(mine[pivots], mine[pivot])[owner] / 2)
        far = _gap(mine[seen], mine[pivot])
        nearer = far < gap[seen]
        owner[seen[nearer]], gap[seen[nearer]] = len(pivots), far[nearer]
        pivots.append(pivot)
    order = np.argsort(owner, kind="stable")
    return np.split(at[order], np.cumsum(np.bincount(owner, minlength=len(pivots)))[:-1])


def _joined(points: np.ndarray, groups: list[np.ndarray]) -> list[tuple[int, int]]:
    """The pairs of balls to join, in turn, for the smallest common balls; ball len(groups) + k is the k-th join."""
    n = len(groups)
    middle = np.zeros((2 * n - 1, points.shape[1]))
    radius, count = np.zeros(2 * n - 1), np.zeros(2 * n - 1)
    for k, g in enumerate(groups):
        middle[k], count[k] = points[g].mean(axis=0), len(g)
        radius[k] = _gap(points[g], middle[k]).max()

    def size(k: int, others: np.ndarray) -> np.ndarray:
        both = (_gap(middle[others], middle[k]) + radius[others] + radius[k]) / 2
        return np.maximum(both, np.maximum(radius[others], radius[k]))

    common = np.full((2 * n - 1, 2 * n - 1), np.inf)
    live = np.arange(n)
    for k in range(1, n):
        common[k, :k] = size(k, live[:k])
    out = []
    for new in range(n, 2 * n - 1):
        a, b = divmod(int(common.argmin()), 2 * n - 1)
        out.append((a, b))
        radius[new], count[new] = common[a, b], count[a] + count[b]
        middle[new] = (middle[a] * count[a] + middle[b] * count[b]) / count[new]
        common[[a, b]] = np.inf
        common[:, [a, b]] = np.inf
        live = live[(live != a) & (live != b)]
        common[new, live] = size(new, live)
        live = np.append(live, new)
    return out


def build(points: np.ndarray) -> Tree:
    """The metric tree of integer points (n x d)."""
    first, end, left, right, order = [], [], [], [], []

    def ball() -> int:
        for x in (first, end, left, right):
            x.append(-1)
        return len(first) - 1

    # of a ball still to be made: its place, and its points or the two it joins
    root = ball()
    todo: list[tuple] = [("points", root, np.arange(len(points)))]
    while todo:
        kind, here, what = todo.pop()
        if kind == "end":
            end[here] = len(order)
            continue
        if kind == "points":
            groups = anchors(points, what, int(np.ceil(np.sqrt(len(what))))) if len(what) > LEAF else [what]
            if len(groups) == 1:
                first[here] = len(order)
                order += what.tolist()
                end[here] = len(order)
                continue
            joins = _joined(points, groups)
            what = (groups, joins, len(groups) + len(joins) - 1)
        groups, joins, k = what
        if k < len(groups):
            todo.append(("points", here, groups[k]))
            continue
        first[here] = len(order)
        left[here], right[here] = ball(), ball()
        todo.append(("end", here, None))
        for child, side in zip(joins[k - len(groups)], (left[here], right[here]), strict=True):
            todo.append(("joined", side, (groups, joins, child)))
    # the left side was put down first, so the right side's points come first: ranges stay gapless
    order, first, end = np.array(order, np.int64), np.array(first, np.int64), np.array(end, np.int64)
    points = points[order]
    running = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points, axis=0)])
    sums = running[end] - running[first]
    radius = np.zeros(len(first))
    for k, (a, b) in enumerate(zip(first, end, strict=True)):
        if b > a:
            radius[k] = _gap(points[a:b], sums[k] / (b - a)).max()
    return Tree(points, order, first, end, np.array(left), np.array(right), radius, sums)


def _squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of points (n x d) and entries (k x d), exact for integers."""
    out = np.zeros((len(points), len(entries)), points.dtype)
    for x, e in zip(points.T, entries.T, strict=True):
        out += (x[:, None] - e[None, :]) ** 2
    return out


def owners(tree: Tree, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(balls, their entry, True) where one entry is left, and (points, their entry, False) of open leaves."""
    if not len(tree.points):
        return
    between = np.sqrt(_squares(entries.astype(np.float64), entries.astype(np.float64)))
    balls, open_ = np.array([0]), np.ones((1, len(entries)), bool)
    while len(balls):
        count = (tree.end - tree.first)[balls]
        far = np.where(open_, _squares(tree.sums[balls] / count[:, None], entries.astype(np.float64)), np.inf)
        best = far.argmin(axis=1)
        lead = np.where(open_, far - far[np.arange(len(balls)), best][:, None], 0)
        # the margin is far above the rounding errors, so no entry is dropped that ties
        margin = 1e-6 + 1e-9 * np.where(open_, far, 0)
        open_ = open_ & (lead <= 2 * tree.radius[balls][:, None] * between[best] + margin)
        single = open_.sum(axis=1) == 1
        yield balls[single], best[single], True
        leaf = ~single & (tree.left[balls] < 0)
        if leaf.any():
            at = np.concatenate([np.arange(tree.first[b], tree.end[b]) for b in balls[leaf]])
            row, entry = np.nonzero(np.repeat(open_[leaf], count[leaf], axis=0))  # by row, then entry
            exact = ((tree.points[at[row]] - entries[entry]) ** 2).sum(axis=1)
            begins = np.searchsorted(row, np.arange(len(at)))
            least = np.flatnonzero(exact == np.minimum.reduceat(exact, begins)[row])
            yield at, entry[least[np.searchsorted(row[least], np.arange(len(at)))]], False
        inner = ~single & ~leaf
        balls = np.concatenate([tree.left[balls[inner]], tree.right[balls[inner]]])
        open_ = np.concatenate([open_[inner], open_[inner]])


def entry_sums(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count and componentwise sum of the points of each entry."""
    counts, sums = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    for at, entry, whole in owners(tree, entries):
        np.add.at(counts, entry, (tree.end - tree.first)[at] if whole else 1)
        np.add.at(sums, entry, tree.sums[at] if whole else tree.points[at])
    return counts, sums


def assigned(tree: Tree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry and the squared distance of each row of the block."""
    found = np.zeros(len(tree.points), np.int64)
    for at, entry, whole in owners(tree, entries):
        if whole:
            for ball, e in zip(at, entry, strict=True):
                found[tree.first[ball]:tree.end[ball]] = e
        else:
            found[at] = entry
    code, error = np.empty_like(found), np.empty_like(found)
    code[tree.order] = found
    error[tree.order] = ((tree.points - entries[found]) ** 2).sum(axis=1)
    return code, error


NAMES = [f.name for f in fields(Tree)]
KINDS = {"points": np.int32, "order": np.int32, "first": np.int32, "end": np.int32, "left": np.int32, "right": np.int32, "radius": np.float64, "sums": np.int64}


def packed(tree: Tree) -> dict[str, bytes]:
    return {n: getattr(tree, n).astype(KINDS[n]).tobytes() for n in NAMES}


def unpacked(row: dict, width: int) -> Tree:
    values = {n: np.frombuffer(row[n], KINDS[n]).astype(np.float64 if n == "radius" else np.int64) for n in NAMES}
    for n in ("points", "sums"):
        values[n] = values[n].reshape(len(values["order" if n == "points" else "first"]), width)
    return Tree(**values)


TREE = T.StructType([T.StructField(n, T.BinaryType()) for n in NAMES])


def usable_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """The rows whose vectors are whole, with the column ``WHOLE`` of integer components."""
    require(vectors, "vec_id", "embedding")
    double = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    too_large = F.exists(double, lambda x: F.abs(x * scale) >= LIMIT)
    error = F.raise_error(F.concat(F.lit("a component of this vec_id is too large: "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))))
    whole = F.when(too_large, error.cast("array<int>")).otherwise(F.transform(double, lambda x: F.floor(x * scale).cast("int")))
    return vectors.where(F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False))).withColumn(WHOLE, whole)


def blocks_of(rows: DataFrame, length: int, parts: int) -> DataFrame:
    """One row for each block: its rows (without the vector) and the tree of each part."""
    kept = [f for f in rows.schema.fields if f.name not in (WHOLE, "embedding")]
    width = length // parts
    most = max(1, min(BLOCK_ROWS, BLOCK_VALUES // max(length, 1)))
    kind = pa.list_(pa.struct([(n, pa.binary()) for n in NAMES]))
    schema = T.StructType([T.StructField("rows", T.ArrayType(T.StructType(kept))), T.StructField("trees", T.ArrayType(TREE))])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, len(batch), most):
                piece = batch.slice(at, most)
                if held and size + len(piece) > most:
                    yield block(held, size)
                    held, size = [], 0
                held.append(piece)
                size += len(piece)
        if held:
            yield block(held, size)

    def block(pieces: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
        whole = pa.Table.from_batches(pieces).combine_chunks()
        values = whole.column(WHOLE).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(size, length)
        trees = [packed(build(np.ascontiguousarray(values[:, k * width:(k + 1) * width]))) for k in range(parts)]
        rest = [whole.column(f.name).combine_chunks() for f in kept]
        struct = pa.StructArray.from_arrays(rest, fields=[pa.field(f.name, a.type) for f, a in zip(kept, rest, strict=True)])
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, size], struct), pa.array([trees], kind)], ["rows", "trees"])

    return rows.select(*[F.col(f"`{f.name}`") for f in kept], f"`{WHOLE}`").mapInArrow(blocks, schema)


def next_codebooks(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """One round: the floored means of what each entry owns; an entry that owns nothing stays."""
    parts, entries, width = codebooks.shape
    shared = blocks.sparkSession.sparkContext.broadcast(codebooks)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for trees in batch.column(0):
                for k, tree in enumerate(trees):
                    n, total = entry_sums(unpacked(tree.as_py(), width), shared.value[k])
                    counts[k] += n
                    sums[k] += total
        used = [(k, e) for k in range(parts) for e in range(entries) if counts[k, e]]
        columns = [[k for k, _ in used], [e for _, e in used], [int(counts[u]) for u in used]]
        kinds = [pa.int32(), pa.int32(), pa.int64()]
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        arrays.append(pa.array([sums[u].tolist() for u in used], pa.list_(pa.int64())))
        yield pa.RecordBatch.from_arrays(arrays, ["part", "entry", "n", "sums"])

    rows = blocks.select("trees").mapInArrow(summed, "part int, entry int, n long, sums array<long>")
    total = rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    out = codebooks.copy()
    for r in total.collect():  # a row for each entry at most
        out[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return out


def coded(blocks: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """The blocks' rows with code (two hex digits a part) and error."""
    rows = blocks.schema["rows"].dataType.elementType
    kept = [f for f in rows.fields if f.name not in ("code", "error")]
    schema = T.StructType([*kept, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    shared = blocks.sparkSession.sparkContext.broadcast(codebooks)
    digits = np.array([f"{k:02x}" for k in range(256)], object)
    width = codebooks.shape[2]

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members, trees in zip(batch.column(0), batch.column(1), strict=True):
                values = members.values
                code, error = np.full(len(values), "", object), np.zeros(len(values), np.int64)
                for k, tree in enumerate(trees):
                    entry, far = assigned(unpacked(tree.as_py(), width), shared.value[k])
                    code, error = code + digits[entry], error + far
                held = [values.field(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays([*held, pa.array(code.tolist(), pa.string()), pa.array(error)], names=schema.names)

    return blocks.select("rows", "trees").mapInArrow(codes, schema)


@dataclass
class Codebooks:
    """parts x entries x width integers."""

    values: np.ndarray

    def sha256(self) -> str:
        """Of all integers by part, entry and position, in decimal, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.values.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """The usable rows of vectors (without embedding) with code and error, and the codebooks they refer to."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows = usable_vectors(vectors, scale)
    bounds = rows.agg(F.min(F.size(F.col(f"`{WHOLE}`"))).alias("least"), F.max(F.size(F.col(f"`{WHOLE}`"))).alias("most")).first()
    if bounds["least"] != bounds["most"]:
        raise ValueError(f"usable vectors have lengths from {bounds['least']} to {bounds['most']}")
    length = bounds["most"] or 0
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    firsts = rows.select("vec_id", f"`{WHOLE}`").orderBy(F.col("vec_id").asc_nulls_last(), f"`{WHOLE}`").limit(entries).collect()
    codebooks = np.array([r[WHOLE] for r in firsts], np.int64).reshape(len(firsts), parts, length // parts).transpose(1, 0, 2)
    blocks = saved(blocks_of(rows, length, parts), "trees")
    if len(firsts):
        for _ in range(rounds):
            codebooks = next_codebooks(blocks, codebooks)
    return coded(blocks, codebooks), Codebooks(codebooks)


def with_group_error(rows: DataFrame, group: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of error over the rows of equal ``group``, nulls together."""
    rows = saved(rows, "codes")
    # saved, so that its size decides whether it is broadcast
    sums = saved(rows.groupBy(F.col(f"`{group}`").alias("_group_of_error")).agg(F.sum("error").alias("_sum_of_error")), "group-errors")
    joined = rows.drop(name).join(sums, F.col(f"`{group}`").eqNullSafe(F.col("_group_of_error")))
    return joined.withColumnRenamed("_sum_of_error", name).drop("_group_of_error")
