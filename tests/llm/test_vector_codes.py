"""Vector codes against k-means with all distances in plain integers."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tablesift.llm import vector_codes
from tablesift.llm.queries import op12_vector_codes


def brute(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error) of each usable row, and the digest."""
    fine = [(i, [math.floor(4096 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(fine[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v in fine]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            mine = defaultdict(list)
            for c in cut:
                mine[nearest(c[p], books[p])[1]].append(c[p])
            for k, xs in mine.items():
                books[p][k] = [sum(col) // len(xs) for col in zip(*xs, strict=True)]
    out = []
    for (i, _), c in zip(fine, cut, strict=True):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


@pytest.mark.parametrize(("points", "leaf"), [(1, 8), (9, 2), (700, 1), (700, 24)])
def test_tree_balls_hold_their_points(monkeypatch, points, leaf):
    monkeypatch.setattr(vector_codes, "LEAF", leaf)
    rng = np.random.default_rng(points)
    data = rng.integers(-40, 40, (points, 3))
    data[points // 2:] = data[points // 2:] // 20  # many equal points
    tree = vector_codes.build(data)
    assert sorted(tree.order.tolist()) == list(range(points)) and (tree.points == data[tree.order]).all()
    for k, (a, b) in enumerate(zip(tree.first, tree.end, strict=True)):
        mine = tree.points[a:b]
        assert (tree.sums[k] == mine.sum(axis=0)).all()
        assert np.sqrt(((mine - tree.sums[k] / (b - a)) ** 2).sum(axis=1)).max() <= tree.radius[k] + 1e-9
        if tree.left[k] >= 0:
            children = sorted((int(tree.first[c]), int(tree.end[c])) for c in (tree.left[k], tree.right[k]))
            assert children[0][0] == a and children[0][1] == children[1][0] and children[1][1] == b
    entries = np.concatenate([data[:5], data[:1], [[0, 0, 0], [1000, 0, 0]]])  # a repeated one, one that owns nothing
    far = ((data[:, None] - entries[None]) ** 2).sum(axis=2)
    code, error = vector_codes.assigned(tree, entries)
    assert (code == far.argmin(axis=1)).all() and (error == far.min(axis=1)).all()
    counts, sums = vector_codes.entry_sums(tree, entries)
    assert (counts == np.bincount(code, minlength=len(entries))).all()
    assert all((sums[k] == data[code == k].sum(axis=0)).all() for k in range(len(entries)))


def test_far_groups_are_owned_whole():
    rng = np.random.default_rng(5)
    middles = np.array([[0, 0], [9000, 0], [0, 9000], [9000, 9000]])
    data = (middles[:, None] + rng.integers(-50, 50, (4, 300, 2))).reshape(-1, 2)
    found = list(vector_codes.owners(vector_codes.build(data), middles))
    assert sum(len(at) for at, _, whole in found if not whole) == 0
    assert sum(len(at) for at, _, whole in found if whole) < 40


def test_codes_are_those_of_plain_k_means(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 37)
    rng = np.random.default_rng(1)
    base = rng.normal(0, 0.2, (150, 16)).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(200 + k, rows[3][1]) for k in range(60)] + [(5, rows[7][1]), (5, rows[7][1]), (None, rows[9][1])]
    rows += [(300, None), (301, [None] * 16), (302, [float("nan")] + [0.0] * 15), (303, [float("inf")] * 16), (304, [0.0] * 16)]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame([(i, v, None if k % 5 == 0 else k % 3, "mine", 7.0) for k, (i, v) in enumerate(rows)],
                               "vec_id long, embedding array<float>, label int, code string, rows double").repartition(3)
    coded, books = vector_codes.compress(df)
    want, digest = brute(rows)
    got = coded.collect()
    assert coded.columns == ["vec_id", "label", "rows", "code", "error"]
    assert Counter((r["vec_id"], r["code"], r["error"]) for r in got) == Counter(want)
    assert books.sha256() == digest
    sums = defaultdict(int)
    for r in got:
        sums[r["label"]] += r["error"]
    joined = vector_codes.with_group_error(coded, "label", "label_error").collect()
    assert len(joined) == len(got) and all(r["label_error"] == sums[r["label"]] for r in joined)


def test_few_rows_and_odd_vectors(spark, tmp_path):
    schema = "vec_id long, embedding array<float>, label int"
    few = spark.createDataFrame([(2, [0.5] * 8, 1), (1, [0.25] * 8, None)], schema)
    assert {(r["vec_id"], r["code"], r["error"]) for r in vector_codes.compress(few)[0].collect()} == {(1, "00" * 8, 0), (2, "01" * 8, 0)}
    assert vector_codes.compress(few.limit(0))[0].count() == 0
    empty = spark.createDataFrame([(1, [], 0)], schema)
    assert vector_codes.compress(empty)[0].first()["code"] == "00" * 8
    for vectors, message in (([[0.5] * 8, [0.5] * 16], "8 to 16"), ([[0.5] * 9], "9 components"), ([[1e9] * 8], "too large")):
        df = spark.createDataFrame([(k, v, 0) for k, v in enumerate(vectors)], schema)
        with pytest.raises(Exception, match=message):
            vector_codes.compress(df)[0].collect()
    few.where("false").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op12_vector_codes(spark, str(tmp_path)).count() == 0
