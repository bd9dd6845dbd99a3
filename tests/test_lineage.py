import random

import pytest

from tablesift import resolve_lineage

SCHEMA = "old_id string, new_id string, change_date string"


def run(spark, rows, seeds):
    out = resolve_lineage(spark.createDataFrame(rows, SCHEMA), seeds)
    return (
        {r.id for r in out.ids.collect()},
        {r.id: r.newest_id for r in out.newest.collect()},
        sorted((r.old_id or "", r.new_id or "", r.newest_id) for r in out.rows.collect()),
    )


CHAIN = [("A", "B", "2020-01-01"), ("B", "C", "2021-01-01")]


@pytest.mark.parametrize("seed", ["A", "C"])
def test_chain(spark, seed):
    ids, newest, rows = run(spark, CHAIN, [seed])
    assert ids == {"A", "B", "C"} and set(newest.values()) == {"C"}
    assert [r[2] for r in rows] == ["C", "C"]


def test_latest_branch_wins(spark):
    ids, newest, rows = run(spark, [("A", "B", "2020-01-01"), ("A", "C", "2021-01-01")], ["A"])
    assert ids == {"A", "B", "C"} and newest["A"] == "C" and newest["B"] == "B"
    assert [r[2] for r in rows] == ["C", "C"]


def test_unknown_and_null(spark):
    assert run(spark, CHAIN, ["Z"]) == ({"Z"}, {"Z": "Z"}, [])
    assert run(spark, [(None, "C", "2020-01-01")], ["C"]) == ({"C"}, {"C": "C"}, [("", "C", "C")])
    assert run(spark, CHAIN, []) == (set(), {}, [])


def test_null_dates_lose_and_ties_take_the_greater_id(spark):
    rows = [("A", "Z", None), ("A", "B", "2020-01-01"), ("A", "C", "2020-01-01"), ("A", "D", "bad")]
    assert run(spark, rows, ["A"])[1]["A"] == "C"


def test_cycles_take_their_smallest_id(spark):
    rows = [("X", "P", "2020"), ("P", "Q", "2020"), ("Q", "R", "2020"), ("R", "P", "2020"), ("S", "S", "2020")]
    ids, newest, _ = run(spark, rows, ["X", "S"])
    assert newest == {"X": "P", "P": "P", "Q": "P", "R": "P", "S": "S"}


def naive(rows, seeds):
    best, near = {}, {}
    for old, new, day in rows:
        best[old, new] = max(best.get((old, new), ""), day or "")
        near.setdefault(old, set()).add(new)
        near.setdefault(new, set()).add(old)
    ids, todo = set(seeds), list(seeds)
    while todo:
        for other in near.get(todo.pop(), ()):
            if other not in ids:
                ids.add(other)
                todo.append(other)
    step = {}
    for (old, new), day in best.items():
        step[old] = max(step.get(old, ("", "")), (day, new))
    newest = {}
    for start in ids:
        seen, at = [], start
        while at in step and at not in seen:
            seen.append(at)
            at = step[at][1]
        newest[start] = min(seen[seen.index(at):]) if at in seen else at
    return ids, newest


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_graphs(spark, seed):
    rnd = random.Random(seed)
    n = 60
    rows = [
        (f"N{rnd.randrange(n):02d}", f"N{rnd.randrange(n):02d}", rnd.choice([None, "2020-01-01", "2021-01-01"]))
        for _ in range(50)
    ]
    rows += [(f"L{i:02d}", f"L{i + 1:02d}", "2020-01-01") for i in range(40)]
    seeds = [f"N{rnd.randrange(n):02d}" for _ in range(3)] + ["L20"]
    ids, newest, out = run(spark, rows, seeds)
    assert (ids, newest) == naive(rows, seeds)
    assert len(out) == sum(1 for o, w, _ in rows if o in ids or w in ids)
