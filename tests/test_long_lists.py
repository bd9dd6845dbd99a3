"""Lists of any length over several columns against a row-by-row filter, and the joins they take."""

import random

import pytest

from tablesift.operators import filters
from tablesift.operators.filters import Clause, LayeredFilter, apply_layers

IDS = [f"{c}{n:02d}" for c in ("DK", "SE", "NO") for n in range(12)]
ROWS = "n int, `a.b` string, b string, c int, note string"


def some_rows(rnd, n=300):
    def pick():
        return rnd.choice([None, "", *IDS, *IDS])
    rows = [(k, pick(), pick(), rnd.choice([None, *range(12)]), "x") for k in range(n)]
    return rows + [(900, None, None, None, None)] * 20 + rows[:5]


def passes(row, both, any_of):
    cells = {"a.b": row[1], "b": row[2], "c": None if row[3] is None else str(row[3])}

    def test(values, columns, mode):
        held = [cells[c] for c in columns if cells[c] is not None]
        return any(h == v if mode == "exact" else h.startswith(v) for h in held for v in values)
    return bool(both) and all(test(*c) for c in both) or any(test(*c) for c in any_of)


SHORT = (["DK01", "3"], ["a.b", "c"], "exact")
LISTS = [
    ([(IDS[::3], ["a.b", "b"], "exact")], []),
    ([(IDS[::2], ["a.b", "b"], "exact"), (["3", "4", "5"], ["c"], "exact")], []),
    ([], [(IDS[::5], ["a.b"], "exact"), (["DK1", "SE", "NO00"], ["b", "c"], "prefix")]),
    ([(IDS[::2], ["a.b", "b"], "exact"), SHORT], [(IDS[4:6], ["b"], "exact")]),
    ([SHORT], [(IDS[::7], ["b", "a.b"], "exact")]),
    ([(IDS[::2], ["b"], "exact"), (IDS[1::2], ["a.b", "b"], "exact")], [SHORT]),
]


@pytest.mark.parametrize("both,any_of", LISTS)
@pytest.mark.parametrize("as_frames", [False, True])
def test_masks_give_the_rows_of_a_plain_filter(spark, monkeypatch, both, any_of, as_frames):
    monkeypatch.setattr(filters, "INLINE_VALUES", 2)
    monkeypatch.setattr(filters, "BROADCAST_BYTES", 0)
    rows = some_rows(random.Random(len(both) * 10 + len(any_of)))
    df = spark.createDataFrame(rows, ROWS).repartition(3)

    def clause(values, columns, mode):
        if as_frames and mode == "exact" and len(values) > 2:
            values = spark.createDataFrame([(v,) for v in [*values, None, "", values[0]]], "v string")
        return Clause(values, columns, mode)
    layered = LayeredFilter(required=[clause(*c) for c in both], alternatives=[clause(*c) for c in any_of])
    out = apply_layers(df, layered)
    assert out.columns == df.columns
    got = sorted(map(repr, (tuple(r) for r in out.collect())))
    assert got == sorted(repr(r) for r in rows if passes(r, both, any_of))


def test_whole_rows_meet_one_join(spark, monkeypatch, tmp_path):
    """Only the ID columns are unpivoted; the other columns are read for one semi join."""
    monkeypatch.setattr(filters, "INLINE_VALUES", 2)
    monkeypatch.setattr(filters, "BROADCAST_BYTES", 0)
    spark.createDataFrame(some_rows(random.Random(1)), ROWS.replace("a.b", "a")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    lists = [Clause(spark.createDataFrame([(v,) for v in IDS[k::2]], "v string"), ["a", "b"]) for k in range(2)]
    plan = apply_layers(df, LayeredFilter(required=lists[0], alternatives=[lists[1], Clause(IDS[:5], "b")]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 1 and "LeftOuter" not in plan
    scans = [line for line in plan.splitlines() if "Relation [" in line and "note" in line]
    assert plan.count("note#") >= 1 and len(scans) >= 1
    generated = plan[plan.index("Generate"):]
    assert "note" not in generated.split("Relation")[0]
