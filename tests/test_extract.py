from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablesift import Clause, DateRange, ExtractSpec, LayeredFilter, extract, preflight, sample
from tablesift.operators import filters
from tablesift.operators.extract import default_destination, lookup_national_ids
from tablesift.operators.filters import classify_ids, id_clause, merge_columns


def values(df, column="value"):
    return sorted(r[column] for r in df.collect())


@pytest.fixture(scope="module")
def two_ids(spark):
    return spark.createDataFrame(
        [("DK100", "X1", 1), ("SE200", "Y2", 2), ("NO300", "DK999", 3), ("FI400", "SE777", 4),
         (None, None, 5)],
        "first string, second string, value int",
    )


def test_exact_and_multi_column(spark):
    df = spark.createDataFrame(
        [("A1", "X9", 1), ("B2", "A1", 2), ("C3", "C3", 3), ("D4", "D4", 4)],
        "first string, second string, value int",
    )
    one = ExtractSpec(ids=LayeredFilter(Clause(["A1", "C3"], "first")))
    assert values(extract(df, one)) == [1, 3]
    both = ExtractSpec(ids=LayeredFilter(Clause(["A1", "C3"], ["first", "second"])))
    assert values(extract(df, both)) == [1, 2, 3]


def test_prefix(two_ids):
    spec = ExtractSpec(ids=LayeredFilter(Clause(["DK", "SE"], ["first", "second"], "prefix")))
    assert values(extract(two_ids, spec)) == [1, 2, 3, 4]


def test_many_prefixes_give_the_same_rows(two_ids, monkeypatch):
    spec = ExtractSpec(ids=LayeredFilter(Clause(["DK", "SE2"], ["first", "second"], "prefix")))
    short = values(extract(two_ids, spec))
    monkeypatch.setattr(filters, "INLINE_PREFIXES", 1)
    assert values(extract(two_ids, spec)) == short
    monkeypatch.setattr(filters, "INLINE_VALUES", 1)
    assert values(extract(two_ids, spec)) == short == [1, 2, 3]


def test_layers(spark):
    df = spark.createDataFrame(
        [(1, "B1", None, "A1", None, None), (2, None, "B1", None, "A1", None),
         (3, None, None, None, None, "O1"), (4, "B1", None, None, None, None)],
        "value int, base_a string, base_b string, and_a string, and_b string, or_b string",
    )
    layers = LayeredFilter(
        Clause(["B1"], ["base_a", "base_b"]), Clause(["A1"], ["and_a", "and_b"]), Clause("O1", "or_b")
    )
    assert values(extract(df, ExtractSpec(ids=layers))) == [1, 2, 3]
    assert layers.columns() == ["base_a", "base_b", "and_a", "and_b", "or_b"]


def test_two_required_clauses_are_grouped(spark):
    df = spark.createDataFrame([("a", "x", "p", "q", 1), ("a", "x", "p", "z", 2), ("z", "y", "c", "d", 3)],
                               "a string, b string, c string, d string, value int")
    layers = LayeredFilter(required=[Clause(["a", "y"], ["a", "b"]), Clause(["q", "d"], ["c", "d"])])
    assert values(extract(df, ExtractSpec(ids=layers))) == [1, 3]


@pytest.mark.parametrize("limit", [0, 1000])
def test_long_lists_and_short_lists_agree(spark, monkeypatch, limit):
    monkeypatch.setattr(filters, "INLINE_VALUES", limit)
    df = spark.range(100).select(F.concat(F.lit("E"), "id").alias("a"), F.concat(F.lit("E"), F.col("id") + 1).alias("b"),
                                 F.col("id").cast("int").alias("value"))
    ids = [f"E{i}" for i in range(0, 40, 2)]
    layers = LayeredFilter(Clause(ids, ["a", "b"]), Clause(["E3", "E4", "E5"], "a"), Clause(["E90"], "b"))
    assert values(extract(df, ExtractSpec(ids=layers))) == [3, 4, 5, 89]
    semi = LayeredFilter(Clause(spark.createDataFrame([("E7",), ("E7",), (None,), (" ",)], "v string"), "a"))
    assert values(extract(df, ExtractSpec(ids=semi))) == [7]


def test_literal_characters(spark):
    df = spark.createDataFrame([("a%b", 1), ("a_b", 2), ("a'b", 3), ("axb", 4)], "k string, value int")
    spec = ExtractSpec(ids=LayeredFilter(Clause(["a%", "a'"], "k", "prefix")))
    assert values(extract(df, spec)) == [1, 3]


def test_blank_clauses_vanish(two_ids):
    spec = ExtractSpec(ids=LayeredFilter(Clause([None, " "], "first"), [], None))
    assert extract(two_ids, spec).count() == 5
    with pytest.raises(ValueError):
        Clause(["a"], "first", "like")


def test_years(spark):
    df = spark.createDataFrame(
        [("2019-01-01 00:00:00", 1), ("2020-06-01 00:00:00", 2), (None, 3), ("n/a", 4), ("31/12/2020", 5)],
        "closing_date string, value int",
    )
    remove = extract(df, ExtractSpec(years=DateRange(2020, 2020)))
    assert values(remove) == [2, 5]
    assert dict(remove.dtypes)["closing_date"] == "timestamp"
    keep = extract(df, ExtractSpec(columns=["value"], years=DateRange(2020, 2020, nulls="keep")))
    assert keep.columns == ["value"] and values(keep) == [2, 3, 4, 5]
    empty = extract(df, ExtractSpec(years=DateRange(1950, 1951)))
    assert empty.columns == df.columns and empty.isEmpty()
    other = df.drop("closing_date")
    assert extract(other, ExtractSpec(years=DateRange(2020, 2020))).count() == 5


def test_year_checks():
    assert DateRange(2020, None, this_year=2024).end_year is None
    for bad in ((2021, 2020), (1800, 2000), ("2019", 2020), (2020, 2999)):
        with pytest.raises(ValueError):
            DateRange(*bad)


def test_range_reaches_the_reader(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(datetime(2020, 1, 1), "DK1", 1, 2)], "d timestamp_ntz, k string, value int, x int").write.parquet(path)
    spec = ExtractSpec(["value"], LayeredFilter(Clause(["DK"], "k", "prefix")), DateRange(2020, 2020, "d"))
    plan = extract(spark.read.parquet(path), spec)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d" in plan and "StringStartsWith(k,DK)" in plan
    assert "x:int" not in plan


def test_predicates_functions_sample(two_ids):
    assert values(extract(two_ids, ExtractSpec(predicate="value > 3"))) == [4, 5]
    assert values(extract(two_ids, ExtractSpec(predicate=F.col("value") < 2))) == [1]
    table = ExtractSpec(function=lambda df, n: df.where(F.col("value") == n), function_args=(2,))
    assert values(extract(two_ids, table)) == [2]
    part = ExtractSpec(function=lambda pdf, n: pdf[pdf.value == n], function_args=(3,), scope="partition")
    assert values(extract(two_ids, part)) == [3]
    assert sample(two_ids, ExtractSpec(), 2).count() == 2
    assert sample(two_ids, ExtractSpec(), 0).count() == 5
    with pytest.raises(ValueError):
        extract(two_ids, ExtractSpec(columns=["nope"]))
    kept = ExtractSpec(["value"], LayeredFilter(Clause(["DK100"], "first")), keep_filter_columns=True)
    assert extract(two_ids, kept).columns == ["value", "first"]


def test_national_ids(spark):
    df = spark.createDataFrame([("E1", 10), ("E2", 20)], "entity_id string, national long")
    assert values(lookup_national_ids(df, [10, "30"], "entity_id", "national"), "entity_id") == ["E1"]


def test_id_lists(spark):
    codes = spark.createDataFrame([("DK",), ("SE",)], "Code string")

    def ids(*v):
        return spark.createDataFrame([(x,) for x in v], "v string")

    assert id_clause(ids("DK", "SE", "DK"), codes, "k").mode == "prefix"
    assert id_clause(ids("AB12", "CD34"), codes, "k").mode == "exact"
    with pytest.raises(ValueError, match="###"):
        id_clause(ids("AB12", "###"), codes, "k")
    keep = id_clause(ids("AB12", "###"), codes, "k", on_invalid="keep")
    assert values(keep.values) == ["###", "AB12"]
    drop = id_clause(ids("AB12", "###"), codes, "k", on_invalid="drop")
    assert values(drop.values) == ["AB12"]
    rows = {r["value"]: r for r in classify_ids(ids("DK", "A-1", "9x"), codes).collect()}
    assert not rows["9x"]["kept"] and rows["DK"]["is_code"] and rows["A-1"]["mode"] == "exact"


def test_preflight(spark, two_ids):
    listing = spark.createDataFrame([("a.parquet",)], "path string")
    spec = ExtractSpec(["value"], LayeredFilter(Clause(["DK"], "first")))
    now = datetime(2024, 1, 2, 3, 4)
    ok = preflight(two_ids, spec, ["a.parquet"], listing, "csv", table="t", output_root="/o", now=now).first()
    assert ok.ok and ok.would_write and ok.destination == "/o/2401020304_t" == default_destination("t", "/o", now)
    assert ok.required_columns == ["value", "first"]
    bad = preflight(two_ids, ExtractSpec(["nope"]), ["b.parquet"], listing).first()
    assert not bad.ok and bad.missing_files == ["b.parquet"] and len(bad.errors) == 2


def test_merge_columns():
    assert merge_columns("a", ["b", "a"], None, ("c",)) == ["a", "b", "c"]
    with pytest.raises(TypeError):
        merge_columns([1])


def test_absent_date_column_is_an_error(spark):
    df = spark.createDataFrame([("DK1",)], "entity_id string")
    with pytest.raises(ValueError, match="closing_dat"):
        extract(df, ExtractSpec(years=DateRange(2015, 2016, "closing_dat")))
    assert extract(df, ExtractSpec(years=DateRange(2015, 2016))).count() == 1


def test_half_written_job_is_written_anew(spark, tmp_path):
    from tablesift.operators.jobs import run_batch

    jobs = spark.createDataFrame([("P", "T", "entity_id", True)], "`Data Product` string, `Table` string, `Column` string, Run boolean")
    half = tmp_path / "1_P_T.parquet" / "_temporary"
    half.mkdir(parents=True)
    df = spark.createDataFrame([("DK1",), ("SE1",)], "entity_id string")
    for status in ("written", "exists"):
        assert [r["status"] for r in run_batch(jobs, ["DK1"], lambda p, t: df, str(tmp_path)).collect()] == [status]
    assert spark.read.parquet(str(tmp_path / "1_P_T.parquet")).count() == 1


@pytest.mark.parametrize("kind", ["date", "string"])
def test_open_years_are_unbounded(spark, kind):
    days = ["1850-01-01", "2020-06-01", "2090-12-31", None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d string").withColumn("d", F.col("d").cast(kind))

    def left(*years, **options):
        return sorted(r.i for r in extract(df, ExtractSpec(["i"], years=DateRange(*years, "d", **options))).collect())

    assert left(2020, None) == [1, 2]
    assert left(None, 2020) == [0, 1]
    assert left(None, None) == [0, 1, 2]
    assert left(None, None, nulls="keep") == [0, 1, 2, 3]
    assert left(2020, None, nulls="keep") == [1, 2, 3]


def test_combined_function_of_part_files_holds_no_whole_file(spark, tmp_path):
    spark.range(0, 30_000, 1, 2).selectExpr("id", "id % 3 AS kind").write.parquet(f"{tmp_path}/many")

    def counted(pdf):
        assert len(pdf) <= 10_000  # an Arrow batch
        return pdf.groupby("kind", as_index=False).agg(n=("id", "count"))

    spec = ExtractSpec(function=counted, scope="part", function_schema="kind long, n long",
                       combine_by=["kind"], combine=[F.sum("n").alias("n")])
    got = extract(spark.read.parquet(f"{tmp_path}/many"), spec)
    assert got.columns == ["kind", "n"]
    assert sorted(tuple(r) for r in got.collect()) == [(k, 5000) for k in (0, 0, 1, 1, 2, 2)]


def test_function_of_part_files(spark, tmp_path):
    for k in range(2):
        spark.range(10 * k, 10 * k + 5 + k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/t.parquet")
    count = ExtractSpec(predicate="id <> 3", function=lambda pdf: pdf.agg({"id": ["count"]}).rename(columns={"id": "n"}), scope="part", function_schema="n long")
    assert sorted(r.n for r in extract(spark.read.parquet(f"{tmp_path}/t.parquet"), count).collect()) == [4, 6]


def test_long_lists_keep_pushed_filters_and_spread_nulls(spark, tmp_path):
    rows = [(datetime(2020, 1, 1), None if i % 3 else f"A{i}", None if i % 2 else f"B{i}", i) for i in range(60)]
    spark.createDataFrame(rows, "d timestamp_ntz, a string, b string, value int").write.parquet(f"{tmp_path}/t")
    listed = [f"A{i}" for i in range(0, 3000, 2)] + [f"B{i}" for i in range(0, 3000, 4)]
    table = spark.read.parquet(f"{tmp_path}/t")
    spec = ExtractSpec(["value"], LayeredFilter(Clause(listed, ["a", "b"])), DateRange(2020, 2020, "d"), predicate="value < 50")
    got = extract(table, spec)
    assert values(got) == [i for i in range(50) if i % 6 == 0 or i % 4 == 0]
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = extract(table, spec)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(d" in plan and "LessThan(value,50)" in plan
