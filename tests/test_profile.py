from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablesift import profile, profile_table, profile_tables, report_views, year_distribution
from tablesift.operators.profile import PROFILE_COLUMNS, merged_profile, safe_report_name, save_profile_state, write_report

CODES = ["DK", "SE", "CN"]


@pytest.fixture(scope="module")
def owners(spark):
    return spark.createDataFrame(
        [("DK12345678", "Ann", "2024-01-31", 1.5, "x", None, True, datetime(2024, 1, 1), "01/02/2024"),
         ("SE 1234567", "Bo", "2024-02-29", None, "x", None, True, datetime(2024, 1, 1), "02/01/2024"),
         ("CN-123456", "Cy", None, float("nan"), "x", None, False, None, "13/01/2024")],
        "entity_id string, name string, closing_date string, revenue double, status string, gone string, "
        "flag boolean, ts timestamp, day string",
    )


@pytest.fixture(scope="module")
def by_column(owners):
    return {r["column"]: r for r in profile(owners, CODES, "P", "t", "f.csv").collect()}


def test_fields(owners, by_column):
    assert profile(owners, CODES).columns == PROFILE_COLUMNS and len(PROFILE_COLUMNS) == 38
    ids = by_column["entity_id"]
    assert (ids.entity_id_like_count, ids.entity_id_like_pct, ids.mostly_entity_id_like) == (3, 1.0, True)
    assert ids.logical_type == "identifier" and ids.can_join_key and ids.unique_count == 3
    assert ids.operation_notes == "candidate_join_key;candidate_identifier;candidate_entity_id_column"
    assert not by_column["name"].contains_entity_id_like_values
    day = by_column["closing_date"]
    assert (day.date_format, day.can_date_filter, day.date_filter_strategy, day.logical_type) == (
        "%Y-%m-%d", True, "parse_with_format:%Y-%m-%d", "date")
    assert (day.missing_count, day.nullable, day.non_null_count) == (1, True, 2)
    rev = by_column["revenue"]
    assert rev.can_numeric_aggregate and rev.needs_null_handling and rev.non_null_count == 1
    assert by_column["status"].logical_type == "string" and by_column["status"].can_groupby
    gone = by_column["gone"]
    assert gone.logical_type == "unknown" and gone.string_min_length is None and not gone.can_filter_exact
    assert by_column["flag"].logical_type == "boolean"
    ts = by_column["ts"]
    assert (ts.logical_type, ts.date_format, ts.has_time_component) == ("datetime", "native", True)
    dm = by_column["day"]
    assert (dm.date_format, dm.date_format_ambiguous, dm.date_parseable_pct) == ("%d/%m/%Y", True, 1.0)


def test_empty_and_constant(spark):
    empty = profile(spark.createDataFrame([], "a string, b int")).collect()
    assert [(r.sampled_rows, r.logical_type, r.missing_pct) for r in empty] == [(0, "unknown", 0.0), (0, "integer", 0.0)]
    same = profile(spark.range(10).select(F.lit("k").alias("a"))).first()
    assert same.logical_type == "categorical" and same.unique_count == 1


def test_approximate_agrees_on_small_data(owners):
    exact = profile(owners, CODES).orderBy("column").collect()
    assert profile(owners, CODES, approximate=True).orderBy("column").collect() == exact


@pytest.mark.parametrize("text,fmt,granularity", [
    ("20240131", "%Y%m%d", "date"), ("2024-01", "%Y-%m", "year_month"), ("2024", "%Y", "year"),
    ("31-01-2024", "%d-%m-%Y", "date"), ("01/31/2024", "%m/%d/%Y", "date"),
    ("2024-01-31 10:00:00", "%Y-%m-%d %H:%M:%S", "datetime"), ("2024-01-31T10:00:00", "%Y-%m-%dT%H:%M:%S", "datetime"),
    ("2024-01-31T10:00:00Z", "%Y-%m-%dT%H:%M:%SZ", "datetime"), ("2024-01-31 10:00:00+0200", "%Y-%m-%d %H:%M:%S%z", "datetime"),
    ("2024-01-31T10:00:00+02:00", "%Y-%m-%dT%H:%M:%S%z", "datetime"), ("2024-01-31 10:00:00.25", "mixed", "mixed"),
    ("2024-13-31", None, None), ("text", None, None), ("9999", None, None)])
def test_date_formats(spark, text, fmt, granularity):
    row = profile(spark.createDataFrame([(text,)], "a string")).first()
    assert (row.date_format, row.date_granularity) == (fmt, granularity)


def test_views_and_files(spark, owners, tmp_path):
    prof = profile(owners, CODES, "P", "t")
    views = report_views(prof, {"scope": "x"})
    assert list(views) == ["columns", "summary", "date_formats", "entity_id_columns", "operation_hints", "report_info"]
    assert views["summary"].count() == 1 and views["entity_id_columns"].count() == 1
    assert {r["column"] for r in views["date_formats"].collect()} == {"closing_date", "ts", "day"}
    assert len(write_report(prof, str(tmp_path / "r"), "csv")) == 6
    path = f"{tmp_path}/t.parquet"
    owners.write.parquet(path)
    one = profile_table(spark, [path], CODES, "P", "t", report_path=f"{tmp_path}/rep")
    assert one.count() == 9 and spark.read.parquet(f"{tmp_path}/rep/summary").first().file_name is None
    first = profile_table(spark, [path, "absent"], CODES, "P", "t", sample_strategy="first_file")
    assert {r.file_name for r in first.collect()} == {"t.parquet"}
    assert profile_table(spark, [path], dry_run=True).first().would_profile
    many = profile_tables(spark, {("P", "a"): [path], ("P", "b"): [path]}, CODES, sample_strategy="all")
    assert many.count() == 18
    assert safe_report_name("a/b:c") == "a_b_c" and safe_report_name(None) == "profile"


def test_states_of_parts_merge_to_the_profile_of_all(spark, owners, tmp_path):
    cut = [owners.where("revenue > 1"), owners.where("NOT revenue > 1"), owners.where("revenue IS NULL"), owners.limit(0)]
    for k, part in enumerate(cut):
        save_profile_state(part, f"{tmp_path}/{k}", CODES)
    paths = [f"{tmp_path}/{k}" for k in range(len(cut))]
    whole = profile(owners, CODES, "P", "t").orderBy("column").collect()
    assert merged_profile(spark, paths, "P", "t").orderBy("column").collect() == whole
    assert merged_profile(spark, paths, "P", "t", approximate=True).orderBy("column").collect() == whole
    stored = spark.read.parquet(f"{tmp_path}/0/digests")
    assert [f.dataType.simpleString() for f in stored.schema] == ["int", "bigint", "bigint"]
    save_profile_state(owners.select("revenue"), f"{tmp_path}/other", CODES)
    with pytest.raises(ValueError, match="different columns"):
        merged_profile(spark, [*paths, f"{tmp_path}/other"])
    with pytest.raises(ValueError, match="no states"):
        merged_profile(spark, [])


def test_year_distribution(spark):
    df = spark.createDataFrame([("01-01-2020",), ("15-06-2020",), ("01-01-2021",), ("x",)], "closing_date string")
    got = [(r.Year, r.Frequency, round(r.Percentage, 2)) for r in year_distribution(df, date_format="dd-MM-yyyy").collect()]
    assert got == [("2020", 2, 66.67), ("2021", 1, 33.33), ("Total", 3, 100.0)]
    with pytest.raises(ValueError):
        year_distribution(spark.range(1))
