"""Which files an extract can touch, from footers; never fewer than those that hold a row."""

import random
from datetime import date

from pyspark.sql import functions as F

from tablesift.operators.filters import Clause, DateRange, LayeredFilter, apply_date_range, apply_layers
from tablesift.sources.footers import file_facts

ROWS = "entity_id string, owner_id string, closing_date date, n int"


def delivery(spark, tmp_path):
    rnd = random.Random(1)
    paths = []
    for k, code in enumerate(("DK", "DE", "SE", "NO", None)):
        rows = [(None if code is None else f"{code}{rnd.randint(0, 99):02d}", rnd.choice([None, f"US{k}{rnd.randint(0, 9)}"]),
                 None if rnd.random() < k / 8 else date(2000 + 3 * k + rnd.randint(0, 2), 1 + rnd.randint(0, 11), 1), k) for _ in range(40)]
        paths.append(f"{tmp_path}/{k}.parquet")
        spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(paths[-1])
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(str(tmp_path))
    return listing.select("path")


def test_no_file_with_a_row_is_left_out(spark, tmp_path):
    files = delivery(spark, tmp_path)
    table = spark.read.parquet(*[r.path for r in files.collect()])
    cases = [
        (LayeredFilter(Clause(["DK"], "entity_id", "prefix")), None, 1),
        (LayeredFilter(Clause(["DK05", "SE99", "XX"], ["entity_id"])), None, 2),
        (LayeredFilter(Clause(["NO"], "entity_id", "prefix"), Clause(["US3"], "owner_id", "prefix")), None, 1),
        (LayeredFilter(Clause(["NO"], "entity_id", "prefix"), alternatives=Clause(["US1"], "owner_id", "prefix")), None, 2),
        (LayeredFilter(Clause(["US"], ["entity_id", "owner_id"], "prefix")), None, 5),
        (LayeredFilter(Clause(["7"], "n")), None, 5),  # numbers do not sort like their text
        (None, DateRange(2003, 2006), 2),
        (None, DateRange(2003, 2006, nulls="keep"), 5),
        (LayeredFilter(Clause(["DK"], "entity_id", "prefix")), DateRange(2010, 2012), 0),
    ]
    for ids, years, most in cases:
        facts = {r.path: r for r in file_facts(spark, files, ids, years).collect()}
        assert len(facts) == 5 and all(r.present and r.rows == 40 and r.error is None for r in facts.values())
        hits = apply_date_range(apply_layers(table.withColumn("path", F.col("_metadata.file_path")), ids), years)
        held = {p.replace("file:///", "file:/") for p in {r.path for r in hits.select("path").distinct().collect()}}
        found = {p.replace("file:///", "file:/") for p, r in facts.items() if r.may_match}
        assert held <= found and len(found) <= most, (ids, years)


def test_absent_and_broken_files(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("no parquet")
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/ok")
    part = next((tmp_path / "ok").glob("*.parquet"))
    facts = {r.path.rpartition("/")[2]: r for r in file_facts(spark, [f"{tmp_path}/gone.parquet", f"file:{tmp_path}/x.parquet", str(part)]).collect()}
    assert (facts["gone.parquet"].present, facts["gone.parquet"].error) == (False, "missing file")
    assert facts["x.parquet"].present and facts["x.parquet"].error and not facts["x.parquet"].may_match
    assert (facts[part.name].rows, facts[part.name].may_match, facts[part.name].row_groups) == (3, True, 1)
    assert file_facts(spark, spark.createDataFrame([], "path string")).count() == 0
