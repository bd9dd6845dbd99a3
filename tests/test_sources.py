import os
import random

import pytest
from pyspark.sql import functions as F

from tablesift import read_table, run_batch, write_table
from tablesift.operators.extract import ExtractSpec
from tablesift.operators.jobs import incomplete_jobs
from tablesift.sources import catalog, metadata, readers, writers
from tablesift.streaming.ingest import ingest_new


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_readers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "value int, name string")
    for fmt in ("csv", "parquet", "orc", "json"):
        df.write.format(fmt).option("header", True).save(f"{tmp_path}/t.{fmt}")
    paths = [f"{tmp_path}/t.{f}" for f in ("csv", "parquet", "orc")]
    mixed = read_table(spark, paths)
    assert dict(mixed.dtypes)["value"] == "int" and mixed.count() == 6
    assert rows(read_table(spark, f"{tmp_path}/t.csv", ["value"]), "value") == [("1",), ("2",)]
    assert readers.column_names(spark, f"{tmp_path}/t.parquet") == ["value", "name"]
    assert readers.column_names(spark, f"{tmp_path}/t.csv") == ["value", "name"]
    with pytest.raises(ValueError, match="xyz"):
        read_table(spark, "t.xyz")
    with pytest.raises(ValueError, match="nope"):
        read_table(spark, paths, ["nope"])
    stems = readers.with_source_file(read_table(spark, f"{tmp_path}/t.parquet"))
    assert all(r.source_file.startswith("part-") for r in stems.collect())


def test_avro_needs_its_package(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)avro"):
        read_table(spark, str(tmp_path / "t.avro"))


def test_id_list_files(spark, tmp_path):
    codes = spark.createDataFrame([("DK",)], "Code string")
    (tmp_path / "a.csv").write_text("AB123,x\nCD45,y\n,z\nCD45,w\n")
    (tmp_path / "b.txt").write_text("entity number\tx\nDK\ty\n \tz\n")
    assert rows(readers.read_id_list(spark, str(tmp_path / "a.csv"), codes), "value") == [("AB123",), ("CD45",)]
    assert rows(readers.read_id_list(spark, str(tmp_path / "b.txt"), codes), "value") == [("DK",)]
    (tmp_path / "c.txt").write_text("A1\n\n B2 \n")
    assert rows(readers.read_plain_ids(spark, str(tmp_path / "c.txt")), "value") == [("A1",), ("B2",)]
    with pytest.raises(ValueError):
        readers.read_id_list(spark, "x.xlsx", codes)


def test_writers(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("int").alias("value"), F.lit(None).cast("string").alias("gone"))
    out = f"{tmp_path}/out"
    assert write_table(df, out, ["csv", ".parquet"]) == [f"{out}.csv", f"{out}.parquet"]
    assert read_table(spark, [f"{out}.parquet"]).count() == read_table(spark, [f"{out}.csv"]).count() == 100
    assert write_table(df.where("false"), f"{tmp_path}/none") == [] and not os.path.exists(f"{tmp_path}/none.parquet")
    with pytest.raises(ValueError):
        write_table(df, out, "xlsx")
    assert writers.split_plan(df, 100) == (1, 100)
    n, per = writers.split_plan(df, 10_000_000, "csv", 10)
    assert n == int(10_000_000 * 54 / (10 * 2**20 * 3)) and n * per >= 10_000_000
    filled = writers.fill_null_columns(df)
    assert rows(filled.select("gone").distinct(), "gone") == [("N/A",)]
    assert writers.write_stamped(df.where("false"), str(tmp_path), "x") is None
    assert writers.write_stamped(df, str(tmp_path), "x").endswith("_x.csv")
    tagged = readers.with_source_file(read_table(spark, f"{out}.parquet"))
    write_table(tagged, f"{tmp_path}/per", by_source=True)
    assert spark.read.parquet(f"{tmp_path}/per.parquet").count() == 100


def test_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "rows_per_file", lambda *a: 10)
    write_table(spark.range(95).coalesce(1), f"{tmp_path}/b")
    assert len([f for f in os.listdir(f"{tmp_path}/b.parquet") if f.endswith(".parquet")]) == 10


def test_catalog(spark):
    entries = spark.createDataFrame(
        [("/r", "Prod One_exported 2024-02-03_04-05-06", "company_data.csv"),
         ("/r", "Prod One_exported 2024-02-03_04-05-06", "ownership_data"),
         ("/r", "Prod One_exported 2023-01-01_00-00-00", "usd_interim_x"),
         ("/r", "Odd_exported soon", "eur_interim")], "root string, export string, entry string")
    cat = catalog.build_catalog(entries)
    assert cat.columns == catalog.CATALOG_COLUMNS
    assert rows(cat.where("Timestamp IS NULL"), "Table") == [("interim_eur",)]
    assert rows(catalog.newest_exports(cat), "Table") == [("company_data",), ("interim_eur",), ("ownership_data",)]
    assert rows(catalog.stale_exports(cat), "Export") == [("/r/Prod One_exported 2023-01-01_00-00-00",)]
    assert rows(cat.where("Table = 'company_data'"), "`Base Directory`")[0][0].endswith("04-05-06")
    assert catalog.search_tables(cat, "OWNER").count() == 1
    assert rows(catalog.resolve_name(cat, "Table", "company_data"), "status") == [("exact",)]
    assert rows(catalog.resolve_name(cat, "Table", "owner"), "status") == [("partial",)]
    assert rows(catalog.resolve_name(cat, "Table", "data"), "status") == [("ambiguous",)] * 2
    assert rows(catalog.resolve_name(cat, "Table", "zzz"), "status") == [("none",)]


def test_products_labels_files(spark, tmp_path):
    exports = spark.createDataFrame([("e1", "table_1.csv"), ("e1", "table_2"), ("e2", "table_2")], "export string, Table string")
    products = spark.createDataFrame([("A", "table_1"), ("A", "table_2"), ("B", "table_1"), ("B", "table_2")],
                                     "`Data Product` string, Table string")
    assert rows(catalog.match_products(exports, products), "export", "label") == [
        ("e1", "Multiple_Options: A, B"), ("e2", "Unknown")]
    cat = spark.createDataFrame([("X", "d1"), ("Y", "d2")], "`Data Product` string, `Top-level Directory` string")
    given = spark.createDataFrame([("New", "d1")], "`Data Product` string, `Top-level Directory` string")
    assert rows(catalog.override_labels(cat, given), "`Data Product`") == [("New",), ("Y",)]
    os.makedirs(tmp_path / "P_exported 2024-01-01_00-00-00" / "t1")
    (tmp_path / "P_exported 2024-01-01_00-00-00" / "t1" / "p1.parquet").write_text("x")
    (tmp_path / "P_exported 2024-01-01_00-00-00" / "t2.csv").write_text("x")
    files = catalog.list_files(spark, str(tmp_path))
    root = f"file:{tmp_path}"
    cat = catalog.build_catalog(catalog.entries_from_files(files, root))
    assert rows(cat, "Table") == [("t1",), ("t2",)] and rows(cat, "`Data Product`") == [("P",)] * 2
    assert catalog.new_files(files, files.limit(1)).count() == 1
    kept = catalog.keep_last(spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "k string, v int"), ["k"], "v")
    assert rows(kept, "k", "v") == [("a", 2), ("b", None)]
    listed = spark.createDataFrame([("/d/a.csv",), ("/d/b.csv",), ("/e/p1.parquet",), ("/f/only.csv",)], "path string")
    assert rows(catalog.select_table_files(listed, "a"), "path") == [("/d/a.csv",), ("/e/p1.parquet",), ("/f/only.csv",)]


@pytest.fixture(scope="module")
def dictionary(spark):
    return spark.createDataFrame(
        [("Prod", "main_table", "Total Assets", "Total assets"), ("Prod", "main_table", "name", "Company name"),
         ("Other", "other_table", "value", "Other value")],
        "`Data Product` string, Table string, Column string, Definition string")


def test_dictionary(spark, dictionary):
    def found(**kw):
        return rows(metadata.search_dictionary(dictionary, **kw), "Column")

    assert found(word="total-assets", letters=True) == [("Total Assets",)]
    assert found(word="NAME") == [("name",)]
    assert found(word="prod", product="Prod") == []
    assert found(product="Prod", table="MAIN") == [("Total Assets",), ("name",)]
    assert found(word="value", exact=True) == [("value",)]
    assert found(word="it's") == []
    many = metadata.search_dictionary_words(dictionary, ["assets", "name", "assets"])
    assert rows(many, "Column", "search_word") == [("Total Assets", "assets"), ("name", "name")]
    only = spark.createDataFrame([("Other",)], "`Data Product` string")
    assert found(available=only) == [("value",)]
    assert metadata.resolve_id_column(dictionary, "name") == "name"
    with pytest.raises(ValueError):
        metadata.resolve_id_column(dictionary, "a")
    dates = spark.createDataFrame([("Prod", "main_table", "closing_date"), ("Prod", "history_table", "information_date")],
                                  "`Data Product` string, Table string, Column string")
    assert rows(metadata.date_columns(dates, table="history"), "Column") == [("information_date",)]
    codes = spark.createDataFrame([("Denmark", "DK"), ("Congo", "CG")], "Country string, Code string")
    assert rows(metadata.search_country_codes(codes, "dk", ["Code"]), "Code") == [("DK",)]


def test_headings(spark, dictionary):
    heads = spark.createDataFrame([("Total Assets\nEUR",), ("Missing Header",), ("Unnamed: 0",)], "heading string")
    found = metadata.order_by_coverage(metadata.map_headings(heads, dictionary))
    assert rows(found, "heading", "unique_headings") == [("Total Assets", 1)]
    assert rows(metadata.unmatched_headings(heads, dictionary), "heading") == [("Missing Header",)]


def test_ingest_is_incremental(spark, tmp_path):
    src, out, ck = (f"{tmp_path}/{n}" for n in ("src", "out", "ck"))
    spark.range(3).write.parquet(src)
    spec = ExtractSpec(predicate="id > 0")
    for expected in (2, 2):
        ingest_new(spark, src, "id long", out, ck, spec=spec)
        assert spark.read.parquet(out).count() == expected
    spark.range(10, 12).write.mode("append").parquet(src)
    ingest_new(spark, src, "id long", out, ck, spec=spec)
    assert rows(spark.read.parquet(out), "id") == [(1,), (2,), (10,), (11,)]
    with pytest.raises(ValueError):
        ingest_new(spark, src, "id long", out, ck, spec=ExtractSpec(row_limit=1))


def test_batch(spark, tmp_path):
    table = spark.createDataFrame([("DK1", "X", 1), ("X", "SE2", 2), ("Y", "Y", 3)], "own string, owner string, value int")
    jobs = spark.createDataFrame(
        [("P", "t", "own, owner", True), ("P", "u", "own", True), ("P", "v", "nope", True), ("P", "w", "own", False)],
        "`Data Product` string, Table string, Column string, Run boolean")

    def load(product, name):
        return None if name == "u" else table

    first = run_batch(jobs, ["DK1", "SE2"], load, str(tmp_path))
    assert rows(first, "n", "status") == [(1, "written"), (2, "table not found"), (3, "columns not found")]
    assert rows(spark.read.parquet(f"{tmp_path}/1_P_t.parquet"), "value") == [(1,), (2,)]
    assert incomplete_jobs(first).count() == 2
    assert run_batch(jobs, ["DK1"], load, str(tmp_path)).first().status == "exists"


def test_csv_values_stay_as_delivered(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,n\n00123,7\n")
    path = f"{tmp_path}/a.csv"
    assert rows(read_table(spark, path), "id", "n") == [("00123", "7")]
    assert rows(read_table(spark, path, schema="id string, n int"), "id", "n") == [("00123", 7)]
    assert dict(read_table(spark, path, infer=True).dtypes)["n"] == "int"


def test_stream_checks_csv_headers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("b,a\n1,x\n")
    with pytest.raises(Exception, match="(?i)header|CSV"):
        ingest_new(spark, f"{tmp_path}/in", "a string, b int", f"{tmp_path}/out", f"{tmp_path}/ck", "csv")


def test_formats_share_one_run_and_few_files(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b

    df = spark.range(0, 1000, 1, 50).mapInPandas(counted, "id long")
    for path in write_table(df, f"{tmp_path}/t", ["csv", "parquet", "json"]):
        assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
        assert read_table(spark, path).count() == 1000
    assert read.value == 1000


def test_fill_null_on_write(spark, tmp_path):
    path, = write_table(spark.sql("SELECT 1 AS a, cast(NULL AS int) AS b"), f"{tmp_path}/f", fill_null="N/A")
    assert rows(spark.read.parquet(path), "a", "b") == [(1, "N/A")]


def test_names_without_letters_match_nothing(spark):
    headings = spark.createDataFrame([("123",), ("Total",)], "heading string")
    names = spark.createDataFrame([("p", "456"), ("p", "total")], "`Data Product` string, Column string")
    assert rows(metadata.map_headings(headings, names), "heading", "Column") == [("Total", "total")]
    assert rows(metadata.unmatched_headings(headings, names), "heading") == [("123",)]


def test_many_search_words(spark, monkeypatch):
    columns = "`Data Product` string, Table string, Column string, Definition string"
    lines = [("Trade", "Deals", "buyer id", "ID of the buyer"), ("Trade", "Deals", None, ""), (None, None, None, None),
             ("Fin-Ance", "Assets", "Total Assets", "aaaa"), ("Fin-Ance", "Assets", "Total Assets", "aaaa")]
    table = spark.createDataFrame(lines, columns)
    words = ["", "a", "ID", "aa", "aaa", "assets", "BUYER", "nope", "-", "Trade", "Total Assets", "Fin-Ance"]
    for exact in (False, True):
        for letters in (False, True):
            few = metadata.search_dictionary_words(table, words, exact=exact, letters=letters)
            with monkeypatch.context() as m:
                m.setattr(metadata, "INLINE_WORDS", 0)
                many = metadata.search_dictionary_words(table, words, exact=exact, letters=letters)
                framed = metadata.search_dictionary_words(table, spark.createDataFrame([(w,) for w in [*words, None]], "w string"), exact=exact, letters=letters)
                expected = sorted(map(repr, few.collect()))
                assert expected and sorted(map(repr, many.collect())) == expected == sorted(map(repr, framed.collect()))


def test_source_names_are_unique_text(spark, tmp_path):
    for folder in ("a", "b"):
        os.makedirs(f"{tmp_path}/{folder}.csv")
        with open(f"{tmp_path}/{folder}.csv/0001.csv", "w") as out:
            out.write("x\n1\n")
    tagged = readers.with_source_file(read_table(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"]))
    path, = write_table(tagged, f"{tmp_path}/per", by_source=True)
    names = [r.source_file for r in spark.read.parquet(path).collect()]
    assert len(set(names)) == 2 and all(n.startswith("0001-") for n in names)


def test_control_files_name_the_newest_export(spark, tmp_path):
    for product, files in {"p1": [("a.tnf", "old", 100), ("b.tnf", "new", 200)], "p2": [("c.tnf", "new", 300), ("d.tnf", "old", 400)],
                           "p3": [("e.tnf", None, 100)], "p4": [("f.tnf", "gone", 100)], "p5": []}.items():
        (tmp_path / product / "tnfs").mkdir(parents=True)
        for name, folder, modified in files:
            path = tmp_path / product / "tnfs" / name
            path.write_text('{"DataFolder": "%s"}' % folder if folder else "no json")
            os.utime(path, (modified, modified))
    (tmp_path / "p1" / "tnfs" / "z.txt").write_text("{}")
    entries = spark.createDataFrame([(f"file:{tmp_path}/{p}", e, "t") for p in ("p1", "p2", "p3", "p4", "p5") for e in ("old", "new")],
                                    "root string, export string, entry string")
    cat = catalog.build_catalog(entries)
    controls = catalog.control_files(spark, str(tmp_path))
    assert {r.folder for r in controls.collect()} == {"gone", "new", "old", None}
    found = catalog.newest_by_control(cat, controls)
    assert found.columns == cat.columns
    got = {(r["Export"].rpartition("/p")[2], r["Timestamp"].timestamp()) for r in found.collect()}
    assert got == {("1/new", 200.0), ("2/old", 400.0)}


def test_sets_that_contain_others(spark):
    rnd = random.Random(3)
    sets = {frozenset(rnd.sample("abcdefghij", rnd.randint(0, 7))) for _ in range(60)}
    parts = {frozenset(rnd.sample("abcdefghijk", rnd.randint(1, 4))) for _ in range(40)}
    have = spark.createDataFrame([(sorted(s),) for s in sets], "have array<string>")
    want = spark.createDataFrame([(sorted(s),) for s in parts], "want array<string>")
    got = {(frozenset(r.have), frozenset(r.want)) for r in catalog.containing_sets(have, want).collect()}
    assert got == {(s, p) for s in sets for p in parts if p <= s}


@pytest.mark.parametrize("letters", [False, True])
def test_many_words_are_found_as_one_by_one(spark, dictionary, monkeypatch, letters):
    words = ["", "Assets", "ASS", "total assets", "e", "o", "name", "e", None, "total-assets", "zzz", ".", "é"]
    rows_ = dictionary.union(dictionary.limit(1))
    few = metadata.search_dictionary_words(rows_, words, letters=letters)
    want = sorted(map(repr, (tuple(r) for r in few.collect())))
    monkeypatch.setattr(metadata, "INLINE_WORDS", 0)
    for limit in (10**9, 150):
        monkeypatch.setattr(metadata, "BROADCAST_BYTES", limit)
        many = metadata.search_dictionary_words(rows_, words, letters=letters)
        assert many.columns == few.columns
        assert sorted(map(repr, (tuple(r) for r in many.collect()))) == want


def test_rows_are_written_to_folders_without_a_sort(spark, tmp_path, monkeypatch):
    from tablesift.sources import writers

    seen = []
    plain = writers._write_settings

    def watched(session, megabytes):
        seen.append(session.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        return plain(session, megabytes)

    monkeypatch.setattr(writers, "_write_settings", watched)
    with plain(spark, 7):
        assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == writers.OPEN_FOLDERS > 0
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "7m"
    rows = spark.range(600).selectExpr("id", "concat('s', id % 9) AS source_file")  # more folders than are open at once
    path, = writers.write_table(rows, f"{tmp_path}/out", by_source=True)
    back = spark.read.parquet(path).groupBy("source_file").count().collect()
    assert {(r[0], r[1]) for r in back} == {(f"s{k}", 600 // 9 + (k < 600 % 9)) for k in range(9)}
    assert seen == ["0"] and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
