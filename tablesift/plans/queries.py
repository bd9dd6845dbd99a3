"""One query per operator, on the views of ``data``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from string import ascii_lowercase, ascii_uppercase

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import company_suffixes, letters_only, normalize_name, safe_file_name, split_list
from ..operators.extract import ExtractSpec, default_destination, extract, lookup_national_ids, preflight, sample
from ..operators.filters import Clause, DateRange, LayeredFilter, classify_ids, id_clause
from ..operators.jobs import run_batch
from ..operators.lineage import resolve_lineage
from ..operators.name_pairs import qualifying_pairs
from ..operators.names import (
    best_matches,
    block_columns,
    match_names,
    match_names_plain,
    prepare_names,
    search_company_names,
)
from ..operators.profile import merged_profile, profile, profile_table, profile_tables, report_views, save_profile_state, write_report
from ..operators.stats import year_distribution
from ..sources import catalog as cat
from ..sources import metadata as meta
from ..sources.footers import file_facts
from ..sources.readers import column_names, read_id_list, read_metadata, read_plain_ids, read_table, with_source_file
from ..sources.writers import fill_null_columns, write_stamped, write_table
from ..streaming.ingest import ingest_new
from . import data as d

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FINANCIAL_COLUMNS = ["o_orderkey", "entity_id", "closing_date", "total_assets"]
SHORT_IDS = [f"{code}{n:08d}" for code in d.CODES for n in range(50)]
LONG_IDS = [f"{code}{n:08d}" for code in d.CODES for n in range(100, 400)]
SEARCH_WORDS = ["red", "bolt", "Brand#1", "ECONOMY", "size 1"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without zone and rounded doubles, as the check compares them."""
    casts = {c: F.col(f"`{c}`").cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"}
    casts |= {c: F.round(f"`{c}`", 6) for c, t in df.dtypes if t == "double"}
    return df.withColumns(casts) if casts else df


def by_ids(values, columns, mode="exact") -> LayeredFilter:
    return LayeredFilter(Clause(values, columns, mode))


# extract


@query
def flagship(spark, sf):
    """Layered filter, year range and projection over the whole financial table."""
    layers = LayeredFilter(Clause(["DK", "SE"], "entity_id", "prefix"), alternatives=Clause(SHORT_IDS, "entity_id"))
    return extract(d.financials(spark, sf), ExtractSpec(FINANCIAL_COLUMNS, layers, DateRange(1996, 1998)))


@query
def extract_exact(spark, sf):
    return extract(d.financials(spark, sf), ExtractSpec(FINANCIAL_COLUMNS, by_ids(SHORT_IDS, "entity_id")))


@query
def extract_prefix(spark, sf):
    spec = ExtractSpec(FINANCIAL_COLUMNS, by_ids(["DK", "SE0", "NO00"], "entity_id", "prefix"))
    return extract(d.financials(spark, sf), spec)


@query
def extract_multi_column(spark, sf):
    return extract(d.trades(spark, sf), ExtractSpec(ids=by_ids(SHORT_IDS, ["buyer_id", "seller_id"])))


@query
def extract_layered(spark, sf):
    layers = LayeredFilter(
        Clause(["DK", "US"], ["buyer_id", "seller_id"], "prefix"),
        [Clause(["SE", "US"], ["seller_id"], "prefix"), Clause(SHORT_IDS + LONG_IDS, ["buyer_id"])],
        Clause(["GB00000001", "FR00000007"], ["buyer_id", "seller_id"]),
    )
    return extract(d.trades(spark, sf), ExtractSpec(ids=layers))


@query
def extract_long_list(spark, sf):
    return extract(d.financials(spark, sf), ExtractSpec(FINANCIAL_COLUMNS, by_ids(LONG_IDS, "entity_id")))


@query
def extract_semi_join(spark, sf):
    rich = d.entities(spark, sf).where("c_acctbal > 5000").select("entity_id")
    return extract(d.financials(spark, sf), ExtractSpec(FINANCIAL_COLUMNS, by_ids(rich, "entity_id")))


@query
def year_range_native(spark, sf):
    return extract(d.financials(spark, sf), ExtractSpec(FINANCIAL_COLUMNS, years=DateRange(1996, 1998)))


@query
def year_range_remove(spark, sf):
    return naive(extract(d.text_dates(spark, sf), ExtractSpec(FINANCIAL_COLUMNS, years=DateRange(1996, 1998))))


@query
def year_range_keep(spark, sf):
    years = DateRange(1996, 1998, nulls="keep")
    return naive(extract(d.text_dates(spark, sf), ExtractSpec(FINANCIAL_COLUMNS, years=years)))


@query
def string_predicate(spark, sf):
    return extract(d.financials(spark, sf), ExtractSpec(FINANCIAL_COLUMNS, predicate="total_assets > 400000"))


@query
def column_predicate(spark, sf):
    test = (F.col("o_orderstatus") == "F") & F.col("total_assets").between(1000, 200000)
    return extract(d.financials(spark, sf), ExtractSpec(FINANCIAL_COLUMNS, predicate=test))


@query
def table_function(spark, sf):
    def largest(df: DataFrame, by: str) -> DataFrame:
        return df.groupBy(by).agg(F.max("total_assets").alias("largest"), F.count("*").alias("n"))

    return extract(d.financials(spark, sf), ExtractSpec(function=largest, function_args=("entity_id",)))


@query
def partition_function(spark, sf):
    def in_thousands(batch: pd.DataFrame, floor: float) -> pd.DataFrame:
        batch = batch[batch["total_assets"] > floor]
        return batch.assign(thousands=batch["total_assets"] / 1000)[["o_orderkey", "thousands"]]

    rows = d.financials(spark, sf).select("o_orderkey", "total_assets")
    spec = ExtractSpec(function=in_thousands, function_args=(250000.0,), scope="partition",
                       function_schema="o_orderkey long, thousands double")
    return extract(rows, spec)


@query
def part_function(spark, sf):
    """The largest order of each status, part file by part file, then over all parts."""
    def largest(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.groupby("o_orderstatus", as_index=False).agg(largest=("o_totalprice", "max"), n=("o_orderkey", "count"))

    spec = ExtractSpec(predicate="o_orderdate IS NOT NULL", function=largest, scope="part", function_schema="o_orderstatus string, largest double, n long",
                       combine_by=["o_orderstatus"], combine=[F.max("largest").alias("largest"), F.sum("n").alias("n")])
    parts = extract(d.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"), spec)
    return parts.groupBy("o_orderstatus").agg(F.max("largest").alias("largest"), F.sum("n").alias("n"))


@query
def extract_null_ids(spark, sf):
    """A long list over two columns, one of which is mostly null."""
    rows = d.trades(spark, sf).withColumn("agent_id", F.when(F.col("l_linenumber") == 7, F.col("seller_id")))
    return extract(rows, ExtractSpec(ids=by_ids(LONG_IDS, ["agent_id", "buyer_id"])))


@query
def extract_two_lists(spark, sf):
    """Two long lists that must both hold, each on its column."""
    layers = LayeredFilter(Clause(LONG_IDS, "buyer_id"), Clause(d.entities(spark, sf).where("c_acctbal > 0").select("entity_id"), "buyer_id"))
    return extract(d.trades(spark, sf), ExtractSpec(ids=layers))


@query
def extract_long_multi(spark, sf):
    """Lists of any length over several columns, in AND and OR layers, with short ones."""
    trades = d.trades(spark, sf)
    in_debt = d.table(spark, sf, "supplier").where("s_acctbal < -500").select(d.entity_id("s_nationkey", "s_suppkey"))
    layers = LayeredFilter(
        base=Clause(d.entities(spark, sf).where("c_acctbal > 5000").select("entity_id"), ["buyer_id", "seller_id"]),
        required=Clause(["DK", "SE", "US"], "seller_id", "prefix"),
        alternatives=[Clause(in_debt, ["seller_id", "buyer_id"]), Clause(SHORT_IDS, "buyer_id")],
    )
    return extract(trades, ExtractSpec(ids=layers))


@query
def sample_limit(spark, sf):
    return sample(d.financials(spark, sf).orderBy("o_orderkey"), ExtractSpec(FINANCIAL_COLUMNS), 1000)


@query
def national_id_lookup(spark, sf):
    return lookup_national_ids(d.entities(spark, sf), [1, 7, "42", 99, 100, 1001], "entity_id", "c_custkey")


@query
def id_list_classify(spark, sf):
    codes = d.country_codes(spark, sf)
    ids = d.entities(spark, sf).select("entity_id").union(codes.select("Code"))
    ids = ids.union(d.table(spark, sf, "part").select("p_brand"))
    return classify_ids(ids, codes)


@query
def id_list_file(spark, sf):
    """ID lists read from files with and without a header."""
    root, ids = d.scratch(spark), d.entities(spark, sf).select("entity_id")
    ids.write.option("header", True).csv(f"{root}/headed.csv")
    ids.write.text(f"{root}/plain.txt")
    headed = read_id_list(spark, f"{root}/headed.csv", d.country_codes(spark, sf))
    plain = read_plain_ids(spark, f"{root}/plain.txt")
    return headed.withColumn("form", F.lit("headed")).unionByName(plain.withColumn("form", F.lit("plain")))


@query
def id_list_kept(spark, sf):
    """An ID list with values that are no IDs, all kept."""
    listed = d.entities(spark, sf).where("c_acctbal < 0").select("entity_id").union(d.table(spark, sf, "part").select("p_brand"))
    clause = id_clause(listed, d.country_codes(spark, sf), "entity_id", on_invalid="keep")
    return extract(d.financials(spark, sf), ExtractSpec(FINANCIAL_COLUMNS, LayeredFilter(clause)))


@query
def preflight_report(spark, sf):
    """The report, with the number of rows the extract then gives."""
    df = d.financials(spark, sf)
    spec = ExtractSpec(["total_assets"], by_ids(["DK"], "entity_id", "prefix"), DateRange(1996, 1998))
    rows = extract(df, spec).agg(F.count("*"))
    return preflight(df, spec).select(
        "ok", F.array_join("required_columns", ",").alias("required_columns"), "resolved_date_column",
        F.array_join("resolved_id_columns", ",").alias("resolved_id_columns"), "would_write",
        rows.scalar().alias("rows_out"))


@query
def year_distribution_orders(spark, sf):
    return naive(year_distribution(d.financials(spark, sf)))


@query
def year_distribution_text(spark, sf):
    return naive(year_distribution(d.text_dates(spark, sf), date_format="yyyy-MM-dd HH:mm:ss"))


# sources and sinks


@query
def mixed_format_union(spark, sf):
    orders, root = d.table(spark, sf, "orders"), d.scratch(spark)
    for fmt, part in (("csv", "F"), ("orc", "O"), ("parquet", "P")):
        rows = orders.where(F.col("o_orderstatus") == part)
        rows.write.format(fmt).option("header", True).save(f"{root}/orders.{fmt}")
    return read_table(spark, [f"{root}/orders.{fmt}" for fmt in ("parquet", "orc", "csv")])


@query
def write_split_roundtrip(spark, sf):
    paths = write_table(d.financials(spark, sf), f"{d.scratch(spark)}/out", ["csv", "parquet", "orc"], file_size_mb=1)
    back = spark.read.schema(d.financials(spark, sf).schema).option("header", True).csv(paths[0])
    return back.unionByName(read_table(spark, paths[1])).unionByName(read_table(spark, paths[2]))


@query
def write_per_source(spark, sf):
    orders = with_source_file(d.table(spark, sf, "orders")).select("o_orderkey", "source_file")
    lines = with_source_file(d.table(spark, sf, "lineitem")).select(F.col("l_orderkey").alias("o_orderkey"), "source_file")
    path, = write_table(orders.unionByName(lines), f"{d.scratch(spark)}/per", by_source=True)
    stem = F.regexp_replace("source_file", "-[0-9a-f]{16}$", "").alias("source_file")
    return spark.read.parquet(path).groupBy(stem).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query
def null_column_fill(spark, sf):
    rows = d.financials(spark, sf).select("o_orderkey", "total_assets", F.lit(None).cast("string").alias("note"))
    return fill_null_columns(rows)


@query
def ingest_new_files(spark, sf):
    orders, root = d.table(spark, sf, "orders"), d.scratch(spark)
    spec = ExtractSpec(["o_orderkey", "o_totalprice"], years=DateRange(1996, 1999, "o_orderdate"))
    for part in (orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F'")):
        part.write.mode("append").parquet(f"{root}/in")
        ingest_new(spark, f"{root}/in", orders.schema, f"{root}/out", f"{root}/ck", spec=spec)
    return spark.read.parquet(f"{root}/out")


@query
def batch_extract(spark, sf):
    jobs = spark.createDataFrame(
        [("Trade", "trades", "buyer_id, seller_id", True), ("Finance", "financials", "entity_id", True),
         ("Finance", "missing", "entity_id", True), ("Trade", "trades", "nope", True)],
        "`Data Product` string, Table string, Column string, Run boolean")
    tables = {"trades": d.trades(spark, sf), "financials": d.financials(spark, sf)}
    report = run_batch(jobs, SHORT_IDS, lambda _, name: tables.get(name), d.scratch(spark))
    out = None
    for row in report.orderBy("n").collect():
        n = spark.read.parquet(row.path).agg(F.count("*").alias("rows")) if row.path else report.limit(1).select(F.lit(0).cast("long").alias("rows"))
        one = n.select(F.lit(row.n).alias("n"), F.lit(row.table).alias("table"), F.lit(row.status).alias("status"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


# catalog and metadata


@query
def catalog_build(spark, sf):
    return naive(cat.build_catalog(d.export_entries(spark, sf)))


@query
def catalog_newest(spark, sf):
    return naive(cat.newest_exports(cat.build_catalog(d.export_entries(spark, sf))))


@query
def catalog_newest_control(spark, sf):
    """The exports that the newest control files name; for some products they name the export of the oldest stamp."""
    root = d.scratch(spark)
    catalog = cat.build_catalog(d.export_entries(spark, sf).withColumn(
        "root", F.concat(F.lit(f"{root}/product="), F.split("export", "_exported")[0])))
    exports = catalog.groupBy(F.col("`Data Product`").alias("product")).agg(
        F.min_by("Top-level Directory", "Timestamp").alias("oldest"), F.max_by("Top-level Directory", "Timestamp").alias("newest"))
    named = F.to_json(F.struct(F.col("newest").alias("DataFolder"))).alias("value")
    exports.select("product", F.lit("tnfs").alias("kind"), named).write.partitionBy("product", "kind").text(root)
    named = F.to_json(F.struct(F.col("oldest").alias("DataFolder"))).alias("value")
    exports.where("product < 'C'").select("product", F.lit("tnfs").alias("kind"), named).write.mode("append").partitionBy("product", "kind").text(root)
    found = cat.newest_by_control(catalog, cat.control_files(spark, root, "kind=tnfs", "part-*"))
    return found.select("Data Product", "Table", "Top-level Directory")


@query
def catalog_stale(spark, sf):
    return cat.stale_exports(cat.build_catalog(d.export_entries(spark, sf)))


@query
def catalog_search(spark, sf):
    return naive(cat.search_tables(cat.build_catalog(d.export_entries(spark, sf)), "buil"))


@query
def catalog_resolve(spark, sf):
    return cat.resolve_name(cat.build_catalog(d.export_entries(spark, sf)), "Data Product", "MA")


@query
def product_match(spark, sf):
    lines = d.table(spark, sf, "lineitem").select("l_suppkey", "l_partkey")
    parts = d.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    sold = lines.join(parts, lines["l_partkey"] == parts["p_partkey"])
    exports = sold.select(F.concat(F.lit("supplier "), "l_suppkey").alias("export"), F.concat("p_name", F.lit(".csv")).alias("Table"))
    products = parts.select(F.col("p_brand").alias("Data Product"), F.col("p_name").alias("Table"))
    return cat.match_products(exports, products).select("export", "label")


@query
def label_override(spark, sf):
    catalog = cat.build_catalog(d.export_entries(spark, sf))
    people = d.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    orders = d.table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'")
    labels = orders.join(people, orders["o_custkey"] == people["c_custkey"]).select(
        F.concat("c_mktsegment", F.lit("_exported "), F.date_format("o_orderdate", "yyyy-MM-dd_HH-mm-ss")).alias("Top-level Directory"),
        F.concat(F.lit("Urgent "), "c_mktsegment").alias("Data Product"))
    return naive(cat.override_labels(catalog, labels))


@query
def missing_files(spark, sf):
    pages = d.table(spark, sf, "pages").select(F.col("url").alias("path"))
    seen = pages.where(F.contains("path", F.lit("//www.")))
    return cat.new_files(pages.distinct(), seen.distinct())


@query
def dictionary_search(spark, sf):
    return meta.search_dictionary(d.dictionary(spark, sf), "RED")


@query
def dictionary_narrowed(spark, sf):
    return meta.search_dictionary(d.dictionary(spark, sf), "size 1", product="Brand#7", table="econ")


@query
def dictionary_letters_only(spark, sf):
    return meta.search_dictionary(d.dictionary(spark, sf), "Red-Bolt", letters=True)


@query
def dictionary_exact(spark, sf):
    return meta.search_dictionary(d.dictionary(spark, sf), "red bolt", exact=True, columns=["Column"])


@query
def dictionary_multi_word(spark, sf):
    return meta.search_dictionary_words(d.dictionary(spark, sf), SEARCH_WORDS)


@query
def dictionary_many_words(spark, sf):
    """Every part name as a search word."""
    words = d.table(spark, sf, "part").select("p_name")
    return meta.search_dictionary_words(d.dictionary(spark, sf), words)


@query
def dictionary_many_exact(spark, sf):
    words = d.table(spark, sf, "part").select("p_type").union(d.table(spark, sf, "part").select("p_brand"))
    return meta.search_dictionary_words(d.dictionary(spark, sf), words, exact=True)


@query
def dictionary_available(spark, sf):
    """Only products that a catalog holds."""
    held = d.table(spark, sf, "part").where("p_size > 48").select(F.col("p_brand").alias("Data Product"))
    return meta.search_dictionary(d.dictionary(spark, sf), "RED", available=held)


@query
def metadata_read(spark, sf):
    path = f"{d.scratch(spark)}/dictionary.parquet"
    d.dictionary(spark, sf).write.parquet(path)
    return read_metadata(spark, path, ["Data Product", "Column"])


@query
def text_helpers(spark, sf):
    """Comma lists split and trimmed, and file names made safe."""
    parts = d.table(spark, sf, "part")
    return parts.select(
        "p_partkey", F.array_join(split_list(F.concat_ws(" , ", "p_name", "p_brand", "p_type")), "|").alias("listed"),
        safe_file_name(F.concat_ws("/", "p_name", "p_brand")).alias("file"))


@query
def table_dates(spark, sf):
    dates = d.dictionary(spark, sf).select("Data Product", "Table", "Column").distinct()
    return meta.date_columns(dates, product="Brand#3", table="small")


@query
def country_search(spark, sf):
    return meta.search_country_codes(d.country_codes(spark, sf), "d", ["Code"])


@query
def heading_map(spark, sf):
    return meta.map_headings(d.headings(spark, sf), d.dictionary(spark, sf))


@query
def heading_unmatched(spark, sf):
    return meta.unmatched_headings(d.headings(spark, sf), d.dictionary(spark, sf))


# lineage


@query
def lineage_ids(spark, sf):
    return resolve_lineage(d.id_changes(spark, sf), d.lineage_seeds(spark, sf)).ids


@query
def lineage_newest(spark, sf):
    return resolve_lineage(d.id_changes(spark, sf), d.lineage_seeds(spark, sf)).newest


@query
def lineage_rows(spark, sf):
    return resolve_lineage(d.id_changes(spark, sf), d.lineage_seeds(spark, sf)).rows


# profiles


@query
def profile_orders(spark, sf):
    return naive(profile(d.table(spark, sf, "orders"), d.CODES, "Sales", "orders"))


@query
def profile_customer(spark, sf):
    return naive(profile(d.entities(spark, sf), d.CODES, "Sales", "customer"))


@query
def profile_date_formats(spark, sf):
    day, order = F.col("closing_date"), d.financials(spark, sf)
    forms = {
        "iso": "yyyy-MM-dd", "compact": "yyyyMMdd", "month": "yyyy-MM", "year": "yyyy", "day_first": "dd/MM/yyyy",
        "month_first": "MM/dd/yyyy", "day_dash": "dd-MM-yyyy", "full": "yyyy-MM-dd HH:mm:ss",
        "full_t": "yyyy-MM-dd'T'HH:mm:ss", "full_z": "yyyy-MM-dd'T'HH:mm:ss'Z'"}
    return naive(profile(order.select(*[F.date_format(day, f).alias(n) for n, f in forms.items()]), d.CODES))


@query
def profile_entity_ids(spark, sf):
    return naive(report_views(profile(d.trades(spark, sf), d.CODES))["entity_id_columns"])


@query
def profile_views(spark, sf):
    prof = profile(d.text_dates(spark, sf), d.CODES, "Finance", "financials")
    return naive(report_views(prof)["operation_hints"])


@query
def profile_summary(spark, sf):
    prof = profile(d.text_dates(spark, sf), d.CODES, "Finance", "financials")
    return report_views(prof)["summary"]


@query
def profile_files(spark, sf):
    """Profiles of tables given by their files."""
    return naive(profile_tables(spark, {("Sales", "orders"): [f"{sf}/orders.parquet"]}, d.CODES))


@query
def profile_merged(spark, sf):
    """The profile of orders from the saved states of its parts, here by status."""
    orders, root = d.table(spark, sf, "orders"), d.scratch(spark)
    paths = []
    for status in ("F", "O", "P"):
        paths.append(f"{root}/{status}")
        save_profile_state(orders.where(F.col("o_orderstatus") == status), paths[-1], d.CODES)
    return naive(merged_profile(spark, paths, "Sales", "orders"))


@query
def preflight_files(spark, sf):
    """Per file of a delivery by year its rows and whether an extract can take any of them, from the footers."""
    path = d.scratch(spark)
    rows = d.financials(spark, sf).withColumn("year", F.year("closing_date"))
    rows.repartition("year").sortWithinPartitions("entity_id").write.option("maxRecordsPerFile", 0).partitionBy("year").parquet(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path")
    facts = file_facts(spark, files, LayeredFilter(Clause(["DK", "SE"], "entity_id", "prefix")), DateRange(1996, 1997, "closing_date"))
    return facts.select(F.regexp_extract("path", r"year=(\d+)", 1).cast("int").alias("year"), "rows", "may_match")


@query
def profile_report(spark, sf):
    """The summary view of a written report."""
    path = f"{d.scratch(spark)}/report"
    write_report(profile(d.text_dates(spark, sf), d.CODES, "Finance", "financials"), path)
    return spark.read.parquet(f"{path}/summary")


# names


@query
def name_normalize(spark, sf):
    docs = d.table(spark, sf, "documents")
    return docs.select("doc_id", normalize_name(F.col("text"), company_suffixes()).alias("name"), letters_only(F.col("text")).alias("letters"))


@query
def name_blocks(spark, sf):
    names = prepare_names(d.page_titles(spark, sf), "name", "page_id", company_suffixes())
    blocks = block_columns(F.col("name"))
    return names.select(
        "name", F.col("result").alias("page_id"), blocks["prefix3"].alias("prefix3"), blocks["prefix1"].alias("prefix1"),
        blocks["name_len"].alias("name_len"), F.array_join(blocks["tokens"], " ").alias("tokens"))


def _match(spark, sf, searches, scorer, cut_off):
    return naive(match_names(searches, d.page_titles(spark, sf), "name", "page_id", cut_off, company_suffixes(), scorer))


@query
def name_exact(spark, sf):
    # only A-Z, as engines differ in the upper case of sharp s
    upper = d.page_titles(spark, sf).select(F.translate("name", ascii_lowercase, ascii_uppercase).alias("search"))
    return _match(spark, sf, upper, "ratio", 100)


@query
def name_match_ratio(spark, sf):
    return _match(spark, sf, d.misspelled(spark, sf), "ratio", 90)


@query
def name_match_staged(spark, sf):
    """The same through the stages, whatever the number of names."""
    return naive(match_names(d.misspelled(spark, sf), d.page_titles(spark, sf), "name", "page_id", 90, company_suffixes(), "ratio", direct_pairs=0))


@query
def name_match_ratio_low(spark, sf):
    return _match(spark, sf, d.misspelled(spark, sf), "ratio", 60)


@query
def name_token_sort(spark, sf):
    return _match(spark, sf, d.reordered(spark, sf), "token_sort_ratio", 85)


@query
def name_token_set(spark, sf):
    return _match(spark, sf, d.reordered(spark, sf), "token_set_ratio", 85)


@query
def name_match_wratio(spark, sf):
    return naive(search_company_names(d.misspelled(spark, sf), d.page_titles(spark, sf), "name", "page_id"))


@query
def name_plain(spark, sf):
    return naive(match_names_plain(d.misspelled(spark, sf), d.page_titles(spark, sf), "name", "page_id", 80,
                                   suffixes=["ltd", "inc"], scorer="ratio"))


@query
def name_plain_ties(spark, sf):
    return naive(match_names_plain(d.misspelled(spark, sf), d.page_titles(spark, sf), "name", "page_id", 80,
                                   remove=[" ltd", " inc"], scorer="ratio", ties="all"))


@query
def name_best_ties(spark, sf):
    """Best rows per search string of a score table: parts by price within a brand."""
    parts = d.table(spark, sf, "part").select(
        F.col("p_brand").alias("Search_string"), F.col("p_name").alias("BestMatch"),
        F.col("p_size").cast("double").alias("Score"))
    return best_matches(parts)


@query
def saved_matches(spark, sf):
    """A match result saved under a time stamp, and read again."""
    best = name_best_ties(spark, sf)
    path = write_stamped(best, d.scratch(spark), "matches")
    return spark.read.schema(best.schema).option("header", True).csv(path)


@query
def name_match_phrases(spark, sf):
    """All phrases of the benchmark texts against all phrases of the documents."""
    names = d.phrases(spark, sf, "documents")
    searches = d.phrases(spark, sf, "benchmark").select("phrase")
    return naive(match_names(searches, names, "phrase", "id", 85, scorer="ratio"))


@query
def name_callable(spark, sf):
    """A scorer of one's own: names of equal length are best, of those that are alike."""
    return naive(match_names(d.misspelled(spark, sf), d.page_titles(spark, sf), "name", "page_id", 90, company_suffixes(),
                             lambda a, b: 100.0 - abs(len(a) - len(b)), guard=("ratio", 80)))


def _short_titles(spark, sf, n: int, column: str) -> DataFrame:
    words = F.slice(F.split(F.lower("name"), " "), 1, n)
    return d.page_titles(spark, sf).select(F.array_join(words, " ").alias(column)).where(f"{column} <> ''").distinct()


def _pairs(spark, sf, scorer: str, cut_off: float) -> DataFrame:
    """All pairs of the titles' first two words and first three words at the cut-off."""
    return naive(qualifying_pairs(_short_titles(spark, sf, 2, "search"), _short_titles(spark, sf, 3, "name"), scorer, cut_off))


@query
def pairs_partial_ratio(spark, sf):
    return _pairs(spark, sf, "partial_ratio", 80)


@query
def pairs_token_ratio(spark, sf):
    return _pairs(spark, sf, "token_ratio", 70)


@query
def pairs_quick_ratio(spark, sf):
    return _pairs(spark, sf, "QRatio", 75)


# small operators


@query
def table_files(spark, sf):
    """The part files of one table in folders that several tables may share."""
    files = d.export_entries(spark, sf).select(F.concat_ws("/", "root", "export", "entry").alias("path"))
    return cat.select_table_files(files, "usd_interim_F")


@query
def table_schema(spark, sf):
    rows = [(t, c) for t in ("orders", "customer", "documents") for c in column_names(spark, f"{sf}/{t}.parquet")]
    return spark.createDataFrame(rows, "table string, column string")


@query
def profile_first_file(spark, sf):
    """The profile of the first of several parts."""
    root = d.scratch(spark)
    for status in ("F", "O"):
        d.table(spark, sf, "orders").where(F.col("o_orderstatus") == status).write.parquet(f"{root}/{status}.parquet")
    return naive(profile_table(spark, [f"{root}/F.parquet", f"{root}/O.parquet"], d.CODES, "Sales", "orders", sample_strategy="first_file"))


@query
def default_output(spark, sf):
    """An extract that goes where it goes by default, read again."""
    path = default_destination("financials", d.scratch(spark), datetime(2024, 2, 3, 4, 5))
    written = write_table(d.financials(spark, sf), path)
    name = written[0].rpartition("/")[2].partition(".")[0]
    return naive(read_table(spark, written).withColumn("name", F.lit(name)))


@query
def id_column(spark, sf):
    """The dictionary rows of the ID column that a search word resolves to."""
    dictionary = d.dictionary(spark, sf)
    word = dictionary.agg(F.max("Column")).first()[0]
    return dictionary.where(F.col("Column") == meta.resolve_id_column(dictionary, word))


@query
def period_validation(spark, sf):
    """Which pairs of the years of orders are a period."""
    years = [r[0] for r in d.table(spark, sf, "orders").select(F.year("o_orderdate")).distinct().collect()]  # one a year
    rows = []
    for first in [*years, 1899, None]:
        for last in [*years, 2999, None]:
            try:
                DateRange(first, last, this_year=2024)
                rows.append((first, last, True))
            except ValueError:
                rows.append((first, last, False))
    return spark.createDataFrame(rows, "first int, last int, valid boolean")
