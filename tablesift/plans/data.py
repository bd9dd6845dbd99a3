"""The delivery the registered queries run on, derived from the TPC-H-like tables.

Every view covers its whole source table.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

CODES = ["DK", "SE", "NO", "DE", "US", "CN", "FR", "GB"]
SUFFIXES = ["inc", "ltd", "gmbh", "a/s", "s.a.", ""]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(spark)}/tablesift-{uuid4().hex}"


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def entity_id(nation: str, key: str) -> Column:
    return F.concat(pick(CODES, F.col(nation)), F.lpad(F.col(key).cast("string"), 8, "0"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumn("entity_id", entity_id("c_nationkey", "c_custkey"))


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: entity_id, closing_date, total_assets and the order's columns."""
    owners = entities(spark, sf_dir).select("c_custkey", "entity_id")
    orders = table(spark, sf_dir, "orders")
    return orders.join(owners, orders["o_custkey"] == owners["c_custkey"]).select(
        "o_orderkey", "entity_id", F.col("o_orderdate").alias("closing_date"),
        F.col("o_totalprice").alias("total_assets"), "o_orderstatus", "o_orderpriority",
    )


def text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Financials with text dates: urgent ones missing, low ones unreadable."""
    day = F.date_format("closing_date", "yyyy-MM-dd HH:mm:ss")
    day = F.when(F.col("o_orderpriority") == "1-URGENT", None).when(
        F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(day)
    return financials(spark, sf_dir).withColumn("closing_date", day)


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line with the buyer's and the seller's entity ID."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    sellers = table(spark, sf_dir, "supplier").select("s_suppkey", entity_id("s_nationkey", "s_suppkey").alias("seller_id"))
    buyers = financials(spark, sf_dir).select("o_orderkey", F.col("entity_id").alias("buyer_id"))
    return (
        lines.join(sellers, lines["l_suppkey"] == sellers["s_suppkey"])
        .join(buyers, lines["l_orderkey"] == buyers["o_orderkey"])
        .select("l_orderkey", "l_linenumber", "buyer_id", "seller_id", "l_extendedprice")
    )


def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.select(F.col("n_name").alias("Country"), pick(CODES, F.col("n_nationkey")).alias("Code"))


def id_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change row per order; IDs stay within a market segment."""
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders")
    shift = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    new = F.col("c_custkey") + F.col("c_nationkey") + shift
    return orders.join(people, orders["o_custkey"] == people["c_custkey"]).select(
        F.concat_ws("-", "c_mktsegment", "c_custkey").alias("old_id"),
        F.concat_ws("-", "c_mktsegment", new).alias("new_id"),
        F.col("o_orderdate").alias("change_date"),
    )


def lineage_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_acctbal < 0").select(
        F.concat_ws("-", "c_mktsegment", "c_custkey").alias("id"))


def export_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One export folder per market segment and order date, one entry per status."""
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd_HH-mm-ss")
    return (
        orders.join(people, orders["o_custkey"] == people["c_custkey"])
        .select(
            F.lit("/exports").alias("root"),
            F.concat("c_mktsegment", F.lit("_exported "), stamp).alias("export"),
            F.concat(F.lit("usd_interim_"), "o_orderstatus", F.lit(".csv")).alias("entry"),
        )
        .distinct()
    )


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as products, part types as tables, part names as columns."""
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("Data Product"), F.col("p_type").alias("Table"), F.col("p_name").alias("Column"),
        F.concat(F.col("p_name"), F.lit(" of size "), F.col("p_size")).alias("Definition"),
    ).distinct()


def headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-line headings: part names, and market segments, which no dictionary column has."""
    parts = table(spark, sf_dir, "part").select(F.concat(F.upper(F.replace("p_name", F.lit(" "), F.lit("-"))), F.lit("\n"), "p_brand").alias("heading"))
    people = table(spark, sf_dir, "customer").select(F.concat("c_mktsegment", F.lit("\n"), "c_name").alias("heading"))
    return parts.union(people)


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company names: page titles with a company suffix, and their page."""
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return table(spark, sf_dir, "pages").select(
        F.trim(F.concat(title, F.lit(" "), pick(SUFFIXES, F.col("page_id")))).alias("name"), "page_id")


def misspelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search names: the titles without their fourth character."""
    return page_titles(spark, sf_dir).select(F.regexp_replace("name", "^(...).", "$1").alias("search"))


def reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search names: the titles with their words in reverse order."""
    words = F.reverse(F.split("name", " "))
    return page_titles(spark, sf_dir).select(F.array_join(words, " ").alias("search"))


def phrases(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Every phrase of every text of a table."""
    key = table(spark, sf_dir, name).columns[0]
    return table(spark, sf_dir, name).select(
        F.col(key).alias("id"), F.explode(F.split("text", r"[.,\n]+")).alias("phrase")).where("trim(phrase) <> ''")
