"""Snapshot catalog: which products, tables and exports a delivery holds."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import contains_word, snapshot_product, snapshot_timestamp, table_name_from_file

CATALOG_COLUMNS = [
    "Data Product", "Table", "Base Directory", "Timestamp", "Export", "Top-level Directory",
]


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, modified, bytes) of every file below a folder; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def select_table_files(files: DataFrame, table: str) -> DataFrame:
    """Part files of a table: when CSVs share a folder, only the one named like the table."""
    name = F.element_at(F.split("path", "/"), -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    folder = F.regexp_replace("path", r"/[^/]*$", "")
    marked = files.withColumns({"_folder": folder, "_csv": F.endswith(name, F.lit(".csv")), "_stem": stem})
    shared = marked.groupBy("_folder").agg(
        (F.bool_or("_csv") & (F.count("*") > 1)).alias("_shared")
    )
    kept = marked.join(shared, "_folder").where(~F.col("_shared") | (F.col("_stem") == table))
    return kept.select(*files.columns)


def build_catalog(entries: DataFrame) -> DataFrame:
    """Catalog from one row per (export folder, entry).

    ``entries`` has ``root``, ``export`` (folder name, ``<product>_exported
    <date_time>``) and ``entry`` (file or folder name in it).
    """
    export = F.concat_ws("/", "root", "export")
    base = F.when(F.endswith("entry", F.lit(".csv")), export).otherwise(F.concat_ws("/", export, "entry"))
    return entries.select(
        snapshot_product(F.col("export")).alias("Data Product"),
        table_name_from_file(F.col("entry")).alias("Table"),
        base.alias("Base Directory"),
        snapshot_timestamp(F.col("export")).alias("Timestamp"),
        export.alias("Export"),
        F.col("export").alias("Top-level Directory"),
    )


def entries_from_files(files: DataFrame, root: str) -> DataFrame:
    """Export entries from a recursive file listing (part files fold into their table)."""
    below = F.element_at(F.split("path", F.concat(F.lit("\\Q"), F.lit(root.rstrip("/") + "/"), F.lit("\\E"))), -1)
    parts = F.split(below, "/")
    return (
        files.select(F.lit(root.rstrip("/")).alias("root"), parts[0].alias("export"), parts[1].alias("entry"))
        .where("entry IS NOT NULL")
        .distinct()
    )


def newest_exports(catalog: DataFrame) -> DataFrame:
    """Catalog rows of each product's newest export; unreadable stamps lose."""
    stamp = F.struct(F.col("Timestamp").isNotNull(), F.col("Timestamp"), F.col("Export"))
    # one (product, newest export) row each, so the join is small on one side
    newest = catalog.groupBy("Data Product").agg(F.max_by("Export", stamp).alias("Export"))
    return catalog.join(newest, ["Data Product", "Export"], "left_semi")


def _bare_path(path: Column) -> Column:
    """A path without scheme and host."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?", "")


def control_files(spark: SparkSession, root: str, folder: str = "tnfs", pattern: str = "*.tnf") -> DataFrame:
    """(directory, folder, modified, path): the newest control file of each directory below ``root``.

    A directory keeps its control files in ``folder``; their JSON names the current export in ``DataFolder``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    path = _bare_path(F.col("path"))
    named = F.from_json(F.col("content").cast("string"), "DataFolder string")["DataFolder"]
    found = files.select(
        F.regexp_extract(path, f"^(.*)/{re.escape(folder)}/[^/]*$", 1).alias("directory"),
        F.struct(F.col("modificationTime").alias("modified"), path.alias("path"), named.alias("folder")).alias("file"),
    )
    newest = found.where("directory <> ''").groupBy("directory").agg(F.max("file").alias("file"))
    return newest.select("directory", "file.folder", "file.modified", "file.path")


def newest_by_control(catalog: DataFrame, controls: DataFrame) -> DataFrame:
    """Catalog rows of the exports that control files name, their ``Timestamp`` being the file's time.

    The stamp in a folder's name does not count. A control file without a folder, or with
    one that the catalog does not hold, gives no row.
    """
    named = controls.select(
        F.concat_ws("/", "directory", "folder").alias("_export"), F.col("modified").alias("_modified")).where("folder IS NOT NULL")
    rows = catalog.join(named, _bare_path(F.col("Export")) == F.col("_export"))
    return rows.withColumn("Timestamp", F.col("_modified")).drop("_export", "_modified")


def stale_exports(catalog: DataFrame) -> DataFrame:
    """(Data Product, Export) of every export that is not the newest."""
    exports = catalog.select("Data Product", "Export").distinct()
    return exports.join(newest_exports(catalog), ["Data Product", "Export"], "left_anti")


def search_tables(catalog: DataFrame, word: str) -> DataFrame:
    return catalog.where(
        contains_word(F.col("`Data Product`"), word) | contains_word(F.col("Table"), word)
    )


def resolve_name(catalog: DataFrame, column: str, name: str) -> DataFrame:
    """Exact names, else names containing ``name``: (name, status).

    Status is exact, partial (one candidate, to be confirmed), ambiguous or none.
    """
    found = catalog.select(F.col(f"`{column}`").alias("name")).distinct()
    found = found.withColumn("exact", F.col("name") == name)
    found = found.where(F.col("exact") | contains_word(F.col("name"), name))
    exact = found.where("exact").select("name", F.lit("exact").alias("status"))
    n_partial = found.agg(F.count("*"))
    status: Column = F.when(n_partial.scalar() == 1, "partial").otherwise("ambiguous")
    has_exact = found.agg(F.coalesce(F.bool_or("exact"), F.lit(False)))
    partial = found.where(~F.col("exact") & ~has_exact.scalar()).select("name", status.alias("status"))
    nothing = found.agg(F.count("*").alias("n")).where("n = 0")
    none = nothing.select(F.lit(None).cast("string").alias("name"), F.lit("none").alias("status"))
    return exact.unionByName(partial).unionByName(none)


def containing_sets(sets: DataFrame, parts: DataFrame) -> DataFrame:
    """(have, want): each array of ``parts.want`` with the arrays of ``sets.have`` that hold all of it.

    A part enters by the element that the fewest sets hold, so only sets with that element are
    candidates; of these the rest is verified. The arrays must be distinct on both sides.
    """
    held = sets.select("have", F.explode("have").alias("item"))
    frequency = held.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        parts.select("want", F.explode("want").alias("item"))
        .join(frequency, "item", "left")
        .groupBy("want")
        .agg(F.min_by("item", F.struct(F.coalesce("n", F.lit(0)), "item")).alias("item"))
    )
    return held.join(rarest, "item").where(F.size(F.array_except("want", "have")) == 0).select("have", "want")


def match_products(export_tables: DataFrame, product_tables: DataFrame) -> DataFrame:
    """Products whose tables all appear in an export: (export, options, label).

    ``export_tables``: export, Table.  ``product_tables``: Data Product, Table. Exports with equal tables
    are matched once, and so are products; an export's or a product's tables (hundreds at most) form an array.
    """
    have = export_tables.select("export", table_stem("Table").alias("Table"))
    have = have.groupBy("export").agg(F.array_sort(F.collect_set("Table")).alias("have"))
    want = product_tables.groupBy("Data Product").agg(F.array_sort(F.collect_set("Table")).alias("want"))
    options = (
        containing_sets(have.select("have").distinct(), want.select("want").distinct())
        .join(want, "want")
        .groupBy("have")
        .agg(F.array_sort(F.collect_set("Data Product")).alias("options"))
    )
    label = F.when(
        F.col("options").isNotNull(), F.concat(F.lit("Multiple_Options: "), F.array_join("options", ", "))
    ).otherwise(F.lit("Unknown"))
    return have.join(options, "have", "left").select("export", "options", label.alias("label"))


def table_stem(column: str) -> Column:
    return F.regexp_replace(F.col(column), r"\.csv$", "")


def override_labels(catalog: DataFrame, labels: DataFrame) -> DataFrame:
    """Product label by top-level directory where given, else the existing one."""
    given = labels.select("Top-level Directory", F.col("Data Product").alias("_label"))
    given = given.groupBy("Top-level Directory").agg(F.max("_label").alias("_label"))
    return (
        catalog.join(given, "Top-level Directory", "left")
        .withColumn("Data Product", F.coalesce("_label", "Data Product"))
        .select(*catalog.columns)
    )


def new_files(listing: DataFrame, processed: DataFrame) -> DataFrame:
    """Files of a listing that a manifest does not hold yet."""
    return listing.join(processed.select("path"), "path", "left_anti")


def keep_last(df: DataFrame, keys: list[str], order_by: str) -> DataFrame:
    """Last row per key in the order of a column; an aggregate, so hot keys combine early."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    order = F.struct(F.col(order_by).isNotNull(), F.col(order_by))
    last = df.groupBy(*keys).agg(F.max_by(row, order).alias("_row"))
    return last.select("_row.*")
