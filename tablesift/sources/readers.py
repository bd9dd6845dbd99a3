"""Readers for tables delivered as many part files."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_listed_id

FORMATS = {
    ".csv": "csv",
    ".parquet": "parquet",
    ".orc": "orc",
    ".json": "json",
    ".avro": "avro",
}


def extension(path: str) -> str:
    return PurePosixPath(path.rstrip("/")).suffix.lower()


def format_of(path: str) -> str:
    suffix = extension(path)
    if suffix not in FORMATS:
        raise ValueError(f"unsupported file extension {suffix!r}; use one of {sorted(FORMATS)}")
    return FORMATS[suffix]


#: Batch and stream readers take the same: headers are checked, bad rows fail.
CSV_OPTIONS = {"header": True, "mode": "FAILFAST", "enforceSchema": False}


def _read_one_format(
    spark: SparkSession, fmt: str, paths: list[str], schema: T.StructType | str | None, infer: bool = False
) -> DataFrame:
    reader = spark.read
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS).option("inferSchema", infer and schema is None)
    elif fmt == "parquet" and schema is None and len(paths) > 1:
        reader = reader.option("mergeSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.format(fmt).load(paths)
    except Exception as exc:
        if fmt == "avro" and "avro" in str(exc).lower():
            raise RuntimeError("reading Avro needs the spark-avro package on the cluster") from exc
        raise


def read_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    schema: T.StructType | str | None = None,
    infer: bool = False,
) -> DataFrame:
    """One DataFrame from part files of one or several formats.

    Parts of several formats are unioned by column name. CSV columns are text, as
    delivered (an ID keeps its leading zeros), unless typed parts or a schema give
    their type. ``infer`` guesses types, at the cost of one more pass.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError("no files given")
    by_format = defaultdict(list)
    for path in paths:
        by_format[format_of(path)].append(path)
    parts = [(fmt, _read_one_format(spark, fmt, group, schema, infer)) for fmt, group in by_format.items()]
    typed = {f.name: f.dataType for fmt, df in parts if fmt not in ("csv", "json") for f in df.schema}
    out = None
    for fmt, df in parts:
        if fmt in ("csv", "json") and typed:
            df = df.select(
                *[F.col(f"`{c}`").cast(typed[c]).alias(c) if c in typed else F.col(f"`{c}`")
                  for c in df.columns]
            )
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if columns is not None:
        missing = [c for c in columns if c not in out.columns]
        if missing:
            raise ValueError(f"columns not found: {missing}")
        out = out.select(*[F.col(f"`{c}`") for c in columns])
    return out


def with_source_file(df: DataFrame, column: str = "source_file") -> DataFrame:
    """Adds a name of the part file each row comes from: its stem and a hash of its path.

    Equal stems of two folders or formats stay apart, and the name is never a number.
    """
    stem = F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "")
    path = F.lpad(F.lower(F.hex(F.xxhash64("_metadata.file_path"))), 16, "0")
    return df.withColumn(column, F.concat(stem, F.lit("-"), path))


def column_names(spark: SparkSession, path: str) -> list[str]:
    """Column names without reading rows (CSV: header line only)."""
    fmt = format_of(path)
    if fmt == "csv":
        return spark.read.option("header", True).csv(path).columns
    return _read_one_format(spark, fmt, [path], None).columns


def read_id_list(spark: SparkSession, path: str, codes: DataFrame, delimiter: str = "\t") -> DataFrame:
    """Distinct IDs of the first column of a CSV or tab-separated text file.

    The header line is kept as a value when it looks like an ID or is a country code.
    """
    suffix = extension(path)
    if suffix not in (".csv", ".txt"):
        raise ValueError(f"unsupported file extension {suffix!r}")
    sep = "," if suffix == ".csv" else delimiter
    options = {"sep": sep, "inferSchema": False}
    headed = spark.read.options(header=True, **options).csv(path)
    first = headed.columns[0]
    ids = headed.select(F.col(f"`{first}`").alias("value"))
    title = spark.createDataFrame([(first,)], "value string")
    is_code = title.join(codes.select(F.col("Code").alias("value")), "value", "left_semi")
    title = title.where(is_listed_id(F.col("value"))).union(is_code)
    return ids.union(title).where("value IS NOT NULL AND trim(value) <> ''").distinct()


def read_plain_ids(spark: SparkSession, path: str) -> DataFrame:
    """One ID per line, no header."""
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value <> ''")


def read_metadata(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A metadata table (products, dictionary, codes, date columns), projected and distinct."""
    df = read_table(spark, path)
    if columns is None:
        return df
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"metadata table {path} lacks {missing}")
    return df.select(*[F.col(f"`{c}`") for c in columns]).distinct()
