"""Writers with size-bounded files."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes per value, and in-memory bytes per written byte.
TYPE_BYTES = {T.IntegerType: 4, T.LongType: 8, T.FloatType: 4, T.DoubleType: 8, T.StringType: 50}
OTHER_BYTES = 8
SIZE_FACTORS = {"csv": 3, "parquet": 12}
WRITE_FORMATS = ("csv", "parquet", "orc", "json")
COLUMNAR = ("parquet", "orc")


def row_bytes(df: DataFrame) -> int:
    return sum(TYPE_BYTES.get(type(f.dataType), OTHER_BYTES) for f in df.schema)


def split_plan(df: DataFrame, n_rows: int, fmt: str = "parquet", file_size_mb: int = 500) -> tuple[int, int]:
    """(number of files, rows per file) for a target file size; at least one file."""
    budget = file_size_mb * 1024 * 1024 * SIZE_FACTORS.get(fmt, 1)
    n_files = max(1, int(n_rows * row_bytes(df) / budget))
    return n_files, max(1, math.ceil(n_rows / n_files))


def rows_per_file(df: DataFrame, fmt: str = "parquet", file_size_mb: int = 500) -> int:
    """Rows that fit the target file size; needs no count of the data."""
    budget = file_size_mb * 1024 * 1024 * SIZE_FACTORS.get(fmt, 1)
    return max(1, budget // max(1, row_bytes(df)))


def fill_null_columns(df: DataFrame, value: str = "N/A") -> DataFrame:
    """Columns with only nulls become a constant text; one aggregate decides."""
    filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(df.columns)]).first()
    empty = [c for c, n in zip(df.columns, filled) if n == 0]
    return df.withColumns({c: F.lit(value) for c in empty}) if empty else df


def write_table(
    df: DataFrame,
    destination: str,
    formats: str | Sequence[str] = "parquet",
    file_size_mb: int = 500,
    mode: str = "errorifexists",
    by_source: bool = False,
    fill_null: str | None = None,
) -> list[str]:
    """Writes ``<destination>.<format>`` folders; returns the paths written.

    The plan runs once: a columnar format is written first and the others are made
    from its files (with append or ignore, or text formats only, it runs for each).
    Adaptive execution deals rows into files near ``file_size_mb``; rows per file are
    bounded as well.  An unknown format raises before anything is written; an empty
    result leaves nothing.  With ``by_source`` every input part keeps its own
    ``source_file`` folder.  ``fill_null`` replaces columns that hold only nulls.
    """
    formats = [formats] if isinstance(formats, str) else list(formats)
    formats = [f.lower().lstrip(".") for f in formats]
    unknown = [f for f in formats if f not in WRITE_FORMATS]
    if unknown:
        raise ValueError(f"unsupported formats {unknown}; use {list(WRITE_FORMATS)}")
    if fill_null is not None:
        df = fill_null_columns(df, fill_null)
    spark = df.sparkSession
    own = mode in ("error", "errorifexists", "overwrite")
    if not own and df.isEmpty():
        return []
    first = next((f for f in formats if f in COLUMNAR), formats[0])
    source = df
    for fmt in [first] + [f for f in formats if f != first]:
        path = f"{destination}.{fmt}"
        dealt = source.hint("rebalance", *(["source_file"] if by_source else []))
        writer = dealt.write.mode(mode).format(fmt)
        writer = writer.option("maxRecordsPerFile", rows_per_file(df, fmt, file_size_mb))
        if fmt == "csv":
            writer = writer.option("header", True)
        if by_source:
            writer = writer.partitionBy("source_file")
        with _write_settings(spark, file_size_mb):
            writer.save(path)
        if fmt == first and own:
            stored = spark.read.schema(df.schema).format(fmt).load(path)
            if stored.isEmpty():
                _remove(spark, path)
                return []
            source = stored if fmt in COLUMNAR else df
    return [f"{destination}.{f}" for f in formats]


#: Folders that a task writes at once. Beyond them Spark sorts the rest of its rows, up to a whole file's, in memory.
OPEN_FOLDERS = 4


@contextmanager
def _write_settings(spark: SparkSession, megabytes: int) -> Iterator[None]:
    """The partition size that adaptive execution aims at, and rows dealt to folders without a sort, for one write."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{megabytes}m", "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FOLDERS)}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _remove(spark: SparkSession, path: str) -> None:
    """Removes the folder of an empty result that was just written."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_stamped(df: DataFrame, folder: str, name: str, now: datetime | None = None) -> str | None:
    """Small result to a time-stamped CSV folder; an empty one is not written."""
    if df.isEmpty():
        return None
    stamp = (now or datetime.now()).strftime("%y%m%d%H%M")
    path = f"{folder.rstrip('/')}/{stamp}_{name}.csv"
    df.write.option("header", True).csv(path)
    return path
