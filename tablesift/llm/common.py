"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, kind: str) -> str:
    """A name below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/llm-{kind}-{uuid4().hex}"


def saved(df: DataFrame, kind: str = "table") -> DataFrame:
    """The frame, written to the shared folder and read again: cuts the lineage, and
    what was computed survives the loss of the executors that computed it."""
    path = new_folder(df.sparkSession, kind)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def single_rows(df: DataFrame, key: str, kind: str = "table") -> DataFrame:
    """``df`` with the column ``key`` replaced by a number unique to each row.

    Saved, so that a recomputed task cannot number rows anew.
    """
    return saved(df.withColumn(key, F.monotonically_increasing_id()), kind)


def with_place(df: DataFrame, name: str) -> DataFrame:
    """Adds ``name``: the place of a row, from 0, in the Parquet table that ``df`` reads, by file name and row.

    A frame that reads no files is saved first, in the order of its partitions.
    """
    try:
        held = df.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
        held.schema  # noqa: B018
    except AnalysisException:
        return with_place(saved(df, "ordered"), name)
    files = held.groupBy("_file").agg(F.count(F.lit(1)).alias("n"))
    # the number after part- has five digits or more
    number = F.coalesce(F.regexp_extract("_file", r"^part-(\d+)", 1).try_cast("long"), F.lit(-1))
    before = Window.orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(F.col("_file").alias("_f"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    placed = held.join(starts, F.col("_file") == F.col("_f"))
    return placed.withColumn(name, F.col("_start") + F.col("_at")).drop("_file", "_at", "_f", "_start")


def key_rank(df: DataFrame, group: list[str], order: Column, ties: list[Column], bits: int = 10,
             few_groups: bool = False, tied: bool = False) -> DataFrame:
    """Adds ``rank``: the 0-based position of a row within its group.

    Rows are ordered by ``order`` (a long that is spread evenly, such as a hash) and
    then ``ties``. A group is cut into 2^bits ranges of ``order``, whose sizes are
    counted first; each range is then numbered on its own, so a group that holds a
    third of all rows is spread over 2^bits window partitions. Ranges follow the order,
    so their number has no influence on the result. ``few_groups`` says that the number of
    groups is bounded, so that the sizes can be broadcast; ``tied`` gives rows of equal order the rank of
    the first of them.
    """
    df = df.withColumn("_order", order).withColumn("_range", F.shiftright("_order", 64 - bits))
    sizes = df.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    named = [F.col(c).alias(f"_g{i}") for i, c in enumerate(group)]
    # saved, as the rows below must not be dealt by the group alone, which these are
    sizes = saved(sizes.select(*named, F.col("_range").alias("_r"), "_before"), "sizes")
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    inner = (F.rank() if tied else F.row_number()).over(Window.partitionBy(*group, "_range").orderBy("_order", *ties)) - 1
    ranked = df.withColumn("_inner", inner).join(F.broadcast(sizes) if few_groups else sizes, same)
    return ranked.withColumn("rank", F.col("_before") + F.col("_inner")).drop(
        "_order", "_range", "_inner", "_before", "_r", *[f"_g{i}" for i in range(len(group))])


def bit_marks(rows: DataFrame, bit: Column, size: int) -> np.ndarray:
    """A bit set of ``size`` bits, as longs, that has the bit (a number from 0 to ``size`` - 1) of every row."""
    words = rows.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    out = np.zeros(size // 64, np.int64)
    got = words.toArrow()  # size / 64 rows at most
    out[got.column("at").to_numpy()] = got.column("bits").to_numpy()
    return out


def marks_at(marks: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (marks[bits >> 6] >> (bits & 63)) & 1 == 1


def marked(spark: SparkSession, marks: np.ndarray) -> Callable[[Column], Column]:
    """A test of a column of bit numbers: whether the bit is set."""
    shared = spark.sparkContext.broadcast(marks)

    @F.pandas_udf("boolean")
    def is_set(bits: pd.Series) -> pd.Series:
        return pd.Series(marks_at(shared.value, bits.to_numpy()))

    return is_set


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


LONG, STRING = T.LongType(), T.StringType()
