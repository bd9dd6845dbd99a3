"""Rows per year with shares and a total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_timestamp
from .filters import DateRange


def year_distribution(
    df: DataFrame, column: str | None = None, date_format: str | None = None
) -> DataFrame:
    """Year (text, last row ``Total``), Frequency and Percentage, sorted by year.

    Missing dates are counted nowhere.  ``date_format`` is a Spark pattern for text
    dates, e.g. ``dd-MM-yyyy``; without it all known formats are tried.
    """
    column = DateRange(column=column).resolve_column(df.columns)
    if column is None:
        raise ValueError("no date column found")
    day = F.col(f"`{column}`")
    if date_format:
        day = F.try_to_timestamp(day.cast("string"), F.lit(date_format))
    else:
        day = as_timestamp(day, df.schema[column].dataType)
    per_year = (
        df.select(F.year(day).alias("_year"))
        .where("_year IS NOT NULL")
        .groupBy("_year")
        .agg(F.count("*").alias("_n"))
    )
    # the rollup runs on one row per year, not on the table
    rolled = per_year.rollup("_year").agg(F.sum("_n").alias("Frequency"))
    total = per_year.agg(F.sum("_n"))
    return (
        rolled.withColumn("_total", total.scalar())
        .orderBy(F.col("_year").asc_nulls_last())
        .select(
            F.coalesce(F.col("_year").cast("string"), F.lit("Total")).alias("Year"),
            "Frequency",
            (F.col("Frequency") / F.col("_total") * 100).alias("Percentage"),
        )
    )
