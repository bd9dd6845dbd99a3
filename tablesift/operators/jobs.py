"""A list of extracts, one write each."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..sources.writers import write_table
from .extract import ExtractSpec, extract
from .filters import Clause, LayeredFilter

JOB_SCHEMA = T.StructType(
    [
        T.StructField("n", T.IntegerType()),
        T.StructField("data_product", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("available_columns", T.ArrayType(T.StringType())),
    ]
)


def _path_exists(df: DataFrame, path: str) -> bool:
    spark = df.sparkSession
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def run_batch(
    jobs: DataFrame,
    ids: Sequence[str] | DataFrame,
    load: Callable[[str, str], DataFrame | None],
    output_root: str,
    fmt: str = "parquet",
    required: Sequence[Clause] | Clause | None = None,
    alternatives: Sequence[Clause] | Clause | None = None,
) -> DataFrame:
    """Run an exact-ID extract for each job row with ``Run`` true; one report row each.

    ``jobs`` (a hand-written list: Data Product, Table, Column, Run) is read in the
    order of product, table, column and numbered over the rows to run; ``load(product,
    table)`` gives the table or ``None``.  A job whose output is complete (it has
    the writer's success mark) is skipped, a half-written one is written anew, one whose table or columns are missing is reported as incomplete.
    """
    report = []
    rows = jobs.where("Run").orderBy("Data Product", "Table", "Column").collect()
    for n, job in enumerate(rows, start=1):
        product, table = job["Data Product"], job["Table"]
        target = f"{output_root.rstrip('/')}/{n}_{product}_{table}"
        if _path_exists(jobs, f"{target}.{fmt}/_SUCCESS"):
            report.append((n, product, table, "exists", f"{target}.{fmt}", None))
            continue
        df = load(product, table)
        if df is None:
            report.append((n, product, table, "table not found", None, None))
            continue
        columns = [c.strip() for c in job["Column"].split(",")]
        if not set(columns) <= set(df.columns):
            report.append((n, product, table, "columns not found", None, df.columns))
            continue
        layers = LayeredFilter(Clause(ids, columns), required, alternatives)
        written = write_table(extract(df, ExtractSpec(ids=layers)), target, fmt, mode="overwrite")
        status = "written" if written else "empty"
        report.append((n, product, table, status, written[0] if written else None, df.columns))
    return jobs.sparkSession.createDataFrame(report, JOB_SCHEMA)


def incomplete_jobs(report: DataFrame) -> DataFrame:
    return report.where("status IN ('table not found', 'columns not found')")


