"""The extract: project, filter by ID layers, year range and predicate, sample."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .filters import DateRange, LayeredFilter, apply_date_range, apply_layers, merge_columns

PART = "_part_file"  # name of the part file a row comes from, while functions of parts run


@dataclass(frozen=True)
class ExtractSpec:
    """What to take from a table.

    ``predicate`` is a Spark SQL text or a Column.  ``function`` is called as
    ``function(df, *function_args)``; with ``scope="partition"`` it gets pandas
    batches instead and must work row by row, ``function_schema`` naming its output.
    With ``scope="part"`` it gets all kept rows of one part file at a time, for functions
    that aggregate; the table must come straight from files. With ``combine`` (aggregates of
    the columns of ``function_schema``) it gets the rows of a part file in Arrow batches, and
    its results are combined for each part file and value of ``combine_by``: no task
    holds a whole file. Without it the file must fit into the memory of a task.
    """

    columns: Sequence[str] | None = None
    ids: LayeredFilter | None = None
    years: DateRange | None = None
    predicate: str | Column | None = None
    function: Callable | None = None
    function_args: Sequence = ()
    function_schema: T.StructType | str | None = None
    scope: str = "table"
    row_limit: int | None = None
    keep_filter_columns: bool = False
    combine_by: Sequence[str] = ()
    combine: Sequence[Column] = ()

    def filter_columns(self, available: Sequence[str]) -> list[str]:
        dated = self.years.resolve_column(available) if self.years else None
        return merge_columns(self.ids.columns() if self.ids else None, dated)

    def required_columns(self, available: Sequence[str]) -> list[str]:
        wanted = self.columns if self.columns is not None else available
        return merge_columns(wanted, self.filter_columns(available))


def check_columns(available: Sequence[str], wanted: Sequence[str]) -> None:
    missing = [c for c in wanted if c not in available]
    if missing:
        raise ValueError(f"columns not found: {missing}; available: {list(available)}")


def apply_function(df: DataFrame, spec: ExtractSpec) -> DataFrame:
    if spec.function is None:
        return df
    if spec.scope == "table":
        return df.transform(spec.function, *spec.function_args)
    if spec.scope not in ("partition", "part"):
        raise ValueError("scope must be 'table', 'partition' or 'part'")
    fn, args = spec.function, tuple(spec.function_args)
    if spec.scope == "part":
        rest = df.drop(PART)
        schema = spec.function_schema or rest.schema
        if spec.combine:
            fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

            def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    for part, rows in batch.groupby(PART, sort=False):
                        yield fn(rows.drop(columns=PART), *args).assign(**{PART: part})

            partial = df.mapInPandas(of_batches, schema=T.StructType([*fields.fields, T.StructField(PART, T.StringType())]))
            return partial.groupBy(PART, *spec.combine_by).agg(*spec.combine).select(*[F.col(f"`{c}`") for c in fields.names])

        def of_part(rows: pd.DataFrame) -> pd.DataFrame:
            return fn(rows.drop(columns=PART), *args)

        return df.groupBy(PART).applyInPandas(of_part, schema=schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch, *args)

    return df.mapInPandas(run, schema=spec.function_schema or df.schema)


def extract(df: DataFrame, spec: ExtractSpec) -> DataFrame:
    """One lazy plan: Catalyst prunes the columns and pushes the filters to the scan."""
    check_columns(df.columns, spec.required_columns(df.columns))
    if spec.ids:
        check_columns(df.columns, spec.ids.columns())
    required = spec.required_columns(df.columns)
    if spec.function is not None and spec.scope == "part":
        df = df.withColumn(PART, F.col("_metadata.file_path"))
    dated = spec.years.resolve_column(df.columns) if spec.years else None
    # layers with long lists come last, as their joins would hold the other filters from
    # the scan, unless they test the date column, which the year range may parse
    both, any_of = spec.ids.layers() if spec.ids else ([], [])
    layers_first = all(c.inline for c in both + any_of) or (spec.ids is not None and dated in spec.ids.columns())
    out = df.transform(apply_layers, spec.ids) if layers_first else df
    out = out.transform(apply_date_range, spec.years)
    if spec.predicate is not None:
        out = out.where(spec.predicate)
    out = out if layers_first else out.transform(apply_layers, spec.ids)
    out = apply_function(out, spec)
    if spec.columns is not None:
        keep = required if spec.keep_filter_columns else list(spec.columns)
        out = out.select(*[F.col(f"`{c}`") for c in keep])
    if spec.row_limit is not None and spec.row_limit > 0:
        out = out.limit(spec.row_limit)
    return out


def sample(df: DataFrame, spec: ExtractSpec, n_rows: int = 1000) -> DataFrame:
    """First rows of an extract; zero or less means all."""
    out = extract(df, spec)
    return out.limit(n_rows) if n_rows > 0 else out


def lookup_national_ids(
    df: DataFrame, national_ids: Sequence, id_column: str, national_column: str
) -> DataFrame:
    """(entity ID, national ID) of the rows whose national ID is listed."""
    from .filters import Clause

    ids = LayeredFilter(Clause([str(v) for v in national_ids], national_column))
    return extract(df, ExtractSpec(columns=[id_column, national_column], ids=ids))


PREFLIGHT_SCHEMA = T.StructType(
    [
        T.StructField("ok", T.BooleanType(), False),
        T.StructField("reason", T.StringType()),
        T.StructField("files", T.ArrayType(T.StringType())),
        T.StructField("missing_files", T.ArrayType(T.StringType())),
        T.StructField("warnings", T.ArrayType(T.StringType())),
        T.StructField("errors", T.ArrayType(T.StringType())),
        T.StructField("required_columns", T.ArrayType(T.StringType())),
        T.StructField("resolved_date_column", T.StringType()),
        T.StructField("resolved_id_columns", T.ArrayType(T.StringType())),
        T.StructField("destination", T.StringType()),
        T.StructField("would_write", T.BooleanType(), False),
    ]
)


def default_destination(table: str, output_root: str = "", now: datetime | None = None) -> str:
    """``<output_root>/<yymmddHHMM>_<table>``."""
    stamp = (now or datetime.now()).strftime("%y%m%d%H%M")
    return f"{output_root.rstrip('/')}/{stamp}_{table}" if output_root else f"{stamp}_{table}"


def preflight(
    df: DataFrame,
    spec: ExtractSpec,
    files: Sequence[str] | None = None,
    listing: DataFrame | None = None,
    output_format: str | Sequence[str] | None = None,
    destination: str | None = None,
    table: str = "output",
    output_root: str = "",
    now: datetime | None = None,
) -> DataFrame:
    """One-row report of what an extract would do; reads schemas and listings only.

    ``listing`` has a ``path`` column with the files present (see
    ``sources.catalog.list_files``).
    """
    spark: SparkSession = df.sparkSession
    files = list(files if files is not None else df.inputFiles())
    missing: list[str] = []
    if listing is not None and files:
        asked = spark.createDataFrame([(f,) for f in files], "path string")
        missing = [r["path"] for r in asked.join(listing, "path", "left_anti").collect()]
    warnings, errors = [], [f"missing file: {f}" for f in missing]
    required = spec.required_columns(df.columns)
    absent = [c for c in required if c not in df.columns]
    errors += [f"missing column: {c}" for c in absent]
    dated = spec.years.resolve_column(df.columns) if spec.years else None
    if spec.years and dated is None:
        warnings.append("no date column found; rows would not be filtered by year")
    if not files:
        errors.append("no files given")
    if not errors:
        try:
            extract(df, spec).schema
        except Exception as exc:  # analysis errors become part of the report
            errors.append(str(exc).splitlines()[0])
    active = bool(spec.columns or spec.ids or spec.years or spec.predicate is not None)
    writes = bool(output_format) and active
    if writes and destination is None:
        destination = default_destination(table, output_root, now)
        warnings.append("no destination given; the default one would be used")
    row = (
        not errors, errors[0] if errors else None, [f for f in files if f not in set(missing)],
        missing, warnings, errors, required, dated, spec.ids.columns() if spec.ids else [],
        destination, writes,
    )
    return spark.createDataFrame([row], PREFLIGHT_SCHEMA)
