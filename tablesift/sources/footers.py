"""What the footers of Parquet files tell: rows per file, and the range of columns.

Footers are read on the executors, so neither a listing nor a footer meets the driver. Paths are
those that pyarrow's file systems open (local paths, ``file:``, ``hdfs:``, ``s3:`` and others).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from datetime import date, datetime

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import Clause, DateRange, LayeredFilter

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FACTS = "path string, present boolean, rows long, row_groups int, may_match boolean, error string"
#: longest value list that is compared one by one; of longer ones only the ends are
MOST_VALUES = 100_000
Range = tuple  # (least, greatest, nulls) of a column in a file; least is None if all values are null


def column_ranges(metadata, columns: Sequence[str]) -> dict[str, Range | None]:
    """The range of each column over all row groups; None where a footer does not tell it."""
    found: dict[str, list] = {}
    unknown = set()
    for g in range(metadata.num_row_groups):
        group = metadata.row_group(g)
        for i in range(group.num_columns):
            part = group.column(i)
            if part.path_in_schema not in columns:
                continue
            stats, name = part.statistics, part.path_in_schema
            if stats is None or not stats.has_null_count or not (stats.has_min_max or stats.null_count == group.num_rows):
                unknown.add(name)
                continue
            seen = found.setdefault(name, [None, None, 0])
            seen[2] += stats.null_count
            if stats.has_min_max:
                seen[0] = stats.min if seen[0] is None else min(seen[0], stats.min)
                seen[1] = stats.max if seen[1] is None else max(seen[1], stats.max)
    return {c: None if c in unknown or c not in found else tuple(found[c]) for c in columns}


def clause_may_match(clause: Clause, ranges: dict[str, Range | None]) -> bool:
    """Whether a row of a file with such ranges can pass a clause."""
    values = clause.values
    if isinstance(values, DataFrame):
        return True
    for column in clause.columns:
        held = ranges.get(column)
        if held is None:
            return True
        least, greatest, _ = held
        if least is None:
            continue
        if not isinstance(least, str):
            return True  # numbers do not sort like their text
        if clause.mode == "prefix":
            if any(least[:len(v)] <= v <= greatest for v in values):
                return True
        elif len(values) > MOST_VALUES:
            if min(values) <= greatest and max(values) >= least:
                return True
        # a writer may have shortened the greatest value
        elif any(least <= v and (v <= greatest or v.startswith(greatest)) for v in values):
            return True
    return False


def filter_may_match(layered: LayeredFilter | None, ranges: dict[str, Range | None]) -> bool:
    both, any_of = layered.layers() if layered else ([], [])
    if not both and not any_of:
        return True
    return bool(both) and all(clause_may_match(c, ranges) for c in both) or any(clause_may_match(c, ranges) for c in any_of)


def years_may_match(years: DateRange | None, column: str | None, ranges: dict[str, Range | None]) -> bool:
    held = ranges.get(column) if years and column else None
    if held is None:
        return True
    least, greatest, nulls = held
    if nulls and years.nulls == "keep":
        return True
    if least is None:
        return False
    if not isinstance(least, (date, datetime)):
        return True
    return (years.end_year is None or least.year <= years.end_year) and (years.start_year is None or greatest.year >= years.start_year)


def file_facts(spark: SparkSession, files: Sequence[str] | DataFrame, ids: LayeredFilter | None = None, years: DateRange | None = None) -> DataFrame:
    """path, present, rows, row_groups, may_match and error of each file.

    ``files`` is a list or a DataFrame with a column ``path``. ``may_match`` is false if no row of the file
    can pass the clauses and the year range by the footer's ranges; a file that is absent or no Parquet file
    has an error and no rows.
    """
    if not isinstance(files, DataFrame):
        files = spark.createDataFrame([(f,) for f in files], "path string")
    columns = ids.columns() if ids else []

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            rows = []
            for path in batch["path"]:
                try:
                    uri = path if ":/" in path else f"file://{path}"
                    uri = uri.replace(":/", ":///", 1) if uri.startswith("file:/") and not uri.startswith("file:///") else uri
                    system, place = fs.FileSystem.from_uri(uri)
                    metadata = pq.ParquetFile(place, filesystem=system).metadata
                    dated = years.resolve_column(metadata.schema.names) if years else None
                    ranges = column_ranges(metadata, [*columns, *([dated] if dated else [])])
                    fits = metadata.num_rows > 0 and filter_may_match(ids, ranges) and years_may_match(years, dated, ranges)
                    rows.append((path, True, metadata.num_rows, metadata.num_row_groups, fits, None))
                except FileNotFoundError:
                    rows.append((path, False, 0, 0, False, "missing file"))
                except (OSError, ValueError) as error:  # what is wrong with a file is a row of the report
                    rows.append((path, True, 0, 0, False, str(error).splitlines()[0]))
            names = [c.split()[0] for c in FACTS.split(", ")]
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({"path": object, "error": object, "row_groups": "int32", "rows": "int64"})

    return files.select("path").repartition(F.col("path")).mapInPandas(read, FACTS)
