"""Entity-ID clauses, AND/OR layers and year ranges as Spark filters."""

from __future__ import annotations

import operator
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import as_timestamp
from ..functions.text import is_listed_id

#: longest value list written into the plan; longer ones become a join
INLINE_VALUES = 1_000
#: most prefixes written as pushed-down ``startswith`` tests
INLINE_PREFIXES = 50
#: largest value list (bytes of text, known on the driver) that is broadcast
BROADCAST_BYTES = 32 * 1024 * 1024

DEFAULT_DATE_COLUMNS = ("closing_date", "information_date")
FIRST_YEAR = 1900


def as_list(values) -> list:
    if values is None:
        return []
    if isinstance(values, str) or not hasattr(values, "__iter__"):
        return [values]
    return list(values)


def merge_columns(*groups) -> list[str]:
    """Ordered union of scalars, lists and ``None``."""
    merged: dict[str, None] = {}
    for group in groups:
        for name in as_list(group):
            if not isinstance(name, str):
                raise TypeError(f"column names must be strings, got {name!r}")
            merged.setdefault(name)
    return list(merged)


def _present(values) -> list[str]:
    kept: dict[str, None] = {}
    for value in as_list(values):
        text = None if value is None or value != value else str(value)
        if text is not None and text.strip():
            kept.setdefault(text)
    return list(kept)


@dataclass(frozen=True)
class Clause:
    """One membership test: any of ``columns`` equals / starts with any of ``values``.

    ``values`` is a list or a one-column DataFrame.  Null and blank values and
    columns are left out; a clause without either is no clause.
    """

    values: Sequence | DataFrame
    columns: Sequence[str] | str
    mode: str = "exact"

    def __post_init__(self):
        if self.mode not in ("exact", "prefix"):
            raise ValueError(f"mode must be 'exact' or 'prefix', got {self.mode!r}")
        if not isinstance(self.values, DataFrame):
            object.__setattr__(self, "values", tuple(_present(self.values)))
        elif self.mode == "prefix":
            raise ValueError("prefixes are given as a list, not as a DataFrame")
        object.__setattr__(self, "columns", tuple(_present(self.columns)))

    @property
    def empty(self) -> bool:
        return not self.columns or (not isinstance(self.values, DataFrame) and not self.values)

    @property
    def inline(self) -> bool:
        return not isinstance(self.values, DataFrame) and len(self.values) <= INLINE_VALUES


def clause_group(clauses: Clause | Sequence[Clause] | None) -> list[Clause]:
    """One clause or a list of clauses to a list without empty ones."""
    group = [clauses] if isinstance(clauses, Clause) else list(clauses or [])
    return [c for c in group if not c.empty]


@dataclass(frozen=True)
class LayeredFilter:
    """``(base AND every required) OR any alternative``; missing layers drop out."""

    base: Clause | None = None
    required: Clause | Sequence[Clause] | None = None
    alternatives: Clause | Sequence[Clause] | None = None

    def layers(self) -> tuple[list[Clause], list[Clause]]:
        return clause_group(self.base) + clause_group(self.required), clause_group(
            self.alternatives
        )

    def columns(self) -> list[str]:
        both, any_of = self.layers()
        return merge_columns(*[c.columns for c in both + any_of])


def _as_text(df: DataFrame, name: str) -> Column:
    # a cast would keep the filter from the parquet reader
    is_text = isinstance(df.schema[name].dataType, T.StringType)
    return F.col(f"`{name}`") if is_text else F.col(f"`{name}`").cast("string")


def starts_with_any(col: Column, prefixes: Sequence[str]) -> Column:
    if len(prefixes) <= INLINE_PREFIXES:
        return reduce(operator.or_, [F.startswith(col, F.lit(p)) for p in prefixes])
    by_length = defaultdict(list)
    for prefix in prefixes:
        by_length[len(prefix)].append(prefix)
    return reduce(
        operator.or_, [F.substring(col, 1, n).isin(group) for n, group in by_length.items()]
    )


def _inline_test(df: DataFrame, clause: Clause) -> Column:
    values = list(clause.values)
    tests = [
        _as_text(df, c).isin(values)
        if clause.mode == "exact"
        else starts_with_any(_as_text(df, c), values)
        for c in clause.columns
    ]
    return reduce(operator.or_, tests)


def value_frame(df: DataFrame, values: Sequence[str] | DataFrame) -> DataFrame:
    """Distinct non-blank values as one column ``_value``, broadcast when known to be small."""
    if isinstance(values, DataFrame):
        only = F.col(f"`{values.columns[0]}`").cast("string").alias("_value")
        return values.select(only).where(F.trim("_value") != "").distinct()
    listed = df.sparkSession.createDataFrame([(v,) for v in values], "_value string")
    if sum(len(v.encode()) for v in values) <= BROADCAST_BYTES:
        listed = F.broadcast(listed)
    return listed


def _known_small(clause: Clause) -> bool:
    return not isinstance(clause.values, DataFrame) and sum(len(v.encode()) for v in clause.values) <= BROADCAST_BYTES


def _joined_test(df: DataFrame, clause: Clause, tag: str) -> tuple[DataFrame, Column]:
    """Left joins with the broadcast values, one flag per column (and prefix length)."""
    flags = []
    for c in clause.columns:
        for kind, values in _by_kind(clause).items():
            flag = f"_hit_{tag}_{len(flags)}"
            listed = value_frame(df, values).select(F.col("_value").alias(f"{flag}_key"), F.lit(True).alias(flag))
            df = df.join(listed, _piece(_as_text(df, c), kind) == F.col(f"{flag}_key"), "left").drop(f"{flag}_key")
            flags.append(flag)
    return df, reduce(operator.or_, [F.col(f).isNotNull() for f in flags])


def _by_kind(clause: Clause) -> dict[int, Sequence[str] | DataFrame]:
    """The values of a clause by the length of the prefix they are compared with, 0 for whole texts."""
    if clause.mode == "exact":
        return {0: clause.values}
    groups = defaultdict(list)
    for prefix in clause.values:
        groups[len(prefix)].append(prefix)
    return groups


def _piece(text: Column, kind: int) -> Column:
    return F.substring(text, 1, kind) if kind else text


def _rows_by_masks(df: DataFrame, both: list[Clause], any_of: list[Clause]) -> DataFrame:
    """Filter by lists too long to broadcast.

    Whether a row passes depends on its values in the clauses' columns only. So these alone are unpivoted to
    (values, ID, clauses that test it); one join with the lists gives each ID the clauses that hold it, a
    ``bit_or`` folds them to a mask per combination of values, and ``df`` keeps the rows whose
    combination passes: whatever the number of columns and lists, one semi join of whole rows.
    """
    clauses = both + any_of
    columns = merge_columns(*[c.columns for c in clauses])
    names = [f"_v{i}" for i in range(len(columns))]
    long = [c for c in clauses if not c.inline]
    if len(long) > 62:
        raise ValueError("at most 62 long lists in one filter")
    narrow = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names, strict=True)])
    kinds = sorted({k for c in long for k in _by_kind(c)})
    cells = []
    for column, name in zip(columns, names, strict=True):
        for kind in kinds:
            tested = sum(1 << i for i, c in enumerate(long) if column in c.columns and kind in _by_kind(c))
            if tested:
                key = _piece(_as_text(narrow, name), kind)
                cells.append(F.struct(F.concat(F.lit(f"{kind}:"), key).alias("key"), F.lit(tested).cast("long").alias("tested")))
    listed = []
    for i, clause in enumerate(long):
        for kind, values in _by_kind(clause).items():
            key = F.concat(F.lit(f"{kind}:"), "_value").alias("key")
            listed.append(value_frame(df, values).select(key, F.lit(1 << i).cast("long").alias("holds")))
    lists = reduce(DataFrame.unionByName, listed).groupBy("key").agg(F.bit_or("holds").alias("holds"))
    unpivoted = narrow.select(*names, F.explode(F.array(*cells)).alias("cell")).select(*names, "cell.key", "cell.tested").where("key IS NOT NULL")
    hits = unpivoted.join(lists, "key").where("tested & holds <> 0")
    masks = hits.groupBy(*names).agg(F.bit_or(F.expr("tested & holds")).alias("mask"))
    inline = [c for c in clauses if c.inline]
    if inline and (any_of or not both):
        # combinations that no list holds may pass by a short list
        short = narrow.where(reduce(operator.or_, [_inline_test(narrow, _renamed(c, columns, names)) for c in inline])).distinct()
        masks = masks.unionByName(short.withColumn("mask", F.lit(0).cast("long"))).groupBy(*names).agg(F.bit_or("mask").alias("mask"))

    def test(clause: Clause) -> Column:
        if clause.inline:
            return F.coalesce(_inline_test(masks, _renamed(clause, columns, names)), F.lit(False))
        return F.col("mask").bitwiseAND(F.lit(1 << long.index(clause)).cast("long")) != 0

    parts = ([reduce(operator.and_, [test(c) for c in both])] if both else []) + [test(c) for c in any_of]
    passing = masks.where(reduce(operator.or_, parts)).select(*names)
    same = [F.col(f"`{c}`").eqNullSafe(F.col(n)) for c, n in zip(columns, names, strict=True)]
    # a row without any value passes no clause
    some = reduce(operator.or_, [F.col(f"`{c}`").isNotNull() for c in columns])
    return df.where(some).join(passing, reduce(operator.and_, same), "left_semi")


def _renamed(clause: Clause, columns: list[str], names: list[str]) -> Clause:
    return Clause(clause.values, [names[columns.index(c)] for c in clause.columns], clause.mode)


def _is_semi_join(clause: Clause) -> bool:
    return not clause.inline and clause.mode == "exact" and len(clause.columns) == 1


def apply_layers(df: DataFrame, layered: LayeredFilter | None) -> DataFrame:
    """Filter by a layered filter; short lists in the plan, long lists as broadcast joins, longer ones as one join.

    Without alternatives every clause must hold: those on one column become semi joins,
    one after another, so each shrinks what the next one reads.
    """
    if layered is None:
        return df
    both, any_of = layered.layers()
    if not both and not any_of:
        return df
    columns = df.columns
    if not any_of:
        for clause in [c for c in both if c.inline]:
            df = df.where(_inline_test(df, clause))
        for clause in filter(_is_semi_join, both):
            df = semi_join(df, clause.values, clause.columns[0])
        both = [c for c in both if not c.inline and not _is_semi_join(c)]
        if not both:
            return df

    if not all(c.inline or _known_small(c) for c in both + any_of):
        return _rows_by_masks(df, both, any_of)

    def tests(clauses: list[Clause], layer: str) -> list[Column]:
        nonlocal df
        found = []
        for i, clause in enumerate(clauses):
            if clause.inline:
                found.append(_inline_test(df, clause))
            else:
                df, test = _joined_test(df, clause, f"{layer}{i}")
                found.append(test)
        return found

    and_tests, or_tests = tests(both, "a"), tests(any_of, "o")
    parts = ([reduce(operator.and_, and_tests)] if and_tests else []) + or_tests
    return df.where(reduce(operator.or_, parts)).select(*[F.col(f"`{c}`") for c in columns])


def semi_join(df: DataFrame, values: Sequence[str] | DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is in a list of any length."""
    listed = value_frame(df, _present(values) if not isinstance(values, DataFrame) else values)
    return df.join(listed, _as_text(df, column) == listed["_value"], "left_semi")


@dataclass(frozen=True)
class DateRange:
    """Inclusive year range on ``column``; ``nulls`` keeps or removes missing dates.

    An open end is unbounded; a given year must lie between 1900 and the current
    one (``this_year`` for repeatable runs).  Without a column the first of ``closing_date``, ``information_date``
    found in the data is used, and data with neither passes unfiltered.
    """

    start_year: int | None = None
    end_year: int | None = None
    column: str | None = None
    nulls: str = "remove"
    this_year: int | None = None

    def __post_init__(self):
        now = self.this_year or date.today().year
        given = [y for y in (self.start_year, self.end_year) if y is not None]
        for year in given:
            if isinstance(year, bool) or not isinstance(year, int):
                raise ValueError("years must be integers")
            if not FIRST_YEAR <= year <= now:
                raise ValueError(f"years must lie between {FIRST_YEAR} and {now}")
        if given != sorted(given):
            raise ValueError("start year must not be after end year")
        if self.nulls not in ("keep", "remove"):
            raise ValueError("nulls must be 'keep' or 'remove'")

    def resolve_column(self, columns: Sequence[str]) -> str | None:
        wanted = [self.column] if self.column else DEFAULT_DATE_COLUMNS
        return next((c for c in wanted if c in columns), None)


def _year_start(year: int, dtype: T.DataType) -> Column:
    kind = {T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP_NTZ"}.get(type(dtype), "TIMESTAMP")
    clock = "" if kind == "DATE" else " 00:00:00"
    return F.expr(f"{kind}'{year:04d}-01-01{clock}'")


def apply_date_range(df: DataFrame, years: DateRange | None) -> DataFrame:
    """Filter by year as a half-open range, which the parquet reader can use.

    A text column is parsed and replaced by the timestamp; text that is no date
    counts as missing. A named column that is absent is an error; of the default
    columns both may be absent, then nothing is filtered.
    """
    column = years.resolve_column(df.columns) if years else None
    if column is None:
        if years and years.column:
            raise ValueError(f"the table has no column {years.column}")
        return df
    dtype = df.schema[column].dataType
    native = isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))
    day = F.col(f"`{column}`")
    if not native:
        df = df.withColumn(column, as_timestamp(day, dtype))
        return _text_years(df, day, years)
    inside = F.lit(True)
    if years.start_year is not None:
        inside = inside & (day >= _year_start(years.start_year, dtype))
    if years.end_year is not None:
        inside = inside & (day < _year_start(years.end_year + 1, dtype))
    return df.where((day.isNull() | inside) if years.nulls == "keep" else (day.isNotNull() & inside))


def _text_years(df: DataFrame, day: Column, years: DateRange) -> DataFrame:
    """The year test on a parsed date, which it names only once, since parsing is costly."""
    if years.start_year is None and years.end_year is None:
        return df if years.nulls == "keep" else df.where(day.isNotNull())
    year = F.year(day)
    if years.end_year is None:
        inside = year >= years.start_year
    elif years.start_year is None:
        inside = year <= years.end_year
    else:
        inside = year.isin(list(range(years.start_year, years.end_year + 1)))
    return df.where(F.coalesce(inside, F.lit(years.nulls == "keep")))


def classify_ids(ids: DataFrame, codes: DataFrame, column: str | None = None) -> DataFrame:
    """Per distinct value: is it a country code, does it look like an ID, is it kept.

    Codes at least as frequent as ID-shaped values make it a list of prefixes,
    otherwise a list of exact IDs.  Output: value, is_code, is_id, mode, kept.
    """
    column = column or ids.columns[0]
    values = ids.select(F.col(f"`{column}`").cast("string").alias("value"))
    values = values.where(F.trim("value") != "").distinct()
    known = codes.select(F.col("Code").alias("value")).distinct().withColumn("_code", F.lit(True))
    marked = values.join(known, "value", "left").select(
        "value", F.col("_code").isNotNull().alias("is_code"), is_listed_id(F.col("value")).alias("is_id")
    )
    totals = marked.agg(
        F.when(F.count_if("is_code") >= F.count_if("is_id"), "prefix").otherwise("exact").alias("mode")
    )
    # the one-row verdict is a scalar subquery, so every row stays where it is
    return marked.withColumn("mode", totals.scalar()).withColumn(
        "kept", F.when(F.col("mode") == "prefix", F.col("is_code")).otherwise(F.col("is_id"))
    )


def id_clause(
    ids: DataFrame, codes: DataFrame, columns: Sequence[str] | str, on_invalid: str = "raise"
) -> Clause:
    """A clause from an ID list; ``on_invalid`` is raise, keep (all exact) or drop.

    Exact IDs stay a DataFrame, so the list may be of any size.  Only the verdict,
    ten bad values and, in prefix mode, country codes come to the driver.
    """
    if on_invalid not in ("raise", "keep", "drop"):
        raise ValueError("on_invalid must be 'raise', 'keep' or 'drop'")
    marked = classify_ids(ids, codes)
    first = marked.select("mode").first()
    mode = first["mode"] if first else "exact"
    if on_invalid == "raise":
        bad = [r["value"] for r in marked.where("NOT kept").orderBy("value").limit(10).collect()]
        if bad:
            raise ValueError(f"not entity IDs: {bad}; use on_invalid='keep' to keep them")
    if on_invalid == "keep" and not marked.where("NOT kept").isEmpty():
        return Clause(marked.select("value"), columns, "exact")
    kept = marked.where("kept").select("value")
    if mode == "prefix":
        return Clause([r["value"] for r in kept.toLocalIterator()], columns, "prefix")
    return Clause(kept, columns, "exact")
