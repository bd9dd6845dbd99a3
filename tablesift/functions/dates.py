"""Date formats and date parsing as Spark columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class DateFormat:
    name: str
    patterns: tuple[str, ...]
    shape: str
    granularity: str
    ambiguous: bool = False
    has_time: bool = False


_DAY = r"\d{4}-\d{2}-\d{2}"
_CLOCK = r"\d{2}:\d{2}:\d{2}"

# The formats tried, in order (the first of the best wins).  ``shape``
# is a cheap regular expression that must hold before the parser runs, so that a
# text of another form costs no parser exception.
DATE_FORMATS = [
    DateFormat("%Y-%m-%d", ("yyyy-MM-dd",), rf"^{_DAY}$", "date"),
    DateFormat("%Y%m%d", ("yyyyMMdd",), r"^\d{8}$", "date"),
    DateFormat("%Y-%m", ("yyyy-MM",), r"^\d{4}-\d{2}$", "year_month"),
    DateFormat("%Y", ("yyyy",), r"^\d{4}$", "year"),
    DateFormat("%d/%m/%Y", ("d/M/yyyy",), r"^\d{1,2}/\d{1,2}/\d{4}$", "date", True),
    DateFormat("%m/%d/%Y", ("M/d/yyyy",), r"^\d{1,2}/\d{1,2}/\d{4}$", "date", True),
    DateFormat("%d-%m-%Y", ("d-M-yyyy",), r"^\d{1,2}-\d{1,2}-\d{4}$", "date", True),
    DateFormat("%m-%d-%Y", ("M-d-yyyy",), r"^\d{1,2}-\d{1,2}-\d{4}$", "date", True),
    DateFormat("%Y-%m-%d %H:%M:%S", ("yyyy-MM-dd HH:mm:ss",), rf"^{_DAY} {_CLOCK}$",
               "datetime", False, True),
    DateFormat("%Y-%m-%dT%H:%M:%S", ("yyyy-MM-dd'T'HH:mm:ss",), rf"^{_DAY}T{_CLOCK}$",
               "datetime", False, True),
    DateFormat("%Y-%m-%dT%H:%M:%SZ", ("yyyy-MM-dd'T'HH:mm:ss'Z'",), rf"^{_DAY}T{_CLOCK}Z$",
               "datetime", False, True),
    DateFormat("%Y-%m-%d %H:%M:%S%z", ("yyyy-MM-dd HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ssXX"),
               rf"^{_DAY} {_CLOCK}(Z|[+-]\d{{2}}:?\d{{2}})$", "datetime", False, True),
    DateFormat("%Y-%m-%dT%H:%M:%S%z", ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ssXX"),
               rf"^{_DAY}T{_CLOCK}(Z|[+-]\d{{2}}:?\d{{2}})$", "datetime", False, True),
]
GENERIC_SHAPE = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}([ T]\d{{1,2}}:\d{{2}}.*)?$"
TIME_ZONE_SHAPE = r"(?:Z|[+-]\d{2}:?\d{2})$"
CLOCK_SHAPE = r"\d{1,2}:\d{2}"
# A text of bare digits counts as a date only in these years, as most such numbers are no dates.
BARE_DIGITS = ("%Y%m%d", "%Y")
FIRST_YEAR, LAST_YEAR = 1678, 2261


def _in_range(ts: Column) -> Column:
    return F.year(ts).between(FIRST_YEAR, LAST_YEAR)


def parse_format(col: Column, fmt: DateFormat) -> Column:
    """Timestamp of a trimmed text in one format, else null."""
    parsed = F.coalesce(*[F.try_to_timestamp(col, F.lit(p)) for p in fmt.patterns])
    return F.when(F.rlike(col, F.lit(fmt.shape)), parsed)


def is_format(col: Column, fmt: DateFormat) -> Column:
    parsed = parse_format(col, fmt)
    return F.coalesce(_in_range(parsed), F.lit(False)) if fmt.name in BARE_DIGITS else parsed.isNotNull()


def is_generic_date(col: Column) -> Column:
    return F.when(F.rlike(col, F.lit(GENERIC_SHAPE)), col.try_cast("timestamp")).isNotNull()


def parse_date(col: Column) -> Column:
    """Text to timestamp by Spark's own cast, then the listed formats; bad text is null.

    Day-first wins over month-first where both would parse.
    """
    text = F.trim(col.cast("string"))
    generic = F.when(F.rlike(text, F.lit(GENERIC_SHAPE)), text.try_cast("timestamp"))
    parsed = F.coalesce(generic, *[parse_format(text, f) for f in DATE_FORMATS])
    # text that does not begin with a digit is no date in any format
    return F.when(F.rlike(text, F.lit(r"^\d")), parsed)


def as_timestamp(col: Column, dtype: T.DataType) -> Column:
    """Native dates stay as they are (so range filters push down); text is parsed."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return col
    return parse_date(col)
