"""Extract, match, lineage and profiling jobs over many-part company tables.

Every public function takes and returns a Spark ``DataFrame`` (or ``Column``), so
plans stay lazy and Catalyst sees the whole query.  The few functions that loop
(lineage) or need a bounded statistic first (name matching) say so in their
docstring.
"""

from .operators.extract import ExtractSpec, extract, preflight, sample
from .operators.filters import Clause, DateRange, LayeredFilter
from .operators.jobs import run_batch
from .operators.lineage import resolve_lineage
from .operators.names import match_names, match_names_plain, search_company_names
from .operators.profile import profile, profile_table, profile_tables, report_views
from .operators.stats import year_distribution
from .sources.readers import read_table
from .sources.writers import write_table

__all__ = [
    "Clause",
    "DateRange",
    "ExtractSpec",
    "LayeredFilter",
    "extract",
    "match_names",
    "match_names_plain",
    "preflight",
    "profile",
    "profile_table",
    "profile_tables",
    "read_table",
    "report_views",
    "resolve_lineage",
    "run_batch",
    "sample",
    "search_company_names",
    "write_table",
    "year_distribution",
]
