"""Text functions as Spark columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Company-form suffixes, in matching order (the first listed wins).
COMPANY_SUFFIXES = [
    "inc", "incorporated", "ltd", "limited", "llc", "plc", "corp", "corporation",
    "co", "company", "llp", "gmbh", "ag", "sa", "sas", "pty ltd", "bv", "oy", "as",
    "nv", "kk", "srl", "sp z oo", "sc", "ou",
    "inc.", "ltd.", "llc.", "plc.", "corp.", "co.", "llp.", "gmbh.", "ag.", "s.a.",
    "s.a.s.", "pty ltd.", "b.v.", "oy.", "a/s", "n.v.", "k.k.", "s.r.l.",
    "sp. z o.o.", "s.c.", "oü",
]

# Fixed value: shape of an entity ID in an ID list.
ENTITY_ID_PATTERN = r"^[A-Za-z]+[*]?[A-Za-z]*\d*[-\dA-Za-z]*$"


def company_suffixes() -> list[str]:
    return list(COMPANY_SUFFIXES)


def letters_only(col: Column) -> Column:
    """Lower-cased ASCII letters and digits of a text."""
    return F.regexp_replace(F.lower(col), "[^a-zA-Z0-9]", "")


def contains_word(col: Column, word: Column | str) -> Column:
    """Case-insensitive literal containment; null is no hit."""
    word = F.lit(word) if isinstance(word, str) else word
    return F.coalesce(F.contains(F.lower(col.cast("string")), F.lower(word)), F.lit(False))


def _clean(col: Column) -> Column:
    # Java's \w and \s are ASCII without (?U)
    spaced = F.regexp_replace(F.lower(col), r"(?U)[^\w\s]", " ")
    return F.trim(F.regexp_replace(spaced, r"(?U)\s+", " "))


def clean_suffix(suffix: str) -> str:
    """The name cleaning applied to one suffix literal."""
    kept = "".join(c if c.isalnum() or c == "_" else " " for c in suffix.lower())
    return " ".join(kept.split())


def _without_suffix(name: Column, suffixes: Sequence[str], word_boundary: bool = False) -> Column:
    """Name without the first listed suffix it ends in."""
    if not suffixes:
        return name
    # read backwards the suffixes begin at one place, where alternatives are tried in their order
    listed = "|".join(re.escape(s[::-1]) for s in suffixes)
    flipped = F.reverse(name)
    cut = F.regexp_replace(flipped, f"^(?:{listed})" + ("(?= |$)" if word_boundary else ""), "")
    return F.when(cut == flipped, name).otherwise(F.trim(F.reverse(cut)))


def normalize_name(
    col: Column, suffixes: Iterable[str] | None = None, word_boundary: bool = False
) -> Column:
    """Lower, punctuation to spaces, single spaces, first matching suffix off; empty is null.

    ``word_boundary`` keeps ``cisco`` whole when ``co`` is a suffix.
    """
    listed = [s for s in map(clean_suffix, suffixes or []) if s]
    name = _without_suffix(_clean(col.cast("string")), listed, word_boundary)
    return F.nullif(name, F.lit(""))


def strip_suffix_plain(col: Column, suffixes: Sequence[str]) -> Column:
    """Lower-case and take off the last listed suffix that matches; nothing else is cleaned."""
    return _without_suffix(F.lower(col), [s.lower() for s in reversed(suffixes)])


def remove_substrings(col: Column, parts: Sequence[str]) -> Column:
    """Drop every occurrence of every part, in list order."""
    return reduce(lambda c, p: F.replace(c, F.lit(p.lower()), F.lit("")), parts, col)


def block_key(col: Column, length: int) -> Column:
    return F.coalesce(F.substring(letters_only(col), 1, length), F.lit(""))


def tokens(col: Column) -> Column:
    """Whitespace tokens longer than one character."""
    parts = F.split(F.coalesce(col, F.lit("")), r"(?U)\s+")
    return F.filter(parts, lambda t: F.length(t) > 1)


def length_tolerance(length: Column) -> Column:
    return F.greatest(F.lit(3), F.least(F.lit(10), F.ceil(length / 3).cast("int")))


def looks_like_entity_id(col: Column, codes: Sequence[str]) -> Column:
    """Country code followed by at least three digits, separators ignored; null is false.

    The code list is a literal: country codes are a few hundred at most.
    """
    bare = F.regexp_replace(F.upper(F.trim(col)), r"[\s\-_./]", "")
    known = sorted({c.strip().upper() for c in codes if c and c.strip()})
    hit = F.rlike(bare, F.lit("^..[0-9]{3,}$")) & F.substring(bare, 1, 2).isin(known)
    return F.coalesce(hit, F.lit(False))


def is_listed_id(col: Column) -> Column:
    return F.rlike(col, F.lit(ENTITY_ID_PATTERN))


def first_line(col: Column) -> Column:
    return F.element_at(F.split(col, "\n"), 1)


def split_list(col: Column) -> Column:
    """Comma-separated text to a trimmed array."""
    return F.transform(F.split(col, ","), lambda part: F.trim(part))


def safe_file_name(col: Column) -> Column:
    text = F.trim(F.coalesce(F.when(col != "", col), F.lit("profile")))
    return F.regexp_replace(text, r"[^\p{L}\p{N}._\- ]", "_")


def snapshot_product(folder: Column) -> Column:
    """Product part of ``<product>_exported <yyyy-mm-dd_HH-MM-SS>``."""
    return F.trim(F.element_at(F.split(folder, "_exported", 2), 1))


def snapshot_timestamp(folder: Column) -> Column:
    """Timestamp part of a snapshot folder name; null when it has another form."""
    tail = F.regexp_extract(
        F.trim(folder), r"_exported\s*(\d{4}-\d{2}-\d{2}[_ ]\d{2}-\d{2}-\d{2})$", 1
    )
    return F.try_to_timestamp(F.replace(tail, F.lit("_"), F.lit(" ")), F.lit("yyyy-MM-dd HH-mm-ss"))


def table_name_from_file(name: Column) -> Column:
    """Table name of a part file or folder: no ``.csv``, interim names in one order."""
    bare = F.regexp_replace(name, r"\.csv$", "")
    usd = F.replace(bare, F.lit("usd_interim"), F.lit("interim_usd"))
    return F.replace(usd, F.lit("eur_interim"), F.lit("interim_eur"))
