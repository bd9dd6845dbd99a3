"""Search in the column dictionary, date-column list and country codes; heading maps."""

from __future__ import annotations

import operator
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import contains_word, first_line, letters_only
from ..operators.filters import BROADCAST_BYTES

DICTIONARY_COLUMNS = ("Data Product", "Table", "Column", "Definition")
INLINE_WORDS = 100  # search words that are written into the plan


def restrict_products(df: DataFrame, available: DataFrame | None) -> DataFrame:
    """Only products that a catalog holds."""
    if available is None:
        return df
    return df.join(available.select("Data Product").distinct(), "Data Product", "left_semi")


def _narrow(df: DataFrame, product: str | None, table: str | None) -> DataFrame:
    """Product by equality, table by equality or else by containment."""
    if product is not None:
        df = df.where(F.col("`Data Product`") == product)
    if table is not None:
        exact = F.col("Table") == table
        any_exact = df.agg(F.coalesce(F.bool_or(exact), F.lit(False)))
        df = df.withColumn("_exact", any_exact.scalar()).where(
            exact | (~F.col("_exact") & contains_word(F.col("Table"), table))
        ).drop("_exact")
    return df


def _searched(product: str | None, table: str | None, columns: Sequence[str] | None) -> list[str]:
    enabled = list(columns or DICTIONARY_COLUMNS)
    off = {"Data Product"} if product is not None else set()
    off |= {"Table"} if table is not None else set()
    return [c for c in enabled if c not in off]


def _hit(columns: Sequence[str], word: Column, letters: bool, exact: bool) -> Column:
    tests = []
    for name in columns:
        value = F.col(f"`{name}`").cast("string")
        value = letters_only(value) if letters else value
        test = F.coalesce(value == word, F.lit(False)) if exact else contains_word(value, word)
        tests.append(test)
    return reduce(operator.or_, tests, F.lit(False))


def search_dictionary(
    dictionary: DataFrame,
    word: str | None = None,
    columns: Sequence[str] | None = None,
    letters: bool = False,
    exact: bool = False,
    product: str | None = None,
    table: str | None = None,
    available: DataFrame | None = None,
) -> DataFrame:
    """Dictionary rows with the word in any enabled column.

    ``letters`` compares letters and digits only but returns the original rows.
    """
    df = _narrow(restrict_products(dictionary, available), product, table)
    if word is None:
        return df
    key = letters_only(F.lit(word)) if letters else F.lit(word)
    return df.where(_hit(_searched(product, table, columns), key, letters, exact))


def search_dictionary_words(
    dictionary: DataFrame,
    words: Sequence[str] | DataFrame,
    columns: Sequence[str] | None = None,
    letters: bool = False,
    exact: bool = False,
    product: str | None = None,
    table: str | None = None,
    available: DataFrame | None = None,
) -> DataFrame:
    """Every (dictionary row, word) hit, tagged with ``search_word``.

    ``words`` is a list of any length or a DataFrame, whose first column is taken. A few
    words are a literal array, so the dictionary is read once and not joined; more are
    joined by equality on the cell values, or looked for by an automaton that reads each
    distinct cell once (it needs pyahocorasick on the executors). Null words find nothing.
    """
    df = _narrow(restrict_products(dictionary, available), product, table)
    searched = _searched(product, table, columns)
    if not isinstance(words, DataFrame):
        words = [w for w in dict.fromkeys(words) if w is not None]
        if len(words) <= INLINE_WORDS:
            listed = F.array(*[letters_only(F.lit(w)) if letters else F.lit(w) for w in words])
            hits = F.filter(listed, lambda w: _hit(searched, w, letters, exact))
            return df.withColumn("search_word", F.explode(hits))
        words = df.sparkSession.createDataFrame([(w,) for w in words], "word string")
    words = words.select(F.col(f"`{words.columns[0]}`").cast("string").alias("word")).dropna().distinct()
    words = words.select(letters_only(F.col("word")).alias("search_word") if letters else F.col("word").alias("search_word"))
    if not searched:
        return df.withColumn("search_word", F.lit(None).cast("string")).where("false")
    cells = [F.col(f"`{c}`").cast("string") for c in searched]
    cells = F.filter(F.array(*[letters_only(c) if letters else c for c in cells]), lambda c: c.isNotNull())
    if exact:
        found = df.withColumn("_cell", F.explode(F.array_distinct(cells)))
        return found.join(words, F.col("_cell") == F.col("search_word")).drop("_cell")
    hits = _word_hits(df, cells, words)
    found = df
    for i, name in enumerate(searched):
        cell = F.col(f"`{name}`").cast("string")
        cell = F.lower(letters_only(cell) if letters else cell)
        found = found.join(hits.select(F.col("cell").alias(f"_cell{i}"), F.col("found").alias(f"_found{i}")), cell == F.col(f"_cell{i}"), "left")
    every = F.flatten(F.array_compact(F.array(*[F.col(f"_found{i}") for i in range(len(searched))])))
    found = found.withColumn("_word", F.explode(F.array_distinct(every)))
    return found.select(*[F.col(f"`{c}`") for c in df.columns], F.col("_word.search_word").alias("search_word"))


def _word_hits(df: DataFrame, cells: Column, words: DataFrame) -> DataFrame:
    """(cell, found): each distinct lower-case cell with the words it holds, as (search_word, its number among equal ones).

    The cells are read by an automaton of all words, once each; words of more than ``BROADCAST_BYTES`` are dealt
    into several automata.
    """
    texts = df.select(F.explode(cells).alias("cell")).select(F.lower("cell").alias("cell")).distinct()
    number = F.row_number().over(Window.partitionBy("search_word").orderBy(F.lit(0)))
    words = words.select("search_word", F.lower("search_word").alias("word"), number.alias("number"))
    size = words.agg(F.sum(F.octet_length("word") + 64)).first()[0] or 0
    groups = max(1, -(-size // BROADCAST_BYTES))
    found = []
    for group in range(groups):
        mine = words.where(F.pmod(F.xxhash64("word"), F.lit(groups)) == group)
        listed = df.sparkSession.sparkContext.broadcast([tuple(r) for r in mine.collect()])
        found.append(texts.mapInPandas(_searcher(listed), "cell string, search_word string, number int"))
    hit = F.struct("search_word", "number")
    return reduce(DataFrame.unionByName, found).groupBy("cell").agg(F.collect_list(hit).alias("found"))


def _searcher(listed):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton, empty = ahocorasick.Automaton(), []
        for search_word, word, number in listed.value:
            held = automaton.get(word, []) if word else empty
            held.append((search_word, number))
            if word:
                automaton.add_word(word, held)
        automaton.make_automaton()
        for batch in batches:
            rows = []
            for cell in batch["cell"]:
                hits = set(empty)
                if len(automaton):
                    for _, held in automaton.iter(cell):
                        hits.update(held)
                rows += [(cell, word, number) for word, number in hits]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            cell, word, number = (pd.Series(list(c), dtype=object) for c in columns)
            yield pd.DataFrame({"cell": cell, "search_word": word, "number": number.astype("int32")})

    return search



def date_columns(
    dates: DataFrame,
    product: str | None = None,
    table: str | None = None,
    available: DataFrame | None = None,
) -> DataFrame:
    return _narrow(restrict_products(dates, available), product, table)


def search_country_codes(
    codes: DataFrame, word: str | None = None, columns: Sequence[str] = ("Country", "Code")
) -> DataFrame:
    if word is None:
        return codes
    return codes.where(_hit(columns, F.lit(word), False, False))


def resolve_id_column(dictionary: DataFrame, word: str | None = None) -> str:
    """The one ID column a search finds; several need an exact name."""
    found = search_dictionary(dictionary, word, columns=["Column"]) if word else dictionary
    names = found.select("Column").distinct()
    some = [r["Column"] for r in names.orderBy("Column").limit(10).collect()]
    if not some:
        raise ValueError("no ID column found for this table")
    if len(some) == 1:
        return some[0]
    if word and not names.where(F.col("Column") == word).isEmpty():
        return word
    raise ValueError(f"several ID columns found, name one; the first are {some}")


def normalize_headings(headings: DataFrame, column: str = "heading") -> DataFrame:
    """Distinct first lines of headings with their comparison key."""
    line = first_line(F.col(f"`{column}`"))
    return (
        headings.select(line.alias("heading"))
        .where("heading IS NOT NULL AND heading <> 'Unnamed: 0'")
        .distinct()
        .withColumn("letters_only", letters_only(F.col("heading")))
    )


def map_headings(headings: DataFrame, dictionary: DataFrame, column: str = "heading") -> DataFrame:
    """Dictionary rows per heading, with the product's number of distinct headings.

    ``unique_headings`` is counted by an aggregate and joined back by product, so a
    product with very many rows is not gathered in one place.  Order by it,
    descending, then by product, to see the best product first.
    """
    keyed = dictionary.withColumn("letters_only", letters_only(F.col("Column")))
    # a name without letters has an empty key, which matches nothing
    found = keyed.where("letters_only <> ''").join(normalize_headings(headings, column), "letters_only")
    counts = found.groupBy("Data Product").agg(F.count_distinct("heading").alias("unique_headings"))
    return found.join(counts, "Data Product")


def order_by_coverage(mapped: DataFrame) -> DataFrame:
    return mapped.orderBy(F.col("unique_headings").desc(), "Data Product")


def unmatched_headings(headings: DataFrame, dictionary: DataFrame, column: str = "heading") -> DataFrame:
    keyed = dictionary.select(letters_only(F.col("Column")).alias("letters_only")).where("letters_only <> ''")
    return normalize_headings(headings, column).join(keyed, "letters_only", "left_anti").select("heading")
