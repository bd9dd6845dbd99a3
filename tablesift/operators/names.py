"""Company-name matching as joins.

A search ends at the first tier that holds a name at the cut-off: an equal name, the same three
letters, a shared word, the same first letter, a similar length, all names. The tiers run as stages,
each over blocks of equal keys whose pairs are predicted from counts per key; a stage that would score too many
is left out together with those after it. Resolved searches leave by an anti-join. Scorers of word sets have their full
scores found beforehand by an equi-join on rare words: a search with one takes part only in the stages before the tier of that. What is left is
compared with all names by ``name_pairs.qualifying_pairs``, and its pairs are given their tier afterwards. Nothing is
capped or sampled, so the stages decide the time, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scorers import Scorer
from ..functions.text import (
    block_key,
    company_suffixes,
    length_tolerance,
    normalize_name,
    remove_substrings,
    strip_suffix_plain,
    tokens,
)
from ..session import checkpoint
from .name_pairs import (
    DIRECT,
    KEY_COST,
    SET_SCORERS,
    best_pairs,
    block_pairs,
    contained_pairs,
    predicted_rows,
    qualifying_pairs,
    stage_keys,
    wide,
)

#: The stages before the search among all names, with their tiers.
STAGES = {"prefix3": 1, "token": 2, "prefix1": 3}
#: A stage runs if it is predicted to score at most one pair for so many of all.
STAGE_GAIN = 2


def prepare_names(
    df: DataFrame,
    match_column: str,
    return_column: str,
    suffixes: Sequence[str] | None = None,
    order_by: str | None = None,
) -> DataFrame:
    """One row per normalised name: name, match, result.

    Of several rows with one normalised name the last in ``order_by`` stays (default:
    the greatest return value); the choice is an aggregate with map-side combine.
    """
    order = F.struct(F.col(order_by or return_column), F.col(return_column), F.col(match_column))
    return (
        df.select(
            normalize_name(F.col(match_column), suffixes).alias("name"),
            F.struct(
                F.col(match_column).alias("match"), F.col(return_column).alias("result")
            ).alias("row"),
            order.alias("order"),
        )
        .where("name IS NOT NULL")
        .groupBy("name")
        .agg(F.max_by("row", "order").alias("row"))
        .select("name", "row.match", "row.result")
    )


def block_columns(name: Column) -> dict[str, Column]:
    return {
        "prefix3": block_key(name, 3),
        "prefix1": block_key(name, 1),
        "name_len": F.length(name),
        "tokens": tokens(name),
    }


def _block_keys(name: Column) -> Column:
    """(block kind, key) pairs; the empty prefix is no block."""
    prefixes = F.array(
        F.struct(F.lit("prefix3").alias("kind"), block_key(name, 3).alias("key")),
        F.struct(F.lit("prefix1").alias("kind"), block_key(name, 1).alias("key")),
    )
    words = F.transform(
        F.array_distinct(tokens(name)), lambda t: F.struct(F.lit("token").alias("kind"), t.alias("key"))
    )
    whole = F.array(F.struct(F.lit("length").alias("kind"), F.lit("").alias("key")))
    return F.concat(F.filter(prefixes, lambda b: b["key"] != ""), words, whole)


def _blocks_in_band(searches: DataFrame, names: DataFrame) -> DataFrame:
    """Per search the block kinds that hold a name of similar length: search, in_band.

    Works on blocks with the distinct lengths of their names - never on pairs of names.
    """
    known = (
        names.select(F.explode(_block_keys(F.col("name"))).alias("b"), F.length("name").alias("len"))
        .select("b.kind", "b.key", "len")
        .distinct()
        .groupBy("kind", "key")
        .agg(F.collect_list("len").alias("lens"))  # no more than the longest name has characters
    )
    wanted = searches.select("search", F.explode(_block_keys(F.col("search"))).alias("b")).select("search", "b.kind", "b.key")
    length = F.length("search")
    near = F.exists("lens", lambda n: (n > 0) & (F.abs(n - length) <= length_tolerance(length)))
    return (
        wanted.join(known, ["kind", "key"])
        .where(near)
        .groupBy("search")
        .agg(F.collect_set("kind").alias("in_band"))  # four kinds at most
    )


def with_tier(scored: DataFrame, names: DataFrame, band: DataFrame | None = None) -> DataFrame:
    """Adds the search tier each pair belongs to; ``band`` is ``_blocks_in_band`` of the searches, if at hand.

    1 same three-letter prefix, 2 a shared word, 3 same first letter, 4 similar
    length, 5 the rest.  Tiers 1-4 only admit names of similar length, unless the
    block has none of that length at all; then it admits the whole block.
    """
    length = F.length("search")
    near = F.abs(F.length("name") - length) <= length_tolerance(length)
    scored = scored.withColumn("near", near)
    if band is None:
        # only searches with a pair outside the band can need the exception
        far = scored.where("NOT near").select("search").distinct()
        band = _blocks_in_band(far, names)
    out = scored.join(band, "search", "left")

    def admits(kind: str) -> Column:
        held = F.coalesce(F.array_contains("in_band", kind), F.lit(False))
        return F.col("near") | ~held

    def same(length: int) -> Column:
        key = block_key(F.col("search"), length)
        return (key != "") & (key == block_key(F.col("name"), length))

    shared = F.arrays_overlap(tokens(F.col("search")), tokens(F.col("name")))
    tier = (
        F.when(same(3) & admits("prefix3"), 1)
        .when(shared & admits("token"), 2)
        .when(same(1) & admits("prefix1"), 3)
        .when(admits("length"), 4)
        .otherwise(5)
    )
    return out.select("search", "name", "score", tier.alias("tier"))


def _full_scores(band: DataFrame, names: DataFrame, scorer: str | Scorer | None, cut_off: float, every: int) -> DataFrame | None:
    """(search, name, score, tier) of the pairs that score 100, for each search those of their first tier; None if the scorer or the words do not allow it."""
    if callable(scorer) or scorer not in SET_SCORERS or cut_off > 100:
        return None
    pairs = contained_pairs(band, names, every / KEY_COST)
    if pairs is None:
        return None
    tiers = with_tier(pairs.withColumn("score", F.lit(100.0)), names, band)
    first = Window.partitionBy("search").orderBy("tier")
    return checkpoint(tiers.withColumn("_rank", F.rank().over(first)).where("_rank = 1").drop("_rank"))


def tiered_pairs(searches: DataFrame, names: DataFrame, scorer: str | Scorer | None, cut_off: float,
                 guard: tuple[str, float] | None = None, direct_pairs: int = DIRECT) -> DataFrame:
    """(search, name, score, tier) of the pairs at the cut-off, for each search the best of its first tier at least."""
    if callable(scorer) and guard is None:
        raise ValueError("a callable scorer needs guard=(scorer name, cut-off)")
    searches, found = checkpoint(searches), []
    every = searches.count() * names.count()
    if every > direct_pairs:
        band = checkpoint(searches.join(_blocks_in_band(searches, names), "search", "left"))
        full = _full_scores(band, names, scorer, cut_off, every)
        if full is not None:
            band = checkpoint(band.join(full.select("search", F.col("tier").alias("first")).distinct(), "search", "left"))
        for kind, tier in [*STAGES.items(), (None, 4)]:
            if full is not None:  # no score is better, so the tier of a full one needs no stage
                found.append(full.join(band.where(F.col("first") == tier), "search", "left_semi"))
                band = band.where(F.col("first").isNull() | (F.col("first") > tier))
            every = band.count() * names.count()
            if kind is None or every <= direct_pairs:
                break
            left, right = stage_keys(band, names, kind)
            if STAGE_GAIN * predicted_rows(left, right, ["key", "tile"]) > every:
                break  # and no later stage, as it must not win over this one
            hits = block_pairs(left, right, ["key", "tile"], scorer, cut_off, guard if callable(scorer) else None, best=True)
            hits = checkpoint(hits.distinct())  # some share several words
            found.append(hits.withColumn("tier", F.lit(tier)))
            band = checkpoint(band.join(hits.select("search").distinct(), "search", "left_anti"))
        searches = band.select("search")
    if every or not found:
        found.append(with_tier(checkpoint(qualifying_pairs(searches, names, scorer, cut_off, guard, direct_pairs)), names))
    return reduce(DataFrame.unionByName, found)


def match_names(
    searches: DataFrame,
    df: DataFrame,
    match_column: str,
    return_column: str,
    cut_off: float = 50,
    suffixes: Sequence[str] | None = None,
    scorer: str | Scorer | None = None,
    order_by: str | None = None,
    guard: tuple[str, float] | None = None,
    direct_pairs: int = DIRECT,
) -> DataFrame:
    """Best reference names per search name.

    An equal normalised name scores 100 and ends the search.  Otherwise the first
    tier (see ``with_tier``) with a score at the cut-off wins, and all ties of its
    best score are returned.  Unmatched names give one row of nulls with score 0.

    Output: Search_string, BestMatch, Score, <match_column>, <return_column>; equal
    search strings are one.  The searches, the prepared names and the pairs at the cut-off are
    checkpointed, so each is computed once.  Up to ``direct_pairs`` pairs of names are
    compared without stages; the result is the same.
    """
    names = prepare_names(df, match_column, return_column, suffixes, order_by)
    names = checkpoint(names.repartition(wide(df), "name"))
    wanted = searches.select(
        normalize_name(F.col(f"`{searches.columns[0]}`"), suffixes).alias("search")
    ).where("search IS NOT NULL").distinct()
    wanted = checkpoint(wanted)
    only = names.select("name")
    exact = wanted.join(only, wanted["search"] == only["name"], "left_semi").select(
        "search", F.col("search").alias("name"), F.lit(100.0).alias("score")
    )
    rest = wanted.join(only, wanted["search"] == only["name"], "left_anti")
    scored = tiered_pairs(rest, only, scorer, cut_off, guard, direct_pairs)
    # rank() = 1 is trimmed on the map side, so only ties travel
    best = Window.partitionBy("search").orderBy("tier", F.col("score").desc())
    fuzzy = scored.withColumn("_rank", F.rank().over(best)).where("_rank = 1")
    hits = exact.unionByName(fuzzy.select("search", "name", "score")).join(names, "name")
    return _report(wanted, hits, match_column, return_column)


def _report(wanted: DataFrame, hits: DataFrame, match_column: str, return_column: str) -> DataFrame:
    return wanted.join(hits, "search", "left").select(
        F.col("search").alias("Search_string"),
        F.col("name").alias("BestMatch"),
        F.coalesce("score", F.lit(0.0)).alias("Score"),
        F.col("match").alias(match_column),
        F.col("result").alias(return_column),
    )


def match_names_plain(
    searches: DataFrame,
    df: DataFrame,
    match_column: str,
    return_column: str,
    cut_off: float = 50,
    suffixes: Sequence[str] | None = None,
    remove: Sequence[str] | None = None,
    scorer: str | Scorer | None = None,
    order_by: str | None = None,
    ties: str = "first",
    guard: tuple[str, float] | None = None,
) -> DataFrame:
    """Best match over all reference rows, without tiers and without name cleaning.

    Names are lower-cased; ``suffixes`` come off both sides, ``remove`` drops
    substrings from the reference only.  In ``order_by`` (default: the return column)
    the last of equal names answers an exact hit and the first best a fuzzy one;
    ``ties="all"`` returns every best row instead.
    """
    if ties not in ("first", "all"):
        raise ValueError("ties must be 'first' or 'all'")
    name = F.lower(F.col(match_column))
    search = F.lower(F.col(f"`{searches.columns[0]}`"))
    if suffixes:
        name, search = strip_suffix_plain(name, suffixes), strip_suffix_plain(search, suffixes)
    if remove:
        name = remove_substrings(name, remove)
    rows = df.select(
        name.alias("name"),
        F.struct(F.col(order_by or return_column).alias("o"), F.col(return_column).alias("result"),
                 F.col(match_column).alias("match")).alias("row"),
    ).where("name IS NOT NULL")
    names = checkpoint(
        rows.groupBy("name")
        .agg(F.min("row").alias("head"), F.max("row").alias("tail"))
        .repartition(wide(df), "name")
    )
    wanted = search.alias("search")
    wanted = searches.select(wanted).where("search IS NOT NULL").distinct()
    only = names.select("name")
    exact = wanted.join(only, wanted["search"] == only["name"], "left_semi").select(
        "search", F.col("search").alias("name"), F.lit(100.0).alias("score")
    )
    rest = wanted.join(only, wanted["search"] == only["name"], "left_anti").where("search <> ''")
    pairs = checkpoint(best_pairs(rest, only.where("name <> ''"), scorer, cut_off, guard))
    if ties == "all":
        best = Window.partitionBy("search").orderBy(F.col("score").desc())
        fuzzy = pairs.withColumn("_rank", F.rank().over(best)).where("_rank = 1").drop("_rank")
        hits = exact.unionByName(fuzzy).join(rows.distinct(), "name")
        hits = hits.select("search", "name", "score", "row.match", "row.result")
        return _report(wanted, hits, match_column, return_column).distinct()
    # the single winner is an aggregate: greatest score, then first in order
    winner = (
        pairs.join(names, "name")
        .groupBy("search")
        .agg(F.min_by(F.struct("name", "score", "head"), F.struct(-F.col("score"), "head")).alias("w"))
        .select("search", "w.name", "w.score", F.col("w.head").alias("row"))
    )
    exact = exact.join(names, "name").select("search", "name", "score", F.col("tail").alias("row"))
    hits = exact.unionByName(winner).select("search", "name", "score", "row.match", "row.result")
    return _report(wanted, hits, match_column, return_column)


def best_matches(matches: DataFrame) -> DataFrame:
    """Rows of the best score per search string, distinct."""
    best = Window.partitionBy("Search_string").orderBy(F.col("Score").desc())
    ranked = matches.withColumn("_rank", F.rank().over(best)).where("_rank = 1")
    return ranked.drop("_rank").distinct()


def search_company_names(
    searches: DataFrame,
    df: DataFrame,
    match_column: str = "name",
    return_column: str = "entity_id",
    cut_off: float = 90.1,
    suffixes: Sequence[str] | None = None,
    scorer: str | Scorer | None = "WRatio",
) -> DataFrame:
    """The company search job: match, keep the best score per name, distinct rows."""
    suffixes = company_suffixes() if suffixes is None else suffixes
    return best_matches(
        match_names(searches, df, match_column, return_column, cut_off, suffixes, scorer)
    )
