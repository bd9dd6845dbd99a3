"""Chat formatting: collapse cumulative snapshots, then render what is left.

Chat logs hold a conversation again and again while it grows. A conversation is dropped
if its turns are the first turns of a longer one, or all the turns of one with a smaller
conv_id; the maximal ones are rendered.

**Prefix hashes.** Turn *i* of a conversation has two XXH64 hashes of (i, role, text); the
hash of a prefix is the exclusive-or of its turns' hashes, 128 bits that a running window
gives for every prefix. A conversation is a prefix of another if its full hash is among
the other's prefix hashes: an anti-join of full hashes against shorter prefixes.

**Scale.** Conversations are cut into ranges of ``PART`` turn numbers that are numbered
and hashed on their own and put together from one row per range, so a conversation that
holds a third of all rows is spread over tasks. The text of a turn is shuffled only to be
rendered. A rendered conversation has a row for each ``PART`` turns; joining its parts in
order gives the whole.

Turns are ordered by turn, role and text. A null role or text is rendered as empty, and
differs from an empty one for the comparison; a null turn comes first; rows with a null
conv_id are one conversation, whose id counts as largest. Repeated rows are turns of
their own. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import require, saved

PART = 256
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"


def _numbered(turns: DataFrame) -> DataFrame:
    """Adds i (place in the conversation, from 0), part and the hashes h1 and h2 of each prefix."""
    part = F.coalesce(F.floor(F.col("turn") / PART).cast("long"), F.lit(-(1 << 62)))
    rows = turns.select("conv_id", "turn", "role", "text").withColumn("range", part)
    counts = rows.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = saved(counts.select(F.col("conv_id").alias("c"), F.col("range").alias("r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("past")), "ranges")
    inner = Window.partitionBy("conv_id", "range").orderBy("turn", "role", "text")
    rows = rows.withColumn("k", F.row_number().over(inner) - 1)
    rows = rows.join(counts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("range") == F.col("r")))
    rows = rows.withColumn("i", F.col("past") + F.col("k"))
    return rows.select("conv_id", "range", "i", *[
        F.xxhash64(F.lit(seed), "i", F.col("role").isNull(), "role", F.col("text").isNull(), "text").alias(name)
        for seed, name in ((0, "h1"), (1, "h2"))], F.col("turn"), "role", "text")


def _prefix_hashes(numbered: DataFrame) -> DataFrame:
    """conv_id, i and the hashes p1, p2 of the turns up to i."""
    rows = numbered.select("conv_id", "range", "i", "h1", "h2")
    sums = rows.groupBy("conv_id", "range").agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = saved(sums.select(F.col("conv_id").alias("c"), F.col("range").alias("r"), *[
        F.coalesce(F.bit_xor(h).over(before), F.lit(0)).alias(f"b{h[1]}") for h in ("h1", "h2")]), "sums")
    inner = Window.partitionBy("conv_id", "range").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"q{h[1]}": F.bit_xor(h).over(inner) for h in ("h1", "h2")})
    rows = rows.join(sums, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("range") == F.col("r")))
    return rows.select("conv_id", "i", F.col("q1").bitwiseXOR(F.col("b1")).alias("p1"), F.col("q2").bitwiseXOR(F.col("b2")).alias("p2"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id and turns (their number) of the conversations that stay."""
    require(turns, "conv_id", "turn", "role", "text")
    return _maximal(saved(_numbered(turns).drop("turn", "role", "text"), "turns"))


def _maximal(numbered: DataFrame) -> DataFrame:
    prefixes = saved(_prefix_hashes(numbered), "prefixes")
    lengths = prefixes.groupBy("conv_id").agg(F.max("i").alias("last"))
    lengths = lengths.select(F.col("conv_id").alias("c"), "last")
    marked = prefixes.join(lengths, F.col("conv_id").eqNullSafe(F.col("c")))
    full = marked.where(F.col("i") == F.col("last"))
    shorter = marked.where(F.col("i") < F.col("last")).select("i", "p1", "p2").distinct()
    # of equal conversations the smallest id; min ignores the null one unless it is alone
    full = full.groupBy("i", "p1", "p2").agg(F.min("conv_id").alias("conv_id"))
    kept = full.join(shorter, ["i", "p1", "p2"], "left_anti")
    return kept.select("conv_id", (F.col("i") + 1).alias("turns"))


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(TURN_START), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(TURN_END))


def render_maximal(turns: DataFrame) -> DataFrame:
    """conv_id, turns, part and rendered: the maximal conversations in chat form, ``PART`` turns a row."""
    require(turns, "conv_id", "turn", "role", "text")
    numbered = saved(_numbered(turns), "turns")
    kept = saved(_maximal(numbered), "maximal").select(F.col("conv_id").alias("c"), "turns")
    rows = numbered.join(kept, F.col("conv_id").eqNullSafe(F.col("c")))
    rows = rows.select("conv_id", "turns", "i", F.floor(F.col("i") / PART).cast("int").alias("part"), rendered_turn(F.col("role"), F.col("text")).alias("piece"))
    parts = rows.groupBy("conv_id", "turns", "part").agg(F.sort_array(F.collect_list(F.struct("i", "piece"))).alias("pieces"))
    return parts.select("conv_id", "turns", "part", F.array_join(F.transform("pieces", lambda x: x["piece"]), "").alias("rendered"))
