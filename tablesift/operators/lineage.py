"""Entity-ID changes: which IDs belong together and which one is the newest.

Edges ``old_id -> new_id @ change_date`` may form chains, branches and cycles.
The job is built from aggregates and joins whose number of rounds grows with the
logarithm of the longest chain:

1. each old ID keeps its successor of greatest (has date, date, id);
2. pointer doubling takes every ID to the end of its successor chain;
3. only the edges that were *not* chosen can still link two chains, so the
   connected components are computed on chain ends, a far smaller graph.

A round is one job: what decides about the next round (rows still moving, whether an edge
has changed) is observed while the round's checkpoint is written.

Hot IDs: every grouping is a min / max with map-side combine, and every join has
one side unique on its key, so adaptive execution can split the other one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_timestamp
from ..session import checkpoint, observed_checkpoint


@dataclass(frozen=True)
class Lineage:
    """``ids``: id.  ``newest``: id, newest_id.  ``rows``: input rows + newest_id."""

    ids: DataFrame
    newest: DataFrame
    rows: DataFrame


def build_edges(changes: DataFrame) -> DataFrame:
    """Distinct (old_id, new_id) with the newest date; rows without both ends drop out."""
    if "change_date" in changes.columns:
        day = as_timestamp(F.col("change_date"), changes.schema["change_date"].dataType)
    else:
        day = F.lit(None).cast("timestamp")
    return (
        changes.select("old_id", "new_id", day.alias("change_date"))
        .where("old_id IS NOT NULL AND new_id IS NOT NULL")
        .groupBy("old_id", "new_id")
        .agg(F.max("change_date").alias("change_date"))
    )


def successors(edges: DataFrame) -> DataFrame:
    """Per old ID the new ID with a date, the latest date, the greatest ID."""
    order = F.struct(
        F.col("change_date").isNotNull(), F.col("change_date"), F.col("new_id").cast("string")
    )
    return edges.groupBy(F.col("old_id").alias("id")).agg(F.max_by("new_id", order).alias("next"))


def terminal_ids(step: DataFrame) -> DataFrame:
    """Follow (id, next) to the end of each chain: (id, terminal).

    IDs on or before a cycle get the smallest ID of that cycle.  Each round joins
    only the IDs that are still moving and doubles their stride.
    """
    moving, seen = observed_checkpoint(step.select("id", "next", F.col("id").alias("least")), n=F.count(F.lit(1)))
    finished = moving.select("id", F.col("next").alias("terminal")).where("false")
    n_moving = seen["n"]
    stride = 1
    while n_moving:
        ahead = moving.select(
            F.col("id").alias("next"), F.col("next").alias("far"), F.col("least").alias("seen"),
            F.lit(None).cast(moving.schema["next"].dataType).alias("end"),
        ).unionByName(
            finished.select(F.col("id").alias("next"), F.col("terminal").alias("end")),
            allowMissingColumns=True,
        )
        joined, seen = observed_checkpoint(moving.join(ahead, "next", "left"), left=F.count("far"))
        ended = joined.where("far IS NULL")
        finished = finished.unionByName(ended.select("id", F.coalesce("end", "next").alias("terminal")))
        moving = joined.where("far IS NOT NULL").select(
            "id", F.col("far").alias("next"), F.least("least", "seen").alias("least")
        )
        stride *= 2
        left = seen["left"]
        if left == n_moving and stride >= left:
            # nobody reached an end and the stride covers every cycle: the least ID
            # seen from the node landed on is the least of its cycle
            on_cycle = moving.select(F.col("id").alias("next"), F.col("least").alias("terminal"))
            return finished.unionByName(moving.join(on_cycle, "next").select("id", "terminal"))
        n_moving = left
    return finished


def connected_groups(links: DataFrame) -> DataFrame:
    """(id, group) for an undirected graph (a, b); the group is its smallest ID.

    Alternates two rewirings until nothing changes, which is when only stars are left: every node sends its larger
    neighbours, then its smaller ones, to the smallest neighbour it knows.  Whether edges have changed is told by their number and
    by sum and exclusive-or of their hashes.
    """
    mark = F.xxhash64("hi", "lo")
    marks = {"n": F.count(F.lit(1)), "total": F.sum(mark.cast("decimal(38,0)")), "xor": F.bit_xor(mark)}
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    edges, seen = observed_checkpoint(links.where("a <> b").select(hi, lo).distinct(), **marks)
    before = None
    while seen["n"] and seen != before:
        before = seen
        both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("m"))
        least = least.select("node", F.least("node", "m").alias("m"))
        wide = (
            edges.join(least, edges["lo"] == least["node"])
            .select("hi", F.col("m").alias("lo"))
            .where("hi <> lo")
            .distinct()
        )
        near = wide.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("m"))
        ends = F.explode(F.array("hi", "lo")).alias("hi")
        edges, seen = observed_checkpoint(
            wide.join(near, wide["hi"] == near["node"])
            .select(ends, F.col("m").alias("lo"))
            .where("hi <> lo")
            .distinct(),
            **marks,
        )
    roots = edges.select(F.col("lo").alias("id"), F.col("lo").alias("group"))
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("group")).unionByName(roots).distinct()


def resolve_lineage(changes: DataFrame, seeds: DataFrame | Sequence[str]) -> Lineage:
    """All IDs linked to the seeds, their newest ID, and the change rows that touch them.

    Runs eagerly round by round (reliable checkpoints); the three results are lazy.
    """
    if not isinstance(seeds, DataFrame):
        listed = [(s,) for s in seeds if s is not None]
        seeds = changes.sparkSession.createDataFrame(listed, changes.select("old_id").schema)
    seeds = seeds.select(F.col(f"`{seeds.columns[0]}`").alias("id")).where("id IS NOT NULL").distinct()

    edges = checkpoint(build_edges(changes))
    step = successors(edges)
    ends = terminal_ids(step)
    # every ID in the graph with its chain end; IDs without a successor are their own
    nodes = edges.select(F.col("old_id").alias("id")).union(edges.select("new_id")).distinct()
    newest = checkpoint(
        nodes.join(ends, "id", "left").select(
            "id", F.coalesce("terminal", "id").alias("newest_id")
        )
    )
    by_end = newest.select("id", F.col("newest_id").alias("end"))
    old = by_end.select(F.col("id").alias("old_id"), F.col("end").alias("a"))
    new = by_end.select(F.col("id").alias("new_id"), F.col("end").alias("b"))
    spare = edges.join(step.select(F.col("id").alias("old_id"), F.col("next").alias("new_id")),
                       ["old_id", "new_id"], "left_anti")
    links = spare.join(old, "old_id").join(new, "new_id").select("a", "b")
    groups = connected_groups(links)
    grouped = by_end.join(groups.select(F.col("id").alias("end"), "group"), "end", "left").select(
        "id", F.coalesce("group", "end").alias("group")
    )
    wanted = grouped.join(seeds, "id", "left_semi").select("group").distinct()
    found = grouped.join(wanted, "group", "left_semi").select("id")
    ids = checkpoint(found.union(seeds).distinct())
    resolved = ids.join(newest, "id", "left").select(
        "id", F.coalesce("newest_id", "id").alias("newest_id")
    )

    by_old = resolved.select(F.col("id").alias("_old"), F.col("newest_id").alias("_by_old"))
    by_new = resolved.select(F.col("id").alias("_new"), F.col("newest_id").alias("_by_new"))
    rows = (
        changes.join(by_old, changes["old_id"] == by_old["_old"], "left")
        .join(by_new, changes["new_id"] == by_new["_new"], "left")
        .where("_old IS NOT NULL OR _new IS NOT NULL")
        .withColumn("newest_id", F.coalesce("_by_old", "_by_new", "new_id"))
        .drop("_old", "_new", "_by_old", "_by_new")
    )
    return Lineage(ids, resolved, rows)
