"""Clashing column names, unequal vectors, empty tables and histograms that greedy plans serve badly."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesift.llm import bitsliced, kmeans_tree, lines, mixing, neardup, packing, simhash, toxicity, warc

LINE = "one line of words that is the same in both of the texts"


def clashing(spark, *names):
    rows = [(k, f"{LINE} {'x' * (k % 3)}\nalone {k} {k * k} text {k * 7}", "src0", f"kept{k}") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, own string")
    return docs.select("doc_id", "text", "source", *[F.col("own").alias(n) for n in names])


def own_values(df, names):
    return {tuple(r[n] for n in names) == (f"kept{r['doc_id']}",) * len(names) for r in df.collect()}


HELD = ("rank", "key", "_row", "_h", "_id", "_lines", "_hash", "_range", "_order", "held", "fp", "stream_", "_first", "n")


@pytest.mark.parametrize("apply", [
    lambda d: mixing.mix(d, {"src0": 1.0}), lambda d: mixing.in_mixed_order(d, {"src0": 1.0}), lines.without_repeated_lines,
    simhash.near_duplicate_groups, simhash.one_per_group, neardup.one_per_group,
    lambda d: packing.pack(d.withColumn("length", F.lit(5).cast("long"))),
    lambda d: packing.pack_in_order(d.withColumn("length", F.lit(5).cast("long")).withColumn("at", F.col("doc_id")), "at")])
def test_columns_of_any_name_pass_through(spark, apply):
    out = apply(clashing(spark, *HELD))
    assert set(HELD) <= set(out.columns)
    assert own_values(out, HELD) == {True}


def test_mixing_replaces_the_columns_it_adds_and_keeps_them_in_ordering(spark):
    docs = clashing(spark, "block", "stream", "position")
    mixed = mixing.mix(docs, {"src0": 1.0})
    assert sorted(r["position"] for r in mixed.collect()) == list(range(12))
    assert own_values(mixing.in_mixed_order(docs, {"src0": 1.0}), ("block", "stream", "position")) == {True}


@pytest.mark.parametrize("search", [bitsliced.top_k, kmeans_tree.search])
def test_vectors_of_unequal_length_are_an_error(spark, search):
    rows = [(k, [0.1 * k, 0.2, 0.3]) for k in range(1, 9)] + [(9, [0.5] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    with pytest.raises(ValueError, match="3 and of 7"):
        search(df, F.col("vec_id") % 2 == 0)


@pytest.mark.parametrize("search", [bitsliced.top_k, kmeans_tree.search])
def test_searches_of_empty_tables(spark, search):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert search(df, F.col("vec_id") % 2 == 0).collect() == []


def test_bit_slices_sum_and_select_as_integers_do():
    rng = np.random.default_rng(3)
    for rows, dims, size in ((1, 1, 1), (63, 5, 300), (200, 9, 4000), (64, 3, 0)):
        values, weights = rng.integers(-size, size + 1, (rows, dims)), rng.integers(-size, size + 1, dims)
        block = bitsliced.SlicedBlock(*bitsliced.SlicedBlock.stored(values))
        at, scores = block.top(weights, 5)
        exact = values @ weights
        assert (exact[at] == scores).all()
        assert set(at) >= set(np.flatnonzero(exact > np.sort(exact)[-min(5, rows)]))


def test_signed_digits_give_the_number_back():
    for w in range(-600, 600):
        digits = bitsliced.signed_digits(w)
        assert sum(sign << shift for shift, sign in digits) == w
        assert all(b - a > 1 for (a, _), (b, _) in zip(digits, digits[1:], strict=False))


def test_every_other_term_is_swapped_in():
    swaps = toxicity.identity_swaps(toxicity.IDENTITY_TERMS)
    assert all(set(swaps[t]) == set(group) - {t} for group in toxicity.IDENTITY_TERMS for t in group)


@pytest.mark.parametrize("name", ["uniform small", "uniform", "log-normal", "middle"])
def test_plan_takes_no_more_sequences_than_best_fit(name):
    rng = np.random.default_rng(1)
    lengths = {"uniform small": lambda: rng.integers(1, 2049, 4000), "uniform": lambda: rng.integers(1, 2049, 300_000),
               "log-normal": lambda: np.clip(np.exp(rng.normal(6, 1, 300_000)), 1, 2048).astype(int),
               "middle": lambda: rng.integers(400, 900, 5000)}[name]()
    counts = Counter(lengths.tolist())
    plan = packing.plan_sequences(counts)
    placed = Counter()
    for pattern, times in plan.items():
        assert sum(pattern) <= 2048
        for k in pattern:
            placed[k] += times
    assert placed == counts
    assert sum(plan.values()) <= sum(packing.best_fit(counts, 2048).values())
    if name.startswith("uniform"):
        program = packing.solve_configurations(counts, 2048, dict.fromkeys(counts, 1.0))
        assert sum(len(p) * n for p, n in program.items()) > 0.9 * len(lengths)


def test_packing_of_an_empty_table(spark):
    pieces = spark.createDataFrame([], "doc_id long, length long, at long")
    assert packing.pack(pieces).count() == packing.pack_in_order(pieces, "at").count() == 0


def test_archives_of_null_ids_and_very_long_pages(spark):
    rows = [(None, "u", "a"), (1, None, None), (2, "u", "y" * 3_000_000), (3, "u", "y" * 3_000_000), (4, "u", "")]
    got = {r["page_id"]: r for r in warc.archived_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3]["refers_to"] == 2 and got[3]["payload_bytes"] == 3_000_000 and got[4]["refers_to"] == 1
    assert got[None]["record_type"] == "response"
