"""Line deduplication by an exact set-similarity join.

A line is the set of its words (runs of other than ASCII white space, in small letters).
Two lines match at a Jaccard similarity of ``4/5`` or more, and a line is removed if a
line before it, in the order of (doc_id, line number), matches it.

**Classes.** Lines with the same set form a class; only a class's first line enters the
join, all its other lines match that one. So the most common line costs one row.

**Prefix join.** Words become 63-bit codes that sort by rarity: first the rank of the
word's bucket (one of 262,144) by corpus count, then hash bits. Two sets of sizes n and m
that match share one of the rarest n - ceil(4n/5) + 1 codes of each. Those prefix codes
(their upper 32 bits, as a collision here only adds a candidate) are dealt out once and
joined with themselves, with the length filter (4/5 n <= m <= 5/4 n), the positional
filter (from the first shared code on, enough is left of both) and a parity filter (each differing
word flips one bit of a 128-bit sum, and only (n+m)/9 words may differ). What passes is
verified by the words.

**Hot codes.** Where about ``HOT`` or more classes of one length share a code (near copies),
each is first compared with an early one of them. Those that match it are settled (one
earlier match is all it takes) and don't probe again, so a group of near copies costs a
row for each member, not for each pair. Which codes are hot is seen from every eighth
class; that decides who is compared first, not what is found, as all others go through
the join with all classes.

**Style.** All of it is built-in functions, joins and groupings of Spark; no Python runs on the executors. A line's words
become an array of hashes by one lambda and of codes by another, never rows of their own but to be counted.

Null and empty texts stay as they are, as do lines without words. doc_id must be a whole
number (below 2^39, and a text below 2^24 lines, else the job fails); a null one comes
last. Lines at the same place of rows that share a doc_id are not earlier than each other;
rows equal in all columns keep or lose the same lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_marks, require, saved

BITS = 18
BUCKETS = 1 << BITS
HOT = 40
SAMPLED = 8  # one class in so many is counted to find hot codes
LINES = 1 << 24
MARKS = 1 << 22  # bits of the filter for lines to verify
SPACES = "\t\r\f\v"


_hashes: dict[bytes, int] = {}


def _hash_array(words: list[bytes]) -> np.ndarray:
    """Spark's ``xxhash64`` of words, for tests."""
    return np.array([xxhash.xxh64_intdigest(w, seed=42) for w in words], np.uint64)


def _small(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``_ranks`` counts, in plain Python, for tests."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            total += np.bincount(_hash_array(_small(text).split()) & np.uint64(BUCKETS - 1), minlength=BUCKETS)
    yield pa.RecordBatch.from_pydict({"bucket": np.arange(BUCKETS), "n": total})


def _listed(values: np.ndarray, kind: str) -> Column:
    """The numbers as one constant array (folded from its text, as a constant for each is slow to build)."""
    return F.split(F.lit(",".join(map(str, values.tolist()))), ",").cast(f"array<{kind}>")


def _spaced(line: Column) -> Column:
    """The line in small letters with its words parted by spaces."""
    odd = F.contains(line, F.lit(SPACES[0]))
    for space in SPACES[1:]:
        odd = odd | F.contains(line, F.lit(space))
    return F.lower(F.when(odd, F.translate(line, SPACES, " " * len(SPACES))).otherwise(line))


def _hashed(line: Column) -> Column:
    """The hashes of a line's words, repeats included."""
    return F.array_remove(F.transform(F.split(_spaced(line), " "), lambda w: F.xxhash64(w)), F.xxhash64(F.lit("")))


def _counts(docs: DataFrame) -> np.ndarray:
    """How many words each of the buckets has."""
    spaced = F.replace("text", F.lit("\n"), F.lit(" "))
    buckets = F.transform(_hashed(spaced), lambda h: h.bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int"))
    # the array in a step of its own, as one with a lambda is not compiled with the rest; outer, as Spark else tests the array first and makes it twice
    counts = docs.select(buckets.alias("buckets")).select(F.explode_outer("buckets").alias("bucket")).where(F.col("bucket").isNotNull())
    counts = counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    seen, got = np.zeros(BUCKETS, np.int64), counts.toArrow()
    seen[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return seen


def _levels(counts: np.ndarray) -> np.ndarray:
    """The counts on a scale of 1/4 octaves (a byte each, which Spark holds without an object for each)."""
    return np.minimum(np.round(4 * np.log2(counts + 1)), 127).astype(np.int64)


def _ranks(docs: DataFrame) -> np.ndarray:
    """The rank by count of each of the buckets."""
    seen = _counts(docs)
    ranks = np.empty(BUCKETS, np.uint64)
    ranks[np.argsort(seen, kind="stable")] = np.arange(BUCKETS, dtype=np.uint64)
    return ranks


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("hash"), "text")


def _coded(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """doc_id, hash (of the row), no (line number), class c1 and c2, n (0 of a line without words), prefix and two longs of parity bits of each line."""
    table, low = _listed(levels, "tinyint"), F.lit(BUCKETS - 1).cast("long")
    lines = _keyed(docs).select("doc_id", "hash", F.posexplode(F.split("text", "\n")).alias("no", "line"))

    def code(h: Column) -> Column:
        level = F.get(table, h.bitwiseAND(low).cast("int")).cast("long")
        return F.shiftleft(level, 56).bitwiseOR(F.shiftrightunsigned(h, 8))

    codes = F.sort_array(F.array_distinct(F.transform(_hashed(F.col("line")), code)))
    lines = lines.select("doc_id", "hash", "no", codes.alias("codes")).withColumn("n", F.size("codes"))
    # the hash bits of a code alone, which are spread evenly: one names the long, six the bit
    parity = "aggregate(codes, 0L, (a, c) -> if((c & 64) = {}, a ^ shiftleft(1L, cast(c & 63 as int)), a))"
    prefix = F.transform(F.slice("codes", 1, F.col("n") - F.ceil(F.col("n") * 4 / 5).cast("int") + 1), lambda c: F.shiftright(F.shiftleft(c, 32), 32).cast("int"))
    return lines.select("doc_id", "hash", "no", F.xxhash64("codes").alias("c1"), F.xxhash64(F.lit(1), "codes").alias("c2"), "n", prefix.alias("prefix"),
                        F.expr(parity.format(0)).alias("p1"), F.expr(parity.format(64)).alias("p2"))


def _place() -> Column:
    """The order of lines as one number."""
    line = F.when(F.col("no") >= LINES, F.raise_error(F.lit("too many lines in a text"))).otherwise(F.col("no").cast("long"))
    return F.coalesce(F.col("doc_id"), F.lit((1 << 39) - 1)) * LINES + line


def _bit(place: str) -> Column:
    return F.xxhash64(place).bitwiseAND(F.lit(MARKS - 1).cast("long"))


def _marks(places: DataFrame) -> np.ndarray:
    """A bit set, of bounded size, in which every place has its bit."""
    return bit_marks(places, _bit("w"), MARKS)


def _words(ends: DataFrame, docs: DataFrame) -> DataFrame:
    """w, words: the words of the lines at the places ``w``."""
    ends = saved(ends.distinct(), "ends")
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("no", "line"))
    lines = lines.select(_place().alias("place"), "line")
    bit = _bit("place")
    held = F.get(_listed(_marks(ends), "long"), F.shiftright(bit, 6).cast("int"))
    lines = lines.where(F.call_function("bit_get", held, bit.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1)
    words = F.array_distinct(F.array_remove(F.split(_spaced(F.col("line")), " "), ""))
    texts = lines.join(ends, F.col("place") == F.col("w")).select("w", words.alias("words"))
    return saved(texts.distinct(), "words")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("first").alias("w")).union(pairs.select("earlier"))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (first, earlier) of places whose words (``texts``) are 4/5 similar."""
    both = pairs.join(texts.select(F.col("w").alias("w1"), F.col("words").alias("a")), F.col("first") == F.col("w1"))
    both = both.join(texts.select(F.col("w").alias("w2"), F.col("words").alias("b")), F.col("earlier") == F.col("w2"))
    return both.where(F.size(F.array_intersect("a", "b")) * 9 >= (F.size("a") + F.size("b")) * 4).select("first", "earlier")


def _may_match(a: list[Column], b: list[Column]) -> Column:
    """If two classes may match and this may be their first shared code, by n, at, p1 and p2 of each; never with an n below zero."""
    n, at, p1, p2 = a
    n2, at2, q1, q2 = b
    both = n + n2
    differ = F.bit_count(p1.bitwiseXOR(q1)) + F.bit_count(p2.bitwiseXOR(q2))
    return (n * 4 <= n2 * 5) & (n2 * 4 <= n * 5) & ((n - at) * 9 >= both * 4) & ((n2 - at2) * 9 >= both * 4) & (differ * 9 <= both)


def matched_classes(classes: DataFrame, docs: DataFrame) -> DataFrame:
    """first: the first place of each class that matches a class of an earlier one.

    ``classes``: first, n, prefix, p1, p2.
    """
    few = classes.where(F.xxhash64("first").bitwiseAND(F.lit(SAMPLED - 1).cast("long")) == 0)
    few = few.select(F.explode("prefix").alias("code"), "first", "n").groupBy("code", "n").agg(F.count(F.lit(1)).alias("k"), F.min("first").alias("leader"))
    hot = saved(few.where(F.col("k") > HOT // SAMPLED), "hot")
    rows = classes.select(F.explode("prefix").alias("code"), "first", "n")
    hot = hot.select(F.col("code").alias("c"), F.col("n").alias("n2"), "leader")
    led = rows.select("code", "first", "n").join(hot, (F.col("code") == F.col("c")) & (F.col("n") == F.col("n2")) & (F.col("leader") < F.col("first")))
    led = led.select("first", F.col("leader").alias("earlier")).distinct()
    sums = [F.col(c) for c in ("first", "p1", "p2")]
    left = classes.select(*[c.alias(f"{c_}1") for c, c_ in zip(sums, ("f", "a", "b"), strict=True)], "n")
    right = classes.select(*[c.alias(f"{c_}2") for c, c_ in zip(sums, ("f", "a", "b"), strict=True)], F.col("n").alias("n2"))
    led = led.join(left, F.col("first") == F.col("f1")).join(right, F.col("earlier") == F.col("f2"))
    differ = F.bit_count(F.col("a1").bitwiseXOR(F.col("a2"))) + F.bit_count(F.col("b1").bitwiseXOR(F.col("b2")))
    led = led.where(differ * 9 <= F.col("n") + F.col("n2")).select("first", "earlier")
    led = saved(led, "pairs")
    settled = saved(_verified(led, _words(_ends(led), docs)).select("first").distinct(), "settled")
    # settled classes stay as partners; with a length below zero they find none themselves
    marked = classes.join(settled.select(F.col("first").alias("s")), F.col("first") == F.col("s"), "left")
    marked = marked.withColumn("n", F.when(F.col("s").isNull(), F.col("n")).otherwise(-F.col("n")))
    rows = marked.select(F.posexplode("prefix").alias("at", "code"), "first", "n", "p1", "p2").dropna()
    # both sides have the same columns and no test of their own, so one exchange serves both
    mine = [F.col(f"x.{c}") for c in ("n", "at", "p1", "p2")]
    theirs = [F.abs("y.n"), F.col("y.at"), F.col("y.p1"), F.col("y.p2")]
    pairs = rows.alias("x").join(rows.alias("y"), (F.col("x.code") == F.col("y.code")) & (F.col("y.first") < F.col("x.first")) & _may_match(mine, theirs))
    differ = F.bit_count(F.col("x.p1").bitwiseXOR(F.col("y.p1"))) + F.bit_count(F.col("x.p2").bitwiseXOR(F.col("y.p2")))
    pairs = pairs.select(F.col("x.first").alias("first"), F.col("y.first").alias("earlier"), differ.alias("differ"))
    pairs = saved(pairs.distinct(), "candidates")
    # one earlier match is all it takes: first the likeliest candidate of each class, then all of those it doesn't settle
    likely = pairs.groupBy("first").agg(F.min(F.struct("differ", "earlier")).alias("best")).select("first", F.col("best.earlier").alias("earlier"))
    texts = _words(_ends(pairs), docs)
    near = saved(_verified(likely, texts).select("first").distinct(), "near")
    rest = pairs.join(near.select(F.col("first").alias("s")), F.col("first") == F.col("s"), "left_anti")
    found = _verified(rest.select("first", "earlier"), texts)
    return settled.unionByName(near).unionByName(found.select("first")).distinct()


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, hash and lines (the numbers of the lines to remove) of each row that loses some."""
    require(docs, "doc_id", "text")
    levels = _levels(_counts(docs))
    first = [F.first(c).alias(c) for c in ("n", "prefix", "p1", "p2")]
    # tested after it is written: before, Spark would code each line for the test and once more
    coded = saved(_coded(docs, levels), "coded").where(F.col("n") > 0)
    classes = coded.groupBy("c1", "c2").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("rows"), *first)
    classes = saved(classes, "classes")
    matched = saved(matched_classes(classes.select("first", "n", "prefix", "p1", "p2"), docs), "matched").select(F.col("first").alias("s"))
    marked = classes.join(matched, F.col("first") == F.col("s"), "left").where(F.col("s").isNotNull() | (F.col("rows") > 1))
    marked = saved(marked.select(F.col("c1").alias("d1"), F.col("c2").alias("d2"), "first", F.col("s").isNotNull().alias("matched")), "marked")
    own = coded.select("doc_id", "hash", "no", "c1", "c2").join(marked, (F.col("c1") == F.col("d1")) & (F.col("c2") == F.col("d2")))
    gone = own.where(F.col("matched") | (_place() != F.col("first")))
    return gone.groupBy("doc_id", "hash").agg(F.sort_array(F.collect_set("no")).alias("lines"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the text of the lines that stay, and n_chars (if there) recounted."""
    gone = removed_lines(docs).select(F.col("doc_id").alias("_id"), F.col("hash").alias("_h"), F.col("lines").alias("_lines"))
    held = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    every = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    # the columns in one, so that none of them can clash with those that are added
    rows = docs.select(held.alias("held"), every.alias("_hash"))
    rows = rows.join(saved(gone, "gone"), (F.col("_hash") == F.col("_h")) & F.col("held.doc_id").cast("long").eqNullSafe(F.col("_id")), "left")
    text = F.col("held.text")
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains("_lines", i)), "\n")
    changed = {"text": F.when(F.col("_lines").isNull(), text).otherwise(kept)}
    if "n_chars" in docs.columns:
        size = F.length(changed["text"]).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("_lines").isNull(), F.col("held.n_chars")).otherwise(size)
    return rows.select(*[changed.get(c, F.col(f"held.`{c}`")).alias(c) for c in docs.columns])
