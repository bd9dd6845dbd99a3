"""Importance resampling of documents towards a target distribution of hashed n-grams.

**Features.** A text is lower-cased (A-Z only), cut into words (runs of bytes that are
digits, a-z or not ASCII) and scanned once in its separator-normalised form, the words
joined by one space. The scan stores the running CRC-32 at each word's end. The CRC of any
n-gram follows from two of them: appending n bytes multiplies a CRC by x^(8n) over GF(2),
so shifting the CRC before the n-gram by the n-gram's length and adding the one at its end
cancels all that went before. The n-gram's bucket is that CRC modulo ``BUCKETS``.

**Weights.** Each task adds its texts' features to one histogram (at most ``BUCKETS`` rows),
and Spark sums these, for the documents and the target texts. A bucket's gain is the floor of 1000 times
the log ratio of its smoothed shares; the table of gains has ``BUCKETS`` entries and is
broadcast. A document's weight is the sum of its features' gains.

**Draw.** Gumbel noise from a hash of doc_id is added to the weight; the highest scores are a sample
without replacement. Of the documents with at least ``least_words`` words the given per cent
are drawn, highest first. An approximate percentile with a bounded rank error leaves out rows that cannot be drawn (the
bound is checked by a count); the rest is sorted by ranges and numbered by its place.

**Odd rows.** Null and empty texts have no features and weight 0. A null doc_id counts as the empty text
in the noise and comes last among ties; rows of null n_words or weight are not drawn; repeated rows are drawn each on its own; columns that
have the name of an added one are replaced. An empty target or an empty table is fine: gains
are smoothed, and nothing is drawn of nothing. Texts of any length are scanned whole.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import require, saved, single_rows, with_place

MAX_WORDS = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
CHUNK = 1 << 20  # bytes of text that are worked on at once
POLYNOMIAL = 0xEDB88320  # of CRC-32, lowest bit first
SHORT = 64  # lengths with shift tables of their own
ACCURACY = 10_000
ADDED = ("n_words", "n_features", "weight", "score", "rank")
#: Upper case becomes lower case, all other ASCII but digits and a-z a space.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@cache
def byte_table() -> np.ndarray:
    """What a CRC's lowest byte adds when one byte is appended."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


def _tables(shifted_bits: np.ndarray) -> np.ndarray:
    """A linear map, given by the images of the 32 bits, as a table for each byte of its argument."""
    values = np.arange(256)
    tables = np.zeros((4, 256), np.uint32)
    for bit in range(8):
        for place in range(4):
            tables[place] ^= np.where(values >> bit & 1, shifted_bits[8 * place + bit], np.uint32(0)).astype(np.uint32)
    return tables


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


@cache
def shift_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Tables of the multiplication by x^(8n): for each n below ``SHORT``, and for ``SHORT`` times each power of two."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    short = []
    for _ in range(SHORT):
        short.append(_tables(bits))
        bits = byte_table()[bits & 255] ^ bits >> 8
    powers = [_tables(bits)]
    for _ in range(40):
        bits = _apply(powers[-1], bits)
        powers.append(_tables(bits))
    return np.stack(short), powers


def shift(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRCs (uint32) times x^(8 length): what they add to the CRC of a string that is so much longer."""
    short, powers = shift_tables()
    low = length % SHORT
    out = short[low, 0, crc & 255] ^ short[low, 1, crc >> 8 & 255] ^ short[low, 2, crc >> 16 & 255] ^ short[low, 3, crc >> 24]
    high, k = length // SHORT, 0
    while high.any():
        at = np.flatnonzero(high & 1)
        out[at] = _apply(powers[k], out[at])
        high, k = high >> 1, k + 1
    return out


def ngram_crcs(texts: list[bytes], max_words: int = MAX_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 of each n-gram of 1 to ``max_words`` words, the number of its text, and the words of each text."""
    ends: list[int] = []
    parts: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.translate(NORMAL).split()
        if not words:
            continue
        mine = b"\n ".join(words).split(b"\n")  # each but the first with the space before it
        crc = 0
        for part in mine:
            crc = zlib.crc32(part, crc)
            ends.append(crc)
        parts += mine
        counts[i] = len(mine)
    total = len(ends)
    end = np.array(ends, np.uint32)
    size = np.fromiter(map(len, parts), np.int64, total)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.ones(total, bool)
    first[1:] = owner[1:] != owner[:-1]
    before = np.zeros(total, np.uint32)
    before[1:] = end[:-1]
    # a CRC over one more space; CRC-32 inverts its register before and after
    spaced = ~(byte_table()[(~before ^ np.uint32(32)) & 255] ^ ~before >> 8)
    before = np.where(first, np.uint32(0), spaced)
    reach = np.cumsum(size)
    origin = reach - size + ~first  # where the word begins, after its space
    crcs, owners = [], []
    for n in range(1, max_words + 1):
        at = np.arange(max(0, total - n + 1))
        at = at[owner[at] == owner[at + n - 1]]
        crcs.append(end[at + n - 1] ^ shift(before[at], reach[at + n - 1] - origin[at]))
        owners.append(owner[at])
    return np.concatenate(crcs), np.concatenate(owners), counts


def chunks(column: pa.Array) -> Iterator[list[bytes]]:
    """The texts of a column in lists of at least one text and about ``CHUNK`` bytes."""
    held, size = [], 0
    for value in column.cast(pa.large_binary()):
        text = value.as_py() or b""
        if held and size + len(text) > CHUNK:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def bucket_counts(texts: DataFrame, max_words: int = MAX_WORDS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts each bucket holds."""
    require(texts, "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in chunks(batch.column(0)):
                crcs, _, _ = ngram_crcs(part, max_words)
                found += np.bincount(crcs % buckets, minlength=buckets)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(found[some], pa.int64())], ["bucket", "n"])

    rows = texts.select("text").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in rows.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floor of 1000 times the log ratio of each bucket's smoothed share in the target and the source."""
    buckets = len(source)
    all_source, all_target = int(source.sum()) + buckets, int(target.sum()) + buckets
    return np.array([math.floor(1000 * math.log(float((t + 1) * all_source) / float((s + 1) * all_target)))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, keep: list[str] | None = None, max_words: int = MAX_WORDS) -> DataFrame:
    """The columns ``keep`` of docs (default: all) with n_words, n_features and weight."""
    require(docs, "text", *(keep or []))
    kept = [c for c in keep or docs.columns if c not in ADDED]
    buckets = len(gains)
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    schema = T.StructType([*[docs.schema[c] for c in kept], *[T.StructField(c, T.LongType()) for c in ADDED[:3]]])

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in chunks(batch.column(len(kept))):
                crcs, owner, words = ngram_crcs(part, max_words)
                order = np.argsort(owner, kind="stable") if max_words > 1 else slice(None)
                features = np.bincount(owner, minlength=len(part))
                running = np.concatenate([[0], np.cumsum(shared.value[crcs[order] % buckets])])
                bounds = np.concatenate([[0], np.cumsum(features)])
                weight = running[bounds[1:]] - running[bounds[:-1]]
                columns = [batch.column(i).slice(at, len(part)) for i in range(len(kept))]
                added = [pa.array(x, pa.int64()) for x in (words, features, weight)]
                yield pa.RecordBatch.from_arrays([*columns, *added], names=schema.names)
                at += len(part)

    text = F.col("text").alias("_text_of_weigh")
    return docs.select(*[F.col(f"`{c}`") for c in kept], text).mapInArrow(weighed, schema)


def noise(seed: int = SEED):
    """1000 times Gumbel noise, floored, from a hash of doc_id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Adds score and rank (1 is the highest score drawn, null is not drawn) to rows with doc_id, n_words and weight."""
    require(weighed, "doc_id", "n_words", "weight")
    names = [c for c in weighed.columns if c not in ("score", "rank")]
    rows = weighed.select(*[F.col(f"`{c}`") for c in names], (F.col("weight") + noise(seed)).alias("score"))
    rows = single_rows(rows, "_row_of_draw", "weighed")
    fit = F.coalesce((F.col("n_words") >= least_words) & F.col("weight").isNotNull(), F.lit(False))
    n = rows.where(fit).count()
    room = percent * n // 100
    unranked = F.lit(None).cast("long").alias("rank")
    out = [*[F.col(f"`{c}`") for c in names], "score"]
    if not room:
        return rows.select(*out, unranked)
    share = max(0.0, 1 - percent / 100 - 20 / ACCURACY)
    least = rows.where(fit).agg(F.percentile_approx("score", F.lit(share), F.lit(ACCURACY))).first()[0]
    high = rows.where(fit & (F.col("score") >= least))
    if high.count() < room:  # cannot be, within the percentile's error bound
        high = rows.where(fit)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row_of_draw")]
    ranked = with_place(saved(high.orderBy(*order), "ordered"), "_place").withColumn("rank", F.col("_place") + 1)
    last = ranked.where(F.col("rank") == room).select("score", "doc_id", "_row_of_draw").first()
    # what comes after the last row drawn, in the same order
    doc, row = F.col("doc_id"), F.col("_row_of_draw")
    end = F.lit(last["doc_id"]).cast(weighed.schema["doc_id"].dataType)
    later = F.lit(False) if last["doc_id"] is None else F.coalesce(doc > end, F.lit(True))
    after = (F.col("score") < last["score"]) | (F.col("score") == last["score"]) & (later | doc.eqNullSafe(end) & (row > last["_row_of_draw"]))
    rest = rows.where(~fit | after)
    return ranked.where(F.col("rank") <= room).select(*out, "rank").unionByName(rest.select(*out, unranked))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, keep: list[str] | None = None, max_words: int = MAX_WORDS,
             buckets: int = BUCKETS, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """The columns ``keep`` of docs (default: all) with n_words, n_features, weight, score and rank (null: not drawn)."""
    require(docs, "doc_id", "text")
    gains = bucket_gains(bucket_counts(docs, max_words, buckets), bucket_counts(target, max_words, buckets))
    return draw(weigh(docs, gains, keep, max_words), percent, least_words, seed)


def sample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, **options) -> DataFrame:
    """The drawn documents, with the columns of docs."""
    drawn = resample(docs, target, percent, **options).where(F.col("rank").isNotNull())
    return drawn.drop("n_words", "n_features", "weight", "score", "rank")
