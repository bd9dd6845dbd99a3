"""Importance resampling against plain CRC-32 sums and a plain sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tablesift.llm import importance

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def grams(text, most):
    words = WORD.findall((text or "").encode().lower())
    return words, [b" ".join(words[i:i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, percent, most, buckets, least):
    """(doc_id, n_words, n_features, weight, score, rank) of each row."""
    source = Counter(zlib.crc32(g) % buckets for _, t in docs for g in grams(t, most)[1])
    aim = Counter(zlib.crc32(g) % buckets for t in target for g in grams(t, most)[1])
    everything, wanted = sum(source.values()) + buckets, sum(aim.values()) + buckets
    gain = [math.floor(1000 * math.log((aim[k] + 1) * everything / ((source[k] + 1) * wanted))) for k in range(buckets)]
    rows = []
    for i, text in docs:
        words, mine = grams(text, most)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[zlib.crc32(g) % buckets] for g in mine)
        rows.append([i, len(words), len(mine), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = {id(r): k + 1 for k, r in enumerate(fit[:percent * len(fit) // 100])}
    return [(*r, drawn.get(id(r))) for r in rows]


def texts_of(rng, n):
    words = [f"w{k}" for k in range(60)] + ["Ärger", "中文字", "x" * 200, "a b"]
    texts = [None, "", " \t\n", "One", "ONE two", "... , !", "tail-1 " * 30, "q" * 5000 + " w1"]
    texts += [rng.choice(" \n-.\x00").join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    return texts


@pytest.mark.parametrize("most", [1, 2, 4])
def test_crcs_of_ngrams_come_from_two_prefixes(most):
    rng = random.Random(most)
    texts = [(t or "").encode() for t in texts_of(rng, 40)]
    crcs, owner, words = importance.ngram_crcs(texts, most)
    for i, text in enumerate(texts):
        plain, want = grams(text.decode(), most)
        assert words[i] == len(plain)
        assert Counter(crcs[owner == i].tolist()) == Counter(map(zlib.crc32, want))


def test_shift_appends_zero_bytes():
    rng = random.Random(0)
    for size in (0, 1, 63, 64, 65, 4095, 100_000):
        a, b = rng.randbytes(9), rng.randbytes(size)
        got = importance.shift(np.array([zlib.crc32(a)], np.uint32), np.array([size]))[0] ^ zlib.crc32(b)
        assert got == zlib.crc32(a + b)


@pytest.mark.parametrize(("most", "least", "percent"), [(1, 20, 10), (3, 2, 50), (1, 0, 100)])
def test_draw_is_that_of_a_plain_sort(spark, monkeypatch, most, least, percent):
    monkeypatch.setattr(importance, "CHUNK", 700)
    rng = random.Random(11)
    texts = texts_of(rng, 150)
    rows = list(enumerate(texts)) + [(7, texts[9])] * 3 + [(None, texts[20])] * 4
    target = [None, "w1 w2 w3 Ärger", "w5 w5"]
    docs = spark.createDataFrame([(*r, "s", 0.5) for r in rows], "doc_id long, text string, weight string, rank double")
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, n_words int")
    got = importance.resample(docs, aim, percent, max_words=most, buckets=500, least_words=least)
    assert got.columns == ["doc_id", "text", "n_words", "n_features", "weight", "score", "rank"]
    out = Counter(tuple(r)[:1] + tuple(r)[2:] for r in got.collect())
    assert out == Counter(brute(rows, target, percent, most, 500, least))
    kept = importance.sample(docs.select("doc_id", "text"), aim, percent, max_words=most, buckets=500, least_words=least)
    assert kept.columns == ["doc_id", "text"]
    assert kept.count() == sum(n for r, n in out.items() if r[-1])


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c " * 20)], "doc_id long, text string")
    none = docs.limit(0)
    assert importance.resample(none, docs).count() == 0
    assert [r["rank"] for r in importance.resample(docs, none, 100).collect()] == [1]
    odd = spark.createDataFrame([(1, None, 5), (2, 30, None), (3, 30, 7)], "doc_id long, n_words long, weight long")
    assert {(r["doc_id"], r["rank"]) for r in importance.draw(odd, 100).collect()} == {(1, None), (2, None), (3, 1)}
