"""Encoding through the lexicon against the tokenizers library."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest

from tablesift.llm import bpe, lexicon
from tablesift.llm.queries import WORD_VOCABULARY


@pytest.fixture(scope="module")
def exact():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD_VOCABULARY)


def random_lists(rng, n):
    words = {bytes(rng.choice(b"abc\xc3") for _ in range(rng.randint(1, 9))) for _ in range(n)}
    return {w: tuple(rng.randint(0, 3) for _ in range(rng.randint(0, 4))) for w in words}


def test_lexicon_holds_its_words_and_no_others(tmp_path):
    rng = random.Random(1)
    for n in (0, 1, 5, 800):
        held = random_lists(rng, n)
        path = tmp_path / f"{n}"
        path.write_bytes(lexicon.compiled(held.items()))
        asked = [*held, *random_lists(rng, 300), b"a" * 40, b""]
        there, counts, ids = lexicon.Lexicon(str(path)).look_up(asked)
        assert there.tolist() == [w in held for w in asked]
        got = np.split(ids, np.cumsum(counts)[:-1])
        assert all(tuple(x.tolist()) == held.get(w, ()) for w, x in zip(asked, got, strict=True))


def test_lexicon_is_minimal():
    """No two states have the same futures, counted with ids in their earliest places."""
    rng = random.Random(2)
    words = {stem + end: (k, *ids) for k, stem in enumerate([b"talk", b"walk", b"play", b"stay"])
             for end, ids in ((b"", ()), (b"s", (90,)), (b"ed", (91, 92)), (b"ing", (93,)))}
    builder = lexicon.Builder()
    for w, ids in sorted(words.items()):
        builder.add(w, ids)
    builder.finish()
    # one set of states for all endings, one path for each stem's own letters
    assert len(builder.states) < 25 < len({w[:k] for w in words for k in range(len(w) + 1)})

    held = random_lists(rng, 500)
    builder = lexicon.Builder()
    for w, ids in sorted(held.items()):
        builder.add(w, ids)
    builder.finish()

    def futures(w):
        mine = {v[len(w):]: held[v] for v in held if v.startswith(w)}
        lists = list(mine.values())
        n = 0
        while all(len(x) > n for x in lists) and len({x[n] for x in lists}) == 1:
            n += 1
        return frozenset((end, x[n:]) for end, x in mine.items())
    prefixes = {w[:k] for w in held for k in range(len(w) + 1)}
    # the start keeps what all words have in common, as nothing comes before it
    classes = {futures(p) for p in prefixes if p} | {"start"}
    assert len(builder.states) == len(classes)


def test_words_must_come_in_order():
    builder = lexicon.Builder()
    builder.add(b"b", (1,))
    with pytest.raises(ValueError, match="byte order"):
        builder.add(b"a", (2,))


def odd_texts(rng):
    letters = [*range(32, 0x600), *range(0x300, 0x370), *range(0x1e00, 0x2070), *range(0x900, 0xa00), *range(0x1100, 0x1200),
               *range(0x3000, 0x3400), *range(0xa000, 0xb000), *range(0x1f300, 0x1f700), *range(0x1c80, 0x1c90), *range(0x10d50, 0x10d66)]
    out = [None, "", " \n\t", "Hello  World's WE'LL 12ab ΣΑΣ İı ﬁ", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "x\x1cy\x85z  w", "\x00\x01"]
    for _ in range(600):
        out.append("".join(chr(rng.choice(letters)) if rng.random() < 0.5 else rng.choice("abc deΣ's LL<|endoftext|> ") for _ in range(rng.randint(1, 40))))
    return out + ["word " * 4000, "ab" * 20_000, "é" * 3000, "." * 5000]


def test_plain_characters_are_cut_as_by_the_tokenizer(exact):
    vocab = bpe.vocabulary(WORD_VOCABULARY)
    plain = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not vocab.odd.search(chr(c))]
    assert len(plain) > 30_000
    for c in plain:
        text = f"a{c}b{c}-{c}1"
        shown = [p for p, _ in exact.pre_tokenizer.pre_tokenize_str(exact.normalizer.normalize_str(text))]
        assert [bytes(vocab.byte_of[x] for x in p).decode() for p in shown] == vocab.words(text), hex(ord(c))


@pytest.mark.parametrize("words", [0, 40, 100_000])
def test_ids_and_texts_are_the_tokenizers(spark, exact, monkeypatch, words):
    monkeypatch.setattr(bpe, "CHUNK", 3000)
    monkeypatch.setattr(bpe, "COUNTED", 50)
    monkeypatch.setattr(bpe, "REMEMBERED", 30)
    texts = odd_texts(random.Random(3))
    rows = [(k if k % 7 else None, t, "mine", 3.5) for k, t in enumerate(texts)] + [(8, texts[8], "again", None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens double").repartition(3)
    got = bpe.decode(bpe.encode(docs, WORD_VOCABULARY, words), WORD_VOCABULARY)
    assert got.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    out = got.collect()
    assert len(out) == len(rows)
    for r in out:
        ids = exact.encode(r["text"] or "", add_special_tokens=False).ids
        assert bytes(r["ids"]) == struct.pack(f"<{len(ids)}I", *ids) and r["n_tokens"] == len(ids)
        assert r["decoded"] == exact.decode(ids, skip_special_tokens=False)


def test_op11_digests(spark, exact, tmp_path):
    from tablesift.llm.queries import op11_bpe

    texts = ["One two, three!", None, "x" * 9000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in op11_bpe(spark, str(tmp_path)).collect():
        ids = exact.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(exact.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty_table_and_unknown_ids(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")), WORD_VOCABULARY).count() == 0
    odd = spark.createDataFrame([(bytearray(struct.pack("<2I", 49406, 99999)),), (None,)], "ids binary")
    assert [r["decoded"] for r in bpe.decode(odd, WORD_VOCABULARY).collect()] == ["<|startoftext|>", ""]


def test_words_merged_in_blocks_have_the_ids_of_words_merged_alone(monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 37)
    vocab, rng = bpe.vocabulary(WORD_VOCABULARY), random.Random(9)
    words = [bytes(rng.choice(rng.choice([b"aab", b"etaoinshr", bytes(range(256))])) for _ in range(rng.randint(0, 90))) for _ in range(400)]
    words += ["é".encode() * 3, b"", b"a", b"aaaaaaa", b"x" * 64, b"x" * 65, b"internationalisation", "Σας".encode()]
    counts, ids = vocab.all_merged(words)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [vocab.merged(w) for w in words]
    counts, ids = vocab.all_merged([])
    assert len(counts) == len(ids) == 0


def test_ascii_words_are_those_of_the_pattern():
    vocab, rng = bpe.vocabulary(WORD_VOCABULARY), random.Random(10)
    for _ in range(3000):
        text = "".join(chr(rng.randrange(128)) if rng.random() < 0.4 else rng.choice("abtsrevmld' '1.") for _ in range(rng.randint(0, 30)))
        assert bpe.ASCII_WORD.findall(text.lower()) == vocab.word.findall(text.lower())


def test_an_encoder_holds_few_words_at_a_time(tmp_path):
    import tracemalloc

    import pyarrow as pa

    (tmp_path / "lexicon").write_bytes(lexicon.compiled([(b"word", (1,))]))
    of = bpe.Encoder(WORD_VOCABULARY, lexicon.Lexicon(str(tmp_path / "lexicon")))
    texts = pa.array([" ".join(f"w{(k * 211 + j) % 9000}" for j in range(2000)) for k in range(400)])  # 4.6 million characters
    tracemalloc.start()
    try:
        n = sum(len(ids) for chunk in bpe.text_chunks(texts) for ids in of(chunk))
        peak = tracemalloc.get_traced_memory()[1]
        assert n > 400 * 2000 and peak < 30e6
    finally:
        tracemalloc.stop()
