"""Encoding and decoding by a word-level BPE through a lexicon of frequent words.

**Rules.** A text is cut at the vocabulary's special tokens, each of which is one id. The rest is put into
Unicode's composed form, lower-cased character by character and cut into words (``WORD``); white space
is dropped. A word's bytes are its first symbols, the last one marked as the word's end;
then the pair of neighbours of best rank is merged, the leftmost first, until none is left. Decoding
joins the tokens' strings by spaces, as a vocabulary without a decoder does.

**Lexicon.** Words are counted over all texts (each task adds up, Spark sums), the ``WORDS`` most
frequent of at most ``LONGEST`` bytes are merged in Spark and compiled into a minimal acyclic
transducer (``lexicon``), whose size is bounded by those two. It is written to the shared folder,
handed to each executor once by ``addFile`` and memory-mapped there. All other words are merged exactly where they
occur: those of at most ``LONGEST`` bytes in blocks of ``BLOCK`` words of about one length, one merge of each at a time, on
arrays; longer ones one by one, in n log n steps for n bytes. So the lexicon decides the time, never the ids.

**Characters.** Python's Unicode tables are newer than the tokenizer's. Texts of the characters in ``PLAIN``, for which both agree, are
normalised and cut here; other texts by the normaliser and the
pre-tokeniser of the vocabulary's own file. Merging is the same for both.

**Odd rows.** Null texts count as empty: no ids, an empty decoded text. Texts of any length are encoded
whole, in chunks of rows of about ``CHUNK`` characters. Repeated rows and null doc_ids are no
matter; columns with the name of an added one are replaced; an empty table stays empty. Null ids decode to an
empty text, and ids that no token has are left out.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from uuid import uuid4

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import new_folder, require, saved
from .lexicon import Lexicon, compiled, gather
from .warc import file_system

WORDS = 100_000
LONGEST = 64
CHUNK = 1 << 20  # of 4 << 20, a worker's word lists alone take some 60 MB more, and it is no faster
COUNTED = 200_000  # words a task counts before it hands them on
REMEMBERED = 100_000  # merged words a process keeps, at some 400 bytes each
#: The vocabulary's pattern of words, and the mark of a word's end.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
#: The same for ASCII texts in small letters, for the faster of the two libraries (each case has first characters of its own,
#: but for the apostrophe).
ASCII_WORD = re.compile(r"[a-z]+|'(?:s|t|re|ve|m|ll|d)|[^a-z0-9\t-\r ]+|[0-9]")
BLOCK = 4096  # words that are merged together
NO_PAIR, NO_RANK = (1 << 63) - 1, (1 << 31) - 1
#: Characters whose class, case and composition all tables since Unicode 13 agree on.
PLAIN = (r"\u0000-\u0557\u1e00-\u206f\u20a0-\u20bf\u2100-\u218b\u2190-\u23ff\u2500-\u27bf\u3000-\u30ff"
         r"\u4e00-\u9fef\uac00-\ud7a3\uff01-\uffee\ufffd\U0001f300-\U0001f5ff\U0001f600-\U0001f64f")


@lru_cache(1)
def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


class Vocabulary:
    """The tokens and merges of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as text:
            data = json.load(text)
        ids, self.path = data["model"]["vocab"], path
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = {i: t for t, i in (ids | self.special).items()}
        letters = byte_characters()
        self.inner = [ids.get(c) for c in letters]
        self.last = [ids.get(c + END) for c in letters]
        self.byte_of = {c: b for b, c in enumerate(letters)}
        merges = (m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"])
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(merges)}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.word, self.odd = regex.compile(WORD), regex.compile(f"[^{PLAIN}]")
        # the merges as arrays, by a number for the pair; a pair of no merge is after all of them
        pairs = sorted((a << 32 | b, rank, whole) for (a, b), (rank, whole) in self.merges.items())
        self.pairs = np.array([p for p, _, _ in pairs] + [NO_PAIR], np.int64)
        self.ranks = np.array([r for _, r, _ in pairs] + [NO_RANK], np.int32)
        self.wholes = np.array([w for _, _, w in pairs] + [-1], np.int32)
        self.inner_ids, self.last_ids = (np.array([-1 if i is None else i for i in ids], np.int32) for ids in (self.inner, self.last))
        self.full = None

    def merged(self, word: bytes) -> list[int]:
        """The ids of a word: merges by rank, the leftmost first."""
        symbols = [self.inner[b] for b in word[:-1]] + [self.last[word[-1]]] if word else []
        symbols = [s for s in symbols if s is not None]
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [(found[0], k, symbols[k], symbols[k + 1]) for k in range(n - 1) if (found := self.merges.get((symbols[k], symbols[k + 1])))]
        heapq.heapify(waiting)
        while waiting:
            _, k, left, right = heapq.heappop(waiting)
            other = after[k]
            if symbols[k] != left or other >= n or symbols[other] != right:
                continue  # one of the two has been merged since
            symbols[k], symbols[other] = self.merges[left, right][1], -1
            after[k] = after[other]
            if after[k] < n:
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < n and (found := self.merges.get((symbols[a], symbols[b]))):
                    heapq.heappush(waiting, (found[0], a, symbols[a], symbols[b]))
        return [s for s in symbols if s >= 0]

    def all_merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all ids one after the other."""
        counts, found = np.zeros(len(words), np.int64), [np.empty(0, np.int32)] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        together = order[(sizes[order] > 0) & (sizes[order] <= LONGEST)]
        starts, pool, at = np.zeros(len(words), np.int64), [], 0
        for first in range(0, len(together), BLOCK):
            mine = together[first:first + BLOCK]
            counts[mine], ids = self._merged_block([words[k] for k in mine.tolist()], sizes[mine])
            starts[mine] = at + np.cumsum(counts[mine]) - counts[mine]
            pool.append(ids)
            at += len(ids)
        for k in np.flatnonzero(sizes > LONGEST).tolist():
            ids = np.array(self.merged(words[k]), np.int32)
            counts[k], starts[k] = len(ids), at
            pool.append(ids)
            at += len(ids)
        pool = np.concatenate(pool) if pool else np.empty(0, np.int32)
        return counts, gather(pool, starts, counts).astype(np.uint32)

    def _found(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where the merge of each pair is in ``pairs``, its last place if there is none."""
        pair = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, at, len(self.pairs) - 1)

    def _merged_block(self, words: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``all_merged``, of words of about one length: a row of symbols each, one merge of every word at a time."""
        n, width = len(words), int(sizes.max())
        text = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(n), sizes)
        place = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids = np.where(place == sizes[row] - 1, self.last_ids[text], self.inner_ids[text])
        known = ids >= 0
        if not known.all():  # bytes without a symbol are left out
            row, ids = row[known], ids[known]
            sizes = np.bincount(row, minlength=n)
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        symbols = np.full((n, width + 1), -1, np.int32)
        symbols[row, place] = ids
        left, sizes = np.arange(n), sizes.copy()
        none = len(self.pairs) - 1
        merge = np.full((n, width), none, np.int32)
        some = place + 1 < sizes[row]
        merge[row[some], place[some]] = self._found(symbols[row[some], place[some]], symbols[row[some], place[some] + 1])
        out = symbols.copy()
        while True:
            rank = self.ranks[merge]
            best = rank.argmin(axis=1)  # of equal ranks the leftmost
            going = rank[np.arange(len(left)), best] < NO_RANK
            if not going.all():
                out[left[~going]] = symbols[~going]
                left, symbols, merge, best = left[going], symbols[going], merge[going], best[going]
            if not len(left):
                break
            k = np.arange(len(left))
            whole = self.wholes[merge[k, best]]
            # what comes after the pair moves one place on
            after = np.arange(width)[None, :] > best[:, None]
            symbols[:, :-1] = np.where(after, symbols[:, 1:], symbols[:, :-1])
            symbols[:, -1] = -1
            symbols[k, best] = whole
            merge[:, :-1] = np.where(after[:, :-1], merge[:, 1:], merge[:, :-1])
            merge[:, -1] = none
            sizes[left] -= 1
            for one in (best, best - 1):
                inside = (one >= 0) & (one + 1 < sizes[left])
                at, there = k[inside], one[inside]
                merge[at, there] = self._found(symbols[at, there], symbols[at, there + 1])
            ends = best + 1 >= sizes[left]
            merge[k[ends], best[ends]] = none
        return sizes, out[out >= 0]

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if text.isascii():
            return ASCII_WORD.findall(text.lower())
        if self.odd.search(text):
            if self.full is None:
                from tokenizers import Tokenizer

                self.full = Tokenizer.from_file(self.path)
            parts = self.full.pre_tokenizer.pre_tokenize_str(self.full.normalizer.normalize_str(text))
            return [bytes(self.byte_of[c] for c in part).decode() for part, _ in parts]
        # lower() makes a sigma at a word's end another letter than elsewhere
        return self.word.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def parts(self, text: str) -> list[str]:
        """The words; a special token is put in as a space and its string, which no word is."""
        if not self.cut or not any(s in text for s in self.special):
            return self.words(text)
        out, at = [], 0
        for found in self.cut.finditer(text):
            out += self.words(text[at:found.start()])
            out.append(f" {found.group()}")
            at = found.end()
        return out + self.words(text[at:])


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def text_chunks(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a column in lists of at least one text and about ``CHUNK`` characters."""
    held, size = [], 0
    for value in column:
        text = value.as_py() or ""
        if held and size + len(text) > CHUNK:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """word, n: how often each word of at most ``LONGEST`` bytes occurs in all texts."""
    require(docs, "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, found = vocabulary(path), Counter()
        for batch in batches:
            for texts in text_chunks(batch.column(0)):
                for text in texts:
                    found.update(vocab.parts(text))
                if len(found) > COUNTED:
                    yield handed_on(found)
                    found = Counter()
        yield handed_on(found)

    def handed_on(found: Counter) -> pa.RecordBatch:
        # a character has a byte at least, and words begin with no space
        words = [w for w in found if len(w) <= LONGEST and w[0] != " " and len(w.encode()) <= LONGEST]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([found[w] for w in words], pa.int64())], ["word", "n"])

    return docs.select("text").mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, path: str, words: int = WORDS) -> str:
    """Compiles the most frequent words, hands the file to the executors and returns its name there."""
    spark = docs.sparkSession

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            found = batch.column(0).to_pylist()
            counts, ids = vocab.all_merged([w.encode() for w in found])
            ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32)))], ["word", "ids"])

    top = saved(word_counts(docs, path).orderBy(F.col("n").desc(), "word").limit(words), "words")
    rows = top.repartition(16, "word").select("word").mapInArrow(merged, "word string, ids array<int>").toPandas()  # at most ``words`` rows
    data = compiled((w.encode(), tuple(i)) for w, i in zip(rows["word"], rows["ids"], strict=True))
    return hand_out(spark, data)


def hand_out(spark: SparkSession, data: bytes) -> str:
    """Writes a file to the shared folder, from where each executor copies it once; its name there."""
    name = f"lexicon-{uuid4().hex}"
    folder = new_folder(spark, "lexicon")
    system, root = file_system(folder)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/{name}", compression=None) as out:
        out.write(data)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


class Encoder:
    """Ids of texts by a vocabulary and a lexicon."""

    def __init__(self, path: str, lexicon: Lexicon):
        self.vocab, self.lexicon = vocabulary(path), lexicon
        self.memory: dict[str, bytes] = {}

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of the distinct words has, and all ids one after the other."""
        held, counts, ids = self.lexicon.look_up([w.encode() for w in words])
        rest = np.flatnonzero(~held)
        if not len(rest):
            return counts, ids
        missing = [words[k] for k in rest.tolist()]
        found = list(map(self.memory.get, missing))
        new = [k for k, mine in enumerate(found) if mine is None]
        lengths, merged = self.vocab.all_merged([b"" if missing[k][0] == " " else missing[k].encode() for k in new])
        data, end = merged.astype(np.uint32).tobytes(), 0
        if len(self.memory) + len(new) > REMEMBERED:
            self.memory.clear()
        for k, n in zip(new, lengths.tolist(), strict=True):
            word = missing[k]
            found[k] = np.uint32(self.vocab.special[word[1:]]).tobytes() if word[0] == " " else data[end:end + 4 * n]
            end += 4 * n
            if len(word) <= LONGEST and len(self.memory) < REMEMBERED:
                self.memory[word] = found[k]
        more = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.concatenate([ids, np.frombuffer(b"".join(found), np.uint32)])
        starts = np.cumsum(counts) - counts
        starts[rest] = len(ids) + np.cumsum(more) - more
        counts[rest] = more
        return counts, gather(pool, starts, counts)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids (unsigned, 32 bits) of each text."""
        parts = [self.vocab.parts(t) for t in texts]
        number = {word: k for k, word in enumerate(dict.fromkeys(chain.from_iterable(parts)))}
        if not number:
            return [np.zeros(0, np.uint32) for _ in texts]
        counts, ids = self._ids(list(number))
        starts = np.cumsum(counts) - counts
        out = []
        for mine in parts:
            at = np.fromiter(map(number.__getitem__, mine), np.int64, len(mine))
            out.append(gather(ids, starts[at], counts[at]))
        return out


@lru_cache(1)
def encoder(path: str, name: str) -> Encoder:
    return Encoder(path, Lexicon(SparkFiles.get(name)))


def encode(docs: DataFrame, path: str, words: int = WORDS, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of docs (default: all) with n_tokens and ids (binary, little-endian, 4 bytes each)."""
    require(docs, "text", *(keep or []))
    name = build_lexicon(docs, path, words)
    kept = [c for c in keep or docs.columns if c not in ("n_tokens", "ids")]
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(path, name)
        for batch in batches:
            at = 0
            for texts in text_chunks(batch.column(len(kept))):
                ids = of(texts)
                held = [batch.column(i).slice(at, len(texts)) for i in range(len(kept))]
                added = [pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]
                yield pa.RecordBatch.from_arrays([*held, *added], names=schema.names)
                at += len(texts)

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").alias("_text_of_encode")).mapInArrow(encoded, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds decoded: the text of ids (binary, little-endian, 4 bytes each)."""
    require(encoded, "ids")
    kept = [c for c in encoded.columns if c != "decoded"]
    schema = T.StructType([*[encoded.schema[c] for c in kept], T.StructField("decoded", T.StringType())])
    ids_at = kept.index("ids")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary(path).tokens
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                lists = (np.frombuffer(x.as_py() or b"", "<u4").tolist() for x in part.column(ids_at))
                texts = [" ".join([t for t in map(tokens.get, ids) if t is not None]) for ids in lists]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(decoded, schema)
