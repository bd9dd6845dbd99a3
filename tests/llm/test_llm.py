"""The operators of tablesift.llm against brute force, round trips and held-out accuracy."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from tablesift.llm import bitsliced, chat, kmeans_tree, lines, mixing, neardup, packing, quality, simhash, toxicity, warc
from tablesift.llm.queries import VOCABULARY

WORDS = [f"w{k}" for k in range(400)]
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows, extra=""):
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, DOC)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


# --- SimHash -----------------------------------------------------------------------

def brute_fingerprint(text, words):
    parts = (text or "").encode().lower().split()
    grams = [b" ".join(parts[i:i + words]) for i in range(max(1, len(parts) - words + 1))] if parts else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(prints):
    ids = list(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a in range(len(ids)):
        for b in range(a):
            if bin(prints[ids[a]] ^ prints[ids[b]]).count("1") <= 4:
                x, y = root(ids[a]), root(ids[b])
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_simhash_groups_are_those_of_all_pairs(spark):
    rng = random.Random(1)
    texts = [None, "", "one two", "One TWO", " one\ttwo "] + [sentence(rng, rng.randint(1, 60)) for _ in range(40)]
    base = sentence(rng, 300).split()
    for k in range(60):
        copy = list(base)
        copy[rng.randrange(300)] = f"x{k}"
        texts.append(" ".join(copy))
    texts += texts[6:12]
    rows = list(enumerate(texts))
    got = simhash.near_duplicate_groups(docs_of(spark, rows), words=4).collect()
    prints = {i: brute_fingerprint(t, 4) for i, t in rows}
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == components(prints)


def test_links_of_close_and_far_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)  # cells are split
    rng = random.Random(2)
    base = rng.getrandbits(64)
    prints = {base, *[rng.getrandbits(64) for _ in range(50)]}
    for bits in range(1, 8):
        for _ in range(12):
            x = base
            for b in rng.sample(range(64), bits):
                x ^= 1 << b
            prints.add(x)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = [(r["a"], r["b"]) for r in simhash.fingerprint_links(df).collect()]
    parent = {p: p for p in signed}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        parent[root(a)] = root(b)
    want = components(dict(zip(signed, [p % (1 << 64) for p in signed], strict=True)))
    assert len({(root(p), want[p]) for p in signed}) == len({root(p) for p in signed}) == len(set(want.values()))


def test_one_per_group_keeps_columns_and_handles_nulls(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "x"), (0, "a b c d e f", "y"), (None, None, "z"), (None, "", "z"), (0, "a b c d e f", "y")],
                               "doc_id long, text string, fp string")
    got = simhash.one_per_group(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in got.collect() if r["doc_id"] is not None) == [(0, "a b c d e f")]
    assert got.count() == 2
    assert simhash.one_per_group(df.limit(0)).count() == 0


# --- WARC --------------------------------------------------------------------------

def test_warc_round_trip_and_plain_reading(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "FRAME_BYTES", 300)
    pages = [(5, "http://a", "<p>ä</p>"), (3, None, "<p>ä</p>"), (7, "u\nv", None), (8, "u", ""), (9, "u", "x" * 2000), (3, "again", "<p>ä</p>")]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, bundle int")
    index = warc.write_archives(df, f"file://{tmp_path}/out").collect()
    assert Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in index) == Counter(
        [(5, "revisit", 3), (3, "response", None), (3, "response", None), (7, "response", None), (8, "revisit", 7), (9, "response", None)])
    for file in tmp_path.glob("out/*.zst"):
        with file.open("rb") as data:
            plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        mine = [r for r in index if r["bundle"].endswith(file.name)]
        assert plain.count(b"WARC/1.1\r\n") == len(mine)
    got = warc.archived_pages(df).collect()
    want = Counter((i, len((h or "").encode()), warc.base32_sha1((h or "").encode())) for i, _, h in pages)
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in got) == want
    assert warc.archived_pages(df.limit(0)).count() == 0


# --- classifiers -------------------------------------------------------------------

def labelled(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.mark.parametrize(("module", "label", "folds", "fold"), [(quality, "quality", 5, 0), (toxicity, "toxic", 4, 2)])
def test_held_out_accuracy(spark, module, label, folds, fold):
    sf_dir = "/root/testdata/sf0.1"  # sf0.01 has 36 toxic rows to learn from
    docs, labels = labelled(spark, sf_dir, "documents"), labelled(spark, sf_dir, "labels")
    model = module.train(docs, labels, label=label, folds=folds, fold=fold)
    scored = module.score_documents(docs.select("doc_id", "text"), model).join(labels, "doc_id").collect()
    held = [(r[label], int(r["score"] >= 0.3)) for r in scored if zlib.crc32(str(r["doc_id"]).encode()) % folds == fold]
    assert len(held) > 50
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_scores_of_odd_rows(spark, module):
    label = "quality" if module is quality else "toxic"
    docs = spark.createDataFrame([(1, None, 0.5), (None, "", 0.5), (2, "word " * 5000, 0.5), (2, "word", None)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1)], f"doc_id long, {label} int")
    model = module.train(docs, labels)
    got = module.score_documents(docs, model)
    assert got.columns == docs.columns
    assert all(0 <= r["score"] <= 1 for r in got.collect()) and got.count() == 4
    assert module.score_documents(docs.limit(0), module.train(docs.limit(0), labels)).count() == 0


def test_support_vectors_separate():
    rng = np.random.default_rng(0)
    found = [{"good" if y else "bad", f"n{rng.integers(9)}"} for y in [0, 1] * 100]
    model = quality.fit(found, [0, 1] * 100)
    assert model.score({"good"}) > 0.7 > 0.3 > model.score({"bad"})


def test_swaps_pull_identity_weights_together():
    # one group is mentioned in toxic rows only, the other in neutral ones
    rows, labels = [], []
    for k in range(200):
        toxic = k % 2
        rows.append([("muslims" if toxic else "christians"), *(["insult"] if toxic and k % 4 else [])])
        labels.append(toxic)
    vocabulary = ["christians", "insult", "muslims"]
    free = toxicity.fit(rows, labels, Counter(), vocabulary)
    pulled = toxicity.fit(rows, labels, Counter({(("muslims",), ("christians",)): 100, (("christians",), ("muslims",)): 100}), vocabulary)

    def gap(m):
        return abs(m.weights.get("muslims", 0) - m.weights.get("christians", 0))
    assert gap(pulled) < gap(free) / 3
    assert pulled.weights["insult"] > 0
    others = toxicity.identity_swaps((("women", "men"),))
    assert sorted(toxicity.swapped("The women. Men, too", others)) == [("Men,", "women"), ("women", "men")]


# --- chat --------------------------------------------------------------------------

def test_maximal_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART", 3)
    rng = random.Random(3)
    base = [("user" if k % 2 == 0 else "assistant", rng.choice(["hi", "yes", "", None])) for k in range(8)]
    convs = {k: base[:n] for k, n in enumerate([8, 3, 8, 5, 1])}
    convs |= {10 + k: [("user", f"q{k % 3}")] + [("assistant", None)] * (k % 2) for k in range(6)}
    convs[None] = base[:2]
    rows = [(c, t, r, x) for c, turns in convs.items() for t, (r, x) in enumerate(turns)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    big = {c: (1 if c is None else 0, c or 0) for c in convs}

    def dropped(c):
        return any(d != c and convs[d][:len(convs[c])] == convs[c] and (len(convs[d]) > len(convs[c]) or big[d] < big[c]) for d in convs)
    want = {c for c in convs if not dropped(c)}
    assert {r["conv_id"] for r in chat.maximal_conversations(df).collect()} == want
    parts = defaultdict(dict)
    for r in chat.render_maximal(df).collect():
        parts[r["conv_id"]][r["part"]] = r["rendered"]
    assert {c: "".join(p[k] for k in sorted(p)) for c, p in parts.items()} == {
        c: "".join(f"<|im_start|>{r}\n{x or ''}<|im_end|>\n" for r, x in convs[c]) for c in want}
    assert chat.render_maximal(df.limit(0)).count() == 0


# --- lines -------------------------------------------------------------------------

def brute_removed(rows):
    place = [(float("inf") if i is None else i, no, n, set(line.lower().encode().split()))
             for n, (i, t) in enumerate(rows) for no, line in enumerate((t or "").split("\n"))]
    out = defaultdict(list)
    for i, no, n, ws in place:
        if ws and any((j, k) < (i, no) and vs and 9 * len(ws & vs) >= 4 * (len(ws) + len(vs)) for j, k, _, vs in place):
            out[n].append(no)
    return out


def test_removed_lines(spark, monkeypatch):
    monkeypatch.setattr(lines, "HOT", 3)
    rng = random.Random(4)
    base = [sentence(rng, n) for n in (1, 4, 5, 9, 12, 30, 130)]
    rows = [(None, "shared line"), (1, None), (2, ""), (3, "\n\n"), (4, "Shared\tLINE")]
    for k in range(10, 60):
        text = []
        for _ in range(rng.randint(1, 5)):
            words = rng.choice(base).split()
            for _ in range(rng.randint(0, max(1, len(words) // 8))):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            text.append(" ".join(words))
        rows.append((k, "\n".join(text)))
    rows.append(rows[-1])
    docs = docs_of(spark, rows)
    want = brute_removed(rows)
    got = Counter((r["doc_id"], r["text"]) for r in lines.without_repeated_lines(docs).collect())
    keep = [(i, t if n not in want else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[n])) for n, (i, t) in enumerate(rows)]
    assert got == Counter(keep)
    assert lines.without_repeated_lines(docs.limit(0)).count() == 0


def test_removed_lines_of_rows_with_a_null_or_shared_id(spark):
    from tablesift.llm.queries import removed_per_row

    rows = [(1, "alpha beta gamma"), (2, "alpha beta gamma\nfirst text"), (2, "other words\nalpha beta gamma"), (None, "new line\nalpha beta gamma"), (3, None)]
    docs = docs_of(spark, rows).select("doc_id", "text")
    got = Counter((r["doc_id"], r["removed_count"], r["removed"]) for r in removed_per_row(docs).collect())
    assert got == Counter([(1, 0, ""), (2, 1, "0"), (2, 1, "1"), (None, 1, "1"), (3, 0, "")])


# --- packing -----------------------------------------------------------------------

def test_packing_is_gapless_and_near_the_bound(spark):
    from tokenizers import Tokenizer

    rng = random.Random(5)
    texts = [None, "", "a  b\n\n c\t<|endoftext|> 'll", "word " * 5000] + [sentence(rng, rng.randint(1, 900)) for _ in range(80)]
    docs = docs_of(spark, list(enumerate(texts)))
    got = packing.pack(packing.tokenize(docs, **VOCABULARY)).collect()
    exact = Tokenizer.from_file(VOCABULARY["json_path"])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], bytes(r["ids"])))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in enumerate(texts):
        ids = exact.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = sorted(by_doc[i])
        assert np.frombuffer(b"".join(p[3] for p in pieces), "<u4").tolist() == ids
        assert [p[1] for p in pieces] == np.cumsum([0] + [p[2] for p in pieces[:-1]]).tolist()
        assert len(pieces) == -(-len(ids) // 2048)
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(r["length"] for r in got)
    bound = max(-(-total // 2048), sum(r["length"] > 1024 for r in got))
    assert len(by_sequence) <= 1.03 * bound + 1


def test_plan_covers_counts_exactly():
    rng = random.Random(6)
    for size in (1, 5, 40, 300):
        counts = Counter(rng.randint(1, 64) for _ in range(size))
        plan = packing.plan_sequences(counts, 64)
        used = Counter()
        for pattern, times in plan.items():
            assert sum(pattern) <= 64 and times > 0
            for length in pattern:
                used[length] += times
        assert used == counts


# --- searches ----------------------------------------------------------------------

def vectors(spark, n=260, dims=6, seed=7):
    rng = np.random.default_rng(seed)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(0, 0.4, dims)]) for k in range(n)]
    rows += [(n + k, rows[3][1]) for k in range(12)] + [(900, None), (901, [None] * dims), (902, [float("nan")] * dims), (903, [0.0] * dims)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score")


def test_bit_sliced_top_k_is_exact(spark, monkeypatch):
    monkeypatch.setattr(bitsliced, "BLOCK", 50)
    monkeypatch.setattr(bitsliced, "QUERIES", 3)
    rows, df = vectors(spark)
    from pyspark.sql import functions as F

    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in bitsliced.top_k(df, F.col("vec_id") % 50 == 0).collect())
    fine = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows if v is not None and None not in v and not np.isnan(v).any()]
    want = []
    for q, x in fine:
        if q % 50 == 0:
            best = sorted((-int(x @ y), v) for v, y in fine if v != q)[:5]
            want += [(q, k + 1, v, -s) for k, (s, v) in enumerate(best)]
    assert got == sorted(want)
    assert bitsliced.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_k_means_tree_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "LEAF_ROWS", 24)
    monkeypatch.setattr(kmeans_tree, "BLOCK", 16)
    rows, df = vectors(spark)
    from pyspark.sql import functions as F

    got = {(r["query_id"], r["vec_id"]): r["score"] for r in kmeans_tree.search(df, F.col("vec_id") % 50 == 0).collect()}
    fine = [(i, np.array(v)) for i, v in rows if v is not None and None not in v and not np.isnan(v).any() and any(v)]
    want = {}
    for q, x in fine:
        if q % 50 == 0:
            best = sorted((-float(x @ y / np.sqrt((x @ x) * (y @ y))), v) for v, y in fine if v != q)[:5]
            want |= {(q, v): -s for s, v in best}
    assert len(want.keys() & got.keys()) >= 0.9 * len(want)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want.keys() & got.keys())
    assert kmeans_tree.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# --- mixing ------------------------------------------------------------------------

def test_each_source_stays_within_a_block_of_its_share():
    weights = {"a": 0.5, "b": 0.3, "c": 0.2}
    rows = mixing.phases({"a": 300, "b": 200, "c": 7}, weights, slots=100)
    at = {}
    for s, first, end, start, length, period in rows:
        for block in range(first, end):
            k = block - first
            at[start + k // len(period) * length + period[k % len(period)]] = (s, start)
    assert sorted(at) == list(range(507))
    got, phase = Counter(), 0
    for slot in range(507):
        s, start = at[slot]
        if start != phase:
            got, phase = Counter(), start
        got[s] += 1
        share = {s: len(p) / n for s, _, _, begin, n, p in rows if begin == phase}
        for name, part in share.items():
            assert abs(got[name] - part * (slot - phase + 1)) < 1


def test_mix_keeps_every_row(spark):
    rng = random.Random(8)
    rows = [(k if k % 9 else None, rng.choice([None, "", "text"]), "en", rng.choice(["src0", "src0", "src1", "odd", None]), k) for k in range(200)]
    df = spark.createDataFrame(rows + rows[:5], DOC)
    got = mixing.mix(df, {"src0": 0.4, "src1": 0.5, "absent": 0.1}, block_rows=4).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(rows + rows[:5])
    assert len({r["position"] for r in got}) == len(got)
    ordered = mixing.in_mixed_order(df, {"src0": 1.0})
    assert ordered.columns == df.columns and ordered.count() == 205
    assert mixing.mix(df.limit(0), {"src0": 1.0}).count() == 0
    assert mixing.in_mixed_order(df.limit(0), {"src0": 1.0}).count() == 0
    single = df.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    places = mixing.mix(single, {"src0": 0.4, "src1": 0.5}, block_rows=4).orderBy("position").collect()
    assert [r["doc_id"] for r in mixing.in_mixed_order(single, {"src0": 0.4, "src1": 0.5}, block_rows=4).collect()] == [r["doc_id"] for r in places]


# --- pipeline ----------------------------------------------------------------------

def brute_shingles(text, words=5):
    parts = (text or "").encode().lower().split()
    return {b" ".join(parts[i:i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set()


def near_copies(rng, n, edits):
    """A text of n words and copies with some words changed."""
    base = [f"v{rng.randrange(10**6)}" for _ in range(n)]
    for count in edits:
        copy = list(base)
        for at in rng.sample(range(n), count):
            copy[at] = f"x{rng.randrange(10**9)}"
        yield " ".join(copy)


def survivors(rows):
    """Of each group linked at a Jaccard similarity of 0.8 the smallest doc_id, by all pairs."""
    sets, parent = {i: brute_shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i for i in parent if root(i) == i}


def test_near_dedup_links_all_pairs_from_a_similarity_of_0_8(spark, monkeypatch):
    import corpus_pipeline
    from tablesift.llm import neardup

    monkeypatch.setattr(neardup, "SAMPLE", 2)
    rng = random.Random(9)
    texts = [None, "", "a b", "A  b", "a b c"] + ["boiler plate line of ten words that all texts have " + sentence(rng, 12) for _ in range(30)]
    for n in (150, 300, 600):
        for _ in range(12):
            texts += near_copies(rng, n, [0, *[rng.randint(0, n // 40) for _ in range(3)]])
    texts += near_copies(rng, 200, [rng.randint(0, 5) for _ in range(60)])
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    sims = [len(a & b) / len(a | b) for i, a in enumerate(map(brute_shingles, texts)) for b in map(brute_shingles, texts[:i]) if a & b]
    assert sum(0.8 <= s < 0.95 for s in sims) > 30 and sum(0.6 < s < 0.8 for s in sims) > 30
    got = corpus_pipeline.near_dedup(spark, docs_of(spark, rows), None)
    assert {r["doc_id"] for r in got.collect()} == survivors(rows)
    assert corpus_pipeline.near_dedup(spark, docs_of(spark, rows).limit(0), None).count() == 0


def test_prefixes_of_sequences_hold_the_target_shares(spark, monkeypatch):
    import corpus_pipeline
    from tablesift.llm.common import saved

    monkeypatch.setattr(packing, "WINDOW", 128)
    monkeypatch.setattr(packing, "ROUNDS", 20)
    monkeypatch.setattr(corpus_pipeline, "TARGET_WEIGHTS", {"hot": 0.2, "a": 0.4, "b": 0.4})
    rng = random.Random(10)
    # hot has 60 % of the rows; its target is held as long as the others last
    source = {i: "hot" if i % 5 < 3 else "ab"[i % 5 - 3] for i in range(2000)}
    rows = [(i, sentence(rng, rng.randint(1, 300) if i % 50 else 1500), "en", s, 0) for i, s in source.items()]
    docs = saved(corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, DOC), None))
    place = {r["doc_id"]: k for k, r in enumerate(docs.collect())}
    out = corpus_pipeline.pack_sequences(spark, docs, None).collect()
    assert {r["doc_id"] for r in out} == set(source)
    least, sums = {}, Counter()
    for r in out:
        least[r["sequence_id"]] = min(least.get(r["sequence_id"], 2000), place[r["doc_id"]])
        sums[r["sequence_id"]] += r["length"]
    assert sorted(least) == list(range(len(least))) and max(sums.values()) <= 2048
    assert sorted(least.values()) == [least[k] for k in range(len(least))]
    last = {}
    for r in out:
        last[r["doc_id"]] = max(last.get(r["doc_id"], 0), r["sequence_id"])
    order = sorted(last, key=lambda i: (last[i], i))
    for n in (256, 512, 768):
        got = Counter(source[i] for i in order[:n])
        assert abs(got["hot"] / n - 0.2) < 0.06, got


def test_packed_sequences_hold_the_token_ids(spark):
    import corpus_pipeline
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(VOCABULARY["json_path"])
    texts = [None, "", "a b <|endoftext|>", "word " * 5000, "one two three"]
    by_doc = defaultdict(list)
    for r in corpus_pipeline.pack_sequences(spark, docs_of(spark, list(enumerate(texts))), None).collect():
        assert r["sequence_id"] is not None and r["offset"] + r["length"] <= 2048 and len(r["ids"]) == 4 * r["length"]
        by_doc[r["doc_id"]].append((r["piece"], bytes(r["ids"])))
    for i, text in enumerate(texts):
        ids = np.frombuffer(b"".join(x for _, x in sorted(by_doc[i])), "<u4").tolist()
        assert ids == exact.encode(text or "", add_special_tokens=False).ids + [0]


def test_place_follows_files_and_rows(spark):
    from tablesift.llm.common import saved, with_place

    df = saved(spark.range(0, 500, 1, 7))
    assert all(r["id"] == r["at"] for r in with_place(df, "at").collect())
    rows = spark.createDataFrame([(k,) for k in range(90)], "id long")
    assert all(r["id"] == r["at"] for r in with_place(rows, "at").collect())


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == columns, name
        rows = out.collect()
        assert 0 < len(rows) <= docs.count()
        docs = spark.createDataFrame(rows, out.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_near_duplicates_start_from_simhash(spark, monkeypatch):
    from tablesift.llm import neardup

    rnd = random.Random(21)
    base = [f"w{rnd.randrange(5000)}" for _ in range(600)]
    rows = [(0, " ".join(base)), (1, " ".join(base[:-1])), (2, " ".join(f"v{rnd.randrange(5000)}" for _ in range(600)))]
    seen, plain = [], neardup.simhash_pairs

    def watched(classes):
        pairs = plain(classes)
        seen.append([(r.a, r.b) for r in pairs.collect()])
        return pairs

    monkeypatch.setattr(neardup, "simhash_pairs", watched)
    kept = neardup.one_per_group(spark.createDataFrame(rows, "doc_id long, text string"), words=5)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2]
    assert len(seen) == 1 and len(seen[0]) == 1  # the near copy, by its fingerprint


# --- what reaches the driver -------------------------------------------------------

def test_quality_sends_the_driver_numbers_and_no_lists_of_strings(spark, monkeypatch):
    kind, sent = type(spark.range(0)), []
    for name in ("collect", "toPandas", "toArrow"):
        def seen(self, *args, call=getattr(kind, name), **more):
            sent.append(self.schema.simpleString())
            return call(self, *args, **more)
        monkeypatch.setattr(kind, name, seen)
    rng = random.Random(11)
    texts = [sentence(rng, 20) if k % 2 else f"{sentence(rng, 12)} ## {k}" for k in range(60)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, k % 2) for k in range(62)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert sent and not any("array<string>" in s for s in sent)
    rows = quality.labelled_sample(docs, labels, "quality", 5, 0, 100).orderBy("_h", "doc_id", "label").collect()
    want = quality.fit([quality.indicators(r["text"]) for r in rows], [r["label"] for r in rows])
    assert model.weights.keys() == want.weights.keys() and len(want.weights) > 10
    for t in texts:
        assert model.score(quality.indicators(t)) == pytest.approx(want.score(quality.indicators(t)), abs=1e-9)
    empty = quality.train(docs.limit(0), labels)
    assert (empty.weights, empty.offset) == ({}, 0.0)


def test_tables_of_numbers_reach_the_driver_as_arrow(spark, monkeypatch):
    rng = random.Random(12)
    docs = docs_of(spark, [(k, f"{sentence(rng, 9)}\n{sentence(rng, 4)}") for k in range(40)])
    counts = Counter(int(lines._hash_array([w])[0]) % lines.BUCKETS for r in docs.collect() for w in lines._small(r["text"]).split())
    monkeypatch.setattr(type(docs), "collect", lambda self: pytest.fail("rows as Python objects"))
    ranks = lines._ranks(docs)
    assert np.argsort(ranks).tolist() == sorted(range(lines.BUCKETS), key=lambda b: (counts[b], b))
    marks = lines._marks(spark.range(50).select(F.col("id").alias("w")))
    assert 0 < sum(int(x).bit_count() if x >= 0 else 64 - int(~x).bit_count() for x in marks) <= 50
    assert not lines._marks(spark.range(0).select(F.col("id").alias("w"))).any()
    monkeypatch.setattr(neardup, "SAMPLE", 1)
    monkeypatch.setattr(neardup, "FREQUENT", 2)
    doubled = docs.unionAll(docs)
    tokens, n = neardup.frequent_shingles(doubled, 5)
    assert (tokens[1:] > tokens[:-1]).all() and len(tokens) and (n >= 2).all()
    assert not len(neardup.frequent_shingles(docs.limit(0), 5)[0])


# --- what the executors hold and move ----------------------------------------------

def test_near_duplicates_move_no_texts_of_pairs_that_sketches_tell_apart(spark, monkeypatch):
    rng = random.Random(31)
    shared = "one line of five words"
    rows = [(k, f"{shared} " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(14))) for k in range(12)]
    base = [f"v{rng.randrange(10**6)}" for _ in range(80)]
    rows += [(100, " ".join(base)), (101, " ".join([*base[:-3], "x", "y", "z"]))]
    tested, plain = [], neardup.saved

    def watched(df, kind="table"):
        out = plain(df, kind)
        if kind == "alike":
            tested.extend((r.a, r.b, r.same) for r in out.collect())
        return out

    monkeypatch.setattr(neardup, "FREQUENT", 100)  # no shingle is listed, so the shared ones are candidates
    monkeypatch.setattr(neardup, "saved", watched)
    kept = neardup.one_per_group(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), words=5)
    assert sorted(r.doc_id for r in kept.collect()) == [*range(12), 100]
    assert [same for _, _, same in tested] == [True]


def test_sketches_never_tell_similar_sets_apart():
    rng = np.random.default_rng(5)
    for n in (1, 9, 40, 700, 5000):
        a = rng.integers(0, 1 << 64, n, np.uint64, endpoint=False)
        b = np.concatenate([a[n // 9:], rng.integers(0, 1 << 64, n // 9, np.uint64, endpoint=False)])
        differ = int(np.bitwise_count((neardup.sketch_of(a) ^ neardup.sketch_of(b)).view(np.uint64)).sum())
        assert differ <= 2 * (n // 9) and len(neardup.sketch_of(a)) * 64 == neardup.PARITY


def test_line_dedup_leaves_no_word_hashes_in_the_worker():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["some words here", None, "and more"]})
    assert sum(b.column("n").to_numpy().sum() for b in lines._word_counts(iter([batch]))) == 5
    assert not lines._hashes


def test_line_dedup_runs_no_python_on_the_executors(spark, monkeypatch):
    plans, plain = [], lines.saved

    def watched(df, kind="table"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, kind)

    monkeypatch.setattr(lines, "saved", watched)
    monkeypatch.setattr(lines, "HOT", 3)
    rng = random.Random(14)
    base = [sentence(rng, 12) for _ in range(4)]
    rows = [(k, "\n".join(f"{rng.choice(base)} x{rng.randrange(9)}" for _ in range(4))) for k in range(40)]
    docs = spark.createDataFrame(spark.createDataFrame(rows, "doc_id long, text string").toArrow()).repartition(3)
    out = lines.without_repeated_lines(docs)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert not any(name in plan for plan in plans for name in ("ArrowEvalPython", "MapInArrow", "MapInPandas", "BatchEvalPython"))
    want = brute_removed(rows)
    assert {r["doc_id"]: r["text"].count("\n") + bool(r["text"]) for r in out.collect()} == {i: 4 - len(want[i]) for i, _ in rows}


def test_lines_are_parted_by_ascii_white_space(spark):
    rows = [(1, "one two\tthree"), (2, "ONE\x0btwo \x0c three\r"), (3, " \t\r\x0b\n\x0c"), (4, "one two three")]
    got = {r["doc_id"]: r["text"] for r in lines.without_repeated_lines(docs_of(spark, rows)).collect()}
    assert got == dict(rows) | {2: ""}
    counts = lines._counts(docs_of(spark, rows))
    want = np.zeros(lines.BUCKETS, np.int64)
    for _, t in rows:
        np.add.at(want, (lines._hash_array(lines._small(t).split()) & np.uint64(lines.BUCKETS - 1)).astype(int), 1)
    assert counts.tolist() == want.tolist()
