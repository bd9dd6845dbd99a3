"""The queries of this package's operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitsliced, bpe, chat, importance, kmeans_tree, lines, mixing, packing, quality, simhash, toxicity, vector_codes, warc
from .common import table

THRESHOLD = 0.3
#: Shares of the mixture: the largest source is held to a fifth, the others get equal parts.
TARGET_WEIGHTS = {"src0": 0.2} | {f"src{k}": 0.8 / 19 for k in range(1, 20)}
VOCABULARY = {
    "json_path": public_tokenizers.path("byte_bpe_50k.json"),
    "ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"),
    "pattern": public_tokenizers.PATTERN,
}
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicate_groups(docs, words=4)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_maximal(table(spark, sf_dir, "conversations"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, label="quality", folds=5, fold=0)
    scored = quality.score_documents(docs.select("doc_id", "text"), model)
    return judged(scored, quality.held_out(F.col("doc_id"), 5, 0))


def judged(scored: DataFrame, held_out: Column) -> DataFrame:
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its line count and the numbers of the removed lines."""
    return removed_per_row(table(spark, sf_dir, "documents").select("doc_id", "text"))


def removed_per_row(docs: DataFrame) -> DataFrame:
    gone = lines.removed_lines(docs).select(
        F.col("doc_id").alias("id"), F.col("hash").alias("h"), F.concat_ws(",", "lines").alias("removed"), F.size("lines").alias("n"))
    rows = docs.select("doc_id", F.size(F.split("text", "\n")).alias("line_count"), F.xxhash64("doc_id", "text").alias("hash"))
    rows = rows.join(gone, (F.col("hash") == F.col("h")) & F.col("doc_id").cast("long").eqNullSafe(F.col("id")), "left")
    return rows.select("doc_id", "line_count", F.coalesce("n", F.lit(0)).alias("removed_count"), F.coalesce("removed", F.lit("")).alias("removed"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its stream, block and place in the mixture."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), TARGET_WEIGHTS)
    return mixed.select("doc_id", "source", "stream", "block", "block_position", "position")


def op7_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return bitsliced.top_k(vectors.select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op8_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return kmeans_tree.search(vectors.select("vec_id", "embedding"), F.col("vec_id") % 50 == 0, k=5)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces with their sequences; a digest in place of the token ids."""
    pieces = packing.tokenize(table(spark, sf_dir, "documents"), **VOCABULARY).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(pieces)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, label="toxic", folds=4, fold=2)
    scored = toxicity.score_documents(docs.select("doc_id", "text"), model)
    return judged(scored, quality.held_out(F.col("doc_id"), 4, 2))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each text's token ids and of the text they decode to."""
    encoded = bpe.encode(table(spark, sf_dir, "documents"), WORD_VOCABULARY, keep=["doc_id"])
    texts = bpe.decode(encoded, WORD_VOCABULARY)
    return texts.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector its code, its error and that of its label, and the digest of the codebooks."""
    rows, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_group_error(rows, "label", "label_error")
    return rows.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its features, weight, score and rank in the draw."""
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    drawn = importance.resample(docs, target, keep=["doc_id"])
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_warc": op2_warc,
    "op4_chat": op4_chat,
    "op3_quality": op3_quality,
    "op5_line_dedup": op5_line_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_bit_sliced_top_k": op7_bit_sliced_top_k,
    "op8_kmeans_tree": op8_kmeans_tree,
    "op9_toxicity": op9_toxicity,
    "op10_mixing": op10_mixing,
    "op11_bpe": op11_bpe,
    "op12_vector_codes": op12_vector_codes,
    "op13_importance": op13_importance,
}
LINE_SQL = r"""
WITH rows_ AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                      unnest(range(len(string_split(text, chr(10))))) AS no FROM documents),
words AS (SELECT DISTINCT doc_id, no, w FROM (
    SELECT doc_id, no, unnest(string_split(translate(lower(line), chr(9) || chr(13) || chr(12) || chr(11), '    '), ' ')) AS w FROM rows_) WHERE w <> ''),
sizes AS (SELECT doc_id, no, list_sort(list(w)) AS ws, count(*) AS n FROM words GROUP BY ALL),
sets AS (SELECT ws, any_value(n) AS n, min((doc_id, no)) AS first, row_number() OVER () AS c FROM sizes GROUP BY ws),
member AS (SELECT c, n, first, unnest(ws) AS w FROM sets),
rarity AS (SELECT w, count(*) AS df FROM member GROUP BY w),
placed AS (SELECT c, n, first, w, row_number() OVER (PARTITION BY c ORDER BY df, w) AS spot FROM member JOIN rarity USING (w)),
prefix AS (SELECT * FROM placed WHERE spot <= n - ceil(0.8 * n) + 1),
pairs AS (SELECT DISTINCT a.c AS a, b.c AS b FROM prefix a JOIN prefix b ON a.w = b.w AND b.first < a.first AND 4 * a.n <= 5 * b.n AND 4 * b.n <= 5 * a.n),
matched AS (SELECT DISTINCT p.a AS c FROM pairs p JOIN sets x ON x.c = p.a JOIN sets y ON y.c = p.b
    WHERE 9 * len(list_intersect(x.ws, y.ws)) >= 4 * (x.n + y.n)),
gone AS (SELECT doc_id, no FROM sizes JOIN sets USING (ws) WHERE (doc_id, no) <> first OR c IN (SELECT c FROM matched)),
listed AS (SELECT doc_id, string_agg(no::VARCHAR, ',' ORDER BY no) AS removed, count(*)::INTEGER AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(string_split(d.text, chr(10)))::INTEGER AS line_count, coalesce(n, 0)::INTEGER AS removed_count, coalesce(removed, '') AS removed
FROM documents d LEFT JOIN listed USING (doc_id)
"""
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
FROM h
"""
CHAT_SQL = """
WITH c AS (SELECT conv_id, list((role, text) ORDER BY turn, role, text) AS ts, count(*) AS n,
                  string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered
           FROM conversations GROUP BY conv_id)
SELECT a.conv_id, n AS turns, 0 AS part, rendered FROM c a
WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.ts[1] = a.ts[1] AND b.ts[1:a.n] = a.ts AND (b.n > a.n OR (b.n = a.n AND b.conv_id < a.conv_id)))
"""
TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings),
f AS (SELECT vec_id, unnest(e) AS x, unnest(range(len(e))) AS d FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sum(q.x * c.x)::BIGINT AS score
      FROM f q JOIN f c ON q.d = c.d WHERE q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id GROUP BY ALL)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


def vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The same k-means with all distances."""
    steps = [f"""kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS e
FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT id, p, e[1 + p * (len(e) // {parts}):(p + 1) * (len(e) // {parts})] AS xs FROM kept, range({parts}) r(p)),
book0 AS MATERIALIZED (SELECT p, id - 1 AS k, xs AS es FROM part WHERE id <= {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""own{r} AS MATERIALIZED (SELECT id, p, xs, min((list_sum(list_transform(range(1, len(xs) + 1), lambda i: (xs[i] - es[i]) * (xs[i] - es[i])))::BIGINT, k)) AS best
FROM part JOIN book{r} USING (p) GROUP BY id, p, xs)""")
        if r < rounds:
            steps.append(f"""mean{r} AS (SELECT p, k, list(floor(s / n)::BIGINT ORDER BY i) AS es FROM (
    SELECT p, best[2] AS k, i, sum(xs[i])::DOUBLE AS s, count(*) AS n FROM (SELECT *, unnest(range(1, len(xs) + 1)) AS i FROM own{r}) GROUP BY ALL) GROUP BY p, k),
book{r + 1} AS MATERIALIZED (SELECT p, k, coalesce(m.es, b.es) AS es FROM book{r} b LEFT JOIN mean{r} m USING (p, k))""")
    last = f"own{rounds}"
    steps.append(f"""code AS (SELECT id, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM {last} GROUP BY id),
books AS (SELECT sha256(string_agg(array_to_string(es, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM book{rounds})""")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN code USING (id), books"""


IMPORTANCE_SQL = r"""
WITH codes AS (SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS tab FROM range(256) t(n)),
d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
words AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM d UNION SELECT w FROM b)),
bucket AS (SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
                             lambda c, v: xor(c >> 8, tab[(xor(c, v) & 255) + 1])), 4294967295) % 10000 AS k FROM words, codes),
s AS (SELECT k, count(*) AS s FROM d JOIN bucket USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM b JOIN bucket USING (w) GROUP BY k),
gain AS (SELECT k, floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM s) + 10000))::DOUBLE
                                   / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))::DOUBLE))::BIGINT AS g FROM s FULL JOIN t USING (k)),
per AS (SELECT doc_id, count(*) AS n, sum(g) AS weight FROM d JOIN bucket USING (w) JOIN gain USING (k) GROUP BY doc_id),
scored AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                  (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
           FROM documents LEFT JOIN per USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scored LEFT JOIN placed USING (doc_id)
"""
LLM_ORACLES: dict[str, str] = {"op7_bit_sliced_top_k": TOP_K_SQL, "op2_warc": WARC_SQL, "op4_chat": CHAT_SQL, "op5_line_dedup": LINE_SQL,
                               "op12_vector_codes": vector_codes_sql(), "op13_importance": IMPORTANCE_SQL}
