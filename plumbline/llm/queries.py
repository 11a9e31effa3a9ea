"""Queries of the operators over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    byte_bpe, chat_format, exact_dedup, lexical_search, license_scan, mixing, near_dup, secret_scan, token_align, token_files,
    toxicity, vector_dedup, vector_search,
)
from plumbline.llm.common import read
from plumbline.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def add(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@add("op1_source_mix", """
WITH RECURSIVE roots AS (SELECT '=' || source AS key, floor(sqrt(count(*)) * 1000) AS root FROM documents GROUP BY source),
shares AS (
  SELECT key, CAST(greatest(floor(root * 1000 / (SELECT sum(root) FROM roots)), 1) AS BIGINT) AS share FROM roots),
lists AS (SELECT list(key ORDER BY key) AS ks, list(share ORDER BY key) AS shs, CAST(sum(share) AS BIGINT) AS w FROM shares),
steps AS (
  SELECT CAST(-1 AS BIGINT) AS t, list_transform(shs, lambda x: CAST(0 AS BIGINT)) AS js, CAST(0 AS BIGINT) AS p, CAST(0 AS BIGINT) AS j FROM lists
  UNION ALL
  SELECT t + 1, list_transform(js, lambda x, i: CASE WHEN i = pick THEN x + 1 ELSE x END), pick, js[pick]
  FROM (
    SELECT t, js, list_min(list_filter(list_transform(js, lambda x, i: CASE
        WHEN x < shs[i] AND (x * w) // shs[i] <= t + 1 THEN (((x + 1) * w + shs[i] - 1) // shs[i]) * 100000 + i END),
        lambda v: v IS NOT NULL)) % 100000 AS pick
    FROM steps, lists WHERE t + 1 < w) s),
slots AS (SELECT ks[p] AS key, shs[p] AS share, j, t AS slot, w FROM steps, lists WHERE t >= 0),
dealt AS (
  SELECT doc_id, source, '=' || source AS key,
    row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS place FROM documents)
SELECT doc_id, source, place // 64 AS block, place % 64 AS row_in_block,
  ((place // 64) * w) // share AS release, ((place // 64 + 1) * w + share - 1) // share AS deadline,
  ((place // 64) // share) * w + slot AS slot
FROM dealt JOIN slots ON dealt.key = slots.key AND (place // 64) % share = slots.j
""")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "source")
    return mixing.schedule(docs, mixing.tempered_shares(docs)).select(
        "doc_id", "source", F.col("mix_block").alias("block"), F.col("mix_row").alias("row_in_block"),
        F.col("mix_release").alias("release"), F.col("mix_deadline").alias("deadline"), F.col("mix_slot").alias("slot"),
    )


@add("op2_near_dup", """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x09-\\x0D\\x20]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (sh) GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE k / (a.c + b.c - k) >= 0.8),
r AS (SELECT doc_id AS id, doc_id AS seen FROM documents UNION SELECT id, y FROM r JOIN l ON seen = x),
g AS (SELECT id, min(seen) AS class_id FROM r GROUP BY id)
SELECT w.doc_id, class_id, w.doc_id = class_id AS kept, CAST(coalesce(c, 0) AS BIGINT) AS n_shingles
FROM w JOIN g ON w.doc_id = id LEFT JOIN n ON n.doc_id = w.doc_id
""")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return near_dup.classes(read(spark, sf, "documents"))


@add("op3_secret_scan")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    versions = read(spark, sf, "documents").select(F.col("doc_id").alias("path"), "text")
    ledger = scratch_dir(spark, "secret-ledger")
    secret_scan.update_ledger(versions, ledger)
    found = secret_scan.findings(versions, ledger)
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secret_scan.BASE]))
    kinds = F.transform("spans", lambda s: s["kind"])
    count = [
        F.size(F.array_remove(kinds, r.kind)) for r in secret_scan.BASE
    ]
    count = [(F.size("spans") - n).cast("bigint").alias(f"n_{r.kind}") for n, r in zip(count, secret_scan.BASE)]
    return found.select(
        F.col("path").alias("doc_id"), *count,
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed("spans").alias("spans"),
    )


@add("op4_license_scan")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(read(spark, sf, "documents").select("doc_id", "text"))


_ESCAPED = "replace(replace(replace({}, '\\', '\\b'), '###', '\\h'), '</turn>', '\\t')"


@add("op5_chat_format", f"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok')) v)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### : </turn>') + 1 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
""")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    turns = read(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    out = chat_format.formatted(chat_format.chain(turns.unionByName(extra)))
    back = out.select(F.col("tree").alias("conv_id"), "formatted", chat_format.turns_of().alias("turns"), chat_format.learned_text().alias("learned"))
    spelled = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(spelled, 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@add("op6_toxicity")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents").select("doc_id", "text")
    out = toxicity.scores(docs, toxicity.train(docs, read(spark, sf, "labels")))
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    return out.select(
        "doc_id", held.alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted")
    )


@add("op7_byte_bpe")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encode_documents(read(spark, sf, "documents"), path, public_tokenizers.PATTERN)


@add("op8_token_files")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.round_trip(read(spark, sf, "documents"), path, 1, scratch_dir(spark, "token-files"))


@add("op9_exact_dedup", """
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
""")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.classes(read(spark, sf, "documents"))


@add("op10_vector_dedup", """
WITH RECURSIVE l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.98),
r AS (SELECT vec_id AS id, vec_id AS seen FROM embeddings UNION SELECT id, y FROM r JOIN l ON seen = x),
g AS (SELECT id, min(seen) AS component_id FROM r GROUP BY id),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN g ON vec_id = id LEFT JOIN n ON vec_id = x
""")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    # The audited recall is left to the operator: it is no value of a row.
    return vector_dedup.classes(read(spark, sf, "embeddings")).drop("recall")


@add("op11_token_align")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    counts = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return token_align.align(read(spark, sf, "documents"), *paths).select("doc_id", *counts, "groups_sha256")


_TERMS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""


@add("op12_lexical_search", f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS ts FROM documents),
s AS (SELECT count(*) AS n_all, CAST(sum(len(ts)) AS BIGINT) AS l_all FROM d WHERE len(ts) > 0),
i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM d) o GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
x AS (
  SELECT item_id, doc_id, r, CAST(sum(CAST(floor(1000 * ln(CAST(2 * n_all + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_all) // l_all)))) AS BIGINT) AS score
  FROM i JOIN p USING (term) JOIN f USING (term), s GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY rank <= 10
""")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return lexical_search.ranked(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@add("op13_vector_search", """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_cosine_similarity(a.e, b.e) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM p QUALIFY rank <= 5
""")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    vectors = read(spark, sf, "embeddings")
    return vector_search.nearest(vectors, vectors.where("vec_id % 50 = 0"))
