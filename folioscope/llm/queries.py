"""One query per operator of this subpackage, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import bpe, chat, decontaminate, hard_negatives, language, maxscore, minhash, pii, sharding, token_counts, token_files, variants, warc
from folioscope.storage import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: The tokenizer files of op3 and op5, and of op13; their paths are parameters of the operators.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.recode(table(spark, sf_dir, "documents"), TOKENIZER).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )


@query
def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate(F.zip_with("found.starts", "found.ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return found.select(
        "row.doc_id",
        F.col("found.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def _said(spans):
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"] != "term")
    return found.select(
        "row.doc_id",
        *[count(k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(_said(base), 256).alias("base_sha256"),
        _said(F.col("spans")).alias("spans"),
        count("term").alias("n_term"),
    )


@query
def op6_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(table(spark, sf_dir, "documents"), count=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    chats = chat.loss_text(chat.read_back(chat.formatted(rows)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "utf-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "utf-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE_SQL["op10_chat"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), said AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(replace(replace(text, '\', '\s'), '<', '\l'))
    + CASE WHEN before IS NOT DISTINCT FROM role THEN 5
           ELSE 19 + length(replace(replace(role, '\', '\s'), '<', '\l')) END) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
"""


@query
def op2_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return maxscore.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


ORACLE_SQL["op2_maxscore"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, 65), lambda i: q.w[i] * c.w[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL["op4_warc"] = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha256(coalesce(html, '')) AS d FROM pages
), m AS (
  SELECT *, min(page_id) OVER (PARTITION BY d) AS least FROM p
)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> least THEN least END AS refers_to
FROM m
"""


@query
def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    identifier = language.learn(docs.where(F.col("lang").isNotNull() & ~language.held_out()))
    found = language.identify(docs.select("doc_id", "text"), identifier)
    found = found.select("row.doc_id", "lang_pred", "score")
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


ORACLE_SQL["op9_winnowing"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), sized AS (
  SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
), places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM sized) WHERE len(w) >= n)
), found AS (
  SELECT doc_id, item_id, n, i FROM places JOIN windows USING (n, win)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE_SQL["op7_minhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE len(w) WHEN 0 THEN [] WHEN 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS x FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.r = edges.a
)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""


@query
def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = variants.with_lost_letters(variants.runs(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return variants.spelling_groups(variants.vocabulary(found))


ORACLE_SQL["op11_variants"] = r"""
WITH RECURSIVE checks AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t
), said AS (
  SELECT w, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS k, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS w FROM documents
  ) WHERE length(w) >= 7 GROUP BY ALL
), hashed AS (
  SELECT w, n, xor(list_reduce(
    list_transform(range(1, strlen(k) + 1), lambda i: CAST(('0x' || substr(hex(encode(k)), CAST(2 * i - 1 AS BIGINT), 2)) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), 4294967295), 4294967295) AS h FROM said, checks
), lost AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) + 2 AS BIGINT)) ELSE w END AS word, n FROM hashed
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM lost WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), gaps AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS key FROM (SELECT word, CAST(unnest(range(1, length(word) + 1)) AS BIGINT) AS i FROM v)
), near AS (
  SELECT a.word AS a, b.word AS b FROM gaps a JOIN gaps b ON a.key = b.key AND a.i = b.i AND a.word <> b.word
  UNION SELECT g.word, v.word FROM gaps g JOIN v ON g.key = v.word
  UNION SELECT v.word, g.word FROM gaps g JOIN v ON g.key = v.word
), ranked AS (
  SELECT a, b, v.n AS k, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY v.n DESC, b) AS r FROM near JOIN v ON v.word = b
), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN k >= 10 * n THEN b END AS form, CASE WHEN k >= 10 * n THEN k END AS form_n
  FROM v LEFT JOIN ranked ON a = word AND r = 1
), follow(word, reached, k) AS (
  SELECT word, form, 1 FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT f.word, g.form, k + 1 FROM follow f JOIN formed g ON g.word = f.reached WHERE g.form IS NOT NULL
)
SELECT f.word, form, coalesce(root, f.word) AS root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM formed f LEFT JOIN (SELECT word, arg_max(reached, k) AS root FROM follow GROUP BY word) r ON r.word = f.word
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0, positives=5, negatives=3, lower=50, upper=95)


ORACLE_SQL["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_sum(list_transform(range(1, 65), lambda i: a.w[i] * c.w[i])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score FROM (
  SELECT *, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
) WHERE rank <= 3
"""


@query
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.write_token_files(table(spark, sf_dir, "documents"), WORD_TOKENIZER, end_id=1)
    found = token_files.read_token_files(spark, folder)
    return found.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
