"""A corpus pipeline of five stages; each takes all documents its predecessor kept.

1. Language identification: documents that the model rejects go.
2. Near-duplicates: of every group of documents the one with the smallest doc_id stays (null ones count as the
   largest), and one row of it.
3. Decontamination: documents that hold a window of a benchmark item go.
4. Personal data: base patterns and disclosing terms are replaced in the texts.
5. Byte-pair encoding: the ids of every text, and the text they decode to.

Rows with null texts go in the first stage. All stages but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import bpe, decontaminate, language, minhash, pii
from folioscope.llm.queries import TOKENIZER
from folioscope.storage import land, release, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    identifier = language.learn(docs.where(F.col("lang").isNotNull() & ~language.held_out()))
    return language.identify(docs, identifier).where("not rejected").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # rows have keys of their own, landed so that they stay: a doc_id may be null or repeated
    rows = land(docs.select(F.monotonically_increasing_id().alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "keyed")
    found = minhash.near_duplicates(rows.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")), size=5, percent=80)
    found = found.select(F.col("doc_id").alias("key"), F.col("component_id").alias("c"))
    grouped = land(found.join(rows.select("key", F.col("row.doc_id").alias("doc_id")), "key"), "grouped")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    best = land(grouped.groupBy("c").agg(least.alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("c", F.col("least.key").alias("best")), "best")
    gone = land(grouped.join(best, "c").where("key <> best").select("key"), "gone")
    return rows.join(gone, "key", "left_anti").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("found.starts") == 0).select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.sanitise(docs)
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return out.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    decoded = bpe.recode(docs, TOKENIZER)
    return decoded.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

#: Language models, MinHash and byte-pair encoding have no SQL form; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = land(docs, name)
            release(before)  # the last stage still reads the table before it
            before = docs
    return docs
