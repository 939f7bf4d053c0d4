"""Chat formatting by Spark expressions only.

A conversation's rows are sorted by turn (ties: role, then text), neighbouring rows of one role are merged to
one block, and the blocks are joined to the formatted text::

    <turn>role<text>first row's text<cut>second row's text</turn>

``\\`` is written ``\\s`` and ``<`` is written ``\\l`` in roles and texts, so a ``<`` in the output is always
the template's, and every row can be read back as it was: blocks end at </turn>, role and texts part at <text>,
the texts of merged rows at <cut>. The loss mask holds the texts (escaped, as code point ranges) of assistant
rows, not the marks between them.

Null roles and texts are empty. Turns are of any type that has an order; null ones come first. Repeated rows are rows. Null conv_ids are one conversation. Other columns don't
matter, and an empty table gives an empty result. A conversation's text is one value, so its rows meet in one
task; they are collected after a partial aggregate and handled by expressions linear in their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 4096


def escaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l"))


def unescaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id and formatted, one row per conversation."""
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    last = F.size("turns") - 1
    starts = F.filter(F.sequence(F.lit(0), last), lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]))
    turns = turns.withColumn("starts", starts)

    def block(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get("starts", k + 1), F.size("turns"))
        texts = F.transform(F.slice("turns", start + 1, end - start), lambda t: escaped(t["text"]))
        return F.concat(F.lit("<turn>"), escaped(F.get("turns", start)["role"]), F.lit("<text>"), F.array_join(texts, "<cut>"), F.lit("</turn>"))

    return turns.select("conv_id", F.array_join(F.transform("starts", block), "").alias("formatted"))


def read_back(chats: DataFrame) -> DataFrame:
    """Adds ``turns``, an array of (role, text), read from the column ``formatted``."""
    blocks = F.split(F.col("formatted"), "</turn>", -1)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)
    named = F.transform(blocks, lambda b: F.struct(unescaped(F.substring_index(F.substring_index(b, "<text>", 1), "<turn>", -1)).alias("role"), F.split(F.substring_index(b, "<text>", -1), "<cut>", -1).alias("texts")))
    turns = F.flatten(F.transform(named, lambda b: F.transform(b["texts"], lambda t: F.struct(b["role"].alias("role"), unescaped(t).alias("text")))))
    return chats.withColumn("turns", turns)


def running(lengths: Column) -> Column:
    """Sums of all entries before each entry: of few entries one by one, else in runs of 512, so that no long array is copied per entry."""

    def few(x: Column) -> Column:
        return F.transform(x, lambda _, i: F.aggregate(F.slice(x, F.lit(1), i), F.lit(0).cast("long"), lambda a, n: a + n))

    # as a lambda's argument the lengths are made once
    return F.get(F.transform(F.array(lengths), lambda x: F.when(F.size(x) <= 24, few(x)).otherwise(_running(x))), F.lit(0))


def _running(lengths: Column) -> Column:
    zero = F.lit(0).cast("long")
    step = F.lit(512)

    def sums(x: Column) -> Column:
        start = F.struct(zero.alias("s"), F.array().cast("array<bigint>").alias("a"))
        return F.aggregate(x, start, lambda acc, n: F.struct((acc["s"] + n).alias("s"), F.concat(acc["a"], F.array(acc["s"])).alias("a")), lambda acc: acc["a"])

    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), (F.size(lengths) - 1)) , step), lambda k: F.slice(lengths, k + 1, step))
    totals = sums(F.transform(parts, lambda p: F.aggregate(p, zero, lambda a, n: a + n)))
    return F.flatten(F.zip_with(parts, totals, lambda p, before: F.transform(sums(p), lambda x: x + before)))


def loss_mask(chats: DataFrame) -> DataFrame:
    """Adds ``mask``: (start, length) of every assistant row's text in ``formatted``, in code points."""
    blocks = F.split(F.col("formatted"), "</turn>", -1)
    out = chats.withColumn("_blocks", F.slice(blocks, 1, F.size(blocks) - 1))
    out = out.withColumn("_starts", running(F.transform("_blocks", lambda b: F.length(b).cast("long") + len("</turn>"))))
    head = "<turn>assistant<text>"

    def texts(block: Column, start: Column) -> Column:
        lengths = F.transform(F.split(F.substr(block, F.lit(len(head) + 1)), "<cut>", -1), lambda t: F.length(t).cast("long"))
        starts = running(F.transform(lengths, lambda n: n + len("<cut>")))
        return F.zip_with(starts, lengths, lambda a, n: F.struct((start + len(head) + a).alias("start"), n.alias("length")))

    own = F.filter(F.arrays_zip(F.col("_blocks").alias("b"), F.col("_starts").alias("s")), lambda x: F.startswith(x["b"], F.lit(head)))
    return out.withColumn("mask", F.flatten(F.transform(own, lambda x: texts(x["b"], x["s"])))).drop("_blocks", "_starts")


def loss_text(chats: DataFrame) -> DataFrame:
    """Adds ``loss``: the ranges of ``mask``, which ``loss_mask`` gives where it is missing, cut out of ``formatted`` and unescaped.

    They are cut from pieces of PIECE code points, so that no range is sought from the text's start.
    """
    known = chats if "mask" in chats.columns else loss_mask(chats)
    pieces = F.regexp_extract_all("formatted", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def cut(held: Column, m: Column) -> Column:
        first, last = (F.floor(x / PIECE).cast("int") for x in (m["start"], m["start"] + F.greatest(m["length"], F.lit(1)) - 1))
        around = F.array_join(F.transform(F.sequence(first, last), lambda k: F.get(held, k)), "")
        return unescaped(F.substr(around, (m["start"] % PIECE + 1).cast("int"), m["length"].cast("int")))

    # as a lambda's argument the pieces are made once
    loss = F.transform(F.array(pieces), lambda held: F.array_join(F.transform("mask", lambda m: cut(held, m)), ""))
    return known.withColumn("loss", F.get(loss, F.lit(0))).select(*[F.col(f"`{c}`") for c in chats.columns], "loss")
