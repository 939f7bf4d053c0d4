"""Lines of documents and the literal, case-insensitive search in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: All white space of Unicode, which a line loses at both ends.
BLANKS = "".join(chr(i) for i in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def stripped(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit("")), F.lit(BLANKS))


def lines(docs: DataFrame, *keys: str, column: str = "text") -> DataFrame:
    """One row per line with its 0-based ``pos``; a null text keeps its row, with null pos and text."""
    return docs.select(*keys, F.posexplode_outer(F.split(column, "\n", -1)).alias("pos", "text")).withColumn("pos", F.col("pos").cast("long"))


def contains(c: Column, needle: str) -> Column:
    """Literal substring of the stripped text, without regard to case; never for an empty needle."""
    return F.contains(F.lower(stripped(c)), F.lower(F.lit(needle))) if needle else F.lit(False)


def grep(rows: DataFrame, needle: str) -> DataFrame:
    """Rows whose ``text`` contains the needle, their text stripped; an empty needle finds none."""
    return rows.where(contains(F.col("text"), needle)).withColumn("text", stripped(F.col("text")))


def confident(rows: DataFrame, least: float, score: str = "score") -> DataFrame:
    """Rows that OCR read with at least the given score; a null score doesn't count as any."""
    return rows.where(F.col(score) >= least)
