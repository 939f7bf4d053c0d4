"""Rows that pass through Python with their text once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def parted(documents: DataFrame) -> tuple[DataFrame, Column]:
    """(text, rest) of every row, and the expression that puts the row together again from both.

    A text that is a string isn't in ``rest``, so that it goes to Python and back once; one of another type is, beside its string form.
    """
    own = isinstance(documents.schema["text"].dataType, StringType)
    others = [c for c in documents.columns if not (own and c == "text")]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    row = F.struct(*[(F.col("text") if own and c == "text" else F.col("rest")[c]).alias(c) for c in documents.columns])
    return documents.select(F.col("text").cast("string").alias("text"), rest.alias("rest")), row
