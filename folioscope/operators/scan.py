"""Running values in order, per key, where a key may hold any share of all rows.

A window over a key puts all of its rows into one task. Here rows are dealt by ranges of key and order, landed with the number of their
range, and scanned range by range; what a key carries from one range into the next is added from a table of borders. Only a
key that spans ranges has borders, and a range begins within one key at most, so this table has fewer rows than
twice the ranges and is broadcast. Orders must be total, or else equal rows follow each other in either order; nulls come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.storage import land

PART = "_part"


def ranged(rows: DataFrame, keys: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """Lands rows with ``_part``, the number of their range by keys and order; ``parts`` fixes how many there are."""
    by = [*keys, *order]
    dealt = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
    return land(dealt.withColumn(PART, F.spark_partition_id()), "ranged")


def _borders(rows: DataFrame, keys: list[str], totals: list[Column]) -> DataFrame:
    """Aggregates of each range of the keys that span several."""
    spans = rows.groupBy(*keys).agg(F.min(PART).alias("_first"), F.max(PART).alias("_last")).where("_first < _last")
    own = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    some = rows.alias("r").join(F.broadcast(spans.alias("s")), own, "left_semi")
    return some.groupBy(*keys, PART).agg(*totals)


def _with(rows: DataFrame, borders: DataFrame, keys: list[str], carried: list[Column]) -> DataFrame:
    """Adds what earlier ranges carry into each."""
    w = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    at = borders.select(*keys, PART, *[c(w) for c in carried])
    names = [c for c in at.columns if c not in (*keys, PART)]
    own = [F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in (*keys, PART)]
    return rows.alias("r").join(F.broadcast(at.alias("b")), own, "left").select("r.*", *[f"b.{n}" for n in names])


def _inner(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys, PART).orderBy(*order)


def running(rows: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Adds running sums, each row's own value included, to rows as ``ranged`` returns them; null counts as 0."""
    held = rows.select("*", *[F.coalesce(c, F.lit(0)).alias(f"_{n}") for n, c in sums.items()])
    borders = _borders(held, keys, [F.sum(f"_{n}").alias(f"_{n}") for n in sums])
    carried = [lambda w, n=n: F.sum(f"_{n}").over(w).alias(f"_c_{n}") for n in sums]
    w = _inner(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    held = held.select("*", *[F.sum(f"_{n}").over(w).alias(f"_w_{n}") for n in sums])
    out = _with(held, borders, keys, carried)
    return out.select(*rows.columns, *[(F.col(f"_w_{n}") + F.coalesce(f"_c_{n}", F.lit(0))).alias(n) for n in sums])


def last(rows: DataFrame, keys: list[str], order: list[str], values: dict[str, Column], before: bool = False) -> DataFrame:
    """Adds the last value that isn't null at or before each row, or strictly before it; null where there is none."""
    held = rows.select("*", *[c.alias(f"_{n}") for n, c in values.items()])
    latest = F.struct(*order)
    borders = _borders(held, keys, [F.max_by(f"_{n}", F.when(F.col(f"_{n}").isNotNull(), latest)).alias(f"_{n}") for n in values])
    carried = [lambda w, n=n: F.last(f"_{n}", ignorenulls=True).over(w).alias(f"_c_{n}") for n in values]
    w = _inner(keys, order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    held = held.select("*", *[F.last(f"_{n}", ignorenulls=True).over(w).alias(f"_w_{n}") for n in values])
    out = _with(held, borders, keys, carried)
    return out.select(*rows.columns, *[F.coalesce(f"_w_{n}", f"_c_{n}").alias(n) for n in values])


def since_reset(rows: DataFrame, keys: list[str], order: list[str], values: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Adds running sums of the first of two columns that the second, an absolute value, sets anew; null counts as no change.

    A running total less the total at the last reset, plus what it was set to: two running values, no second sort.
    """
    delta = {f"_d_{n}": F.when(absolute.isNull(), delta) for n, (delta, absolute) in values.items()}
    summed = running(rows, keys, order, delta)
    base = {f"_b_{n}": F.when(absolute.isNotNull(), absolute - F.col(f"_d_{n}")) for n, (_, absolute) in values.items()}
    out = last(summed, keys, order, base)
    return out.select(*rows.columns, *[(F.col(f"_d_{n}") + F.coalesce(f"_b_{n}", F.lit(0))).alias(n) for n in values])
