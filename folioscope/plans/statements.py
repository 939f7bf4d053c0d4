"""Queries over the geometry of pages, built from the driver's tables, each with an independently written DuckDB query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import geometry
from folioscope.operators import boxes
from folioscope.plans.registry import query
from folioscope.storage import land, release, table

_L = "WITH l AS (SELECT l_orderkey AS doc_id, l_linenumber AS pos, min(l_quantity) AS q, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2)\n"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("pos")).agg(F.min("l_quantity").cast("double").alias("q"), F.min("l_partkey").alias("p"))


def _turned(x0: Column, y0: Column, width: Column, degrees: Column) -> Column:
    """A line 30 high, turned about the origin."""
    corners = [(x0, y0), (x0 + width, y0), (x0 + width, y0 + 30), (x0, y0 + 30)]
    return F.array(*[F.array(*geometry.rotated(x, y, degrees)) for x, y in corners])


def _skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of pages turned by -2.5 to 2.5 degrees, give or take 0.05 by line; the fourth line of a page stands upright."""
    tilt = (F.col("doc_id") % 11 - 5) / 2 + F.when(F.col("pos") == 4, 90.0).otherwise((F.col("p") % 3 - 1) * 0.05)
    return _lines(spark, sf_dir).select("doc_id", F.lit(1).alias("page"), "pos", _turned(1000.0 * F.col("pos"), 100.0 * F.col("pos"), 100 + F.col("q"), tilt).alias("polygon"))


@query(_L + """, e AS (SELECT doc_id, pos, (doc_id % 11 - 5) / 2.0 AS tilt, (doc_id % 11 - 5) / 2.0 + CASE WHEN pos = 4 THEN 90 ELSE (p % 3 - 1) * 0.05 END AS angle, 100 + q AS w FROM l),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY angle, pos ROWS UNBOUNDED PRECEDING) AS cum, sum(w) OVER (PARTITION BY doc_id) AS total FROM e),
f AS (SELECT doc_id, min(angle) FILTER (2 * cum >= total) AS fitted, count(*) AS n_lines, any_value(CASE doc_id % 4 WHEN 0 THEN tilt WHEN 1 THEN -tilt WHEN 2 THEN tilt + 1 END) AS given FROM c GROUP BY doc_id)
SELECT doc_id, round(fitted, 4) AS fitted, n_lines,
  CASE WHEN given IS NULL THEN 'not given' WHEN abs(fitted - given) <= 0.3 THEN 'agrees' WHEN abs(fitted + given) <= 0.3 THEN 'opposite' ELSE 'differs' END AS finding FROM f
""")
def page_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The angle of every page's text, beside the one it came with."""
    fits = boxes.page_skew(_skewed(spark, sf_dir))
    tilt, kind = (F.col("doc_id") % 11 - 5) / 2, F.col("doc_id") % 4
    given = fits.select("doc_id", "page", F.when(kind == 0, tilt).when(kind == 1, -tilt).when(kind == 2, tilt + 1).alias("skew_angle"))
    return boxes.skew_findings(fits, given).select("doc_id", F.round("fitted", 4).alias("fitted"), "n_lines", "finding")


@query(_L + "SELECT doc_id, pos, CAST(dense_rank() OVER (PARTITION BY doc_id ORDER BY pos % 3) - 1 AS BIGINT) AS row FROM l")
def level_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of turned pages, on which lines of one row stand up to 300 pixels apart."""
    tilt = (F.col("doc_id") % 11 - 5) / 2
    lines = _lines(spark, sf_dir).select("doc_id", F.lit(1).alias("page"), "pos", _turned(1000.0 * F.col("pos"), 100.0 * (F.col("pos") % 3), 100 + F.col("q"), tilt).alias("polygon"))
    return boxes.level_rows(lines, boxes.page_skew(lines)).select("doc_id", "pos", "row")


@query(_L + """, s AS (
  SELECT a.doc_id, a.pos, b.pos AS line, b.p AS read, a.p, 'F' || a.pos % 3 AS field,
    greatest(0, least(a.x + 0.2, b.pos * 0.05 + 0.2) - greatest(a.x, b.pos * 0.05)) * greatest(0, least(a.y, b.q / 60) + 0.02 - greatest(a.y, b.q / 60)) AS shared
  FROM (SELECT *, pos * 0.05 + p % 5 * 0.01 AS x, q / 60 + p % 7 * 0.001 AS y FROM l) a JOIN l b USING (doc_id)
), o AS (
  SELECT *, round(shared / (0.2 * 0.02 * 2 - shared), 9) AS overlap FROM s WHERE shared > 1e-12
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY -overlap, pos, line) AS r FROM o
), taken AS (
  SELECT doc_id, list_reduce(list_prepend({'a': [-1], 'b': [-1], 'r': [-1]}, list({'a': [pos], 'b': [line], 'r': [r]} ORDER BY r)),
    lambda t, x: CASE WHEN list_contains(t.a, x.a[1]) OR list_contains(t.b, x.b[1]) THEN t ELSE {'a': list_concat(t.a, x.a), 'b': list_concat(t.b, x.b), 'r': list_concat(t.r, x.r)} END) AS t
  FROM ranked GROUP BY doc_id
), best AS (
  SELECT doc_id, pos, line, overlap >= 0.5 AS hit, overlap >= 0.5 AND read = p AS ok FROM ranked JOIN taken USING (doc_id) WHERE list_contains(t.r, r)
)
SELECT 'F' || l.pos % 3 AS field, doc_id, count(*) AS n, count(*) FILTER (hit) AS hits, count(*) FILTER (ok) AS n_right, round(count(*) FILTER (ok) / count(*), 6) AS accuracy
FROM l LEFT JOIN best USING (doc_id, pos) GROUP BY ALL
""")
def box_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often submitted boxes, here displaced ones, hit the text they name; per field and document."""
    x, y = F.col("pos") * 0.05, F.col("q") / 60
    box = lambda a, b: F.array(*[F.round(v, 9) for v in (a, b, a + 0.2, b + 0.02)])
    lines = land(_lines(spark, sf_dir), "lines")  # a document's lines are dealt together once, for both sides, before boxes make them wide
    rows = lines.repartition("doc_id").select("doc_id", F.lit(1).alias("page"), F.col("pos").alias("id"), F.col("p").cast("string").alias("text"), F.concat(F.lit("F"), (F.col("pos") % 3).cast("string")).alias("field"), box(x, y).alias("box"), box(x + F.col("p") % 5 * 0.01, y + F.col("p") % 7 * 0.001).alias("said"))
    submitted = rows.select("id", "doc_id", "page", "field", F.col("said").alias("box"), "text")
    _, found = boxes.accuracy(submitted, rows.select("id", "doc_id", "page", "box", "text"))
    release(lines)
    return found.withColumn("accuracy", F.round("accuracy", 6))
