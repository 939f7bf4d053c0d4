"""Which documents and pages are there, and what they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def in_scope(rows: DataFrame, scope: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the scope table."""
    return rows.join(scope.select(key), key, "left_semi")


def missing(rows: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Rows without a counterpart."""
    return rows.join(present.select(key), key, "left_anti")


def shares(rows: DataFrame, present: DataFrame, key: str, by: str) -> DataFrame:
    """Per group: number of rows, and of those with a counterpart."""
    marked = rows.join(present.select(key).distinct().withColumn("_there", F.lit(True)), key, "left")
    return marked.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.count("_there").alias("n_present"))


def page_range(pages: DataFrame) -> DataFrame:
    """Per document: number of pages, first and last page; numbers may have gaps."""
    return pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"), F.min("page").alias("first"), F.max("page").alias("last"))


def filing_documents(filings: DataFrame, pages: DataFrame, key: str = "id") -> DataFrame:
    """Every filing with its OCR document, found by id: has_ocr, number of pages (0 without), first and last page."""
    held = page_range(pages).withColumnRenamed("doc_id", key)
    out = filings.join(held, key, "left")
    return out.withColumn("has_ocr", F.col("n_pages").isNotNull()).withColumn("n_pages", F.coalesce("n_pages", F.lit(0).cast("long")))


def file_order(pages: DataFrame) -> DataFrame:
    """Adds the page's file name and ``seq``, its place from 1 among the document's names as strings: beyond page 999 not by number."""
    named = pages.withColumn("name", F.format_string("page_%03d.json", F.col("page")))
    return named.withColumn("seq", F.row_number().over(Window.partitionBy("doc_id").orderBy("name")))


def page_count_gaps(pages: DataFrame, sizes: DataFrame) -> DataFrame:
    """Documents that have OCR, but for another number of pages than the PDF has."""
    pdf = sizes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pdf"))
    return page_range(pages).join(pdf, "doc_id").where("n_pages > 0 and n_pages <> n_pdf").select("doc_id", F.col("n_pages").alias("n_ocr"), "n_pdf")


def requested_pages(requests: DataFrame, sizes: DataFrame) -> DataFrame:
    """Requests (doc_id, page) with ``in_range``: 1 <= page <= the document's number of pages."""
    n = sizes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"))
    return requests.join(n, "doc_id", "left").withColumn("in_range", F.coalesce(F.col("page").between(1, F.col("n_pages")), F.lit(False)))


def page_info(pages: DataFrame, sizes: DataFrame) -> DataFrame:
    """Size in points and number of lines of every page; pages without OCR have 0 lines."""
    lines = pages.select("doc_id", "page", F.greatest(F.size("ocr"), F.lit(0)).alias("n_lines"))
    return sizes.join(lines, ["doc_id", "page"], "left").select("doc_id", "page", "w_pt", "h_pt", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.col("n_lines").isNotNull().alias("has_ocr"))


def profile(pages: DataFrame, by: str) -> DataFrame:
    """Per group: pages, mean absolute skew, tables and lines per page."""
    tables = F.greatest(F.size(F.filter("layout", lambda r: r["label"] == "table")), F.lit(0))
    lines = F.greatest(F.size("ocr"), F.lit(0))
    return pages.groupBy(by).agg(F.count(F.lit(1)).alias("n_pages"), F.avg(F.abs("skew_angle")).alias("skew"), F.avg(tables).alias("tables"), F.avg(lines).alias("lines"))


def disagreements(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose value differs between two sources or is in one only, as (key, a, b)."""
    both = a.select(key, F.col(value).alias("a")).join(b.select(key, F.col(value).alias("b")), key, "full_outer")
    return both.where(~F.col("a").eqNullSafe(F.col("b")))


def missing_pages(requests: DataFrame, pages: DataFrame) -> DataFrame:
    """Requested (doc_id, page) that aren't there, with the document's first and last page, null if it has none."""
    absent = requests.join(pages.select("doc_id", "page"), ["doc_id", "page"], "left_anti")
    return absent.join(page_range(pages), "doc_id", "left").select("doc_id", "page", "first", "last")
