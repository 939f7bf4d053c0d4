"""The viewer's report: what a search finds on requested pages, and why it finds nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions import geometry
from folioscope.operators import text
from folioscope.sources import filings, sinks


def report(requests: DataFrame, pages: DataFrame, sizes: DataFrame, needle: str) -> DataFrame:
    """For requests (doc_id, page): status, and the found lines with pos, box and report line, in document order.

    The status is ``out of range`` (the document has no such page), ``no ocr`` (the page wasn't read), ``not found`` or
    ``found``. ``pages`` are (doc_id, page, ocr), ``sizes`` (doc_id, page, w_pt, h_pt). A line without polygon has no box and
    is reported by its text alone.
    """
    # the sizes are read once: a document's number of pages, and the size of the requested one
    own = sizes.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_pages"), F.collect_list(F.struct("page", "w_pt", "h_pt")).alias("sizes"))
    asked = requests.join(own, "doc_id", "left").withColumn("size", F.get(F.filter("sizes", lambda x: x["page"] == F.col("page")), F.lit(0))).drop("sizes")
    asked = asked.withColumn("in_range", F.coalesce(F.col("page").between(1, F.col("n_pages")), F.lit(False)))
    # only requested pages are opened and searched
    wanted = asked.where("in_range").select("doc_id", "page", "size").distinct()
    read = pages.select("doc_id", "page", "ocr").join(wanted, ["doc_id", "page"])
    lines = filings.ocr_lines(read, "doc_id", "page", "size")
    there = lines.groupBy("doc_id", "page").agg(F.lit(True).alias("there"))
    pixels = F.array("px_x0", "px_y0", "px_x1", "px_y1")
    box = F.when(F.col("px_x0").isNotNull(), geometry.normalised(pixels, F.col("size.w_pt"), F.col("size.h_pt")))
    found = text.grep(lines, needle).select("doc_id", "page", "pos", "text", box.alias("box"))
    out = asked.join(there, ["doc_id", "page"], "left").join(found, ["doc_id", "page"], "left")
    status = F.when(~F.col("in_range"), "out of range").when(F.col("there").isNull(), "no ocr").when(F.col("pos").isNull(), "not found").otherwise("found")
    line = F.coalesce(sinks.report_line(F.col("box"), F.col("text")), F.col("text"))
    return out.select("doc_id", "page", status.alias("status"), "pos", "box", line.alias("line")).orderBy("doc_id", "page", "pos")
