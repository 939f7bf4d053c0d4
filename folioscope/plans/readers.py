"""Queries that write the driver's rows as files of the corpus's layout and read them back, each with an independently written DuckDB query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import geometry
from folioscope.plans.registry import query
from folioscope.sources import filings, pdf, sinks
from folioscope.storage import land, new_folder, table


def _key(prefix: str, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col("s_suppkey").cast("string"), width - len(prefix), "0"))


def _corpus(spark: SparkSession, sf_dir: str) -> str:
    """A company per supplier: an acte, which some have withdrawn, a bilan, and three pages of OCR, the third without lines. Returns the root."""
    k = F.col("s_suppkey")
    siren, acte, bilan = _key("", 9), _key("a", 24), _key("b", 24)
    decision = lambda text: F.struct(F.lit("Statuts").alias("typeActe"), text.alias("decision"))
    meta = [siren.alias("siren"), F.col("s_name").alias("denomination"), F.date_format(F.date_add(F.lit("2010-01-01").cast("date"), k.cast("int")), "yyyy-MM-dd").alias("dateDepot")]
    acts = F.to_json(F.struct(acte.alias("id"), *meta, F.when(k % 7 == 0, True).alias("deleted"), F.array(decision(F.lit("Augmentation du capital")), decision(F.col("s_name"))).alias("typeRdd")))
    sheet = F.to_json(F.struct(bilan.alias("id"), *meta, F.lit("2009-12-31").alias("dateCloture"), F.lit("C").alias("typeBilan"), F.lit(False).alias("deleted")))
    x, y = (k % 100).cast("double"), F.col("s_acctbal").cast("int").cast("double")
    line = lambda text, dy: F.struct(text.alias("text"), F.lit(0.5).alias("score"), F.array(F.array(x, y + dy), F.array(x + 50, y + dy), F.array(x + 50, y + dy + 9), F.array(x, y + dy + 9)).alias("polygon"))
    page = lambda n, lines: F.to_json(F.struct(F.lit(n).alias("page"), F.lit(0.5).alias("skew_angle"), lines.alias("ocr")))
    first, second = page(1, F.array(line(F.col("s_name"), 0), line(F.lit("Siège"), 10))), page(2, F.array(line(F.lit("Capital"), 0)))
    file = lambda path, content: F.struct(F.concat(siren, *[F.lit(p) if isinstance(p, str) else p for p in path]).alias("path"), content.alias("content"))
    files = [
        file(["/actes/meta/acte_", acte, ".json"], acts),
        file(["/bilans/meta/bilan_", bilan, ".json"], sheet),
        file(["/actes/ocr/", acte, "/page_001.json"], first),
        file(["/actes/ocr/", acte, "/page_002.json"], second),
        file(["/bilans/ocr/", bilan, "/page_003.json"], F.lit('{"page": 3, "ocr": []}')),
    ]
    rows = table(spark, sf_dir, "supplier").select(F.explode(F.array(*files)).alias("f")).select("f.*")
    root = f"{new_folder(spark)}/data"
    land(sinks.write_files(rows, root), "files")
    return root


_S = "WITH s AS (SELECT s_suppkey AS k, lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS siren, 'a' || lpad(CAST(s_suppkey AS VARCHAR), 23, '0') AS acte, 'b' || lpad(CAST(s_suppkey AS VARCHAR), 23, '0') AS bilan, s_name AS name, CAST(trunc(s_acctbal) AS INTEGER) AS y FROM supplier)\n"


@query(_S + """SELECT 'acte' AS kind, siren, acte AS id, strftime(DATE '2010-01-01' + CAST(k AS INTEGER), '%Y-%m-%d') AS deposited, NULL AS closed, 'Augmentation du capital|' || name AS decisions FROM s WHERE k % 7 <> 0
UNION ALL SELECT 'bilan', siren, bilan, strftime(DATE '2010-01-01' + CAST(k AS INTEGER), '%Y-%m-%d'), '2009-12-31', NULL FROM s
""")
def filing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata files of actes and bilans, without those that are withdrawn."""
    found = filings.filings(spark, _corpus(spark, sf_dir))
    decisions = F.when(F.col("typeRdd").isNotNull(), F.array_join(F.transform("typeRdd", lambda x: x["decision"]), "|"))
    return found.select("kind", "siren", "id", F.col("dateDepot").cast("string").alias("deposited"), F.col("dateCloture").cast("string").alias("closed"), decisions.alias("decisions"))


@query(_S + """SELECT siren, 'acte' AS kind, acte AS doc_id, page, pos, text, CAST(k % 100 AS DOUBLE) AS x0, CAST(y + 10 * pos AS DOUBLE) AS y0, CAST(k % 100 + 50 AS DOUBLE) AS x1, CAST(y + 10 * pos + 9 AS DOUBLE) AS y1
FROM (SELECT *, 1 AS page, 0 AS pos, name AS text FROM s UNION ALL SELECT *, 1, 1, 'Siège' FROM s UNION ALL SELECT *, 2, 0, 'Capital' FROM s)
UNION ALL SELECT siren, 'bilan', bilan, 3, NULL, NULL, NULL, NULL, NULL, NULL FROM s
""")
def ocr_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of OCR pages, their company, kind and document from the path; a page without lines keeps a row."""
    lines = filings.ocr_lines(filings.ocr_pages(spark, _corpus(spark, sf_dir)))
    return lines.select("siren", "kind", "doc_id", "page", "pos", "text", F.col("px_x0").alias("x0"), F.col("px_y0").alias("y0"), F.col("px_x1").alias("x1"), F.col("px_y1").alias("y1"))


@query(_S + """SELECT 'folder' AS asked, acte AS doc_id, 2 AS page, 1 AS n_lines FROM s
UNION ALL SELECT 'file', bilan, 3, 0 FROM s
""")
def page_files_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by folder and number, and by file whatever its number; a missing folder, page or file gives no row."""
    root = _corpus(spark, sf_dir)
    doc = F.regexp_extract(F.col("_metadata.file_path"), r"/ocr/([0-9a-z]+)/", 1)
    one = lambda asked, path, page: filings.one_page(spark, path, page).select(F.lit(asked).alias("asked"), doc.alias("doc_id"), "page", F.size("ocr").alias("n_lines"))
    none = lambda path, page: filings.one_page(spark, path, page).select(F.lit("none").alias("asked"), F.lit("").alias("doc_id"), "page", F.size("ocr").alias("n_lines"))
    out = one("folder", f"{root}/*/actes/ocr/*", 2).unionByName(one("file", f"{root}/*/bilans/ocr/*/page_003.json", 1))
    for path, page in ((f"{root}/*/actes/ocr/*", 9), (f"{root}/missing", 1), (f"{root}/missing/page_001.json", 1)):
        out = out.unionByName(none(path, page))
    return out


@query(_S + "SELECT acte AS doc_id, pos, round(k % 100 * 72 / (300.0 * (500 + k % 9)), 9) AS x0, round((y + 10 * pos) * 72 / (300.0 * 700), 9) AS y0 FROM s, (VALUES (0), (1)) p(pos)")
def page_size_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of first pages as fractions, by page sizes out of a CSV file."""
    sizes = table(spark, sf_dir, "supplier").select(_key("a", 24).alias("doc_id"), F.lit(1).alias("page"), (500 + F.col("s_suppkey") % 9).cast("double").alias("w_pt"), F.lit(700.0).alias("h_pt"))
    path = f"{new_folder(spark)}/sizes"
    sizes.write.option("header", True).csv(path)
    lines = filings.ocr_lines(filings.ocr_pages(spark, _corpus(spark, sf_dir), kind="actes")).where("page = 1")
    placed = lines.join(filings.page_sizes(spark, path), ["doc_id", "page"])
    box = geometry.normalised(F.array("px_x0", "px_y0", "px_x1", "px_y1"), F.col("w_pt"), F.col("h_pt"))
    return placed.select("doc_id", "pos", F.round(box[0], 9).alias("x0"), F.round(box[1], 9).alias("y0"))


@query("SELECT s_suppkey AS company_id, s_name AS name, lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS siren, 'S' || s_nationkey AS sector, form FROM supplier, (VALUES ('json'), ('parquet')) f(form)")
def catalogue_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue of companies, from JSON lines and from Parquet."""
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("company_id"), F.col("s_name").alias("name"), _key("", 9).alias("siren"), F.concat(F.lit("S"), F.col("s_nationkey")).alias("sector"))
    folder = new_folder(spark)
    rows.write.json(f"{folder}/catalogue")
    rows.write.parquet(f"{folder}/catalogue.parquet")
    read = lambda form, path: filings.catalogue(spark, path).withColumn("form", F.lit(form))
    return read("json", f"{folder}/catalogue").unionByName(read("parquet", f"{folder}/catalogue.parquet"))


@query("""
SELECT lpad(CAST(s_suppkey AS VARCHAR), 24, 'a') AS doc_id, page, CASE WHEN page = 2 AND s_suppkey % 2 = 1 THEN 842.0 ELSE CAST(500 + s_suppkey % 9 AS DOUBLE) END AS w_pt,
  CASE WHEN page = 2 AND s_suppkey % 2 = 1 THEN CAST(500 + s_suppkey % 9 AS DOUBLE) ELSE 842.0 END AS h_pt FROM supplier, (VALUES (1), (2)) p(page)
""")
def pdf_page_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page sizes out of PDF files of two pages, of which every other file's second is turned."""
    k = F.col("s_suppkey")
    turn = F.when(k % 2 == 1, " /Rotate 90").otherwise("")
    body = [
        "%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n2 0 obj << /Type /Pages /Kids [3 0 R 4 0 R] /Count 2 /MediaBox [0 0 ",
        (500 + k % 9).cast("string"),
        " 842] >> endobj\n3 0 obj << /Type /Page /Parent 2 0 R >> endobj\n4 0 obj << /Type /Page /Parent 2 0 R",
        turn,
        " >> endobj\ntrailer << /Root 1 0 R >>\n%%EOF",
    ]
    content = F.concat(*[F.lit(x) if isinstance(x, str) else x for x in body])
    name = F.concat(F.lit("actes/pdf/acte_2020-01-01_"), F.lpad(k.cast("string"), 24, "a"), F.lit(".pdf"))
    root = f"{new_folder(spark)}/data"
    land(sinks.write_files(table(spark, sf_dir, "supplier").select(name.alias("path"), content.alias("content")), root), "files")
    return land(pdf.page_sizes(spark, f"{root}/actes/pdf"), "sizes")
