"""Readers of a filings corpus under explicit schemas, and its landing as Parquet.

Layout: ``<root>/<siren>/{actes,bilans}/meta/*.json`` and ``<root>/<siren>/{actes,bilans}/ocr/<doc_id>/page_NNN.json``.
Parquet is the form to query: it prunes nested columns and partitions, which JSON does not. A broken file fails the read,
of metadata and of pages alike, so that it can't pass for an empty page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import geometry

LINE = "struct<text: string, score: double, orientation_angle: int, polygon: array<array<double>>, text_original: string>"
CELL = f"struct<bbox: array<double>, score: double, texts: array<{LINE}>>"
REGION = f"struct<label: string, bbox: array<double>, score: double, texts: array<{LINE}>, cells: array<{CELL}>>"
FAILURE = "struct<bbox: array<double>, rot_deg: int, text: string, new_text: string, new_score: double>"
OCR_PAGE = (
    f"page int, pdf string, skew_angle double, most_frequent_angle int, ocr array<{LINE}>, layout array<{REGION}>, "
    f"_reocr_corrected_count int, _reocr_failed_count int, _reocr_failures array<{FAILURE}>"
)
FILING = (
    "id string, siren string, denomination string, dateDepot date, updatedAt timestamp, numChrono string, numNat string, "
    "nomDocument string, confidentiality string, deleted boolean, typeRdd array<struct<typeActe: string, decision: string>>, "
    "typeDocument string, libelle string, dateCloture date, typeBilan string, version string"
)
_OCR_PATH = r"/(\d{9})/(actes|bilans)/ocr/([0-9a-f]{24})/page_(\d+)\.json"
_META_PATH = r"/(\d{9})/(actes|bilans)/meta/"


def _kind(c):
    return F.when(c == "actes", "acte").when(c == "bilans", "bilan")


def _json(spark: SparkSession, schema: str, path: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").option("dateFormat", "yyyy-MM-dd").json(path)


def filings(spark: SparkSession, root: str, siren: str = "*", kind: str = "*") -> DataFrame:
    """One row per metadata file that isn't deleted, with ``kind`` and ``path``."""
    raw = _json(spark, FILING, f"{root}/{siren}/{kind}/meta/*.json")
    raw = raw.withColumn("path", F.col("_metadata.file_path"))
    return raw.where("not coalesce(deleted, false)").withColumn("kind", _kind(F.regexp_extract("path", _META_PATH, 2)))


def ocr_pages(spark: SparkSession, root: str, siren: str = "*", kind: str = "*", doc_id: str = "*") -> DataFrame:
    """One row per OCR page; siren, kind and doc_id come from the path. Narrow the glob to read less."""
    raw = _json(spark, OCR_PAGE, f"{root}/{siren}/{kind}/ocr/{doc_id}/page_*.json")
    path = F.col("_metadata.file_path")
    part = lambda k: F.regexp_extract(path, _OCR_PATH, k)
    return raw.select(part(1).alias("siren"), _kind(part(2)).alias("kind"), part(3).alias("doc_id"), "*")


def exists(spark: SparkSession, glob: str) -> bool:
    """Whether any file matches, in whatever store the path names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def one_page(spark: SparkSession, path: str, page: int) -> DataFrame:
    """A page of a folder of pages, or the one page of a ``.json`` file, whatever its number; no row if it is missing."""
    if path.endswith(".json"):
        return ocr_pages_at(spark, path)
    return ocr_pages_at(spark, f"{path}/page_*.json").where(F.col("page") == page)


def ocr_pages_at(spark: SparkSession, path: str) -> DataFrame:
    """Pages at a path or glob; none, instead of an error, where nothing matches."""
    if not exists(spark, path):
        return spark.createDataFrame([], OCR_PAGE)
    return _json(spark, OCR_PAGE, path)


def ocr_lines(pages: DataFrame, *keys: str) -> DataFrame:
    """One row per line with its place and pixel box; a page without lines keeps one row of nulls.

    Lines repeated in ``layout`` are not taken, so that none counts twice.
    """
    keys = keys or ("siren", "kind", "doc_id", "page")
    lines = pages.select(*keys, F.posexplode_outer(F.coalesce("ocr", F.array().cast(f"array<{LINE}>"))).alias("pos", "line"))
    polygon = F.col("line.polygon")
    box = F.when(F.size(polygon) == 4, geometry.box_of_polygon(polygon, 4)).otherwise(geometry.box_of_polygon(polygon))
    return lines.select(*keys, "pos", "line.text", "line.score", "line.polygon", *[box[i].alias(n) for i, n in enumerate(("px_x0", "px_y0", "px_x1", "px_y1"))])


def cell_texts(pages: DataFrame, *keys: str) -> DataFrame:
    """Texts of table cells, by region and cell number."""
    regions = pages.select(*keys, F.posexplode("layout").alias("region", "r"))
    cells = regions.select(*keys, "region", F.posexplode("r.cells").alias("cell", "c"))
    return cells.select(*keys, "region", "cell", F.col("c.bbox").alias("bbox"), F.explode_outer("c.texts").alias("t")).select(*keys, "region", "cell", "bbox", "t.text", "t.score")


def page_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Page sizes in points, (doc_id, page, w_pt, h_pt), from an external CSV file: PDFs aren't read here."""
    return spark.read.schema("doc_id string, page int, w_pt double, h_pt double").option("header", True).csv(path)


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The catalogue of companies, (company_id, name, siren, sector), from JSON lines or, if the path ends so, Parquet."""
    schema = "company_id long, name string, siren string, sector string"
    return spark.read.schema(schema).parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def land(df: DataFrame, path: str, by: str = "siren", salts: int = 8) -> None:
    """Writes a table as Parquet, partitioned so that a company's rows are read alone; up to ``salts`` tasks write a company."""
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts))
    df.withColumn("_salt", salt).repartition(F.col(by), F.col("_salt")).drop("_salt").write.mode("overwrite").partitionBy(by).parquet(path)
