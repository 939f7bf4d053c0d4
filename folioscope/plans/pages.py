"""Queries over pages, boxes, texts and events that are built from the driver's tables, each with an independently written DuckDB query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import french, geometry
from folioscope.operators import accounts, coverage, entities, ledger, viewer
from folioscope.plans.registry import query
from folioscope.sources import filings, sinks
from folioscope.storage import table

# --- pages built from lines -------------------------------------------------------------------------------

_L = "WITH l AS (SELECT l_orderkey AS doc_id, l_linenumber AS pos, min(l_quantity) AS q, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2)\n"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos, q, p): one row for each line number of an order."""
    items = table(spark, sf_dir, "lineitem")
    return items.groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("pos")).agg(F.min("l_quantity").alias("q"), F.min("l_partkey").alias("p"))


def _line(text: Column, polygon: Column) -> Column:
    return F.struct(text.alias("text"), F.lit(1.0).alias("score"), F.lit(0).alias("orientation_angle"), polygon.alias("polygon"), F.lit(None).cast("string").alias("text_original"))


def _rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(F.array(x0, y0), F.array(x1, y0), F.array(x1, y1), F.array(x0, y1))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page, ocr): an order's lines on three pages; the fifth line has no polygon."""
    x, y = (F.col("pos") * 3).cast("double"), F.col("q") * 6
    text = F.concat(F.lit(" Part "), F.col("p").cast("string"), F.lit(" of Lot "), F.col("q").cast("int").cast("string"), F.lit(" "))
    line = _line(text, F.when(F.col("pos") != 5, _rectangle(x, y, x + 300, y + 30)))
    rows = _lines(spark, sf_dir).select("doc_id", (F.col("pos") % 3 + 1).alias("page"), "pos", line.alias("line"))
    grouped = rows.groupBy("doc_id", "page").agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("x"))
    return grouped.select("doc_id", "page", F.transform("x", lambda x: x["line"]).alias("ocr"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id")).distinct()


def _spaced(c: Column) -> Column:
    """A whole number with blanks between its thousands."""
    return F.regexp_replace(c.cast("string"), "(?<=[0-9])(?=(?:[0-9]{3})+$)", " ")


@query(_L + """, r AS (SELECT DISTINCT doc_id, CAST(n AS INTEGER) AS page FROM l, range(1, 5) t(n)),
g AS (SELECT DISTINCT doc_id, pos % 3 + 1 AS page FROM l),
h AS (SELECT doc_id, pos % 3 + 1 AS page, row_number() OVER (PARTITION BY doc_id, pos % 3 + 1 ORDER BY pos) - 1 AS k, pos AS n, q, 'Part ' || p || ' of Lot ' || CAST(q AS INTEGER) AS t FROM l)
SELECT doc_id, page, CASE WHEN page = 4 THEN 'out of range' WHEN g.doc_id IS NULL THEN 'no ocr' WHEN k IS NULL THEN 'not found' ELSE 'found' END AS status,
  CAST(k AS INTEGER) AS pos, CASE WHEN n = 5 THEN t ELSE printf('[%.4f, %.4f, %.4f, %.4f]  %s', n * 3 / 3000.0, q * 6 / 5000.0, (n * 3 + 300) / 3000.0, (q * 6 + 30) / 5000.0, t) END AS line
FROM r LEFT JOIN g USING (doc_id, page) LEFT JOIN (SELECT * FROM h WHERE t LIKE '%Lot 1%') h USING (doc_id, page)
""")
def viewer_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    page = lambda last: F.explode(F.sequence(F.lit(1), F.lit(last))).alias("page")
    sizes = documents.select("doc_id", page(3), F.lit(720.0).alias("w_pt"), F.lit(1200.0).alias("h_pt"))
    return viewer.report(documents.select("doc_id", page(4)), _pages(spark, sf_dir), sizes, "lOT 1").select("doc_id", "page", "status", "pos", "line")


@query(_L + """, d AS (SELECT DISTINCT doc_id, CAST(n AS INTEGER) AS page FROM l, range(1, 4) t(n))
SELECT doc_id, page, CAST(500 + doc_id % 100 AS DOUBLE) AS w_pt, 700.0::DOUBLE AS h_pt, CAST(count(pos) AS INTEGER) AS n_lines, count(pos) > 0 AS has_ocr
FROM d LEFT JOIN (SELECT doc_id, pos % 3 + 1 AS page, pos FROM l) USING (doc_id, page) GROUP BY doc_id, page
""")
def page_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.explode(F.sequence(F.lit(1), F.lit(3))).alias("page")
    sizes = _documents(spark, sf_dir).select("doc_id", page, (500 + F.col("doc_id") % 100).cast("double").alias("w_pt"), F.lit(700.0).alias("h_pt"))
    return coverage.page_info(_pages(spark, sf_dir), sizes)


@query(_L + "SELECT doc_id, pos * 2 - 4 AS page, 1 + doc_id % 7 AS n_pages, pos * 2 - 4 BETWEEN 1 AND 1 + doc_id % 7 AS in_range FROM l")
def requested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = _documents(spark, sf_dir).select("doc_id", F.explode(F.sequence(F.lit(1), 1 + F.col("doc_id") % 7)).alias("page"))
    asked = _lines(spark, sf_dir).select("doc_id", (F.col("pos") * 2 - 4).alias("page"))
    return coverage.requested_pages(asked, sizes).select("doc_id", "page", "n_pages", "in_range")


@query("""
SELECT o_orderkey AS id, count(l_orderkey) > 0 AS has_ocr, count(l_orderkey) AS n_pages, min(l_linenumber) AS first, max(l_linenumber) AS last
FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') ON l_orderkey = o_orderkey GROUP BY o_orderkey
""")
def filing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"))
    return coverage.filing_documents(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")), pages)


@query(_L + "SELECT doc_id, pos * 400 AS page, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY CAST(pos * 400 AS VARCHAR)) AS INTEGER) AS seq FROM l")
def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _lines(spark, sf_dir).select("doc_id", (F.col("pos") * 400).alias("page"))
    return coverage.file_order(pages).select("doc_id", "page", "seq")


@query(_L + """SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS cell, CAST(pos AS DOUBLE) AS x0,
  CASE WHEN pos % 2 = 0 THEN 'cell ' || p END AS text FROM l""")
def cell_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("pos").cast("double"), F.col("q")
    one = F.array(_line(F.concat(F.lit("cell "), F.col("p").cast("string")), _rectangle(x, y, x + 1, y + 1)))
    cell = F.struct(F.array(x, y, x + 1, y + 1).alias("bbox"), F.lit(1.0).alias("score"), F.when(F.col("pos") % 2 == 0, one).otherwise(F.slice(one, 1, 0)).alias("texts"))
    cells = _lines(spark, sf_dir).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", cell.alias("cell")))).alias("x"))
    pages = cells.select("doc_id", F.array(F.struct(F.lit("table").alias("label"), F.transform("x", lambda x: x["cell"]).alias("cells"))).alias("layout"))
    return filings.cell_texts(pages, "doc_id").select("doc_id", "cell", F.col("bbox")[0].alias("x0"), "text")


@query("""
SELECT source, count(*) AS n_pages, round(avg(abs(doc_id % 21 - 10) / 10.0), 4) AS skew, round(avg(doc_id % 3), 4) AS tables, round(avg(doc_id % 4), 4) AS lines
FROM documents GROUP BY source
""")
def page_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = lambda label: F.struct(F.lit(label).alias("label"))
    layout = F.concat(F.array(region("text")), F.array_repeat(region("table"), (F.col("doc_id") % 3).cast("int")))
    pages = table(spark, sf_dir, "documents").select("source", ((F.col("doc_id") % 21 - 10) / 10).alias("skew_angle"), layout.alias("layout"), F.array_repeat(F.lit("line"), (F.col("doc_id") % 4).cast("int")).alias("ocr"))
    return coverage.profile(pages, "source").select("source", "n_pages", *[F.round(c, 4).alias(c) for c in ("skew", "tables", "lines")])


# --- rows, labels and values ------------------------------------------------------------------------------


@query(_L + """, s AS (SELECT doc_id, pos, 3 * q + 4 AS c FROM l),
n AS (SELECT doc_id, pos, c, coalesce(c - lag(c) OVER w > 4, false) AS new FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY c, pos))
SELECT doc_id, pos, count(*) FILTER (new) OVER (PARTITION BY doc_id ORDER BY c, pos) AS row FROM n
""")
def text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select("doc_id", F.lit(1).alias("page"), "pos", (3 * F.col("q")).alias("px_y0"), (3 * F.col("q") + 8).alias("px_y1"))
    return accounts.text_rows(lines).select("doc_id", "pos", "row")


def _boxed(label: Column) -> Column:
    """Labels at the left, values to the right by number, each 8 high."""
    pos, q = F.col("pos").cast("double"), F.col("q")
    return F.when(label, F.array(F.lit(0.0), q, F.lit(10.0), q + 8)).otherwise(F.array(20 + 10 * pos, q, 28 + 10 * pos, q + 8))


@query(_L + """SELECT doc_id, pos, value_pos FROM (
  SELECT a.doc_id, a.pos, b.pos AS value_pos, row_number() OVER (PARTITION BY a.doc_id, a.pos ORDER BY b.pos) AS n
  FROM l a JOIN l b ON a.doc_id = b.doc_id AND a.pos IN (1, 4) AND b.pos NOT IN (1, 4) AND abs(a.q - b.q) < 8) WHERE n = 1
""")
def label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_label = F.col("pos").isin(1, 4)
    boxes = _lines(spark, sf_dir).select("doc_id", F.lit(1).alias("page"), "pos", _boxed(is_label).alias("box"))
    return accounts.label_values(boxes.where(is_label), boxes.where(~is_label)).select("doc_id", "pos", "value_pos")


@query(_L + """, r AS (
  SELECT doc_id, pos, CASE WHEN (pos + doc_id) % 4 <> 0 THEN (p * 1000 + q) * CASE WHEN pos = 3 THEN -1 ELSE 1 END END AS a, CASE WHEN (pos + doc_id) % 5 <> 0 THEN p * 7 END AS b FROM l
), c AS (SELECT doc_id, count(a) AS has_a, count(b) AS has_b, CASE doc_id % 2 WHEN 1 THEN 1000 ELSE 1 END AS scale FROM r GROUP BY doc_id),
v AS (
  SELECT doc_id, pos, scale,
    CASE WHEN doc_id % 3 = 2 OR (doc_id % 3 = 0 AND has_a = 0) THEN b ELSE a END AS n,
    CASE WHEN doc_id % 3 = 2 THEN a WHEN doc_id % 3 = 1 OR (has_a > 0 AND has_b > 0) THEN b END AS before
  FROM r JOIN c USING (doc_id) WHERE pos <= 2
)
SELECT doc_id, CASE pos WHEN 1 THEN 'assets' ELSE 'equity' END AS field, CASE doc_id % 2 WHEN 1 THEN 'kEUR' ELSE 'EUR' END AS unit,
  CAST(n * scale AS DOUBLE) AS value, CAST(before * scale AS DOUBLE) AS previous FROM v
""")
def page_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements of two columns with blanks; a third of the pages doesn't name them, a third has the year before first; some lines hold label and amount."""
    lines, pos, key = _lines(spark, sf_dir), F.col("pos"), F.col("doc_id")
    number = _spaced((F.col("p") * 1000 + F.col("q")).cast("long"))
    left = F.when((pos + key) % 4 != 0, F.when(pos == 3, F.concat(F.lit("("), number, F.lit(")"))).otherwise(number))
    right = F.when((pos + key) % 5 != 0, _spaced(F.col("p") * 7))
    label = F.concat(F.element_at(F.array(*map(F.lit, ("CO", "DL", "AA", "AB", "AC", "AD", "AE"))), pos.cast("int")), F.lit(" Total général"))
    box = lambda x0, x1: F.array(F.lit(float(x0)), 100.0 * pos, F.lit(float(x1)), 100.0 * pos + 30)
    # every sixth line is read as one, up to the right edge of the first column
    joined = ((pos + key) % 6 == 1) & left.isNotNull()
    parts = F.filter(
        F.array(
            F.struct(F.lit(0).alias("at"), F.when(joined, F.concat(label, F.lit(" "), left)).otherwise(label).alias("text"), F.when(joined, box(100, 1200)).otherwise(box(100, 700)).alias("box")),
            F.struct(F.lit(10).alias("at"), F.when(~joined, left).alias("text"), box(1040, 1203).alias("box")),
            F.struct(F.lit(20).alias("at"), right.alias("text"), box(1700, 1795).alias("box")),
        ),
        lambda x: x["text"].isNotNull(),
    )
    body = lines.select("doc_id", F.lit(1).alias("page"), "pos", F.explode(parts).alias("x")).select("doc_id", "page", (pos + F.col("x.at")).alias("pos"), "x.text", "x.box")
    heads = lines.select("doc_id").distinct()
    unit = F.when(key % 2 == 1, "Montants en milliers d'euros").otherwise("Montants en euros")
    named = lambda a, b: F.when(key % 3 == 1, a).when(key % 3 == 2, b).otherwise("Divers")
    for at, text, x in ((100, F.lit("N° 2050-SD 2020"), 0), (101, unit, 0), (102, named("Exercice N", "N - 1"), 1060), (103, named("N-1", "Exercice N"), 1650)):
        place = F.array(*[F.lit(float(v)) for v in (x, 9000, x + 130, 9030)])
        body = body.unionByName(heads.select("doc_id", F.lit(1).alias("page"), F.lit(at).alias("pos"), text.alias("text"), place.alias("box")))
    registry = spark.sql("SELECT * FROM VALUES ('assets', '2050', 'CO'), ('equity', '2050', 'DL'), ('none', '2050', 'ZZ') AS r(field, form, code)")
    found = accounts.field_values(body, registry)
    return found.select("doc_id", "field", "unit", F.col("value").cast("double").alias("value"), F.col("previous").cast("double").alias("previous"))


@query("SELECT vec_id, round(embedding[1]::DOUBLE * cos(radians(vec_id % 11 - 5)) - embedding[2]::DOUBLE * sin(radians(vec_id % 11 - 5)), 6) AS x, round(embedding[1]::DOUBLE * sin(radians(vec_id % 11 - 5)) + embedding[2]::DOUBLE * cos(radians(vec_id % 11 - 5)), 6) AS y FROM embeddings")
def deskewed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    x, y = geometry.rotated(at(0), at(1), F.col("vec_id") % 11 - 5)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


# --- texts ------------------------------------------------------------------------------------------------


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN strftime(CAST(o_orderdate AS DATE) - 364, '%Y-%m-%d') END AS opened,
  CASE WHEN o_orderkey % 4 <> 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS closed FROM orders
""")
def exercise_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    closed = F.date_format(day, "dd/MM/yyyy")
    said = F.when(F.col("o_orderkey") % 4 != 3, F.concat(F.lit("Exercice Du "), F.date_format(F.date_sub(day, 364), "dd/MM/yyyy"), F.lit("  au "), closed)).otherwise(F.concat(F.lit("Exercice clos le "), closed))
    found = table(spark, sf_dir, "orders").select("o_orderkey", french.exercise(said).alias("x"))
    return found.select("o_orderkey", F.col("x.start").cast("string").alias("opened"), F.col("x.end").cast("string").alias("closed"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS deposited, CAST(o_custkey AS VARCHAR) AS chrono, '2001B' || o_orderkey AS management,
  lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS siren, 'EXEMPLE ' || o_orderpriority AS name FROM orders WHERE o_orderkey % 3 <> 0
""")
def cover_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_custkey").cast("string")
    parts = F.concat_ws(" - ", F.concat(F.lit("DépÔt le "), F.date_format("o_orderdate", "dd/MM/yyyy")), key, F.concat(F.lit("2001B"), F.col("o_orderkey").cast("string")), F.lpad(key, 9, "0"), F.concat(F.lit("EXEMPLE "), F.col("o_orderpriority"), F.lit(" ")))
    said = F.when(F.col("o_orderkey") % 3 != 0, parts).otherwise("Dépôt sans numéro")
    found = table(spark, sf_dir, "orders").select("o_orderkey", french.cover(said).alias("c")).where("c.siren is not null")
    return found.select("o_orderkey", F.col("c.deposited").cast("string").alias("deposited"), "c.chrono", "c.management", "c.siren", "c.name")


@query("""
WITH w AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'capital' WHEN 1 THEN 'Capilal' WHEN 2 THEN 'càpital' WHEN 3 THEN 'capitaine' ELSE split_part(p_name, ' ', 1) END AS word FROM part)
SELECT p_partkey, levenshtein(lower(strip_accents(word)), 'capital') <= 1 AS near FROM w
""")
def near_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 5
    word = F.when(k == 0, "capital").when(k == 1, "Capilal").when(k == 2, "càpital").when(k == 3, "capitaine").otherwise(F.split("p_name", " ")[0])
    return table(spark, sf_dir, "part").select("p_partkey", french.near_word(word, "capital").alias("near"))


@query("""
SELECT o_orderkey, o_custkey + 1 AS shares, o_orderkey AS first, o_orderkey + o_custkey + CASE o_orderkey % 3 WHEN 0 THEN 1 ELSE 0 END AS last, o_orderkey % 3 <> 0 AS consistent
FROM orders WHERE o_orderkey % 7 <> 0
""")
def share_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, n = F.col("o_orderkey"), F.col("o_custkey") + 1
    last = key + n - 1 + F.when(key % 3 == 0, 1).otherwise(0)
    text = F.concat(n.cast("string"), F.lit(" parts sociales numérotées de "), key.cast("string"), F.lit(" à "), last.cast("string"))
    said = F.when(key % 7 != 0, text).otherwise(F.concat(n.cast("string"), F.lit(" parts")))
    found = table(spark, sf_dir, "orders").select("o_orderkey", ledger.share_range(said).alias("r")).where("r.shares is not null")
    return found.select("o_orderkey", "r.shares", "r.first", "r.last", "r.consistent")


@query("""
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS deposit, CAST(o_orderdate AS DATE) - CAST(o_orderkey % 400 - 30 AS INTEGER) AS said FROM orders)
SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 5 NOT IN (0, 3) AND said <= deposit THEN said ELSE deposit END, '%Y-%m-%d') AS event_date,
  CASE WHEN o_orderkey % 5 NOT IN (0, 3) AND said <= deposit THEN 'text' ELSE 'deposit' END AS date_basis FROM d
""")
def event_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_sub(F.to_date("o_orderdate"), (F.col("o_orderkey") % 400 - 30).cast("int"))
    numeric, deposit = F.date_format(day, "dd/MM/yyyy"), F.date_format("o_orderdate", "dd/MM/yyyy")
    month = F.element_at(F.array(*[F.lit(m.replace("fevrier", "février").replace("aout", "août")) for m in french.MONTHS]), F.month(day))
    written = F.concat_ws(" ", F.dayofmonth(day), month, F.year(day))
    # a written date before the deposit's, one after a deposit's date in words, and a deposit's date alone
    said = F.when(F.col("o_orderkey") % 5 == 0, "assemblée").when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit("acte du "), written, F.lit(" déposé le "), deposit))
    said = said.when(F.col("o_orderkey") % 5 == 2, F.concat(F.lit("Dépôt du "), deposit, F.lit(", décision du "), numeric, F.lit(" et du 1er mai 1990")))
    said = said.when(F.col("o_orderkey") % 5 == 3, F.concat(F.lit("déposé au greffe le "), deposit)).otherwise(F.concat(F.lit("assemblée du "), numeric))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("dateDepot"), said.alias("text"))
    return ledger.dated(rows, F.col("text")).select("o_orderkey", F.col("event_date").cast("string").alias("event_date"), "date_basis")


def _statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of thirteen forms, of which ``_SAID`` says what each states: the new capital, a change, or nothing."""
    key, cents = F.col("o_orderkey"), F.round(F.col("o_totalprice") * 100).cast("long")
    new = F.concat(_spaced(F.expr("cast(round(o_totalprice * 100) as bigint) div 100")), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))
    old = _spaced(1000 + key)
    forms = [
        ("Le capital est porté de ", old, " euros à ", new, " euros."),
        ("SARL au capital social de ", new, " €"),
        ("Capital réduit de ", new, " euros"),
        ("Objet social",),
        ("Le capital est porté de ", old, " euros à la somme de ", new, " euros"),
        ("ramené de la somme de ", old, " € à celle de ", new, " €"),
        ("Capital social : ", new, " euros"),
        ("Son capital est de ", new, " euros, siège à Paris, apport de ", old, " euros"),
        ("augmentation du capital social de ", new, " euros"),
        ("Capital augmenté de ", old, " euros pour être porté à ", new, " euros"),
        ("Le capital social est fixé à la somme de ", new, " euros"),
        ("Prix de cession : ", new, " euros"),
        ("augmentation de capital, porté de ", old, " F à ", new, " euros"),
    ]
    said = F.element_at(F.array(*[F.concat(*[F.lit(x) if isinstance(x, str) else x for x in form]) for form in forms]), (key % len(forms) + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", said.alias("text"))


@query("SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders WHERE o_orderkey % 13 IN (0, 1, 4, 6, 7, 9, 10, 12)")
def capital_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ledger.capital_observations(_statements(spark, sf_dir), "o_orderkey")
    return found.select("o_orderkey", (F.col("capital") * 100).cast("long").alias("cents"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 13 WHEN 2 THEN -CAST(round(o_totalprice * 100) AS BIGINT) WHEN 8 THEN CAST(round(o_totalprice * 100) AS BIGINT) WHEN 9 THEN 100 * (1000 + o_orderkey) END AS delta,
  CASE WHEN o_orderkey % 13 IN (0, 1, 4, 5, 6, 7, 9, 10, 12) THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS absolute FROM orders
""")
def capital_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = lambda c: (F.col(c) * 100).cast("long")
    found = _statements(spark, sf_dir).select("o_orderkey", french.capital_statement(F.col("text")).alias("s"))
    return found.select("o_orderkey", cents("s.delta").alias("delta"), cents("s.absolute").alias("absolute"))


@query("SELECT o_orderkey, CASE o_orderkey % 2 WHEN 1 THEN round(o_totalprice / 6.55957, 2) ELSE o_totalprice END AS euros FROM orders")
def amounts_in_euros(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("v"), F.when(F.col("o_orderkey") % 2 == 1, "FRF").otherwise("EUR").alias("c"))
    return orders.select("o_orderkey", french.in_euros(F.col("v"), F.col("c")).cast("double").alias("euros"))


# --- events, holders, graph -------------------------------------------------------------------------------


@query("""
WITH e AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS d FROM events),
n AS (SELECT *, lead(event_id) OVER w AS later, lead(d) OVER w AS later_d FROM e WINDOW w AS (PARTITION BY user_id, event_type ORDER BY d, event_id))
SELECT user_id AS siren, event_type AS code, event_id AS id, later FROM n WHERE later_d - d <= 1
""")
def repeated_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("siren"), F.col("event_type").alias("code"), F.col("event_id").alias("id"), F.to_date("ts").alias("event_date"))
    return ledger.repeated_filings(events, 1)


_HELD = """WITH m AS (SELECT event_id AS id, ts, user_id AS holder, CASE WHEN event_type = 'error' THEN -1 WHEN event_type = 'view' THEN 1 ELSE 0 END AS shares FROM events WHERE event_type IN ('view', 'error')),
b AS (SELECT id, holder, shares, CAST(sum(shares) OVER (PARTITION BY holder ORDER BY ts, id) AS BIGINT) AS balance FROM m)
"""


@query(_HELD + """SELECT id, holder, balance, CASE WHEN balance = 0 THEN 'SHAREHOLDER_END' ELSE 'SHAREHOLDER_ENTRY' END AS code
FROM b WHERE (balance = 0) <> (balance - shares = 0)""")
def holder_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    moves = table(spark, sf_dir, "events").where("event_type in ('view', 'error')")
    moves = moves.select(F.col("event_id").alias("id"), "ts", F.col("user_id").alias("holder"), F.when(F.col("event_type") == "error", -1).otherwise(1).alias("shares"))
    held = ledger.holdings(moves, "holder", ["ts", "id"], "shares")
    return ledger.entry_events(held).select("id", "holder", "balance", "code")


@query("""
WITH h AS (SELECT l_orderkey AS k, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS held FROM lineitem GROUP BY 1),
s AS (SELECT o_orderkey AS k, 25 * (1 + o_orderkey % 6) AS stated FROM orders)
SELECT k, held, stated FROM h JOIN s USING (k) WHERE held <> stated
""")
def holder_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_quantity").cast("long").alias("shares"))
    stated = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (25 * (1 + F.col("o_orderkey") % 6)).alias("stated"))
    return ledger.totals_differ(held, stated, "k")


@query(_HELD + """, c AS (SELECT user_id AS u, count(*) FILTER (event_type = 'click') AS a, count(*) FILTER (event_type = 'signup') AS b FROM events GROUP BY 1)
SELECT 'H' || holder AS key, 'negative balance' AS finding, balance AS a, CAST(NULL AS BIGINT) AS b FROM b WHERE balance < 0
UNION ALL SELECT 'O' || l_orderkey, 'holders and total differ', CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT), 100 FROM lineitem GROUP BY l_orderkey HAVING sum(CAST(l_quantity AS BIGINT)) <> 100
UNION ALL SELECT 'U' || u, 'sources disagree', nullif(a, 0), nullif(b, 0) FROM c WHERE a <> b
""")
def contradictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, items = table(spark, sf_dir, "events"), table(spark, sf_dir, "lineitem")
    moves = events.where("event_type in ('view', 'error')").select(F.concat(F.lit("H"), F.col("user_id")).alias("key"), "ts", "event_id", F.when(F.col("event_type") == "error", -1).otherwise(1).alias("shares"))
    balances = ledger.holdings(moves, "key", ["ts", "event_id"], "shares")
    held = items.select(F.concat(F.lit("O"), F.col("l_orderkey")).alias("key"), F.col("l_quantity").cast("long").alias("shares"))
    stated = held.select("key").distinct().withColumn("stated", F.lit(100).cast("long"))
    count = lambda kind: events.where(F.col("event_type") == kind).groupBy(F.concat(F.lit("U"), F.col("user_id")).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return ledger.contradictions("key", balances, held, stated, coverage.disagreements(count("click"), count("signup"), "key", "n"))


@query(_L + """SELECT doc_id, pos, CASE WHEN pos <> 5 THEN doc_id END AS source, CASE WHEN pos <> 5 THEN 'part ' || p END AS snippet, pos = 5 AS noted FROM l""")
def grounded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = F.when(F.col("pos") != 5, _boxed(F.lit(True)))
    events = _lines(spark, sf_dir).select("doc_id", "pos", F.lit(1).alias("page"), box.alias("box"), F.concat(F.lit("part "), F.col("p").cast("string")).alias("said"))
    found = ledger.grounded(events, "doc_id", "page", "box", "said")
    return found.select("doc_id", "pos", F.col("source.inpi_id").alias("source"), F.col("source.snippet").alias("snippet"), F.col("note").isNotNull().alias("noted"))


@query("""
WITH e AS (SELECT 'P' || c_custkey // 10 AS f, CAST(c_custkey // 10 * 2 + CASE WHEN c_custkey // 10 % 3 = 0 THEN c_custkey % 2 ELSE 0 END AS VARCHAR) AS fs, c_name AS t, CASE WHEN c_custkey % 4 <> 0 THEN 'S' || c_custkey END AS ts
  FROM customer WHERE c_custkey % 5 <> 0),
n AS (SELECT f AS name, fs AS siren FROM e UNION ALL SELECT t, ts FROM e)
SELECT name, CASE WHEN count(DISTINCT siren) = 1 THEN min(siren) END AS siren, count(DISTINCT siren) = 1 AS resolved, (SELECT count(*) FROM e WHERE f = name) AS owns FROM n GROUP BY name
""")
def group_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, parent = F.col("c_custkey"), F.expr("c_custkey div 10")
    edges = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("P"), parent.cast("string")).alias("from_name"),
        (parent * 2 + F.when(parent % 3 == 0, key % 2).otherwise(0)).cast("string").alias("from_siren"),
        F.col("c_name").alias("to_name"),
        F.when(key % 4 != 0, F.concat(F.lit("S"), key.cast("string"))).alias("to_siren"),
        F.when(key % 5 != 0, "a line").alias("evidence"),
    )
    nodes, kept = entities.graph(edges, F.col("evidence"))
    owns = kept.groupBy(F.col("from_name").alias("name")).agg(F.count(F.lit(1)).alias("owns"))
    return nodes.join(owns, "name", "left").select("name", "siren", "resolved", F.coalesce("owns", F.lit(0).cast("long")).alias("owns"))


# --- outputs ----------------------------------------------------------------------------------------------


@query("""
SELECT CAST(to_json({'regions': (SELECT list({'r_regionkey': r_regionkey, 'r_name': r_name} ORDER BY r_regionkey) FROM region),
  'nations': (SELECT list({'n_nationkey': n_nationkey, 'n_name': n_name} ORDER BY n_nationkey) FROM nation)}) AS VARCHAR) AS json
""")
def results_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.results_json({"regions": table(spark, sf_dir, "region").select("r_regionkey", "r_name"), "nations": table(spark, sf_dir, "nation").select("n_nationkey", "n_name")})


@query(_L + "SELECT doc_id, 1 AS page, pos + 1 AS label, 'red' AS colour, 3 AS width, q AS y0 FROM l WHERE pos <> 5")
def draw_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = F.when(F.col("pos") != 5, _boxed(F.lit(True)))
    boxes = _lines(spark, sf_dir).select("doc_id", F.lit(1).alias("page"), "pos", box.alias("box"))
    return sinks.draw_list(boxes, "red", 3).select("doc_id", "page", "label", "colour", "width", F.col("box")[1].alias("y0"))
