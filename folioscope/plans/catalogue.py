"""Queries over the driver's tables, each with an independently written DuckDB query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import french, geometry
from folioscope.operators import accounts, coverage, entities, ledger, text, workflow
from folioscope.plans import captables, pages, readers, readings, statements  # noqa: F401  (their queries register themselves)
from folioscope.plans.registry import ORACLE_SQL, QUERIES, query  # noqa: F401
from folioscope.storage import table

# --- text -------------------------------------------------------------------------------------------------


_BLANK = r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
_STRIPPED = f"regexp_replace(l, '^{_BLANK}|{_BLANK}$', '', 'g')"


@query(f"""
SELECT doc_id, i AS pos, {_STRIPPED} AS text
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l,
             generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)
WHERE position('que' IN lower({_STRIPPED})) > 0
""")
def grep_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.grep(text.lines(table(spark, sf_dir, "documents"), "doc_id"), "que").select("doc_id", "pos", "text")


@query("SELECT page_id, url FROM pages WHERE html ILIKE '%est%the%' AND strpos(lower(html), '<ul') > 0 OR strpos(lower(html), '<table') > 0")
def grep_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    html = F.col("html")
    both = text.contains(html, "<ul") & F.lower(html).rlike("(?s)est.*the")
    return pages.where(both | text.contains(html, "<TABLE")).select("page_id", "url")


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN lower(trim(l)) LIKE '%tion%' THEN 1 ELSE 0 END) AS BIGINT) AS hits,
  sum(CASE WHEN lower(trim(l)) LIKE '%tion%' THEN 1 ELSE 0 END) = 0 AS not_found
FROM l GROUP BY doc_id
""")
def grep_page_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text.lines(table(spark, sf_dir, "documents"), "doc_id")
    hits = F.count_if(text.contains(F.col("text"), "tion"))
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), hits.alias("hits"), (hits == 0).alias("not_found"))


@query("""
SELECT lang, source, count(*) AS n_docs, round(avg(length(text) - length(replace(text, chr(10), '')) + 1), 4) AS lines,
  round(sum(length(text)) / count(*), 4) AS chars
FROM documents GROUP BY lang, source
""")
def text_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.round(F.avg(F.size(F.split("text", "\n", -1))), 4).alias("lines"),
        F.round(F.avg(F.length("text")), 4).alias("chars"),
    )


# --- geometry ---------------------------------------------------------------------------------------------


def _polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four points per embedding from its first eight components."""
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    points = F.array(*[F.array(at(2 * i), at(2 * i + 1)) for i in range(4)])
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", points.alias("polygon"))


def _corners(box, digits: int = 6) -> list:
    return [F.round(box[i], digits).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))]


_SQL_BOX = """WITH e AS (SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding[1:8]] AS v FROM embeddings),
b AS (SELECT vec_id, label, least(v[1], v[3], v[5], v[7]) AS x0, least(v[2], v[4], v[6], v[8]) AS y0,
  greatest(v[1], v[3], v[5], v[7]) AS x1, greatest(v[2], v[4], v[6], v[8]) AS y1 FROM e)
"""


@query(_SQL_BOX + "SELECT vec_id, round(x0, 6) AS x0, round(y0, 6) AS y0, round(x1, 6) AS x1, round(y1, 6) AS y1 FROM b")
def polygon_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _polygons(spark, sf_dir).select("vec_id", *_corners(geometry.box_of_polygon(F.col("polygon"), 4)))


@query(_SQL_BOX + """SELECT vec_id, round(x0 * 72 / (300.0 * (500 + vec_id % 100)), 9) AS x0, round(y0 * 72 / (300.0 * (700 + vec_id % 50)), 9) AS y0,
  round(x1 * 72 / (300.0 * (500 + vec_id % 100)), 9) AS x1, round(y1 * 72 / (300.0 * (700 + vec_id % 50)), 9) AS y1 FROM b""")
def bbox_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = _polygons(spark, sf_dir).select("vec_id", geometry.box_of_polygon(F.col("polygon"), 4).alias("box"))
    return boxes.select("vec_id", *_corners(geometry.normalised(F.col("box"), 500 + F.col("vec_id") % 100, 700 + F.col("vec_id") % 50), 9))


@query(_SQL_BOX + """SELECT vec_id, round(x0 * (1000 + vec_id % 7), 6) AS x0, round(y0 * 1400, 6) AS y0, round(x1 * (1000 + vec_id % 7), 6) AS x1,
  round(y1 * 1400, 6) AS y1 FROM b""")
def bbox_denormalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = _polygons(spark, sf_dir).select("vec_id", geometry.box_of_polygon(F.col("polygon"), 4).alias("box"))
    return boxes.select("vec_id", *_corners(geometry.denormalised(F.col("box"), 1000 + F.col("vec_id") % 7, F.lit(1400)), 6))


@query("""
WITH e AS (SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 4000) / 1000 AS DOUBLE) FOR x IN embedding[1:4]] AS v FROM embeddings)
SELECT vec_id, vec_id % 5 <> 0 AS accepted,
  CASE WHEN vec_id % 5 <> 0 THEN greatest(v[1], v[2], v[3], v[4]) > 1 END AS out_of_range,
  CASE WHEN vec_id % 5 <> 0 THEN v[1] >= 0 AND v[2] >= 0 AND v[3] <= 1 AND v[4] <= 1 AND v[1] < v[3] AND v[2] < v[4] END AS valid
FROM e
""")
def bbox_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda i: (F.floor(F.get("embedding", F.lit(i)).cast("double") * 4000) / 1000).cast("string")
    said = F.when(F.col("vec_id") % 5 == 0, F.concat_ws(",", at(0), at(1), at(2))).otherwise(F.concat_ws(" , ", *map(at, range(4))))
    box = table(spark, sf_dir, "embeddings").select("vec_id", geometry.parsed_box(said).alias("box"))
    return box.select("vec_id", F.col("box").isNotNull().alias("accepted"), geometry.out_of_range(F.col("box")).alias("out_of_range"), geometry.valid(F.col("box")).alias("valid"))


@query(_SQL_BOX + """, p AS (
  SELECT a.vec_id, greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS shared,
    (a.x1 - a.x0) * (a.y1 - a.y0) AS one, (b.x1 - b.x0) * (b.y1 - b.y0) AS two
  FROM b AS a JOIN b ON b.vec_id = a.vec_id + 1 AND a.label = b.label)
SELECT vec_id, round(shared / (one + two - shared), 6) AS iou FROM p""")
def bbox_iou(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = _polygons(spark, sf_dir).select("vec_id", "label", geometry.box_of_polygon(F.col("polygon"), 4).alias("box"))
    after = boxes.select((F.col("vec_id") - 1).alias("vec_id"), "label", F.col("box").alias("next"))
    return boxes.join(after, ["vec_id", "label"]).select("vec_id", F.round(geometry.overlap(F.col("box"), F.col("next")), 6).alias("iou"))


# --- French amounts, dates, names -------------------------------------------------------------------------


@query("SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, CASE WHEN o_orderkey % 4 = 3 THEN 'FRF' ELSE 'EUR' END AS currency FROM orders")
def amount_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    digits = F.expr("cast(cents div 100 as string)")
    grouped = lambda mark: F.regexp_replace(digits, "(?<=[0-9])(?=(?:[0-9]{3})+$)", mark)
    after = F.lpad((F.col("cents") % 100).cast("string"), 2, "0")
    k = F.col("o_orderkey") % 4
    said = (
        F.when(k == 0, F.concat(F.lit("somme de "), grouped(" "), F.lit(","), after, F.lit(" €")))
        .when(k == 1, F.concat(grouped("."), F.lit(","), after, F.lit(" Euros")))
        .when(k == 2, F.concat(F.translate(grouped(" "), "0", "o"), F.lit(","), after, F.lit(" euros")))
        .otherwise(F.concat(grouped(" "), F.lit(","), after, F.lit(" Francs")))
    )
    # a zero misread as o can't come first in an amount, nor stand in one that has no thousands
    said = F.when((k == 2) & ((F.col("cents") < 100_000)), F.concat(digits, F.lit(","), after, F.lit(" euros"))).otherwise(said)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", cents.alias("cents")).select("o_orderkey", french.amount(said).alias("a"))
    return rows.select("o_orderkey", (F.col("a.amount") * 100).cast("long").alias("cents"), F.col("a.currency").alias("currency"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'EUR' ELSE 'kEUR' END AS unit, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders")
def unit_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("decimal(18,0)")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", cents.alias("cents"))
    odd = F.col("o_orderkey") % 2 == 1
    lines = orders.select("o_orderkey", F.when(odd, "Montants en milliers d'euros").otherwise("Montants en euros").alias("text"))
    filed = orders.select("o_orderkey", (F.col("cents") / F.when(odd, 1000).otherwise(1)).cast("decimal(20,3)").alias("value"))
    joined = filed.join(accounts.document_unit(lines, "o_orderkey"), "o_orderkey")
    return joined.select("o_orderkey", "unit", F.round(french.scaled(F.col("value"), F.col("unit"))).cast("long").alias("cents"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS written, strftime(o_orderdate, '%Y-%m-%d') AS numeric FROM orders")
def date_fr_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"]
    day = F.to_date("o_orderdate")
    month = F.get(F.array(*map(F.lit, names)), F.month(day) - 1)
    month = F.when(F.col("o_orderkey") % 3 == 0, F.upper(month)).when(F.col("o_orderkey") % 3 == 1, F.translate(month, "éû", "eu")).otherwise(month)
    said = F.concat_ws(" ", F.lit("fait le"), F.when(F.dayofmonth(day) == 1, "1er").otherwise(F.dayofmonth(day).cast("string")), month, F.year(day).cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", french.written_date(said).cast("string").alias("written"), french.numeric_date(F.concat(F.lit("le "), F.date_format(day, "dd/MM/yyyy"), F.lit("."))).cast("string").alias("numeric"))


@query("""
WITH d AS (SELECT c_custkey, lpad(CAST(c_custkey * 7919 % 1000000000 AS VARCHAR), 9, '0') AS s FROM customer),
v AS (SELECT c_custkey, s, [CAST(x AS INTEGER) FOR x IN string_split(s, '')] AS d FROM d)
SELECT c_custkey, s AS siren, (d[1] + d[3] + d[5] + d[7] + d[9]
  + CASE WHEN d[2] > 4 THEN 2 * d[2] - 9 ELSE 2 * d[2] END + CASE WHEN d[4] > 4 THEN 2 * d[4] - 9 ELSE 2 * d[4] END
  + CASE WHEN d[6] > 4 THEN 2 * d[6] - 9 ELSE 2 * d[6] END + CASE WHEN d[8] > 4 THEN 2 * d[8] - 9 ELSE 2 * d[8] END) % 10 = 0 AS valid
FROM v
""")
def luhn_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    siren = F.lpad((F.col("c_custkey") * 7919 % 1_000_000_000).cast("string"), 9, "0")
    return table(spark, sf_dir, "customer").select("c_custkey", siren.alias("siren")).withColumn("valid", french.luhn(F.col("siren")))


@query("SELECT p_partkey, CASE WHEN p_partkey % 50 <> 0 THEN trim(regexp_replace(upper(strip_accents(p_name)), '[^A-Z0-9]+', ' ', 'g')) END AS name FROM part")
def name_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    accented = F.translate("p_name", "aeo", "àéô")
    said = (
        F.when(F.col("p_partkey") % 50 == 0, "Non renseigné")
        .when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("*SARL "), accented))
        .when(F.col("p_partkey") % 3 == 1, F.concat(F.translate(accented, " ", "-"), F.lit(" S.A.S.")))
        .otherwise(F.concat(accented, F.lit(", S.A.")))
    )
    return table(spark, sf_dir, "part").select("p_partkey", french.company_name(said).alias("name"))


_PERTURBED = "CASE s_suppkey % 4 WHEN 0 THEN s_name WHEN 1 THEN 'X' || substr(s_name, 2) WHEN 2 THEN substr(s_name, 1, length(s_name) - 1) ELSE 'Nobody ' || s_suppkey END"


@query(f"""
WITH m AS (SELECT s_suppkey AS mention_id, {_PERTURBED} AS name FROM supplier),
d AS (SELECT mention_id, m.name, s_suppkey, levenshtein(m.name, s_name) AS d FROM m, supplier),
near AS (SELECT *, min(d) OVER (PARTITION BY mention_id) AS least FROM d),
best AS (SELECT mention_id, count(*) AS n, min(s_suppkey) AS s_suppkey FROM near WHERE d = least AND d <= 1 GROUP BY mention_id)
SELECT m.mention_id, m.name, CASE WHEN n = 1 THEN 'S' || s_suppkey END AS company_id, coalesce(n = 1, false) AS resolved
FROM m LEFT JOIN best USING (mention_id)
""")
def entity_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    mentions = supplier.select(F.col("s_suppkey").alias("mention_id"), F.expr(_PERTURBED).alias("name"))
    return entities.resolved(mentions, supplier.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("company_id"), F.col("s_name").alias("name")))


# --- coverage ---------------------------------------------------------------------------------------------


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def scope_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.in_scope(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def ocr_gap_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.missing(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("""
WITH a AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
b AS (SELECT source, count(*) AS k FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY source)
SELECT source, n, coalesce(k, 0) AS n_present FROM a LEFT JOIN b USING (source)
""")
def coverage_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.shares(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id", "source")


@query("""
WITH n AS (SELECT o_orderkey AS doc_id, 1 + o_orderkey % 7 AS n FROM orders),
l AS (SELECT l_orderkey AS doc_id, count(*) AS n, min(l_linenumber) AS first, max(l_linenumber) AS last FROM lineitem GROUP BY 1)
SELECT doc_id, l.n AS n_ocr, n.n AS n_pdf FROM l JOIN n USING (doc_id) WHERE l.n <> n.n
""")
def page_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"))
    sizes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.explode(F.sequence(F.lit(1), 1 + F.col("o_orderkey") % 7)).alias("page"))
    return coverage.page_count_gaps(pages, sizes)


@query("SELECT l_orderkey AS doc_id, count(*) AS n_pages, min(l_linenumber) AS first, max(l_linenumber) AS last FROM lineitem GROUP BY l_orderkey")
def page_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.page_range(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page")))


@query("""
WITH o AS (SELECT o_orderkey AS k, CAST(round(o_totalprice) AS BIGINT) AS v FROM orders),
l AS (SELECT l_orderkey AS k, CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2)))) AS BIGINT) AS v FROM lineitem GROUP BY 1),
u AS (SELECT k, v AS a, NULL AS b FROM o UNION ALL SELECT k, NULL, v FROM l)
SELECT k AS orderkey, CAST(max(a) AS BIGINT) AS a, CAST(max(b) AS BIGINT) AS b FROM u GROUP BY k HAVING max(a) IS DISTINCT FROM max(b)
""")
def source_disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), F.round("o_totalprice").cast("long").alias("v"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("orderkey"))
    return coverage.disagreements(orders, lines.agg(F.round(F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))).cast("long").alias("v")), "orderkey", "v")


# --- accounts ---------------------------------------------------------------------------------------------


@query("""
SELECT l_orderkey, CAST(a - b AS DOUBLE) AS difference FROM (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS a, sum(CAST(l_quantity AS DECIMAL(18,2)) * 1500) AS b FROM lineitem GROUP BY 1)
WHERE a - b > 20000 OR b - a > 20000
""")
def balance_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
    sides = lines.agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("assets"), F.sum(F.col("l_quantity").cast("decimal(18,2)") * 1500).alias("liabilities"))
    found = accounts.unbalanced(sides, F.col("assets"), F.col("liabilities"), 20000)
    return found.select("l_orderkey", F.col("difference").cast("double").alias("difference"))


@query("""
SELECT l_orderkey, CASE WHEN bool_or(l_linenumber = 1) AND bool_or(l_linenumber = 2) THEN
  CAST(sum(CASE l_linenumber WHEN 3 THEN -1 ELSE 1 END * CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) END AS value
FROM lineitem WHERE l_linenumber <= 3 GROUP BY l_orderkey
""")
def derived_cogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = spark.range(1, 4).select(F.col("id").cast("int").alias("component"), F.when(F.col("id") == 3, -1).otherwise(1).alias("coefficient"), (F.col("id") < 3).alias("required"))
    values = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("component"), F.col("l_extendedprice").cast("decimal(18,2)").alias("value"))
    return accounts.derived(values, registry, ["l_orderkey"]).withColumn("value", F.col("value").cast("double"))


@query("""
WITH t AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY 1, 2)
SELECT b.o_custkey, b.year, CAST(b.v AS DOUBLE) AS total, CAST(a.v AS DOUBLE) AS before FROM t a JOIN t b ON a.o_custkey = b.o_custkey AND b.year = a.year + 1
""")
def yoy_restatement(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    return accounts.restatements(totals, ["o_custkey"], "year", "total").select("o_custkey", "year", "total", "before")


@query("""
SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey
FROM orders GROUP BY 1, 2
""")
def latest_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderdate", "o_orderkey")
    return accounts.latest(orders, ["o_custkey", "year"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "year", "o_orderkey")


@query("""
WITH m AS (SELECT source, sum(1 + doc_id % 5) AS pages, sum(length(text)) AS chars, sum(doc_id % 11) AS seconds FROM documents GROUP BY source)
SELECT source, round(chars / pages, 4) AS cost_per_page, round(seconds / pages, 4) AS seconds_per_page FROM m
""")
def cost_per_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = table(spark, sf_dir, "documents").select("source", (1 + F.col("doc_id") % 5).alias("pages"), F.length("text").alias("cost_eur"), (F.col("doc_id") % 11).alias("seconds"))
    return accounts.run_costs(metrics, "source").select("source", *[F.round(c, 4).alias(c) for c in ("cost_per_page", "seconds_per_page")])


# --- events and the ledger --------------------------------------------------------------------------------

_DECISIONS = {"purchase": "Augmentation du capital social", "error": "Réduction du capital social", "signup": "Cession de parts", "click": "Changement de président", "view": "Actions de préférence"}


@query("""
SELECT event_id, CASE event_type WHEN 'purchase' THEN 'CAPITAL_INCREASE' WHEN 'error' THEN 'CAPITAL_DECREASE'
  WHEN 'signup' THEN 'SHAREHOLDER_SHARE_TRANSFER' WHEN 'view' THEN 'CAPITAL_DUAL_CLASS' END AS code
FROM events WHERE event_type <> 'click'
""")
def classify_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.element_at(F.create_map(*[F.lit(x) for kv in _DECISIONS.items() for x in kv]), F.col("event_type"))
    rows = table(spark, sf_dir, "events").select("event_id", french.folded(said).alias("said"))
    rows = rows.where(~F.col("said").rlike(ledger.OUT_OF_SCOPE))
    return ledger.classified(rows, F.col("said")).select("event_id", "code")


@query("SELECT DISTINCT user_id, upper(event_type) AS decision FROM events")
def decision_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    items = F.array(F.struct(F.lit("a").alias("typeActe"), F.concat(F.lit(" "), F.col("event_type")).alias("decision")), F.struct(F.lit("b").alias("typeActe"), F.concat(F.upper("event_type"), F.lit("  ")).alias("decision")))
    filings = events.select(F.col("user_id").alias("id"), F.lit("").alias("siren"), F.to_date("ts").alias("dateDepot"), items.alias("typeRdd"))
    return ledger.decisions(filings).select(F.col("id").alias("user_id"), "decision")


_MOVES = """WITH m AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'signup' THEN CAST(floor(value) AS BIGINT) END AS absolute,
  CASE event_type WHEN 'purchase' THEN CAST(floor(value) AS BIGINT) WHEN 'error' THEN -CAST(floor(value) AS BIGINT) END AS delta FROM events),
"""
_TIMELINE = _MOVES + """r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM m),
s AS (SELECT a.*, coalesce((SELECT max(b.n) FROM r b WHERE b.user_id = a.user_id AND b.n <= a.n AND b.absolute IS NOT NULL), 0) AS since FROM r a),
t AS (SELECT s.event_id, s.user_id, s.ts, CAST(coalesce((SELECT sum(coalesce(b.absolute, b.delta, 0)) FROM r b WHERE b.user_id = s.user_id AND b.n <= s.n AND b.n >= s.since), 0) AS BIGINT) AS balance FROM s)
"""


def _moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, kind = F.floor("value").cast("long"), F.col("event_type")
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.when(kind == "signup", value).alias("absolute"), F.when(kind == "purchase", value).when(kind == "error", -value).alias("delta"))


def _balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.timeline(_moves(spark, sf_dir), "user_id", ["ts", "event_id"], "delta", "absolute")


@query(_TIMELINE + "SELECT event_id, user_id, balance FROM t")
def capital_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _balances(spark, sf_dir).select("event_id", "user_id", "balance")


@query("""
WITH t AS (SELECT min(event_id) AS id, CAST(ts AS DATE) AS date, user_id AS giver, (user_id * 7 + 3) % 50 AS taker, CAST(floor(value) AS BIGINT) AS shares FROM events GROUP BY 2, 3, 4, 5),
e AS (SELECT id, date, giver AS holder, -shares AS shares FROM t UNION ALL SELECT id, date, taker, shares FROM t),
p AS (SELECT id, date, holder, sum(shares) AS shares, min(shares) AS least FROM e GROUP BY 1, 2, 3)
SELECT a.id, a.holder, a.shares, CAST(sum(b.shares) AS BIGINT) AS balance
FROM e a JOIN e b ON a.holder = b.holder AND (b.date, b.id, b.shares) <= (a.date, a.id, a.shares) GROUP BY a.id, a.holder, a.shares
""")
def holder_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    moves = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.to_date("ts").alias("date"), F.col("user_id").alias("giver"), ((F.col("user_id") * 7 + 3) % 50).alias("taker"), F.floor("value").cast("long").alias("shares"))
    seen = moves.unionByName(moves.withColumn("id", F.col("id") + 1_000_000))  # every movement is filed twice
    rows = ledger.entries(seen)
    return ledger.holdings(rows, "holder", ["date", "id", "shares"], "shares").select("id", "holder", "shares", "balance")


_DATES = "(VALUES (DATE '2024-01-10'), (DATE '2024-01-20'), (DATE '2024-06-30')) AS d(date)"


@query(_TIMELINE + f"""SELECT u.user_id, CAST(d.date AS VARCHAR) AS date, x.balance FROM (SELECT DISTINCT user_id FROM t) u, {_DATES},
LATERAL (SELECT balance FROM t WHERE t.user_id = u.user_id AND t.ts <= d.date ORDER BY ts DESC, event_id DESC LIMIT 1) x""")
def state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = spark.sql(f"SELECT date FROM {_DATES}")
    return ledger.state_as_of(_balances(spark, sf_dir), dates, "user_id", "ts", "date", ["event_id"], "balance").select("user_id", F.col("date").cast("string").alias("date"), "balance")


@query(_TIMELINE + "SELECT event_id, user_id, balance, 'negative balance' AS finding FROM t WHERE balance < 0")
def timeline_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.findings(_balances(spark, sf_dir), "user_id").select("event_id", "user_id", "balance", "finding")


@query("""
WITH RECURSIVE up(owned, owner, hops) AS (
  SELECT c_custkey, c_custkey // 10, 1 FROM customer WHERE c_custkey // 10 > 0
  UNION ALL SELECT owned, owner // 10, hops + 1 FROM up WHERE owner // 10 > 0
), chain AS (SELECT -a AS owner, -b AS owned, CAST(b - a AS INTEGER) AS hops FROM range(1, 131) x(a), range(1, 131) y(b) WHERE a < b)
SELECT owner, owned, hops FROM up UNION ALL SELECT owner, owned, hops FROM chain
""")
def ownership_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "customer").select(F.expr("c_custkey div 10").alias("owner"), F.col("c_custkey").alias("owned")).where("owner > 0")
    chain = spark.range(1, 130).select((-F.col("id")).alias("owner"), (-F.col("id") - 1).alias("owned"))
    return entities.closure(edges.unionByName(chain))


# --- workflow ---------------------------------------------------------------------------------------------


@query("""
SELECT doc_id, sha256(text) AS checksum, min(doc_id) OVER (PARTITION BY text) AS document_id, doc_id = min(doc_id) OVER (PARTITION BY text) AS created FROM documents
""")
def upload_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    uploads = table(spark, sf_dir, "documents").select("doc_id", french.content_key(F.encode("text", "utf-8")).alias("sum"))
    return workflow.receipts(uploads, F.col("sum"), ["doc_id"], "doc_id").select("doc_id", "checksum", "document_id", "created")


_STAGE_OF = "CASE event_type WHEN 'view' THEN 'NDA' WHEN 'click' THEN 'Due diligence' WHEN 'purchase' THEN 'Offer' WHEN 'signup' THEN 'Sourcing' END"


@query("""
WITH RECURSIVE r AS (
  SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n,
    CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 0 ELSE -1 END AS asked FROM events
), f(user_id, n, event_id, s, accepted) AS (
  SELECT user_id, n, event_id, CASE WHEN asked = 1 THEN 1 ELSE 0 END, asked = 1 FROM r WHERE n = 1
  UNION ALL
  SELECT r.user_id, r.n, r.event_id, CASE WHEN asked = s + 1 THEN s + 1 ELSE s END, asked = s + 1 FROM f JOIN r ON r.user_id = f.user_id AND r.n = f.n + 1
)
SELECT event_id, user_id, accepted, ['Sourcing', 'NDA', 'Due diligence', 'Offer'][s + 1] AS state FROM f
""")
def stage_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.expr(_STAGE_OF).alias("stage"))
    return workflow.transitions(requests, "user_id", ["ts", "event_id"], "stage").select("event_id", "user_id", "accepted", "state")


@query("""
WITH e AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error')
SELECT a.event_id, a.user_id, count(*) AS recent, count(*) > 3 AS limited
FROM e a JOIN e b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL 1 DAY AND a.ts GROUP BY 1, 2
""")
def rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempts = table(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", "user_id", "ts")
    return workflow.over_rate(attempts, "user_id", "ts", 86_400, 3).select("event_id", "user_id", "recent", "limited")


@query("""
WITH i AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'signup'),
a AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'click'),
c AS (SELECT a.user_id, a.ts, a.event_id, (SELECT arg_max(event_id, (i.ts, i.event_id)) FROM i WHERE i.user_id = a.user_id AND i.ts <= a.ts) AS code FROM a),
f AS (SELECT c.*, coalesce(c.ts - i.ts <= INTERVAL 2 DAY, false) AS fresh FROM c LEFT JOIN i ON i.event_id = c.code)
SELECT user_id, event_id AS attempt_id, fresh AND NOT EXISTS (
  SELECT 1 FROM f g WHERE g.code = f.code AND g.fresh AND (g.ts, g.event_id) < (f.ts, f.event_id)) AS ok
FROM f
""")
def otp_single_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    issued = events.where("event_type = 'signup'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("issue_id"))
    attempts = events.where("event_type = 'click'").select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("attempt_id"))
    return workflow.code_checks(issued, attempts, "user_id", 2 * 86_400).select("user_id", "attempt_id", "ok")


@query("""
SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS company, arg_max(CASE event_type WHEN 'click' THEN 'add' ELSE 'remove' END, (ts, event_id)) AS action
FROM events WHERE event_type IN ('click', 'error') GROUP BY 1, 2
""")
def watchlist_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = table(spark, sf_dir, "events").where("event_type in ('click', 'error')")
    actions = actions.select("user_id", F.get_json_object("props", "$.k").cast("long").alias("company"), F.when(F.col("event_type") == "click", "add").otherwise("remove").alias("action"), "ts", "event_id")
    return workflow.last_action(actions, ["user_id", "company"], "action", ["ts", "event_id"])


@query("""
SELECT event_id, user_id FROM events e WHERE event_type <> 'error'
AND NOT EXISTS (SELECT 1 FROM events r WHERE r.user_id = e.user_id AND r.event_type = 'error' AND r.ts <= e.ts)
""")
def session_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    requests = events.where("event_type <> 'error'").select("event_id", "user_id", F.col("ts").alias("at"))
    revoked = events.where("event_type = 'error'").select("user_id", F.col("ts").alias("revoked_at"))
    return workflow.live_requests(requests, revoked, "user_id").select("event_id", "user_id")


@query("SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE '%00#_1%' ESCAPE '#' OR (c_name ILIKE '%oMer#%%' ESCAPE '#') OR (lower(c_name) LIKE '%0001%' AND c_mktsegment = 'BUILDING')")
def catalogue_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    found = [workflow.search(customers, "c_name", q, "c_mktsegment", s) for q, s in (("00_1", None), ("oMer%", None), ("0001", "BUILDING"))]
    return found[0].unionByName(found[1]).unionByName(found[2]).select("c_custkey", "c_name").distinct()


@query("""
WITH s AS (SELECT o_custkey, max(CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1 ELSE 0 END) AS current_rank FROM orders GROUP BY 1)
SELECT o_orderkey FROM orders JOIN s USING (o_custkey) WHERE o_orderkey % 4 <= current_rank
""")
def visible_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    level = F.when(F.col("o_orderpriority") == "1-URGENT", 3).when(F.col("o_orderpriority") == "2-HIGH", 2).when(F.col("o_orderpriority") == "3-MEDIUM", 1).otherwise(0)
    states = orders.groupBy("o_custkey").agg(F.max(level).alias("current_rank"))
    return workflow.visible(orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 4).alias("stage_rank")), states, "o_custkey").select("o_orderkey")


@query("""
SELECT o_orderkey AS id, 'acte' AS kind, strftime(o_orderdate, '%Y-%m-%d') AS deposited, o_orderpriority AS decision, CAST(NULL AS VARCHAR) AS closed FROM orders
UNION ALL BY NAME
SELECT l_orderkey AS id, 'bilan' AS kind, strftime(l_shipdate, '%Y-%m-%d') AS closed FROM lineitem
""")
def union_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    actes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit("acte").alias("kind"), F.to_date("o_orderdate").cast("string").alias("deposited"), F.col("o_orderpriority").alias("decision"))
    bilans = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.lit("bilan").alias("kind"), F.to_date("l_shipdate").cast("string").alias("closed"))
    return actes.unionByName(bilans, allowMissingColumns=True)


# --- forms, certificates, identifiers ---------------------------------------------------------------------


@query("""
WITH w AS (SELECT l_orderkey AS doc_id, 7 - l_linenumber AS page FROM lineitem),
r AS (SELECT l_orderkey AS doc_id, min(l_linenumber) AS first, max(l_linenumber) AS last FROM lineitem GROUP BY 1)
SELECT doc_id, page, first, last FROM w JOIN r USING (doc_id)
WHERE NOT EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = w.doc_id AND x.l_linenumber = w.page)
""")
def missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"))
    return coverage.missing_pages(pages.withColumn("page", 7 - F.col("page")), pages)


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_discount < 0.05)")
def confident_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.confident(table(spark, sf_dir, "lineitem"), 0.05, "l_discount").select("l_orderkey", "l_linenumber")


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, l_linenumber AS pos, CASE l_linenumber WHEN 2 THEN 'assets' WHEN 3 THEN 'sales' ELSE 'purchases' END AS field
FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
WHERE (l_linenumber = 2 AND o_orderstatus = 'F') OR (l_linenumber IN (3, 4) AND o_orderstatus = 'O')
""")
def form_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    form = F.when(F.col("o_orderstatus") == "F", "DGFiP N° 2050-SD 2024").when(F.col("o_orderstatus") == "O", "N° 2052 2018").otherwise("2050 puis 2051")
    heads = orders.select(F.col("o_orderkey").alias("k"), F.lit(0).alias("pos"), form.alias("text"))
    code = F.when(F.col("l_linenumber") == 2, "TOTAL GENERAL CO 1 234").when(F.col("l_linenumber") == 3, "FL Chiffres d'affaires nets").when(F.col("l_linenumber") == 4, "ACHATS DE MARCHANDISES FS 1 234").otherwise("Du 01/01/2020 AU 31/12/2020")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("pos"), code.alias("text"))
    rows = heads.unionByName(lines).select(F.col("k").cast("string").alias("doc_id"), F.lit(1).alias("page"), "pos", "text")
    registry = spark.sql("SELECT * FROM VALUES ('assets', '2050', 'CO'), ('sales', '2052', 'FL'), ('purchases', '2052', 'FS'), ('none', '2052', 'DE') AS r(field, form, code)")
    return accounts.field_candidates(rows, registry).select("doc_id", "pos", "field")


@query("""
SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS seq FROM events
""")
def activity_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.history(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"]).select("event_id", "seq")


@query("""
WITH d AS (SELECT c_custkey, lpad(CAST(c_custkey * 7919 % 100000000 AS VARCHAR), 8, '0') AS s FROM customer),
v AS (SELECT c_custkey, s, [CAST(x AS INTEGER) FOR x IN string_split(s, '')] AS d FROM d),
c AS (SELECT c_custkey, s, (10 - (d[1] + d[3] + d[5] + d[7] + (2 * d[2]) // 10 + (2 * d[2]) % 10 + (2 * d[4]) // 10 + (2 * d[4]) % 10
  + (2 * d[6]) // 10 + (2 * d[6]) % 10 + (2 * d[8]) // 10 + (2 * d[8]) % 10) % 10) % 10 AS k FROM v)
SELECT c_custkey, 'SIREN' AS kind, s || k AS value FROM c WHERE c_custkey % 3 <> 0
""")
def siren_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.lpad((F.col("c_custkey") * 7919 % 100_000_000).cast("string"), 8, "0")
    customers = table(spark, sf_dir, "customer").select("c_custkey", body.alias("s"))
    digit = F.get(F.filter(F.sequence(F.lit(0), F.lit(9)), lambda k: french.luhn(F.concat("s", k.cast("string")))), F.lit(0))
    siren = customers.select("c_custkey", F.concat("s", digit.cast("string")).alias("siren"))
    spaced = F.concat_ws(" ", F.substring("siren", 1, 3), F.substring("siren", 4, 3), F.substring("siren", 7, 3))
    # every third text holds a wrong check digit
    wrong = F.translate(F.substring("siren", 9, 1), "0123456789", "1234567890")
    said = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("RCS "), F.substring("siren", 1, 8), wrong)).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("RCS LYON "), spaced, F.lit(", France"))).otherwise(F.concat(F.lit("n° "), F.col("siren"), F.lit(".")))
    found = siren.select("c_custkey", F.explode(french.identifiers(said)).alias("x"))
    return found.select("c_custkey", "x.kind", "x.value")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS deposited, 'A' || o_custkey AS chrono FROM orders WHERE o_orderkey % 2 = 0")
def certificate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat(F.lit("Acte enregistré le "), F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" sous le NUMÉRO de DépÔt A"), F.col("o_custkey").cast("string"), F.lit(" au greffe"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, said).otherwise("Acte non enregistré").alias("text"))
    found = orders.select("o_orderkey", french.certificate(F.col("text")).alias("c")).where("c.chrono is not null")
    return found.select("o_orderkey", F.col("c.deposited").cast("string").alias("deposited"), "c.chrono")


@query("SELECT doc_id, CASE WHEN doc_id % 10 <> 0 THEN sha256(text) END AS checksum FROM documents")
def upload_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = F.when(F.col("doc_id") % 10 == 0, "%%% no base64").otherwise(F.base64(F.encode("text", "utf-8")))
    return table(spark, sf_dir, "documents").select("doc_id", french.content_key(french.upload_bytes(sent)).alias("checksum"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(o_custkey AS VARCHAR) AS chrono FROM orders WHERE o_orderkey % 5 <> 0")
def document_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.concat_ws("_", F.lit("CA"), F.lit("012345678"), F.lit("6901"), F.lit("1999B1"), F.year("o_orderdate").cast("string"), F.col("o_custkey").cast("string"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.concat(said, F.lit("_x"))).otherwise(said).alias("name"))
    parts = orders.select("o_orderkey", french.document_name(F.col("name")).alias("d")).where("d.siren = '012345678'")
    return parts.select("o_orderkey", "d.year", "d.chrono")
