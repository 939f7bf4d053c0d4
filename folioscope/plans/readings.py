"""Queries over running texts of lines, built from the driver's tables, each with an independently written DuckDB query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import reading
from folioscope.plans.registry import query
from folioscope.storage import table

# documents of some hundred lines: an order's lines go to one of 40, page by line number
_SQL = """WITH l AS (
  SELECT min(l_partkey) % 40 AS doc_id, l_linenumber AS page, l_orderkey AS pos, min(l_partkey) AS p, CAST(min(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY l_orderkey, l_linenumber
), t AS (SELECT *, q || ' shares of part ' || p AS text FROM l),
o AS (SELECT *, CAST(coalesce(sum(length(text) + 1) OVER w, 0) AS BIGINT) AS start FROM t WINDOW w AS (PARTITION BY doc_id ORDER BY page, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
"""


def _ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("pos"), F.col("l_linenumber").alias("page")).agg(F.min("l_partkey").alias("p"), F.min("l_quantity").alias("q"))
    x, y = F.col("q").cast("double"), F.col("page").cast("double")
    text = F.concat(F.col("q").cast("long").cast("string"), F.lit(" shares of part "), F.col("p").cast("string"))
    lines = items.select((F.col("p") % 40).alias("doc_id"), "page", "pos", text.alias("text"), F.array(x, y, x + 100, y + 8).alias("box"))
    return reading.in_reading_order(lines, ["page", "pos"])


@query(_SQL + "SELECT doc_id, page, pos, start FROM o")
def reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every line begins in its document's text."""
    return _ordered(spark, sf_dir).select("doc_id", "page", "pos", F.col("offset").alias("start"))


@query(_SQL + """, n AS (
  SELECT *, lead(page) OVER w AS page2, lead(pos) OVER w AS pos2, lead(q) OVER w AS q2, lead(start) OVER w AS start2 FROM o WINDOW w AS (PARTITION BY doc_id ORDER BY page, pos)
)
SELECT doc_id, start + length(q || ' shares of ') AS "at", start2 + length(q2 || ' shares') AS "end", page AS page1, pos AS pos1, page2, pos2,
  CAST(CASE WHEN page = page2 THEN least(q, q2) ELSE q END AS DOUBLE) AS x0, CAST(CASE WHEN page = page2 THEN greatest(q, q2) ELSE q END + 100 AS DOUBLE) AS x1 FROM n WHERE pos2 IS NOT NULL
""")
def text_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches over line and page ends, with the lines they touch and the box of the first page's."""
    found = reading.matches(reading.blocks(_ordered(spark, sf_dir)), r"part [0-9]+\n[0-9]+ shares")
    box = reading.union_boxes(F.col("lines"))[0]["box"]
    line = lambda k: [F.col("lines")[k - 1][c].alias(f"{c}{k}") for c in ("page", "pos")]
    return found.select("doc_id", "at", "end", *line(1), *line(2), box[0].alias("x0"), box[2].alias("x1"))


@query("""
WITH o AS (SELECT o_orderkey AS k, 'HOLDER' || o_custkey AS g, 'TAKER' || o_custkey % 7 AS t, o_custkey % 900 + 1 AS n, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderkey % 6 AS form FROM orders),
m AS (
  SELECT k, 0 AS nr, g AS giver, t AS taker, n AS shares, d AS date, 2 AS n_lines FROM o WHERE form = 0
  UNION ALL SELECT k, 1, g, 'OTHER ' || t, 1000 + n, d, 2 FROM o WHERE form = 0
  UNION ALL SELECT k, 0, g, t, n, NULL, 2 FROM o WHERE form = 1
  UNION ALL SELECT k, 0, NULL, t, n, NULL, 1 FROM o WHERE form = 2
  UNION ALL SELECT k, 0, g, t, 1000 + n, d, 1 FROM o WHERE form = 3
  UNION ALL SELECT k, 0, g, t, n, d, 1 FROM o WHERE form = 4
  UNION ALL SELECT k, 1, t, g, n, d, 1 FROM o WHERE form = 4
)
SELECT k AS o_orderkey, CAST(CASE form WHEN 4 THEN nr ELSE 0 END AS BIGINT) AS sentence, CAST(CASE form WHEN 4 THEN 0 ELSE nr END AS INTEGER) AS k, giver, taker, CAST(shares AS BIGINT) AS shares, date, n_lines FROM m JOIN o USING (k)
""")
def extracted_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements of shares out of sentences that run over lines."""
    key = F.col("o_custkey")
    g, t, n = (F.concat(F.lit(a), b.cast("string")) for a, b in (("HOLDER", key), ("TAKER", key % 7), ("", key % 900 + 1)))
    more = F.concat(F.lit("1 "), F.lpad((key % 900 + 1).cast("string"), 3, "0"))
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    forms = [
        [("Le ", day, ", M. ", g, " cède à la société"), (t, " ", n, " parts sociales et ", more, " parts à Mme Other ", t)],
        [("CESSION DE ", n, " PARTS SOCIALES DE LA SOCIETE EXEMPLE PAR M. ", g, " A M.;"), (t, ""), ("Déposé le ", day)],
        [("Mme ", t, " souscrit ", n, " actions nouvelles"), ("de 10 euros",)],
        [("Décision du ", day), ("M. ", g, " cède ", more, " actions à Mme ", t, ".")],
        [("Le ", day, " : cession de ", n, " parts par M. ", g, " à Mme ", t, " ; cession de ", n, " parts par Mme ", t, " au profit de M. ", g)],
        [("M. ", g, " est nommé gérant pour ", n, " ans",), ("Les ", n, " parts sont libérées",)],
    ]
    lines = F.array(*[F.array(*[F.concat(*[F.lit(x) if isinstance(x, str) else x for x in line]) for line in form]) for form in forms])
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.posexplode(F.element_at(lines, (F.col("o_orderkey") % len(forms) + 1).cast("int"))).alias("pos", "text"))
    rows = rows.select("doc_id", F.lit(1).alias("page"), "pos", "text", F.lit(None).cast("array<double>").alias("box"))
    found = reading.movements(reading.blocks(reading.in_reading_order(rows, ["page", "pos"])))
    sentence = F.when((F.col("doc_id") % 6 == 4) & (F.col("at") > 20), 1).otherwise(0).cast("long")
    return found.select(F.col("doc_id").alias("o_orderkey"), sentence.alias("sentence"), F.col("k").cast("int").alias("k"), "giver", "taker", "shares", F.col("date").cast("string").alias("date"), F.size("lines").alias("n_lines"))


@query(r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos, unnest(string_split(text, chr(10))) AS text FROM documents
), w AS (
  SELECT doc_id, pos, list_distinct(regexp_extract_all(lower(translate(text, 'ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy')), '[a-z0-9]+')) AS w FROM l
), i AS (SELECT doc_id, pos, len(w) AS size, unnest(w) AS token FROM w),
df AS (SELECT token, count(DISTINCT doc_id) AS df FROM i GROUP BY token),
a AS (
  SELECT doc_id, unnest(list_append(w, 'zzabsent')) AS token FROM w JOIN (SELECT doc_id, max(pos) // 2 AS pos FROM l GROUP BY doc_id) USING (doc_id, pos)
), x AS (
  SELECT a.doc_id, token, CAST(round(1000 * ln(1 + (SELECT count(DISTINCT doc_id) FROM l) / coalesce(df, 1))) AS BIGINT) AS weight FROM a LEFT JOIN df USING (token)
), hit AS (
  SELECT x.doc_id, pos, size, sum(weight) AS hit FROM x JOIN i USING (doc_id, token) GROUP BY ALL
), best AS (
  SELECT doc_id, arg_min(pos, row(-hit, size, pos)) AS pos, max(hit) AS hit FROM hit GROUP BY doc_id
), total AS (SELECT doc_id, sum(weight) AS total FROM x GROUP BY doc_id)
SELECT doc_id, CASE WHEN hit >= 0.5 * total THEN CAST(pos AS BIGINT) END AS pos, CASE WHEN hit >= 0.5 * total THEN round(hit / total, 6) END AS score
FROM total LEFT JOIN best USING (doc_id)
""")
def decision_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line of a document that holds the words of a decision, here those of its middle line and one that is nowhere."""
    text = F.split("text", "\n", -1)
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", text.alias("text"))
    lines = docs.select("doc_id", F.posexplode("text").alias("pos", "text")).select("doc_id", F.lit(1).alias("page"), F.col("pos").cast("long").alias("pos"), "text", F.array(F.lit(0.0)).alias("box"))
    middle = F.get("text", F.floor((F.size("text") - 1) / 2).cast("int"))
    decisions = docs.select("doc_id", F.lit(1).alias("decision_id"), F.concat(middle, F.lit(" zzabsent")).alias("text"))
    return reading.evidence(decisions, lines).select("doc_id", "pos", F.round("score", 6).alias("score"))
