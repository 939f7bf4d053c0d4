"""Queries over capital and holders, built from the driver's events, each with an independently written DuckDB query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators import captable
from folioscope.plans.registry import query
from folioscope.storage import table

# events of a user are those of a company; views, clicks and errors move shares between its holders
_SQL = """WITH m AS (
  SELECT event_id, user_id, 'H' || event_id % 5 AS holder, 1 + event_id % 3 AS n FROM events WHERE event_type = 'view'
  UNION ALL SELECT event_id, user_id, 'H' || event_id % 5, -2 FROM events WHERE event_type = 'click'
  UNION ALL SELECT event_id, user_id, 'H' || event_id % 4, 2 FROM events WHERE event_type = 'click'
  UNION ALL SELECT event_id, user_id, 'H' || event_id % 5, -1 FROM events WHERE event_type = 'error'
), e AS (
  SELECT event_id, user_id, ts, event_type, CAST(floor(value) AS BIGINT) AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events
), moved AS (
  SELECT e.user_id, e.seq, holder, sum(n) AS n FROM m JOIN e USING (event_id) GROUP BY ALL
), own AS (
  SELECT e.user_id, e.seq, holder, CAST(sum(n) AS BIGINT) AS n FROM e JOIN moved m ON m.user_id = e.user_id AND m.seq <= e.seq GROUP BY ALL HAVING sum(n) <> 0
), tables AS (
  SELECT user_id, seq, CAST(sum(n) AS BIGINT) AS held, count(*) AS n_holders, string_agg(holder || ':' || n, ',' ORDER BY holder) AS holders FROM own GROUP BY ALL
), since AS (
  SELECT a.user_id, a.seq, coalesce(max(b.seq) FILTER (b.event_type = 'signup'), 0) AS at, count(*) FILTER (b.event_type IN ('signup', 'purchase')) AS known
  FROM e a JOIN e b ON a.user_id = b.user_id AND b.seq <= a.seq GROUP BY ALL
), totals AS (
  SELECT s.user_id, s.seq, any_value(known) AS known, CAST(sum(CASE e.event_type WHEN 'error' THEN -v WHEN 'signup' THEN v WHEN 'purchase' THEN v ELSE 0 END) AS BIGINT) AS capital,
    CAST(sum(CASE e.event_type WHEN 'signup' THEN v // 10 WHEN 'purchase' THEN 3 ELSE 0 END) AS BIGINT) AS shares
  FROM since s JOIN e ON e.user_id = s.user_id AND e.seq <= s.seq AND e.seq >= s.at GROUP BY ALL
), states AS (
  SELECT e.event_id, e.user_id, e.ts, e.seq, capital, shares, coalesce(held, 0) AS held, coalesce(n_holders, 0) AS n_holders, CASE WHEN known > 0 THEN coalesce(held, 0) = shares END AS agrees, coalesce(holders, '') AS holders
  FROM e JOIN totals USING (user_id, seq) LEFT JOIN tables USING (user_id, seq)
)
"""


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    kind, value, key = F.col("event_type"), F.floor("value").cast("long"), F.col("event_id")
    events = table(spark, sf_dir, "events")
    name = lambda n: F.concat(F.lit("H"), (key % n).cast("string"))
    move = lambda holder, n: F.struct(holder.alias("holder"), n.cast("long").alias("shares"))
    moves = F.when(kind == "view", F.array(move(name(5), 1 + key % 3))).when(kind == "click", F.array(move(name(5), F.lit(-2)), move(name(4), F.lit(2)))).when(kind == "error", F.array(move(name(5), F.lit(-1))))
    movements = events.select(F.col("user_id").alias("siren"), "event_id", F.explode(moves).alias("m")).select("siren", "event_id", "m.*")
    changes = events.select(
        F.col("user_id").alias("siren"),
        "event_id",
        F.col("ts").alias("event_date"),
        F.when(kind == "purchase", value).when(kind == "error", -value).alias("capital_delta"),
        F.when(kind == "signup", value).alias("capital_set"),
        F.when(kind == "purchase", F.lit(3).cast("long")).alias("shares_delta"),
        F.when(kind == "signup", F.floor(value / 10).cast("long")).alias("shares_set"),
    )
    return captable.states(changes, movements)


@query(_SQL + "SELECT event_id, user_id, seq, capital, shares, held, n_holders, agrees, holders FROM states")
def cap_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after every event: capital, shares, and who holds how many."""
    found = captable.holders(*_states(spark, sf_dir))
    said = F.array_join(F.transform(F.map_entries("holders"), lambda h: F.concat(h["key"], F.lit(":"), h["value"].cast("string"))), ",")
    return found.select("event_id", F.col("siren").alias("user_id"), "seq", "capital", "shares", "held", "n_holders", "agrees", said.alias("holders"))


@query(_SQL + "SELECT event_id, user_id, shares, held FROM states WHERE NOT agrees")
def cap_table_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events after which the holders don't hold the shares there are."""
    return captable.disagreements(_states(spark, sf_dir)[0]).select("event_id", F.col("siren").alias("user_id"), "shares", "held")


@query(_SQL + """, o AS (SELECT o_orderkey, o_custkey % 150 AS user_id, CAST(o_orderkey % 60 AS INTEGER) AS d, CAST(floor(o_totalprice) AS BIGINT) % 500 AS observed FROM orders)
SELECT o_orderkey, user_id, capital, observed <> capital AS differs FROM o
LEFT JOIN LATERAL (SELECT capital FROM states s WHERE s.user_id = o.user_id AND s.ts <= TIMESTAMP '2024-01-01' + d * INTERVAL 12 HOUR ORDER BY s.seq DESC LIMIT 1) ON true
""")
def observed_capital(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed capitals beside the capital that the events before them lead to."""
    states, _ = _states(spark, sf_dir)
    day = F.expr("timestamp'2024-01-01' + make_dt_interval(0, 12 * cast(o_orderkey % 60 as int))")
    seen = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 150).alias("siren"), day.alias("event_date"), (F.floor("o_totalprice") % 500).alias("observed"))
    return captable.agreeing(seen, states, F.col("observed")).select("o_orderkey", F.col("siren").alias("user_id"), "capital", "differs")


@query("""
WITH e AS (SELECT user_id AS siren, CASE WHEN event_type IN ('click', 'view') THEN 'other' ELSE event_type END AS code, event_id AS id, CAST(ts AS DATE) AS d FROM events),
o AS (SELECT user_id AS siren, CAST(ts AS DATE) AS d, max(CAST(floor(value / 40) AS BIGINT)) AS capital FROM events WHERE event_type = 'signup' GROUP BY ALL),
c AS (SELECT siren, d FROM (SELECT *, lag(capital) OVER (PARTITION BY siren ORDER BY d) AS was FROM o) WHERE was <> capital),
l AS (SELECT e.*, (SELECT count(*) FROM c WHERE c.siren = e.siren AND c.d <= e.d) AS level FROM e),
p AS (
  SELECT a.siren, a.code, a.id, b.id AS later, b.d - a.d AS gap, row_number() OVER (PARTITION BY a.siren, a.code ORDER BY b.d - a.d, a.d, a.id, b.d, b.id) AS r
  FROM l a JOIN l b ON a.siren = b.siren AND a.code = b.code AND b.level = a.level + 1 AND b.d - a.d <= 4
), q AS (SELECT *, row_number() OVER (PARTITION BY siren, code ORDER BY gap, (SELECT d FROM e x WHERE x.id = p.id), id DESC, later) AS s FROM p),
taken AS (
  SELECT siren, code, list_reduce(list_prepend({'a': [-1::BIGINT], 'r': [-1::BIGINT]}, list({'a': [id, later], 'r': [s]} ORDER BY s)),
    lambda t, x: CASE WHEN list_contains(t.a, x.a[1]) OR list_contains(t.a, x.a[2]) THEN t ELSE {'a': list_concat(t.a, x.a), 'r': list_concat(t.r, x.r)} END) AS t
  FROM q GROUP BY ALL
)
SELECT q.siren AS user_id, q.code, id, later, CAST(gap AS INTEGER) AS gap FROM q JOIN taken ON q.siren = taken.siren AND q.code = taken.code AND list_contains(t.r, s)
""")
def realised_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that are likely the authorisation and the realisation of one change of capital."""
    events = table(spark, sf_dir, "events")
    code = F.when(F.col("event_type").isin("click", "view"), "other").otherwise(F.col("event_type"))
    rows = events.select(F.col("user_id").alias("siren"), code.alias("code"), F.col("event_id").alias("id"), F.to_date("ts").alias("event_date"))
    seen = events.where("event_type = 'signup'").select(F.col("user_id").alias("siren"), F.to_date("ts").alias("event_date"), F.floor(F.col("value") / 40).alias("capital"))
    return captable.realisations(rows, seen, 4).withColumnRenamed("siren", "user_id")
