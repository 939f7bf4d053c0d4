"""Capital and shareholder events, replayed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import french
from folioscope.operators import captable, scan

#: Decisions to event codes, first match wins; texts are folded. The last code is a finding, not scored.
EVENT_RULES = [
    ("augmentation d[ue] capital", "CAPITAL_INCREASE"),
    ("reduction d[ue] capital", "CAPITAL_DECREASE"),
    ("cession de parts|donation.*parts", "SHAREHOLDER_SHARE_TRANSFER"),
    ("actions? de preference|categories? d'actions", "CAPITAL_DUAL_CLASS"),
]
#: Decisions that are no capital events.
OUT_OF_SCOPE = "commissaire|president|gerant|siege|denomination|objet social|date de cloture"


def classified(rows: DataFrame, text: Column, rules: list[tuple[str, str]] = EVENT_RULES) -> DataFrame:
    """Adds ``code``: that of the first rule whose pattern the text matches, else null."""
    code = F.coalesce(*[F.when(text.rlike(pattern), F.lit(code)) for pattern, code in rules])
    return rows.withColumn("code", code)


def decisions(filings: DataFrame) -> DataFrame:
    """One row per distinct decision of a filing, trimmed: filings repeat a decision once per kind of act.

    Spellings that differ by case and accents only are one; the one that sorts first is kept.
    """
    items = filings.select("id", "siren", "dateDepot", F.explode("typeRdd").alias("d"))
    named = items.select("id", "siren", "dateDepot", F.trim("d.decision").alias("decision")).where("decision is not null")
    named = named.withColumn("folded", french.folded(F.col("decision")))
    return named.groupBy("id", "folded").agg(*[F.min(c).alias(c) for c in ("siren", "dateDepot", "decision")])


def dated(events: DataFrame, text: Column, deposit: str = "dateDepot") -> DataFrame:
    """Adds event_date and date_basis: the text's first date, in numbers or words, if it isn't after the deposit, else the deposit's.

    A date that the text gives as that of its deposit is no evidence.
    """
    said = french.first_date(text)
    usable = said.isNotNull() & (said <= F.col(deposit))
    return events.withColumn("event_date", F.when(usable, said).otherwise(F.col(deposit))).withColumn("date_basis", F.when(usable, "text").otherwise("deposit"))


def timeline(events: DataFrame, key: str, order: list[str], delta: str, absolute: str) -> DataFrame:
    """Adds ``balance``: the running sum of deltas, set anew by every absolute statement. ``order`` must be total. A key may have any share of all events."""
    rows = scan.ranged(events, [key], order)
    return scan.since_reset(rows, [key], order, {"balance": (F.col(delta), F.col(absolute))}).drop(scan.PART)


def entries(transfers: DataFrame) -> DataFrame:
    """Double entry: a transfer (id, giver, taker, shares) as -shares of the giver and +shares of the taker.

    A movement seen as transfer and as entry counts once: equal (date, giver, taker, shares) are one.
    """
    once = transfers.groupBy("date", "giver", "taker", "shares").agg(F.min("id").alias("id"))
    out = once.select("id", "date", F.col("giver").alias("holder"), (-F.col("shares")).alias("shares"))
    return out.unionByName(once.select("id", "date", F.col("taker").alias("holder"), "shares")).where("holder is not null")


def holdings(rows: DataFrame, holder: str, order: list[str], shares: str) -> DataFrame:
    """Running balance per holder and ``change``: entry or end, where it leaves or returns to zero. A holder may have any share of all rows."""
    out = scan.running(scan.ranged(rows, [holder], order), [holder], order, {"balance": F.col(shares)}).drop(scan.PART)
    before = F.col("balance") - F.col(shares)
    return out.withColumn("change", F.when((before == 0) & (F.col("balance") != 0), "entry").when((before != 0) & (F.col("balance") == 0), "end"))


def entry_events(held: DataFrame) -> DataFrame:
    """Of ``holdings``, the rows at which a holder comes in or goes out, with their event code."""
    return held.where("change is not null").withColumn("code", F.when(F.col("change") == "entry", "SHAREHOLDER_ENTRY").otherwise("SHAREHOLDER_END"))


def state_as_of(states: DataFrame, dates: DataFrame, key: str, at: str, date: str, order: list[str], value: str) -> DataFrame:
    """The last value per key at or before each date of the list ``dates``. ``order`` must be total.

    Every key is asked for every date, which is as many rows as the result, and both logs are scanned together (``captable.as_of``), so
    no list goes through the driver and a key's states may be in several tasks.
    """
    days = dates.where(F.col(date).isNotNull()).agg(F.collect_set(date)).scalar()
    # from a key's first state on
    asked = states.where(F.col(at).isNotNull()).groupBy(key).agg(F.min(at).alias("_first")).select(key, "_first", F.explode(days).alias(date))
    asked = asked.where(F.col(date) >= F.col("_first")).select(key, date, F.col(date).cast(states.schema[at].dataType).alias(at))
    return captable.as_of(asked, states, [key], at, order, [value]).select(key, date, value)


def share_range(text: Column) -> Column:
    """(shares, first, last, consistent) of ``n parts numérotées a à b``; consistent: n = b - a + 1."""
    pattern = r"([0-9]+) (?:parts?|actions?)[^0-9]*numerote[es]* (?:de )?([0-9]+) a ([0-9]+)"
    n, a, b = (F.regexp_extract(french.folded(text), pattern, k).try_cast("long") for k in (1, 2, 3))
    return F.struct(n.alias("shares"), a.alias("first"), b.alias("last"), (n == b - a + 1).alias("consistent"))


def findings(timeline: DataFrame, key: str, balance: str = "balance") -> DataFrame:
    """States that can't be: negative balances, as rows."""
    return timeline.where(F.col(balance) < 0).withColumn("finding", F.lit("negative balance"))


def totals_differ(held: DataFrame, stated: DataFrame, key: str) -> DataFrame:
    """Keys where the holders' shares don't add up to the stated number."""
    summed = held.groupBy(key).agg(F.sum("shares").alias("held"))
    return summed.join(stated, key).where("held <> stated")


def contradictions(key: str, balances: DataFrame, held: DataFrame, stated: DataFrame, differing: DataFrame) -> DataFrame:
    """What can't be true, as rows (key, finding, a, b): negative balances, totals that differ from the holders' sum, and
    values on which two sources (``differing``, with a and b) disagree."""
    negative = findings(balances, key).select(key, "finding", F.col("balance").cast("long").alias("a"), F.lit(None).cast("long").alias("b"))
    totals = totals_differ(held, stated, key).select(key, F.lit("holders and total differ").alias("finding"), F.col("held").cast("long").alias("a"), F.col("stated").cast("long").alias("b"))
    sources = differing.select(key, F.lit("sources disagree").alias("finding"), F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    return negative.unionByName(totals).unionByName(sources)


def repeated_filings(events: DataFrame, days: int) -> DataFrame:
    """Pairs of events of one company and code within ``days``: authorisation and realisation of one change, maybe.

    Neighbours in order are paired, so a company of many events gives as many pairs at most.
    """
    w = Window.partitionBy("siren", "code").orderBy("event_date", "id")
    out = events.withColumn("later", F.lead("id").over(w)).withColumn("later_date", F.lead("event_date").over(w))
    return out.where(F.datediff("later_date", "event_date").between(0, days)).select("siren", "code", "id", "later")


def capital_observations(lines: DataFrame, *keys: str) -> DataFrame:
    """Lines that state a company's capital, with the amount: letterheads restate it, so these are no events."""
    some = lines.where(F.lower("text").contains("capital"))  # a cheap test before the parse
    said = some.select(*keys, "text", F.explode(F.array(french.capital_statement(F.col("text"))["absolute"])).alias("capital"))
    return said.where("capital is not null")


def grounded(events: DataFrame, doc_id: str, page: str, box: str, snippet: str) -> DataFrame:
    """Adds ``source``, where a value was read, or null and a ``note`` if it can't be pointed at."""
    source = F.struct(F.col(doc_id).alias("inpi_id"), F.col(page).alias("page"), F.col(box).alias("bbox"), F.col(snippet).alias("snippet"))
    there = F.col(doc_id).isNotNull() & F.col(page).isNotNull() & F.col(box).isNotNull()
    return events.withColumn("source", F.when(there, source)).withColumn("note", F.when(~there, F.lit("no box: the text was not read")))
