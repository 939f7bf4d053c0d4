"""State of a deal workflow: stages, document registry, codes, sessions, watchlists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.operators import scan
from folioscope.storage import land

STAGES = ["Sourcing", "NDA", "Due diligence", "Offer"]


def _micros(name: str) -> Column:
    return F.unix_micros(F.col(name).cast("timestamp"))


def rank(stage: Column, stages: list[str] = STAGES) -> Column:
    """0-based rank of a stage; null if it is unknown."""
    return F.nullif(F.array_position(F.array(*map(F.lit, stages)), stage), F.lit(0)).cast("int") - 1


def transitions(requests: DataFrame, key: str, order: list[str], stage: str, stages: list[str] = STAGES) -> DataFrame:
    """Folds stage requests per key: a request is accepted if it asks for the stage after the current one.

    Adds ``accepted`` and ``state`` after each request; the first state is the first stage. A rejected request
    changes nothing. As only the next rank is ever accepted, rank k is reached by the first request for it after
    rank k - 1 was: one aggregate per stage, instead of a fold over a key's whole log, so a key may have any share of all requests.
    ``order`` must be total.
    """
    out = requests.withColumn("_asked", F.coalesce(rank(F.col(stage), stages), F.lit(-1))).withColumn("_at", F.struct(*order))
    same = F.col(f"r.{key}").eqNullSafe(F.col(f"s.{key}"))
    asked, reached = out.select(key, "_asked", "_at"), None
    for k in range(1, len(stages)):
        own = asked.where(F.col("_asked") == k).alias("r")
        if reached is not None:
            own = own.join(reached.alias("s"), same & (F.col("r._at") > F.col(f"s._t{k - 1}")))
        before = [F.first(f"s._t{j}").alias(f"_t{j}") for j in range(1, k)]
        now = own.groupBy(F.col(f"r.{key}").alias(key)).agg(*before, F.min("r._at").alias(f"_t{k}"))
        if reached is not None:
            left = F.col(f"n.{key}").eqNullSafe(F.col(f"p.{key}"))
            now = reached.alias("p").join(now.alias("n"), left, "left").select("p.*", f"n._t{k}")
        reached = land(now, "reached")
    times = [F.col(f"_t{k}") for k in range(1, len(stages))]
    out = out.alias("r").join(reached.alias("s"), same, "left").select("r.*", *times)
    state = sum((F.coalesce(F.col("_at") >= t, F.lit(False)).cast("int") for t in times), F.lit(0))
    accepted = F.greatest(F.lit(False), *[F.coalesce(F.col("_at") == t, F.lit(False)) for t in times])
    return out.select(*requests.columns, accepted.alias("accepted"), F.get(F.array(*map(F.lit, stages)), state).alias("state"))


def receipts(uploads: DataFrame, checksum: Column, order: list[str], document_id: str) -> DataFrame:
    """Adds checksum, created (first of its content) and document_id of the first; content alone is identity.

    First uploads are found by a partial aggregate; only those of contents with copies are landed and joined back, by a
    join that Spark can split, so thousands of copies are no task's work.
    """
    marked = uploads.withColumn("checksum", checksum)
    key = F.struct(*order)
    first = marked.groupBy("checksum").agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    out = marked.join(land(first, "first_uploads"), "checksum", "left")
    created = F.col("_first").isNull() | (key == F.col("_first"))
    return out.withColumn("created", created).withColumn("document_id", F.coalesce(F.col(f"_first.{document_id}"), F.col(document_id))).drop("_first")


def over_rate(attempts: DataFrame, key: str, at: str, seconds: int, limit: int) -> DataFrame:
    """Attempts with the number within the last ``seconds``, themselves included, and whether they exceed the limit."""
    # a key's attempts in stretches of that many seconds, each with the one before, so that a busy key is many tasks' work
    stretch = F.floor(_micros(at) / (seconds * 1_000_000))
    out = attempts.select("*", F.posexplode(F.array_distinct(F.array(stretch, stretch + 1))).alias("_copy", "_stretch"))
    w = Window.partitionBy(key, "_stretch").orderBy(_micros(at)).rangeBetween(-seconds * 1_000_000, 0)
    out = out.withColumn("recent", F.count(F.lit(1)).over(w)).where("_copy = 0").drop("_copy", "_stretch")
    return out.withColumn("limited", F.col("recent") > limit)


def code_checks(issued: DataFrame, attempts: DataFrame, key: str, seconds: int) -> DataFrame:
    """Attempts (key, at, attempt_id) with ok: the latest code issued before isn't expired or used by an earlier success.

    Issues and attempts are one log per key; an issue at the same time comes first.
    """
    log = issued.select(key, "at", F.lit(0).alias("kind"), F.col("issue_id").alias("id")).unionByName(attempts.select(key, "at", F.lit(1).alias("kind"), F.col("attempt_id").alias("id")))
    order = ["at", "kind", "id"]
    log = scan.last(scan.ranged(log, [key], order), [key], order, {"code": F.when(F.col("kind") == 0, F.struct("at", "id"))}).where("kind = 1")
    fresh = F.coalesce(F.col("code").isNotNull() & (_micros("at") - _micros("code.at") <= seconds * 1_000_000), F.lit(False))
    # the attempts while one code lasts
    nth = F.row_number().over(Window.partitionBy(key, "code.id").orderBy("at", "id"))
    ok = log.where(fresh).withColumn("ok", nth == 1).unionByName(log.where(~fresh).withColumn("ok", F.lit(False)))
    return ok.select(key, "at", F.col("id").alias("attempt_id"), "ok")


def last_action(actions: DataFrame, keys: list[str], action: str, order: list[str]) -> DataFrame:
    """The last action per key; ``order`` must be total."""
    return actions.groupBy(*keys).agg(F.max_by(action, F.struct(*order)).alias(action))


def live_requests(requests: DataFrame, revocations: DataFrame, key: str) -> DataFrame:
    """Requests (key, at) before their session's first revocation (key, revoked_at)."""
    first = revocations.groupBy(key).agg(F.min("revoked_at").alias("revoked_at"))
    return requests.join(first, key, "left").where("revoked_at is null or at < revoked_at").drop("revoked_at")


def search(companies: DataFrame, name: str, q: str, sector_column: str, sector: str | None = None) -> DataFrame:
    """Companies whose name holds q, literally and without regard to case, in a sector if one is given."""
    found = companies.where(F.contains(F.lower(name), F.lower(F.lit(q))))
    return found if sector is None else found.where(F.col(sector_column) == sector)


def visible(documents: DataFrame, states: DataFrame, key: str) -> DataFrame:
    """Documents whose stage rank is at most that of their deal's current stage."""
    return documents.join(states.select(key, "current_rank"), key).where("stage_rank <= current_rank")


def history(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Numbers each key's events from 1, in a total order."""
    rows = scan.running(scan.ranged(events, [key], order), [key], order, {"seq": F.lit(1)})
    return rows.withColumn("seq", F.col("seq").cast("int")).drop(scan.PART)
