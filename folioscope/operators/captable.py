"""The cap table: capital, shares and holders after every event of a company.

Holdings are kept as intervals: a holder's shares from one change to the next, in *versions*, the events of a company at which any
holding changes. Sums over holders are running sums of the changes, so checking an event costs nothing per holder, and a
holder's row is made once for every version in which it holds, never for events that change no holding; these share the last version's table.
All running values are scans over ranges (scan.py), so one company or holder may have any share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.operators import scan
from folioscope.storage import land, release

KEY, ORDER = ["siren"], ["event_date", "event_id"]


def _moved(events: DataFrame, movements: DataFrame) -> DataFrame:
    """One row per event and holder whose shares it changes, with the event's date."""
    moved = movements.where("holder is not null").groupBy("siren", "event_id", "holder").agg(F.sum("shares").alias("moved")).where("moved <> 0")
    return moved.join(events.select("siren", "event_id", "event_date"), ["siren", "event_id"])


def states(events: DataFrame, movements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The state after each event, and holdings as intervals. Both are landed.

    ``events``: siren, event_id, event_date, capital_delta, capital_set, shares_delta, shares_set; one row per event, and (event_date,
    event_id) is their order in a company. ``movements``: siren, event_id, holder, shares (signed); several of one holder at one event add
    up, and those of unknown events or without holder take no part.

    State: siren, event_id, event_date, seq (from 1), capital, shares, held (all holders together), n_holders, version, agrees: whether
    held = shares, null as long as no statement or change of shares has been seen. A balance of 0 is no holding; a negative one is, so
    that it shows.
    Intervals: siren, holder, shares, since (version), until (the version that ends it, or null).
    """
    events = land(events.select("siren", "event_id", "event_date", "capital_delta", "capital_set", "shares_delta", "shares_set"), "events")
    moved = scan.ranged(_moved(events, movements), ["siren", "holder"], ORDER)
    held = scan.running(moved, ["siren", "holder"], ORDER, {"balance": F.col("moved")})
    before = F.col("balance") - F.col("moved")
    came = F.when((before == 0) & (F.col("balance") != 0), 1).when((before != 0) & (F.col("balance") == 0), -1).otherwise(0)
    held = land(held.drop(scan.PART).withColumn("came", came), "held")
    changes = held.groupBy("siren", "event_id").agg(F.sum("moved").alias("d_held"), F.sum("came").alias("d_holders"))
    rows = scan.ranged(events.join(changes, ["siren", "event_id"], "left"), KEY, ORDER)
    known = F.when(F.col("shares_delta").isNotNull() | F.col("shares_set").isNotNull(), 1)
    sums = {"seq": F.lit(1), "held": F.col("d_held"), "n_holders": F.col("d_holders"), "version": F.when(F.col("d_held").isNotNull(), 1), "_known": known}
    out = scan.running(rows, KEY, ORDER, sums)
    out = scan.since_reset(out, KEY, ORDER, {"capital": (F.col("capital_delta"), F.col("capital_set")), "shares": (F.col("shares_delta"), F.col("shares_set"))})
    agrees = F.when(F.col("_known") > 0, F.col("held") == F.col("shares"))
    out = land(out.select("siren", "event_id", "event_date", "seq", "capital", "shares", "held", "n_holders", "version", agrees.alias("agrees")), "states")
    # a change ends the interval before it; the last one of a holder stays open
    at = scan.ranged(held.join(out.select("siren", "event_id", "version"), ["siren", "event_id"]).select("siren", "holder", "balance", "version"), ["siren", "holder"], ["version"])
    ended = scan.last(at, ["siren", "holder"], ["version"], {"was": F.struct("version", "balance")}, before=True).where("was is not null")
    ended = ended.select("siren", "holder", F.col("was.balance").alias("shares"), F.col("was.version").alias("since"), F.col("version").alias("until"))
    open_ = at.groupBy("siren", "holder").agg(F.max(F.struct("version", "balance")).alias("last"))
    open_ = open_.select("siren", "holder", F.col("last.balance").alias("shares"), F.col("last.version").alias("since"), F.lit(None).cast("long").alias("until"))
    intervals = land(ended.unionByName(open_).where("shares <> 0"), "intervals")
    release(moved, held, rows, at, events)
    return out, intervals


def holders(states: DataFrame, intervals: DataFrame) -> DataFrame:
    """The states with ``holders``, a map from holder to shares, empty where nobody holds any.

    The table of a version is made once, from the intervals that cover it, and joined to all of the version's events.
    """
    top = states.groupBy("siren").agg(F.max("version").alias("top"))
    until = F.coalesce(F.col("until") - 1, F.col("top"))
    each = intervals.join(top, "siren").select("siren", "holder", F.col("shares").alias("n"), F.explode(F.sequence("since", until)).alias("version"))
    tables = each.groupBy("siren", "version").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("holder", "n")))).alias("holders"))
    out = states.join(tables, ["siren", "version"], "left")
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<long>"))
    return out.withColumn("holders", F.coalesce(F.col("holders").cast("map<string,bigint>"), none))


def disagreements(states: DataFrame) -> DataFrame:
    """Events after which the holders' shares don't add up to the shares there are."""
    return states.where("not agrees").select("siren", "event_id", "event_date", "shares", "held")


def as_of(observations: DataFrame, log: DataFrame, keys: list[str], at: str, order: list[str], values: list[str]) -> DataFrame:
    """Observations with the log's last ``values`` at or before their time, null before its first row.

    Both tables are dealt together by key and time, the log's rows first where times are equal and among themselves by ``order``, and the last
    state is carried on, also over the borders of ranges: one shuffle for both sides, no list of times on the driver, no
    join by ranges. Observations without time have no state.
    """
    state = F.struct(*values)
    own = [c for c in observations.columns if c not in (*keys, at)]
    a = log.where(F.col(at).isNotNull()).select(*keys, at, F.lit(0).alias("_side"), F.struct(*order).alias("_order"), state.alias("_state"), F.lit(None).cast(observations.select(F.struct(*own)).schema[0].dataType).alias("_own"))
    kind = {f.name: f.dataType for f in a.schema}
    b = observations.select(*keys, at, F.lit(1).alias("_side"), F.lit(None).cast(kind["_order"]).alias("_order"), F.lit(None).cast(kind["_state"]).alias("_state"), F.struct(*own).alias("_own"))
    sort = [at, "_side", "_order"]
    rows = scan.ranged(a.unionByName(b), keys, sort)
    out = scan.last(rows, keys, sort, {"_seen": F.when(F.col("_side") == 0, F.struct("_state"))}).where("_side = 1")
    return out.select(*keys, at, "_own.*", *[F.col(f"_seen._state.{v}").alias(v) for v in values])


def agreeing(observations: DataFrame, states: DataFrame, value: Column) -> DataFrame:
    """Observed capitals (siren, event_date, ...) beside the capital that the events lead to: capital and differs (null before the first event)."""
    seen = as_of(observations, states, ["siren"], "event_date", ["seq"], ["capital"])
    return seen.withColumn("differs", value != F.col("capital"))


def capital_levels(observations: DataFrame) -> DataFrame:
    """(siren, event_date, capital, level) of the observations at which the observed capital changes, numbered from 1; the first one is none.

    ``observations`` are (siren, event_date, capital); of several on one day the largest counts, and null capitals don't.
    """
    days = observations.where("capital is not null and event_date is not null").groupBy("siren", "event_date").agg(F.max("capital").alias("capital"))
    rows = scan.ranged(days, KEY, ["event_date"])
    seen = scan.last(rows, KEY, ["event_date"], {"_was": F.col("capital")}, before=True)
    changed = F.when(F.col("_was").isNotNull() & (F.col("_was") != F.col("capital")), 1)
    return scan.running(seen, KEY, ["event_date"], {"level": changed}).where("_was is not null and _was <> capital").select("siren", "event_date", "capital", "level")


def realisations(events: DataFrame, observations: DataFrame, days: int) -> DataFrame:
    """Authorisations and their realisations: siren, code, id, later (ids of both) and gap, in days. Landed.

    Two events (siren, code, id, event_date) of one company and code may be the same change if the second comes at most ``days``
    after the first and the observed capital changes exactly once between them, after the first's day and up to the second's. Of
    all such pairs the closest are taken first (ties: the earlier first event, then the ids nearest the change), each event in one pair at most.

    Pairs are never listed. The capital's changes cut a company's events into levels, and a pair joins neighbouring levels. Seen from
    such a border pairs form outward, the k-th last event with the k-th next one. A round takes, border by border, the pairs up to the first
    that has an end for which the nearest event beyond its other border is closer; what is left goes into the next round.
    """
    seen = as_of(events.where("event_date is not null and siren is not null and code is not null"), capital_levels(observations), KEY, "event_date", ["level"], ["level"])
    left = land(seen.select("siren", "code", "id", "event_date", F.coalesce("level", F.lit(0)).cast("long").alias("level")), "events")
    level, used, taken = ["siren", "code", "level"], [], None
    while True:
        dealt = scan.ranged(left, level, ["event_date", "id"])
        rows = scan.running(dealt, level, ["event_date", "id"], {"nth": F.lit(1)})
        ends = left.groupBy(*level).agg(F.count(F.lit(1)).alias("n"), F.min("event_date").alias("first"), F.max("event_date").alias("last"))
        rows = rows.join(ends.select(*level, "n"), level)
        a = rows.select("siren", "code", "level", "id", F.col("event_date").alias("at"), (F.col("n") - F.col("nth") + 1).alias("k"))
        b = rows.select("siren", "code", (F.col("level") - 1).alias("level"), F.col("id").alias("later"), F.col("event_date").alias("later_at"), F.col("nth").alias("k"))
        pairs = a.join(b, [*level, "k"]).withColumn("gap", F.datediff("later_at", "at")).where(F.col("gap") <= days)
        # the nearest events beyond the other borders of both ends, while there are any
        pairs = pairs.join(ends.select("siren", "code", (F.col("level") + 1).alias("level"), F.col("last").alias("_before")), level, "left")
        pairs = pairs.join(ends.select("siren", "code", (F.col("level") - 2).alias("level"), F.col("first").alias("_after")), level, "left")
        better = (F.datediff("at", "_before") <= F.col("gap")) | (F.datediff("_after", "later_at") < F.col("gap"))
        pairs = pairs.withColumn("_waits", F.when(F.coalesce(better, F.lit(False)), F.col("k")))
        stop = pairs.groupBy(*level).agg(F.min("_waits").alias("_stop"))
        now = pairs.join(stop, level).where("_stop is null or k < _stop").select("siren", "code", "id", "later", "gap")
        now = land(now, "taken")
        release(dealt)
        used.append(now)
        taken = now if taken is None else taken.unionByName(now)
        if now.isEmpty():
            out = land(taken, "realisations")
            release(left, *used)
            return out
        gone = now.select("siren", "code", "id").unionByName(now.select("siren", "code", F.col("later").alias("id")))
        rest = land(left.join(gone, ["siren", "code", "id"], "left_anti"), "events")
        release(left)
        left = rest
