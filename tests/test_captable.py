from __future__ import annotations

import datetime
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from folioscope.operators import captable, scan

DAY = datetime.date(2020, 1, 1)


@pytest.mark.parametrize("parts", [1, 2, 13])
def test_scans_equal_a_fold(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), rng.randint(0, 40) if rng.random() < 0.97 else None, i, rng.choice([None, 1, -2, 5]), rng.choice([None, None, None, 100, 0])) for i in range(400)]
    df = scan.ranged(spark.createDataFrame(rows, "k string, at int, id int, delta long, abs long"), ["k"], ["at", "id"], parts)
    assert df.select(scan.PART).distinct().count() <= parts
    out = scan.running(df, ["k"], ["at", "id"], {"n": F.lit(1), "sum": F.col("delta")})
    out = scan.last(out, ["k"], ["at", "id"], {"seen": F.col("abs")})
    out = scan.last(out, ["k"], ["at", "id"], {"was": F.col("abs")}, before=True)
    out = scan.since_reset(out, ["k"], ["at", "id"], {"state": (F.col("delta"), F.col("abs"))})
    got = {r.id: (r.n, r["sum"], r.seen, r.was, r.state) for r in out.collect()}
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        by[r[0]].append(r)
    for some in by.values():
        total = state = 0
        seen = None
        for n, (_, _, i, delta, absolute) in enumerate(some, 1):
            was = seen
            total, state = total + (delta or 0), absolute if absolute is not None else state + (delta or 0)
            seen = absolute if absolute is not None else seen
            assert got[i] == (n, total, seen, was, state)
    assert len(got) == 400


def fold(events, movements):
    """States and holders by replaying every event of a company over all its holders."""
    out = {}
    for siren in {e[0] for e in events}:
        capital = shares = 0
        known, held = False, defaultdict(int)
        for n, (_, i, _, dc, ac, ds, as_) in enumerate(sorted((e for e in events if e[0] == siren), key=lambda e: (e[2], e[1])), 1):
            capital = ac if ac is not None else capital + (dc or 0)
            shares = as_ if as_ is not None else shares + (ds or 0)
            known |= ds is not None or as_ is not None
            for s, j, holder, k in movements:
                if (s, j) == (siren, i) and holder is not None:
                    held[holder] += k
            now = {h: k for h, k in held.items() if k}
            out[siren, i] = (n, capital, shares, sum(now.values()), len(now), sum(now.values()) == shares if known else None, now)
    return out


def random_company(rng, n):
    events, movements = [], []
    for i in range(n):
        siren = rng.choice(["hot", "hot", "hot", "cold"])
        pick = lambda p, *v: rng.choice(v) if rng.random() < p else None
        events.append((siren, i, DAY + datetime.timedelta(rng.randint(0, n // 3)), pick(0.4, 100, -50), pick(0.1, 1000, 0), pick(0.4, 10, -5), pick(0.1, 40, 0)))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            movements.append((siren, i, rng.choice(["a", "b", "c", None]), rng.choice([5, -5, 10, 0])))
    return events, movements


E = "siren string, event_id int, event_date date, capital_delta long, capital_set long, shares_delta long, shares_set long"
M = "siren string, event_id int, holder string, shares long"


def tables(spark, events, movements):
    states, intervals = captable.states(spark.createDataFrame(events, E), spark.createDataFrame(movements, M))
    return states, intervals, {(r.siren, r.event_id): (r.seq, r.capital, r.shares, r.held, r.n_holders, r.agrees, r.holders) for r in captable.holders(states, intervals).collect()}


def test_cap_table_equals_a_replay(spark):
    events, movements = random_company(random.Random(1), 250)
    states, intervals, got = tables(spark, events, movements)
    assert got == fold(events, movements)
    wrong = {(r.siren, r.event_id) for r in captable.disagreements(states).collect()}
    assert wrong == {k for k, v in got.items() if v[5] is False}
    for r in intervals.collect():
        assert r.shares and (r.until is None or r.since < r.until)


def test_events_that_move_nothing_share_a_table(spark):
    events = [("s", i, DAY + datetime.timedelta(i), 1, None, None, None) for i in range(300)]
    movements = [("s", 0, "a", 5), ("s", 0, "b", 5), ("s", 200, "a", -5)]
    states, intervals, got = tables(spark, events, movements)
    assert intervals.count() == 2 and {r.version for r in states.select("version").distinct().collect()} == {1, 2}
    assert got["s", 199][-1] == {"a": 5, "b": 5} and got["s", 299][-1] == {"b": 5}


def test_odd_cap_tables(spark):
    events = [("s", 1, DAY, None, None, None, None), ("s", 2, DAY, None, 100, None, 10), (None, 3, DAY, 1, None, None, None)]
    movements = [("s", 1, "a", 5), ("s", 1, "a", -5), ("s", 2, None, 5), ("s", 9, "a", 5), ("t", 1, "a", 5), ("s", 2, "b", -1)]
    _, intervals, got = tables(spark, events, movements)
    assert got == {("s", 1): (1, 0, 0, 0, 0, None, {}), ("s", 2): (2, 100, 10, -1, 1, False, {"b": -1}), (None, 3): (1, 1, 0, 0, 0, None, {})}
    assert [(r.holder, r.since, r.until) for r in intervals.collect()] == [("b", 1, None)]
    assert tables(spark, [], [])[2] == {}


def test_as_of_equals_brute_force(spark):
    rng = random.Random(3)
    log = [(rng.choice("ab"), rng.choice([None, *range(30)]), i, rng.choice([None, 1, 2, 3])) for i in range(200)]
    seen = [(rng.choice("abc"), rng.choice([None, *range(30)]), f"o{i}") for i in range(200)]
    got = captable.as_of(spark.createDataFrame(seen, "k string, t int, o string"), spark.createDataFrame(log, "k string, t int, n int, v int"), ["k"], "t", ["n"], ["v", "n"])
    for r in got.collect():
        before = [(t, n, v) for k, t, n, v in log if k == r.k and t is not None and r.t is not None and t <= r.t]
        want = max(before, key=lambda x: x[:2]) if before else (None, None, None)
        assert (r.n, r.v) == want[1:], r
    assert got.count() == 200


def greedy(events, observations, days):
    """All pairs, the closest first; of equal gaps and dates the pair nearest the change."""
    capital = {}
    for siren, d, c in observations:
        if c is not None and d is not None:
            capital[siren, d] = max(c, capital.get((siren, d), c))
    changes = defaultdict(list)
    for siren in {k for k, _ in capital}:
        log = sorted((d, c) for (s, d), c in capital.items() if s == siren)
        changes[siren] = [d for (_, a), (d, b) in zip(log, log[1:]) if a != b]
    level = lambda e: sum(d <= e[3] for d in changes[e[0]])
    rows = [e for e in events if e[3]]
    pairs = [((b[3] - a[3]).days, a[3], -a[2], b[2], a, b) for a in rows for b in rows if a[:2] == b[:2] and level(b) == level(a) + 1 and (b[3] - a[3]).days <= days]
    used, out = set(), set()
    for gap, _, _, _, a, b in sorted(pairs, key=lambda p: p[:4]):
        if a not in used and b not in used:
            used |= {a, b}
            out.add((a[0], a[1], a[2], b[2], gap))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_realisations_equal_greedy_matching(spark, seed):
    rng = random.Random(seed)
    day = lambda: DAY + datetime.timedelta(rng.randint(0, 60))
    events = [(rng.choice(["hot", "hot", "cold"]), rng.choice("xy"), i, day() if rng.random() < 0.97 else None) for i in range(150)]
    observations = [(rng.choice(["hot", "cold", "none"]), day(), rng.choice([1, 2, 3, None])) for _ in range(40)]
    got = captable.realisations(spark.createDataFrame(events, "siren string, code string, id int, event_date date"), spark.createDataFrame(observations, "siren string, event_date date, capital long"), 12)
    wanted = greedy(events, observations, 12)
    assert {tuple(r[c] for c in ("siren", "code", "id", "later", "gap")) for r in got.collect()} == wanted and len(wanted) > 15
