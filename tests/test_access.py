from __future__ import annotations

import datetime
import random
from collections import defaultdict

import pytest

from folioscope.streaming import access, ordered

START = datetime.datetime(2024, 1, 1)
SCHEMA = "user string, at timestamp, event_id long, kind string"
RULES = access.Rules(code=40, session=60, window=30, limit=2)


@pytest.fixture
def rocksdb(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    ordered.use_rocksdb(spark)
    yield spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def run(spark, tmp_path, batches, name, rules=RULES, delay="30 seconds"):
    """Results, and rows dropped behind the watermark."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/{k:03d}"))
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    q = access.decisions(source, "user", rules, delay).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "check")).outputMode("append").start()
    q.processAllAvailable()
    dropped = sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])
    kept = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    q.stop()
    return {(r.user, int((r.at - START).total_seconds()), r.event_id, r.kind, r.result) for r in spark.table(name).collect()}, dropped, kept


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


def replay(rows, rules, until):
    """Judged one by one from whole logs, every rule looked up in all that went before."""
    out = set()
    by = defaultdict(list)
    for user, t, i, kind in sorted((u, int((a - START).total_seconds()), i, k) for u, a, i, k in rows):
        by[user].append((t, i, kind))
    for user, log in by.items():
        opened, used, results = None, set(), []
        for n, (t, i, kind) in enumerate(log):
            if opened and opened[0] < t:
                results.append((opened[0], opened[1], "session", "ended"))
                opened = None
            codes = [x for x in log[:n] if x[2] == "issue"]
            if kind == "issue":
                result = "issued"
            elif kind == "try":
                recent = [x for x in log[:n] if x[2] == "try" and t - x[0] <= rules.window]
                if len(recent) >= rules.limit:
                    result = "limited"
                elif not codes or t - codes[-1][0] > rules.code:
                    result = "no code"
                elif codes[-1] in used:
                    result = "used"
                else:
                    result, opened = "ok", (t + rules.session, i)
                    used.add(codes[-1])
            elif kind in ("request", "logout"):
                result = "ok" if opened else "no session"
                opened = None if kind == "logout" else opened
            else:
                result = "unknown"
            results.append((t, i, kind, result))
        if opened and opened[0] < until:
            results.append((opened[0], opened[1], "session", "ended"))
        out |= {(user, *r) for r in results}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_results_do_not_depend_on_batches(rocksdb, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("uvw"), at(rng.randint(0, 600)), i, rng.choice(["issue", "try", "try", "request", "logout", "x"])) for i in range(250)]
    # rows come up to 25 seconds out of order, within the delay of 30
    rows.sort(key=lambda r: (r[1] + datetime.timedelta(seconds=rng.randint(0, 25)), r[2]))
    batches = [rows[k : k + 60] for k in range(0, 250, 60)]
    end = [("end", at(5000), 1000, "x")]
    got, dropped, kept = run(rocksdb, tmp_path, [*batches, end, [("end", at(9000), 1001, "x")]], f"access{seed}")
    assert dropped == 0
    assert {r for r in got if r[0] != "end"} == replay(rows, RULES, 9000)
    results = {r[4] for r in got}
    assert results >= {"issued", "ok", "limited", "no code", "used", "no session", "unknown", "ended"}
    # users that are silent keep no state; what is left are the last event and its timer
    assert kept <= 4


def test_rows_behind_the_watermark_are_dropped_and_counted(rocksdb, tmp_path):
    batches = [[("u", at(0), 1, "issue")], [("v", at(100), 2, "x")], [("v", at(101), 3, "x")], [("u", at(5), 4, "try"), ("u", None, 5, "try"), (None, at(200), 6, "try")], [("v", at(900), 7, "x")], [("v", at(999), 8, "x")]]
    got, dropped, _ = run(rocksdb, tmp_path, batches, "late")
    assert dropped == 1
    assert {r for r in got if r[0] == "u"} == {("u", 0, 1, "issue", "issued")}


def test_equal_times_and_repeated_rows(rocksdb, tmp_path):
    rows = [("u", at(1), 2, "try"), ("u", at(1), 1, "issue"), ("u", at(1), 3, "try"), ("u", at(1), 3, "try"), ("u", at(2), 4, None)]
    got, _, _ = run(rocksdb, tmp_path, [rows, [("v", at(500), 9, "x")], [("v", at(900), 10, "x")]], "equal")
    assert {r for r in got if r[0] == "u"} == {
        ("u", 1, 1, "issue", "issued"),
        ("u", 1, 2, "try", "ok"),
        ("u", 1, 3, "try", "used"),
        ("u", 1, 3, "try", "limited"),
        ("u", 2, 4, None, "unknown"),
        ("u", 61, 2, "session", "ended"),
    }
