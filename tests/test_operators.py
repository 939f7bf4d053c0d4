from __future__ import annotations

import datetime
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from folioscope.operators import accounts, coverage, entities, ledger, text, workflow
from folioscope.sources import filings, sinks


def test_grep_is_literal_and_keeps_places(spark):
    docs = spark.createDataFrame([(1, "abc\n A.C here \n"), (2, None), (3, "")], "id int, text string")
    rows = text.lines(docs, "id")
    assert [(r.id, r.pos, r.text) for r in text.grep(rows, "a.c").collect()] == [(1, 1, "A.C here")]
    assert text.grep(rows, "").count() == 0
    assert {r.id for r in rows.collect()} == {1, 2, 3}


def test_timeline(spark):
    rows = [(1, "s", 1, None, 300000), (2, "s", 2, 120500, None), (3, "s", 3, -90250, None), (4, "s", 4, 169750, None), (5, "s", 5, None, 7), (6, "s", 6, -9, None)]
    events = spark.createDataFrame(rows, "id int, siren string, at int, delta int, absolute int")
    got = ledger.timeline(events, "siren", ["at", "id"], "delta", "absolute")
    assert [r.balance for r in got.orderBy("id").collect()] == [300000, 420500, 330250, 500000, 7, -2]
    assert [r.id for r in ledger.findings(got, "siren").collect()] == [6]


def test_movements_count_once(spark):
    day = datetime.date(2020, 1, 1)
    moves = spark.createDataFrame([(1, day, "a", "b", 10), (2, day, "a", "b", 10), (3, day, None, "a", 10)], "id int, date date, giver string, taker string, shares int")
    rows = ledger.entries(moves)
    assert sorted((r.id, r.holder, r.shares) for r in rows.collect()) == [(1, "a", -10), (1, "b", 10), (3, "a", 10)]
    got = ledger.holdings(rows.withColumn("back", -F.col("id")), "holder", ["back"], "shares").where("holder = 'a'").orderBy("back").collect()
    assert [(r.balance, r.change) for r in got] == [(10, "entry"), (0, "end")]


def test_share_range_and_dates(spark):
    row = spark.createDataFrame([("100 parts numérotées 1 à 100", datetime.date(2020, 1, 1))], "t string, dateDepot date")
    got = row.select(ledger.share_range(F.col("t")).alias("x")).first().x
    assert (got.shares, got.first, got.last, got.consistent) == (100, 1, 100, True)
    said = spark.createDataFrame([("assemblée du 3 mars 2019", datetime.date(2020, 1, 1)), ("rien", datetime.date(2020, 1, 1)), ("le 05/05/2021", datetime.date(2020, 1, 1))], "t string, dateDepot date")
    got = [(str(r.event_date), r.date_basis) for r in ledger.dated(said, F.col("t")).collect()]
    assert got == [("2019-03-03", "text"), ("2020-01-01", "deposit"), ("2020-01-01", "deposit")]


def test_classification(spark):
    rows = spark.createDataFrame([("augmentation du capital social",), ("augmentation de capital",), ("reduction du capital social",), ("donation/partage de parts",), ("autre",)], "t string")
    got = [r.code for r in ledger.classified(rows, F.col("t")).collect()]
    assert got == ["CAPITAL_INCREASE", "CAPITAL_INCREASE", "CAPITAL_DECREASE", "SHAREHOLDER_SHARE_TRANSFER", None]


def test_closure_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "owner string, owned string")
    got = {(r.owner, r.owned): r.hops for r in entities.closure(edges).collect()}
    assert got == {("a", "b"): 1, ("b", "a"): 1, ("b", "c"): 1, ("a", "a"): 2, ("a", "c"): 2, ("b", "b"): 2}


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_resolution_equals_brute_force(spark, distance):
    rng = random.Random(distance)
    known = ["".join(rng.choice("AB") for _ in range(rng.randint(1, 7))) for _ in range(40)]
    said = ["".join(rng.choice("AB") for _ in range(rng.randint(1, 7))) for _ in range(40)]

    def lev(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            d, last = [i], d
            for j, y in enumerate(b, 1):
                d.append(min(d[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
        return d[-1]

    companies = spark.createDataFrame(list(enumerate(known)), "company_id int, name string")
    mentions = spark.createDataFrame([*enumerate(said), (99, None)], "mention_id int, name string")
    got = {r.mention_id: r.company_id for r in entities.resolved(mentions, companies, distance).collect()}
    for i, s in enumerate(said):
        near = [(lev(s, k), j) for j, k in enumerate(known) if lev(s, k) <= distance]
        best = [j for d, j in near if d == min(near)[0]]
        assert got[i] == (best[0] if len(best) == 1 else None), s
    assert got[99] is None


def test_stage_machine_equals_fold(spark):
    rng = random.Random(4)
    rows = [(i, rng.randint(1, 6), rng.choice([*workflow.STAGES, "?", None])) for i in range(300)]
    got = {r.id: (r.accepted, r.state) for r in workflow.transitions(spark.createDataFrame(rows, "id int, deal int, stage string"), "deal", ["id"], "stage").collect()}
    state = dict.fromkeys(range(1, 7), 0)
    for i, deal, stage in rows:
        ok = stage in workflow.STAGES and workflow.STAGES.index(stage) == state[deal] + 1
        state[deal] += ok
        assert got[i] == (ok, workflow.STAGES[state[deal]])


def test_registry_is_idempotent(spark):
    uploads = spark.createDataFrame([(1, "x", "a.pdf"), (2, "x", "b.pdf"), (3, "y", "c.pdf")], "id int, data string, name string")
    got = workflow.receipts(uploads, F.sha2("data", 256), ["id"], "id").orderBy("id").collect()
    assert [(r.created, r.document_id) for r in got] == [(True, 1), (False, 1), (True, 3)]


def test_codes_are_used_once(spark):
    at = lambda s: datetime.datetime(2024, 1, 1, 0, 0, s)
    issued = spark.createDataFrame([("u", at(0), 1), ("u", at(30), 2)], "user string, at timestamp, issue_id int")
    tries = spark.createDataFrame([("u", at(1), 1), ("u", at(2), 2), ("u", at(31), 3), ("u", at(59), 4), ("v", at(1), 5)], "user string, at timestamp, attempt_id int")
    got = {r.attempt_id: r.ok for r in workflow.code_checks(issued, tries, "user", 20).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 5: False}


def test_derived_needs_required_components(spark):
    registry = spark.createDataFrame([("p", 1, True), ("s", -1, False)], "component string, coefficient int, required boolean")
    rows = spark.createDataFrame([(1, "p", 10), (1, "s", 3), (2, "s", 3)], "doc int, component string, value int")
    assert {r.doc: r.value for r in accounts.derived(rows, registry, ["doc"]).collect()} == {1: 7, 2: None}
    both = spark.createDataFrame([("p", 1, True), ("q", 1, True)], "component string, coefficient int, required boolean")
    rows = spark.createDataFrame([(1, "p", 10), (1, "p", 10), (2, "p", 1), (2, "q", 2), (2, "q", 3), (3, "p", 1), (3, "q", None)], "doc int, component string, value int")
    assert {r.doc: r.value for r in accounts.derived(rows, both, ["doc"]).collect()} == {1: None, 2: 6, 3: None}


def test_decisions_keep_the_first_spelling(spark):
    item = lambda d: {"typeActe": "x", "decision": d}
    rows = spark.createDataFrame([("a", "s", None, [item("Réduction "), item("REDUCTION"), item("reduction"), item(None)])], "id string, siren string, dateDepot date, typeRdd array<struct<typeActe: string, decision: string>>")
    for n in (1, 3):
        assert [r.decision for r in ledger.decisions(rows.repartition(n)).collect()] == ["REDUCTION"]


def test_state_at_many_dates(spark):
    day = lambda k: datetime.date(2020, 1, 1) + datetime.timedelta(k)
    states = spark.createDataFrame([("a", day(2), 1, 10), ("a", day(5), 3, 30), ("a", day(5), 2, 20), ("b", day(9), 4, 40)], "k string, at date, id int, v int")
    dates = spark.createDataFrame([(day(k),) for k in range(11)] + [(day(3),), (None,)], "d date")
    got = {(r.k, r.d): r.v for r in ledger.state_as_of(states, dates, "k", "at", "d", ["id"], "v").collect()}
    assert got == {("a", day(k)): 10 if k < 5 else 30 for k in range(2, 11)} | {("b", day(k)): 40 for k in (9, 10)}


def test_broken_pages_fail_the_read(spark, tmp_path):
    (tmp_path / "page_001.json").write_text('{"page": 1, "ocr": [')
    with pytest.raises(Exception, match="(?i)malformed"):
        filings.one_page(spark, str(tmp_path), 1).collect()


def test_catalogue_source_and_sizes(spark, tmp_path):
    (tmp_path / "companies.json").write_text('{"company_id": 1, "name": "EXEMPLE", "siren": "732829320", "sector": "x"}\n')
    (tmp_path / "sizes.csv").write_text("doc_id,page,w_pt,h_pt\nd,1,595.0,842.0\n")
    rows = filings.catalogue(spark, str(tmp_path / "companies.json"))
    rows.write.parquet(str(tmp_path / "companies.parquet"))
    assert rows.collect() == filings.catalogue(spark, str(tmp_path / "companies.parquet")).collect() == [(1, "EXEMPLE", "732829320", "x")]
    assert tuple(filings.page_sizes(spark, str(tmp_path / "sizes.csv")).first()) == ("d", 1, 595.0, 842.0)


def test_results_are_refused_beyond_a_bound(spark):
    with pytest.raises(ValueError):
        sinks.results_json({"x": spark.range(5)}, most=4)


def test_values_right_of_labels(spark):
    labels = spark.createDataFrame([("d", 1, 0, [0.0, 0.0, 1.0, 1.0])], "doc_id string, page int, pos int, box array<double>")
    values = spark.createDataFrame([("d", 1, 7, [5.0, 0.2, 6.0, 0.8]), ("d", 1, 8, [2.0, 0.2, 3.0, 0.8]), ("d", 1, 9, [2.0, 5.0, 3.0, 6.0])], "doc_id string, page int, pos int, box array<double>")
    assert accounts.label_values(labels, values).first().value_pos == 8
    assert accounts.label_values(labels, values, 1).first().value_pos == 7


@pytest.fixture
def corpus(tmp_path):
    """A made-up company with two filings and two pages."""
    meta, ocr = tmp_path / "012345678/actes/meta", tmp_path / f"012345678/actes/ocr/{'a' * 24}"
    meta.mkdir(parents=True), ocr.mkdir(parents=True)
    filing = {"id": "a" * 24, "siren": "012345678", "denomination": "EXEMPLE", "dateDepot": "2020-01-02", "updatedAt": "2020-01-02T10:00:00+01:00", "deleted": False, "typeRdd": [{"typeActe": "PV", "decision": " Augmentation du capital social "}, {"typeActe": "Statuts", "decision": "Augmentation du capital social"}]}
    (meta / f"acte_2020-01-02_{'a' * 24}.json").write_text(json.dumps(filing, indent=1))
    (meta / f"acte_2020-01-03_{'b' * 24}.json").write_text(json.dumps(filing | {"id": "b" * 24, "deleted": True}))
    line = {"text": "Capital Social", "score": 0.9, "orientation_angle": 0, "polygon": [[10, 20], [110, 18], [112, 60], [9, 62]]}
    (ocr / "page_002.json").write_text(json.dumps({"page": 2, "pdf": "x.pdf", "skew_angle": -1.0, "ocr": [line], "layout": [{"label": "table", "bbox": [0, 0, 1, 1], "score": 1.0, "texts": [line], "cells": [{"bbox": [0, 0, 1, 1], "score": 1.0, "texts": [line]}]}]}))
    (ocr / "page_005.json").write_text(json.dumps({"page": 5, "pdf": "x.pdf", "skew_angle": 0.0, "ocr": [], "layout": []}))
    return str(tmp_path)


def test_corpus_readers(spark, corpus, tmp_path):
    kept = filings.filings(spark, corpus).collect()
    assert [(r.siren, r.kind, str(r.dateDepot)) for r in kept] == [("012345678", "acte", "2020-01-02")]
    assert ledger.decisions(filings.filings(spark, corpus)).count() == 1
    pages = filings.ocr_pages(spark, corpus)
    lines = {r.page: r for r in filings.ocr_lines(pages).collect()}
    assert (lines[2].px_x0, lines[2].px_y0, lines[2].px_x1, lines[2].px_y1, lines[2].siren) == (9, 18, 112, 62, "012345678")
    assert lines[5].text is None
    assert filings.cell_texts(pages, "doc_id", "page").first().text == "Capital Social"
    got = coverage.profile(pages, "siren").first()
    assert (got.n_pages, got.skew, got.tables, got.lines) == (2, 0.5, 0.5, 0.5)
    assert coverage.page_range(pages).first().last == 5
    sizes = spark.createDataFrame([("a" * 24, p, 720.0, 720.0) for p in range(1, 6)], "doc_id string, page int, w_pt double, h_pt double")
    assert coverage.page_count_gaps(pages, sizes).first().n_pdf == 5
    assert [r.has_ocr for r in coverage.page_info(pages, sizes).orderBy("page").collect()] == [False, True, False, False, True]
    asked = spark.createDataFrame([("a" * 24, 5), ("a" * 24, 6), ("a" * 24, 0)], "doc_id string, page int")
    assert [r.in_range for r in coverage.requested_pages(asked, sizes).orderBy("page").collect()] == [False, True, False]
    folder = f"{corpus}/012345678/actes/ocr/{'a' * 24}"
    assert filings.one_page(spark, folder, 2).count() == 1 and filings.one_page(spark, folder, 3).count() == 0
    assert filings.one_page(spark, f"{folder}/page_005.json", 1).first().page == 5
    assert filings.one_page(spark, f"{corpus}/nowhere", 1).count() == 0
    filings.land(filings.ocr_lines(pages), str(tmp_path / "lines"))
    assert spark.read.parquet(str(tmp_path / "lines")).where("siren = '012345678'").count() == 2


def test_sinks(spark):
    rows = spark.createDataFrame([(2, None), (1, "x")], "id int, note string")
    got = json.loads(sinks.results_json({"events": rows, "values": rows.where("id = 1")}).first().json)
    assert got == {"events": [{"id": 1, "note": "x"}, {"id": 2, "note": None}], "values": [{"id": 1, "note": "x"}]}
    line = spark.range(1).select(sinks.report_line(F.array(*[F.lit(x) for x in (0.1, 0.25, 0.33333, 1.0)]), F.lit("text")).alias("x"))
    assert line.first().x == "[0.1000, 0.2500, 0.3333, 1.0000]  text"
    boxes = spark.createDataFrame([("d", 1, 0, [0.0, 0.0, 1.0, 1.0])], "doc_id string, page int, pos int, box array<double>")
    assert sinks.draw_list(boxes, "red", 3).first().label == 1


def test_costs_and_totals(spark):
    metrics = spark.createDataFrame([("a", 2, 1.0, 4.0), ("a", 2, 3.0, 4.0), ("b", 0, 1.0, 1.0)], "k string, pages int, cost_eur double, seconds double")
    got = {r.k: (r.cost_per_page, r.seconds_per_page) for r in accounts.run_costs(metrics, "k").collect()}
    assert got == {"a": (1.0, 2.0), "b": (None, None)}
    held = spark.createDataFrame([("x", 10), ("x", 5), ("y", 1)], "siren string, shares int")
    stated = spark.createDataFrame([("x", Decimal(15)), ("y", Decimal(2))], "siren string, stated decimal(18,0)")
    assert [r.siren for r in ledger.totals_differ(held, stated, "siren").collect()] == ["y"]


def test_observations_and_sources(spark):
    lines = spark.createDataFrame([("d", "SARL au capital de 517.203 €"), ("d", "rien"), ("e", "capital porté à 700/o0o euros"), ("f", "capital porté de 1 000 à 2 000 euros")], "doc_id string, text string")
    assert [(r.doc_id, r.capital) for r in ledger.capital_observations(lines, "doc_id").collect()] == [("d", Decimal(517203)), ("e", Decimal(700000)), ("f", Decimal(2000))]
    events = spark.createDataFrame([("d", 1, [0.0, 0.0, 1.0, 1.0], "x"), (None, None, None, None)], "doc string, page int, box array<double>, said string")
    got = ledger.grounded(events, "doc", "page", "box", "said").collect()
    assert got[0].source.inpi_id == "d" and got[0].note is None and got[1].source is None and got[1].note


def test_closure_does_not_end_silently(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(4)], "owner long, owned long")
    assert entities.closure(edges, depth=4).count() == entities.closure(edges).count() == 10
    with pytest.raises(ValueError):
        entities.closure(edges, depth=3)


def test_ocr_lines_takes_all_points(spark):
    points = [[5.0, 5.0], [6.0, 5.0], [6.0, 6.0], [5.0, 6.0], [1.0, 9.0]]
    pages = spark.createDataFrame([(1, [(k, 1.0, 0, v, None) for k, v in {"a": points, "b": points[:4], "c": points[3:], "d": []}.items()])], f"page int, ocr array<{filings.LINE}>")
    got = {r.text: (r.px_x0, r.px_y0, r.px_x1, r.px_y1) for r in filings.ocr_lines(pages, "page").collect()}
    assert got == {"a": (1, 5, 6, 9), "b": (5, 5, 6, 6), "c": (1, 6, 5, 9), "d": (None,) * 4}


def test_rates_equal_a_count(spark):
    rng = random.Random(8)
    start = datetime.datetime(2024, 1, 1)
    rows = [(rng.choice("uv"), start + datetime.timedelta(seconds=rng.randint(0, 120)) if rng.random() < 0.95 else None, i) for i in range(200)]
    got = workflow.over_rate(spark.createDataFrame(rows, "user string, at timestamp, id int"), "user", "at", 10, 4).collect()
    assert len(got) == 200
    for r in got:
        n = sum(u == r.user and (a is None) == (r.at is None) and (a is None or 0 <= (r.at - a).total_seconds() <= 10) for u, a, _ in rows)
        assert (r.recent, r.limited) == (n, n > 4)


def test_stages_of_odd_requests(spark):
    rows = [(1, None, "NDA"), (2, None, "Due diligence"), (3, "d", "Offer"), (4, "d", None), (5, "d", "NDA"), (6, "d", "NDA")]
    df = spark.createDataFrame(rows, "id int, deal string, stage string")
    got = {r.id: (r.accepted, r.state) for r in workflow.transitions(df, "deal", ["id"], "stage").collect()}
    assert got == {1: (True, "NDA"), 2: (True, "Due diligence"), 3: (False, "Sourcing"), 4: (False, "Sourcing"), 5: (True, "NDA"), 6: (False, "NDA")}
    assert workflow.transitions(df.where("false"), "deal", ["id"], "stage").count() == 0
