from __future__ import annotations

import math
import random
from pathlib import Path

import pytest
from oracle import SF
from pyspark.sql import functions as F

from folioscope.operators import accounts, boxes
from folioscope.plans import statements

LINE = "doc_id string, page int, pos int, text string, box array<double>"


def statement(*rows, doc="d", heads=(), unit="Montants en euros"):
    """Lines of one page: rows of (text, x0, x1) cells, and heads of (text, x0, x1)."""
    out = [(doc, 1, 900, "N° 2050-SD 2020", [0.0, 5000.0, 90.0, 5030.0]), (doc, 1, 901, unit, [0.0, 5100.0, 90.0, 5130.0])]
    for i, cells in enumerate([heads, *rows]):
        out += [(doc, 1, 10 * i + k, t, [float(a), 100.0 * i, float(b), 100.0 * i + 30]) for k, (t, a, b) in enumerate(cells)]
    return out


def values(spark, lines, registry=(("assets", "2050", "CO"), ("equity", "2050", "DL"))):
    found = accounts.field_values(spark.createDataFrame(lines, LINE), spark.createDataFrame(list(registry), "field string, form string, code string"))
    return {(r.doc_id, r.field): (r.value and float(r.value), r.previous and float(r.previous)) for r in found.collect()}


def label(code):
    return f"{code} Total général", 100, 600


def test_a_blank_year_stays_blank(spark):
    rows = [[label("CO"), ("5 000", 1500, 1600)], [label("DL"), ("1 200", 1000, 1100), ("900", 1550, 1600)]]
    assert values(spark, statement(*rows)) == {("d", "assets"): (None, 5000), ("d", "equity"): (1200, 900)}


def test_label_and_amounts_in_one_line(spark):
    rows = [[("CO TOTAL 1 234 567", 100, 1100)], [label("DL"), ("1 200", 1000, 1100), ("900", 1550, 1600)]]
    assert values(spark, statement(*rows)) == {("d", "assets"): (1234567, None), ("d", "equity"): (1200, 900)}
    rows = [[("CO TOTAL 1 234 567 (2 000)", 100, 1600)], [label("DL"), ("1 200", 1150, 1240), ("900", 1550, 1600)]]
    assert values(spark, statement(*rows)) == {("d", "assets"): (1234567, -2000), ("d", "equity"): (1200, 900)}
    assert values(spark, statement([("CO TOTAL 1 234 567", 100, 1100)])) == {("d", "assets"): (1234567, None)}


def test_heads_name_the_columns(spark):
    rows = [[label("CO"), ("10", 1080, 1100), ("20", 1280, 1300), ("30", 1580, 1600), ("40", 1880, 1900)], [label("DL"), ("5", 1890, 1900)]]
    heads = [("Brut", 1050, 1110), ("Net", 1560, 1610), ("Exercice N", 1520, 1620), ("N-1", 1860, 1920)]
    assert values(spark, statement(*rows, heads=heads)) == {("d", "assets"): (30, 40), ("d", "equity"): (None, 5)}
    assert values(spark, statement(*rows, heads=[("N", 1080, 1100)])) == {("d", "assets"): (10, None), ("d", "equity"): (None, None)}
    # a head over no column names none
    assert values(spark, statement(*rows, heads=[("N-1", 5000, 5100)])) == {("d", "assets"): (10, 20), ("d", "equity"): (None, None)}


def test_units_and_odd_lines(spark):
    lines = statement([label("CO"), ("(1 200)", 1000, 1100)], unit="en milliers d'euros") + statement(doc="e") + [("f", 1, 1, None, None), ("f", 1, 2, "CO 5", None)]
    assert values(spark, lines) == {("d", "assets"): (-1200000, None)}
    assert values(spark, statement([label("CO")])) == {("d", "assets"): (None, None)}
    assert values(spark, []) == {}


def polygon(x, y, w, degrees, h=20.0):
    r = math.radians(degrees)
    return [[a * math.cos(r) - b * math.sin(r), a * math.sin(r) + b * math.cos(r)] for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))]


P = "doc_id string, page int, pos int, polygon array<array<double>>"


def test_skew_is_the_weighted_median(spark):
    rng = random.Random(7)
    rows, wanted = [], {}
    for page in range(30):
        tilt = rng.uniform(-3, 3)
        lines = [(tilt + rng.uniform(-0.2, 0.2) if rng.random() < 0.8 else rng.choice([90, -90, 45]), rng.randint(20, 900)) for _ in range(rng.randint(1, 40))]
        rows += [("d", page, i, polygon(10.0 * i, 30.0 * i, w, a)) for i, (a, w) in enumerate(lines)]
        half, cum = sum(w for _, w in lines) / 2, 0
        for a, w in sorted(lines):
            cum += w
            if cum >= half:
                wanted[page] = a
                break
    rows += [("d", 99, 0, None), ("d", 98, 0, [[1.0, 1.0]]), ("d", 97, 0, [[1.0, 1.0], [1.0, 1.0]])]
    fits = boxes.page_skew(spark.createDataFrame(rows, P))
    assert {r.page: round(r.fitted, 6) for r in fits.collect()} == {k: round(v, 6) for k, v in wanted.items()}


def test_skew_findings_and_sign(spark):
    fits = spark.createDataFrame([("a", 1, 0.7), ("a", 2, 0.71), ("a", 3, 0.1), ("a", 4, 5.0), ("a", 5, 1.0), ("b", 1, 3.0)], "doc_id string, page int, fitted double")
    given = spark.createDataFrame([("a", 1, -0.7), ("a", 2, -0.7), ("a", 3, -0.1), ("a", 4, 1.0), ("a", 5, None)], "doc_id string, page int, skew_angle double")
    found = boxes.skew_findings(fits, given)
    assert [r.finding for r in found.orderBy("doc_id", "page").collect()] == ["opposite", "opposite", "agrees", "differs", "not given", "not given"]
    assert {r.doc_id: r["sign"] for r in boxes.skew_sign(found, "doc_id").collect()} == {"a": -1, "b": None}


def test_rows_of_a_turned_page(spark):
    rows = [("d", 1, 10 * r + c, polygon(900.0 * c, 60.0 * r, 200.0, 2.0)) for r in range(5) for c in range(3)] + [("e", 1, 0, polygon(0, 0, 10, 0)), ("e", 1, 1, None)]
    lines = spark.createDataFrame(rows, P)
    got = {(r.doc_id, r.pos): r.row for r in boxes.level_rows(lines, boxes.page_skew(lines)).collect()}
    assert got == {("d", 10 * r + c): r for r in range(5) for c in range(3)} | {("e", 0): 0}


BOX = "id int, doc_id string, page int, field string, box array<double>, text string"


def some_boxes(rng, n):
    out = []
    for i in range(n):
        x, y, w, h = rng.uniform(-0.1, 1), rng.uniform(-0.1, 1), rng.choice([0.01, 0.1, 0.6]), rng.choice([0.01, 0.05, 0.5])
        out.append((i, rng.choice("ab"), rng.randint(1, 2), rng.choice("xy"), [x, y, x + w, y + h], rng.choice(["t", "u "])))
    return [*out, (n, "a", 1, "x", None, "t"), (n + 1, "a", 1, "x", [0.5, 0.5, 0.4, 0.4], "t"), (n + 2, "a", 1, "x", [0.5, 0.5, 0.5, 0.5], "t")]


def iou(p, q):
    w, h = (max(0.0, min(p[k + 2], q[k + 2]) - max(p[k], q[k])) for k in (0, 1))
    union = sum((r[2] - r[0]) * (r[3] - r[1]) for r in (p, q)) - w * h
    return w * h / union if union > 0 else 0.0


@pytest.mark.parametrize("cells", [1, 4, 16])
def test_overlapping_equals_all_pairs(spark, cells):
    rng = random.Random(cells)
    a, b = some_boxes(rng, 60), some_boxes(rng, 60)
    found = boxes.overlapping(spark.createDataFrame(a, BOX), spark.createDataFrame(b, BOX), cells)
    got = {(r.a, r.b): round(r.overlap, 9) for r in found.collect()}
    ok = lambda x: x[4] and x[4][0] <= x[4][2] and x[4][1] <= x[4][3]
    wanted = {(p[0], q[0]): round(iou(p[4], q[4]), 9) for p in a for q in b if ok(p) and ok(q) and p[1:3] == q[1:3] and iou(p[4], q[4]) > 0}
    assert got == wanted and found.count() == len(wanted)


def test_accuracy_equals_greedy_matching(spark):
    rng = random.Random(5)
    a, b = some_boxes(rng, 60), some_boxes(rng, 60)
    found, per_field = boxes.accuracy(spark.createDataFrame(a, BOX), spark.createDataFrame(b, BOX).drop("field"), least=0.2)
    ok = lambda x: x[4] and x[4][0] <= x[4][2] and x[4][1] <= x[4][3]
    pairs = sorted((-iou(p[4], q[4]), p[0], q[0]) for p in a for q in b if ok(p) and ok(q) and p[1:3] == q[1:3] and iou(p[4], q[4]) > 0)
    one, two = {}, set()
    for s, i, j in pairs:
        if i not in one and j not in two:
            one[i] = (j, -s >= 0.2, -s >= 0.2 and a[i][5].strip() == b[j][5].strip())
            two.add(j)
    got = {r.id: (r.line, r.hit, r.right) for r in found.collect()}
    assert got == {p[0]: one.get(p[0], (None, False, False)) for p in a}
    for r in per_field.collect():
        own = [got[p[0]] for p in a if (p[3], p[1]) == (r.field, r.doc_id)]
        assert (r.n, r.hits, r.n_right, r.accuracy) == (len(own), sum(x[1] for x in own), sum(x[2] for x in own), sum(x[2] for x in own) / len(own))


def test_greedy_matching_of_chains(spark):
    rng = random.Random(6)
    pairs = [(rng.choice("pq"), rng.randrange(25), rng.randrange(25), rng.randrange(6)) for _ in range(200)]
    pairs = list({x[:3]: x for x in pairs}.values())
    found = boxes.one_to_one(spark.createDataFrame(pairs, "k string, a int, b int, w int"), ["k"], "a", "b", [F.col("w"), F.col("a"), F.col("b")])
    one, two, wanted = set(), set(), set()
    for k, a, b, w in sorted(pairs, key=lambda x: (x[3], x[1], x[2])):
        if (k, a) not in one and (k, b) not in two:
            one.add((k, a)), two.add((k, b)), wanted.add((k, a, b, w))
    assert {tuple(r) for r in found.collect()} == wanted


def shuffled_rows(spark, since=-1):
    """Rows that stages after ``since`` wrote to shuffles, and the last stage's number."""
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    stages = [stages.apply(k) for k in range(stages.size())]
    return sum(s.shuffleWriteRecords() for s in stages if s.stageId() > since), max((s.stageId() for s in stages), default=-1)


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_matching_moves_boxes_not_cells_and_pairs(spark, no_broadcast):
    """Wide boxes lie in many cells of a page; sent to each, with a round of joins over their pairs, they were far more rows than boxes."""
    boxed = [(i, f"d{d}", 1, "x", [0.1, 0.05 * i, 0.9, 0.05 * i + 0.04], "t") for d in range(100) for i in range(10)]
    a = spark.createDataFrame(boxed, BOX).repartition(4)
    _, last = shuffled_rows(spark)
    _, per_field = boxes.accuracy(a, a.drop("field"))
    assert {(r.n, r.hits, r.n_right) for r in per_field.collect()} == {(10, 10, 10)}
    assert shuffled_rows(spark, last)[0] <= 4 * 2 * len(boxed)


@pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables aren't here")
def test_box_accuracy_moves_a_line_few_times(spark, no_broadcast):
    _, last = shuffled_rows(spark)
    n = sum(r.n for r in statements.box_accuracy(spark, SF).collect())
    assert n and shuffled_rows(spark, last)[0] <= 6 * n


@pytest.mark.parametrize("most", [0, 12, 1000])
def test_pages_of_any_number_of_boxes_match_alike(spark, most):
    """All, some or no pages go through the table of pairs; a box without id, document or page, or without a usable box, hits nothing but counts."""
    rng = random.Random(8)
    a, b = some_boxes(rng, 50), some_boxes(rng, 50)
    a += [(100, None, 1, "x", [0.0, 0.0, 1.0, 1.0], "t"), (101, "a", None, "y", [0.0, 0.0, 1.0, 1.0], "t"), (102, "a", 1, "x", [0.0, None, 1.0, 1.0], "t"), (103, "z", 1, "x", [0.0, 0.0, 1.0, 1.0], "t")]
    a += [(None, "a", 1, "x", [0.0, 0.0, 1.0, 1.0], "t")]
    b += [(None, "a", 1, "x", [0.0, 0.0, 1.0, 1.0], "t"), (100, None, 1, "x", [0.0, 0.0, 1.0, 1.0], "t"), (101, "a", None, "y", [0.0, 0.0, 1.0, 1.0], "t"), (102, "a", 1, "x", [0.0, 0.0, 1.0, 1.0], None)]
    found, per_field = boxes.accuracy(spark.createDataFrame(a, BOX), spark.createDataFrame(b, BOX).drop("field"), 0.2, most)
    ok = lambda x: x[0] is not None and x[1] and x[2] and x[4] and None not in x[4] and x[4][0] <= x[4][2] and x[4][1] <= x[4][3]
    pairs = sorted((-round(iou(p[4], q[4]), 9), p[0], q[0]) for p in a for q in b if ok(p) and ok(q) and p[1:3] == q[1:3] and round(iou(p[4], q[4]), 9) > 0)
    text, one, two = {q[0]: q[5] for q in b}, {}, set()
    for s, i, j in pairs:
        if i not in one and j not in two:
            own = next(p[5] for p in a if p[0] == i)
            one[i] = (j, -s, -s >= 0.2, -s >= 0.2 and text[j] is not None and own.strip() == text[j].strip())
            two.add(j)
    got = {r.id: (r.line, r.overlap, r.hit, r.right) for r in found.collect()}
    assert got == {p[0]: one.get(p[0], (None, None, False, False)) for p in a}
    assert sum(r.n for r in per_field.collect()) == len(a)
