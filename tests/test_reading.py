from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from folioscope.operators import reading

LINE = "doc_id string, page int, pos int, text string, box array<double>"


def frame(spark, docs):
    """Lines of documents, five to a page, each with a box of its own."""
    rows = [(d, i // 5 + 1, i % 5, t, [float(i), float(i), i + 10.0, i + 1.0]) for d, lines in docs.items() for i, t in enumerate(lines)]
    return spark.createDataFrame(rows, LINE).repartition(3)


@pytest.mark.parametrize(("size", "margin"), [(1, 1), (3, 2), (8, 8), (64, 8)])
def test_matches_equal_those_of_the_whole_text(spark, size, margin):
    rng = random.Random(size)
    docs = {d: [rng.choice(["a b", "b", "", "c a", "aé🙂 b", "x", None]) for _ in range(rng.choice([0, 1, 7, 120]))] for d in "pqrs"}
    docs["hot"] = [rng.choice(["a", "b x", "c"]) for _ in range(500)]
    pattern = r"a[ \n]b|b\nc|🙂"
    ordered = reading.in_reading_order(frame(spark, docs), ["page", "pos"])
    found = reading.matches(reading.blocks(ordered, size, margin), pattern)
    got = {(r.doc_id, r.at, r.end, r.text, tuple((x.page, x.pos) for x in r.lines)) for r in found.collect()}
    wanted = set()
    for d, lines in docs.items():
        text = "\n".join(t or "" for t in lines)
        starts = [sum(len(t or "") + 1 for t in lines[:i]) for i in range(len(lines))]
        for m in re.finditer(pattern, text):
            touched = tuple((i // 5 + 1, i % 5) for i, s in enumerate(starts) if s < m.end() and s + len(lines[i] or "") > m.start())
            wanted.add((d, m.start(), m.end(), m[0], touched))
    assert got == wanted and found.count() == len(wanted) > 20


def test_boxes_of_a_match_by_page(spark):
    lines = [[(1, 0, [0.0, 1.0, 5.0, 2.0]), (1, 1, [3.0, 2.0, 9.0, 3.0]), (2, 0, None), (3, 0, [1.0, 1.0, 2.0, 2.0])]]
    df = spark.createDataFrame([(x,) for x in lines], "lines array<struct<page: int, pos: int, box: array<double>>>")
    got = df.select(reading.union_boxes(F.col("lines")).alias("b")).first().b
    assert [(x.page, x.box) for x in got] == [(1, [0.0, 1.0, 9.0, 3.0]), (2, None), (3, [1.0, 1.0, 2.0, 2.0])]


SENTENCES = {
    "M. Jean DUPONT cède à Mme Marie MARTIN 100 parts sociales": [("JEAN DUPONT", "MARIE MARTIN", 100)],
    "M. Jean DUPONT cède 1 100 parts sociales à Mme Marie MARTIN": [("JEAN DUPONT", "MARIE MARTIN", 1100)],
    "M. A. DUPONT cède et transporte à la société|BETA2 250 actions et à Mlle Zoé LÉVY, qui accepte, 50 actions.": [("A DUPONT", "BETA2", 250), ("A DUPONT", "ZOE LEVY", 50)],
    "M. JEAN DUPONT CEDE 30 PARTS A MME MARIE MARTIN": [("JEAN DUPONT", "MARIE MARTIN", 30)],
    "CESSION DE 134 PARTS SOCIALES DE LA SOCIETE EXEMPLE PAR M. JEAN DUPONT A M.;|PAUL DUPONT": [("JEAN DUPONT", "PAUL DUPONT", 134)],
    "cession de 5 parts par Monsieur Jean Dupont au profit de Madame Anne Roux": [("JEAN DUPONT", "ANNE ROUX", 5)],
    "La société ALPHA SAS souscrit à 40 actions nouvelles": [(None, "ALPHA", 40)],
    "M. Jean DUPONT est nommé gérant. Les 100 parts sont libérées.": [],
    "Cession de fonds par M. Jean DUPONT à M. Paul ROUX": [],
}


def test_movements_of_sentences(spark):
    docs = {f"d{i}": s.split("|") for i, s in enumerate(SENTENCES)}
    found = reading.movements(reading.blocks(reading.in_reading_order(frame(spark, docs), ["page", "pos"])))
    got = defaultdict(list)
    for r in found.orderBy("doc_id", "at", "k").collect():
        got[r.doc_id].append((r.giver, r.taker, r.shares))
    assert {d: got[d] for d in docs} == {f"d{i}": rows for i, rows in enumerate(SENTENCES.values())}


def test_movements_have_the_date_before_them_and_their_lines(spark):
    docs = {"d": ["Déposé le 01/01/2020", "Le 3 mai 2010, M. Jean DUPONT", "cède à Mme Anne ROUX", "10 parts", "", "Le 04/05/2011", "Mme Anne ROUX cède 4 parts à M. Jean DUPONT"], "e": ["Mme Anne ROUX souscrit 4 parts", "le 04/05/2011"]}
    found = reading.movements(reading.blocks(reading.in_reading_order(frame(spark, docs), ["page", "pos"]))).orderBy("doc_id", "at").collect()
    assert [(r.doc_id, str(r.date), r.giver, r.taker, r.shares) for r in found] == [
        ("d", "2010-05-03", "JEAN DUPONT", "ANNE ROUX", 10),
        ("d", "2011-05-04", "ANNE ROUX", "JEAN DUPONT", 4),
        ("e", "None", None, "ANNE ROUX", 4),
    ]
    assert [[(x.page, x.pos) for x in r.lines] for r in found] == [[(1, 1), (1, 2), (1, 3)], [(2, 1)], [(1, 0)]]


def test_evidence_equals_brute_force(spark):
    rng = random.Random(2)
    words = ["capital", "Réduction", "DE", "social", "parts", "été", "x1", "zz"]
    docs = {d: [" ".join(rng.choices(words, k=rng.randint(0, 5))) for _ in range(12)] for d in "abcde"}
    asked = [(d, i, " ".join(rng.choices([*words, "nowhere"], k=rng.randint(0, 4)))) for d in "abcdef" for i in range(4)]
    decisions = spark.createDataFrame([*asked, ("a", 99, None)], "doc_id string, decision_id int, text string")
    got = {(r.doc_id, r.decision_id): (r.page, r.pos, r.score and round(r.score, 9), r.box) for r in reading.evidence(decisions, frame(spark, docs)).collect()}
    plain = lambda t: set((t or "").lower().replace("é", "e").split())
    df = defaultdict(int)
    for lines in docs.values():
        for w in set().union(*map(plain, lines)):
            df[w] += 1
    weigh = lambda ws: sum(round(1000 * math.log1p(5 / df.get(w, 1))) for w in ws)
    for d, i, text in [*asked, ("a", 99, None)]:
        own = plain(text)
        best = min(((-weigh(own & plain(t)), len(plain(t)), k // 5 + 1, k % 5, k) for k, t in enumerate(docs.get(d, [])) if own & plain(t)), default=None)
        want = (None, None, None, None)
        if best and -best[0] >= 0.5 * weigh(own):
            k = best[4]
            want = (best[2], best[3], round(-best[0] / weigh(own), 9), [float(k), float(k), k + 10.0, k + 1.0])
        assert got[d, i] == want, (d, i, text)


def test_no_lines(spark):
    none = reading.in_reading_order(frame(spark, {"a": []}), ["page", "pos"])
    assert reading.movements(reading.blocks(none)).count() == 0
    with pytest.raises(ValueError):
        reading.blocks(none, 4, 5)
