from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from folioscope.functions import french, geometry


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "said, value, currency",
    [
        ("31 700 €", "31700.00", "EUR"),
        ("241.609 Euro", "241609.00", "EUR"),
        ("56 824,37 Euros", "56824.37", "EUR"),
        ("20 000,00 euros", "20000.00", "EUR"),
        ("517 203/euros", "517203.00", "EUR"),
        ("700/o0o euros", "700000.00", "EUR"),
        ("3.000.000 Francs", "3000000.00", "FRF"),
        ("23 456 789 €", "23456789.00", "EUR"),
        ("95 F puis 4,5 FRF", "4.50", "FRF"),
        ("12\u00a0345\u202f678,90\u00a0EUROS", "12345678.90", "EUR"),
        ("loi du 24 juillet", None, None),
        ("", None, None),
    ],
)
def test_amount(spark, said, value, currency):
    got = one(spark, french.amount(F.col("t")), t=said)
    assert (got.amount, got.currency) == (value and Decimal(value), currency)


def test_several_amounts(spark):
    said = "réduit d'une somme de 7.300 euros et fixé à 31.900 euros"
    assert [a.amount for a in one(spark, french.amounts(F.col("t")), t=said)] == [Decimal(7300), Decimal(31900)]
    got = one(spark, french.capital_statement(F.col("t")), t=said)
    assert (got.delta, got.absolute) == (Decimal(-7300), Decimal(31900))


@pytest.mark.parametrize(
    "said, absolute",
    [("porté de 100 000 euros à 200 000 euros", 200000), ("porté de 100 000 à 200 000,50 euros", "200000.50"), ("ramené de 9.000 € à 3.000 €", 3000), ("porté à 5 000 euros", 5000), ("SA au capital de 12 000 euros à Lyon", 12000), ("porté de 5 à 6", None)],
)
def test_new_capital(spark, said, absolute):
    assert one(spark, french.capital_statement(F.col("t")), t=said).absolute == (absolute and Decimal(absolute))


@pytest.mark.parametrize(
    "said, code",
    [("ACHATS DE MARCHANDISES FS 1 234", "FS"), ("FL Chiffres d'affaires nets", "FL"), ("TOTAL GENERAL CO (12)", "CO"), ("| CO | 5 | 1A | 6", "CO"), ("Du 01/01/2020 AU 31/12/2020", None), ("VENTES DE PRODUITS", None), ("", None)],
)
def test_line_code(spark, said, code):
    assert one(spark, french.line_code(F.col("t")), t=said) == code


@pytest.mark.parametrize("said, value", [("1 234", "1234.00"), ("(2 000)", "-2000.00"), ("-7,5", "-7.50"), ("1.234.567,89 ", "1234567.89"), ("12 m", None), ("", None), ("le 3", None)])
def test_plain_number(spark, said, value):
    assert one(spark, french.plain_number(F.col("t")), t=said) == (value and Decimal(value))


@pytest.mark.parametrize("said, day", [("le 30 juillet 2011", (2011, 7, 30)), ("2 août 2011", (2011, 8, 2)), ("2 aout 2011", (2011, 8, 2)), ("4 fevrier 2012", (2012, 2, 4)), ("1er JUIN 2013", (2013, 6, 1)), ("31 février 2012", None)])
def test_written_date(spark, said, day):
    assert one(spark, french.written_date(F.col("t")), t=said) == (day and datetime.date(*day))


@pytest.mark.parametrize("said, day", [("du 24/10/2016.", (2016, 10, 24)), ("99/99/2016", None), ("", None)])
def test_numeric_date(spark, said, day):
    assert one(spark, french.numeric_date(F.col("t")), t=said) == (day and datetime.date(*day))


@pytest.mark.parametrize("digits, ok", [("732829320", True), ("111111118", True), ("732829321", False), ("73282932", False), ("x32829320", False)])
def test_luhn(spark, digits, ok):
    assert one(spark, french.luhn(F.col("t")), t=digits) is ok


def test_identifiers(spark):
    got = one(spark, french.identifiers(F.col("t")), t="RCS 111 111 118, SIRET 732 829 320 00074 et 732829320")
    assert [(x.kind, x.value) for x in got] == [("SIREN", "111111118"), ("SIRET", "73282932000074"), ("SIREN", "732829320")]
    only = one(spark, french.identifiers(F.col("t")), t="732 829 320 00074")
    assert [x.kind for x in only] == ["SIRET"]


def test_folding_and_names(spark):
    assert one(spark, french.folded(F.col("t")), t="DépÔt") == "depot"
    assert one(spark, french.near_word(F.col("t"), "capital"), t="capilal") is True
    assert one(spark, french.near_word(F.col("t"), "capital"), t="hôpital") is False
    for said in ("ÉXEMPLIA S.A.", "*SARL Exemplia", "Exemplia, SAS"):
        assert one(spark, french.company_name(F.col("t")), t=said) == "EXEMPLIA"
    assert one(spark, french.company_name(F.col("t")), t="Non renseigné") is None


def test_lines_of_certificates(spark):
    got = one(spark, french.certificate(F.col("t")), t="enregistré le 11/07/2011 sous le numéro de dépôt B2011/000123 au greffe")
    assert (got.deposited, got.chrono) == (datetime.date(2011, 7, 11), "B2011/000123")
    got = one(spark, french.cover(F.col("t")), t="DépÔt le 06/05/2023 - 1234 - 1991B00456 - 111111118 - EXEMPLE SAS")
    assert (got.siren, got.name, got.chrono) == ("111111118", "EXEMPLE SAS", "1234")
    assert one(spark, french.document_name(F.col("t")), t="CA_732829320_7777_2001B01_2016_1234").year == "2016"
    assert one(spark, french.document_name(F.col("t")), t="autre").siren is None
    got = one(spark, french.exercise(F.col("t")), t="Exercice du 01/07/2015 au 30/06/2016")
    assert (got.start, got.end) == (datetime.date(2015, 7, 1), datetime.date(2016, 6, 30))


def test_uploads(spark):
    assert one(spark, french.upload_bytes(F.col("t")), t="YWJj") == b"abc"
    assert one(spark, french.upload_bytes(F.col("t")), t="%%%") is None
    assert one(spark, french.in_euros(F.lit(Decimal("655.957")).cast("decimal(18,3)"), F.lit("FRF"))) == Decimal("100.00")


@pytest.mark.parametrize("points", [4, None])
def test_box(spark, points):
    polygon = [[10.0, 20.0], [110.0, 18.0], [112.0, 60.0], [9.0, 62.0]]
    box = geometry.box_of_polygon(F.col("p"), points)
    assert one(spark, box, p=polygon) == [9, 18, 112, 62]
    got = one(spark, geometry.normalised(box, F.lit(720.0), F.lit(720.0)), p=polygon)
    assert got == pytest.approx([0.003, 0.006, 112 / 3000, 62 / 3000])
    back = geometry.denormalised(geometry.normalised(box, F.lit(720.0), F.lit(720.0)), F.lit(3000), F.lit(3000))
    assert one(spark, back, p=polygon) == pytest.approx([9, 18, 112, 62])


@pytest.mark.parametrize("said, box, beyond", [("0.1,0.2,0.3", None, None), (" 0.1, 0.2,1.3 ,0.4", [0.1, 0.2, 1.3, 0.4], True), ("0.1,0.2,x,0.4", None, None), ("0,0,1,1", [0, 0, 1, 1], False), ("1,2,3,4,5", None, None)])
def test_parsed_box(spark, said, box, beyond):
    parsed = geometry.parsed_box(F.col("t"))
    assert one(spark, parsed, t=said) == box
    assert one(spark, geometry.out_of_range(parsed), t=said) is beyond


def test_overlap(spark):
    of = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    assert one(spark, geometry.overlap(of(0, 0, 2, 2), of(1, 1, 3, 3))) == pytest.approx(1 / 7)
    assert one(spark, geometry.overlap(of(0, 0, 1, 1), of(2, 2, 3, 3))) == 0
    assert one(spark, geometry.overlap(of(0, 0, 0, 0), of(0, 0, 0, 0))) == 0


@pytest.mark.parametrize(
    ("text", "delta", "absolute"),
    [
        ("porté de 7 500 euros à la somme de 15 000 euros", None, 15000),
        ("ramené de la somme de 9 000 € à celle de 3 000 €", None, 3000),
        ("porté de 7 500 à 15 000 euros", None, 15000),
        ("Capital social : 30 600 euros", None, 30600),
        ("Son capital est de 30 600 euros", None, 30600),
        ("Son capital social est de 30 600 euros. Siège à 75001 PARIS, apport de 20 euros", None, 30600),
        ("SARL au capital de 8 000 €, siège à Lyon, prix de 12 €", None, 8000),
        ("augmentation du capital social de 5 000 euros", 5000, None),
        ("capital augmenté de 5 000 euros pour être porté à 15 000 euros", 5000, 15000),
        ("réduction de capital de 5 000 euros, ramené de 20 000 euros à 15 000 euros", -5000, 15000),
        ("augmentation de capital : le capital est porté de 7 500 euros à 15 000 euros", None, 15000),
        ("fixé à 24.600 euros", None, 24600),
        ("il est fixé à la somme de trente mille (30 000) euros", None, None),
        ("Prix : 30 600 euros", None, None),
        (None, None, None),
    ],
)
def test_capital_statements(spark, text, delta, absolute):
    got = spark.createDataFrame([(text,)], "t string").select(french.capital_statement(F.col("t")).alias("s")).first().s
    assert (got.delta, got.absolute) == (delta, absolute)


def test_first_date(spark):
    texts = {
        "acte du 3 mai 2010 déposé le 01/06/2010": "2010-05-03",
        "déposé au greffe le 01/06/2010, acte du 3 mai 2010": "2010-05-03",
        "Dépôt du 01/06/2010": None,
        "le 31/02/2010 puis le 1er août 2011": "2011-08-01",
        "du 05/04/2009 au 6 avril 2009": "2009-04-05",
        "": None,
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", french.first_date(F.col("t")).cast("string").alias("d")).collect()
    assert {r.t: r.d for r in rows} == texts


def test_an_amount_is_matched_once(spark):
    plan = spark.createDataFrame([("1 euro",)], "t string").select(french.amount(F.col("t")).alias("a")).select("a.amount", "a.currency")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("(?<![0-9])") == 1, text
