"""Amounts, dates, identifiers and names as French filings write them. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed rate of the franc, set by law.
FRANCS_PER_EURO = "6.55957"
#: Months, without accents, in order.
MONTHS = ["janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre"]
#: Accented capital and small letters and what they are folded to, place by place.
ACCENTED, FOLDED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"
#: Legal forms that aren't part of a company's name.
LEGAL_FORMS = ["SARL", "SAS", "SASU", "SA", "SCI", "SNC", "EURL", "SELARL"]
UNKNOWN_NAME = "NON RENSEIGNE"

# digits, with letters o for zero inside; blanks (also no-break ones), full stops and slashes separate thousands
_NUMBER = r"(?:[0-9][0-9oO]{0,2}(?:[ \x{00A0}\x{202F}./][0-9oO]{3})+|[0-9]+)(?:,[0-9]{1,2})?"
_CURRENCY = r"(?:€|[Ee]uros?|EUROS?|EUR|[Ff]rancs?|FRANCS?|FRF)"
_AMOUNT = rf"(?<![0-9]){_NUMBER}[ \x{{00A0}}\x{{202F}}/]*{_CURRENCY}"
# what a sentence on the capital may hold between its verb and an amount; a delta's ends at a verb that sets the capital
_SETS = r"\b(?:porte|ramene|passe|eleve|fixe)"
_DELTA = rf"(?:augmente|reduit|reduction|augmentation)(?:(?!{_SETS})[^0-9])*?({_AMOUNT})"
_CHANGE = rf"{_SETS}[^0-9.;]*?\bd(?:e|u montant de) +(?:la somme de +|celle de +)?{_NUMBER}[ \x{{00A0}}\x{{202F}}/]*{_CURRENCY}?[^0-9.;]{{0,80}}?\ba +[^0-9.;]{{0,40}}?({_AMOUNT})"
_STANDS = rf"(?:{_SETS}[^0-9.;]*?\ba\b|capital(?: social)?[^0-9.;]{{0,40}}?(?::|\bde\b|\best\b))[^0-9.;]{{0,40}}?({_AMOUNT})"


def bound(value: Column, f) -> Column:
    """``f(value)`` with the value computed once: Catalyst copies an expression to every place that reads it, but not a lambda's argument."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _parsed(found: Column) -> Column:
    # currencies start with none of these characters, and francs alone hold an f
    number = F.regexp_extract(found, r"^[0-9oO ./,\x{00A0}\x{202F}]*", 0)
    whole = F.translate(F.substring_index(number, ",", 1), "oO ./\u00a0\u202f", "00")
    cents = F.when(F.contains(number, F.lit(",")), F.rpad(F.translate(F.substring_index(number, ",", -1), " ./\u00a0\u202f", ""), 2, "0")).otherwise("00")
    value = F.when(found != "", F.concat(whole, F.lit("."), cents).try_cast("decimal(18,2)"))
    currency = F.when(F.contains(F.lower(found), F.lit("f")), "FRF").otherwise("EUR")
    return bound(value, lambda v: F.struct(v.alias("amount"), F.when(v.isNotNull(), currency).alias("currency")))


def amount(text: Column) -> Column:
    """(amount, currency) of the first amount with a currency, EUR or FRF; nulls if there is none.

    A letter o counts as zero only inside an amount that has a currency, as OCR errors do.
    """
    return bound(F.regexp_extract(text, _AMOUNT, 0), _parsed)


def amounts(text: Column) -> Column:
    """All amounts of a text in order, as an array of (amount, currency)."""
    return F.transform(F.regexp_extract_all(text, F.lit(_AMOUNT), F.lit(0)), _parsed)


def capital_statement(text: Column) -> Column:
    """(delta, absolute) of a sentence on the capital: increased or reduced by, and set to or standing at, an amount.

    Of ``porté de X à Y`` the second amount counts, whatever words stand between (``à la somme de``, ``à celle de``). A capital
    stands at an amount after a colon, ``de`` or ``est``; what ``augmentation du capital de`` names is a change only.
    """

    def read(plain: Column) -> Column:
        rest = F.regexp_replace(plain, _DELTA, " ")  # without the amount of a change
        change = F.regexp_extract(plain, _DELTA, 1)
        said = bound(rest, lambda r: F.coalesce(F.nullif(F.regexp_extract(r, _CHANGE, 1), F.lit("")), F.regexp_extract(r, _STANDS, 1)))
        delta = bound(change, lambda c: F.when(c != "", _parsed(c)["amount"]))
        sign = F.when(plain.rlike("reduit|reduction"), -1).otherwise(1)
        absolute = bound(said, lambda x: F.when(x != "", _parsed(x)["amount"]))
        return F.struct((delta * sign).cast("decimal(18,2)").alias("delta"), absolute.alias("absolute"))

    return bound(folded(text), read)


def in_euros(value: Column, currency: Column) -> Column:
    """For comparisons only: francs at the fixed rate."""
    return F.when(currency == "FRF", (value / F.lit(FRANCS_PER_EURO).cast("decimal(7,5)")).cast("decimal(18,2)")).otherwise(value)


def scaled(value: Column, unit: Column) -> Column:
    """A value as filed, in EUR or kEUR, in euros."""
    return value * F.when(unit == "kEUR", 1000).otherwise(1)


def folded(text: Column | str) -> Column:
    """Lower case without accents."""
    return F.lower(F.translate(text, ACCENTED, FOLDED))


def numeric_date(text: Column) -> Column:
    """The first dd/MM/yyyy; null if it is no date."""
    return F.try_to_date(F.regexp_extract(text, r"\b([0-9]{2}/[0-9]{2}/[0-9]{4})\b", 1), "dd/MM/yyyy")


def written_date(text: Column) -> Column:
    """The first ``d month yyyy``, accents and case aside; also ``1er``."""
    pattern = rf"\b([0-9]{{1,2}})(?:er)? +({'|'.join(MONTHS)}) +([0-9]{{4}})\b"
    plain = folded(text)
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.regexp_extract(plain, pattern, 2))
    spelt = F.concat_ws("-", F.regexp_extract(plain, pattern, 3), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(plain, pattern, 1), 2, "0"))
    return F.try_to_date(spelt, "yyyy-MM-dd")


def dates(text: Column) -> Column:
    """All dates of a text in numbers or words, in order; one that says when the text was deposited (``déposé le``) is passed over."""
    deposit = r"(?<!\bdepo[st][a-z]{0,4} {1,3}(?:au greffe |au registre )?(?:le|du) {1,3})"
    either = rf"{deposit}\b(?:[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}|[0-9]{{1,2}}(?:er)? +(?:{'|'.join(MONTHS)}) +[0-9]{{4}})\b"
    read = F.transform(F.regexp_extract_all(folded(text), F.lit(either), F.lit(0)), lambda d: F.coalesce(numeric_date(d), written_date(d)))
    return F.filter(read, lambda d: d.isNotNull())


def first_date(text: Column) -> Column:
    """The first of ``dates``."""
    return F.get(dates(text), F.lit(0))


def last_date(text: Column) -> Column:
    """The last of ``dates``."""
    return F.try_element_at(dates(text), F.lit(-1))


def exercise(text: Column) -> Column:
    """(start, end) of ``Du d/m/y au d/m/y``."""
    pattern = r"(?i)\bdu +([0-9]{2}/[0-9]{2}/[0-9]{4}) +au +([0-9]{2}/[0-9]{2}/[0-9]{4})"
    return F.struct(*[F.try_to_date(F.regexp_extract(text, pattern, k), "dd/MM/yyyy").alias(n) for k, n in ((1, "start"), (2, "end"))])


def certificate(text: Column) -> Column:
    """(deposited, chrono) of a deposit certificate's line."""
    chrono = F.nullif(F.regexp_extract(folded(text), r"sous le numero de depot +([a-z0-9/]+)", 1), F.lit(""))
    when = F.regexp_extract(folded(text), r"enregistre le +([0-9]{2}/[0-9]{2}/[0-9]{4})", 1)
    return F.struct(F.try_to_date(when, "dd/MM/yyyy").alias("deposited"), F.upper(chrono).alias("chrono"))


def cover(text: Column) -> Column:
    """(deposited, chrono, management, siren, name) of a cover line."""
    pattern = r"(?i)d[eé]p[oôÔ]t le ([0-9]{2}/[0-9]{2}/[0-9]{4}) +- +(\S+) +- +(\S+) +- +([0-9]{9}) +- +(.*)"
    part = lambda k: F.nullif(F.regexp_extract(text, pattern, k), F.lit(""))
    return F.struct(F.try_to_date(part(1), "dd/MM/yyyy").alias("deposited"), part(2).alias("chrono"), part(3).alias("management"), part(4).alias("siren"), F.trim(part(5)).alias("name"))


def document_name(text: Column) -> Column:
    """(siren, registry, management, year, chrono) of ``CA_siren_registry_management_year_chrono``; else nulls."""
    pattern = r"^CA_([0-9]{9})_([^_]+)_([^_]+)_([0-9]{4})_([^_]+)$"
    return F.struct(*[F.nullif(F.regexp_extract(text, pattern, k), F.lit("")).alias(n) for k, n in enumerate(("siren", "registry", "management", "year", "chrono"), 1)])


def form_number(text: Column) -> Column:
    """Number of the one tax form that a line names, 2033 to 2059 with an optional letter or suffix; else null."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b(20(?:3[3-9]|[45][0-9]))(?:[- ]?[A-Z]{1,2})?\b"), F.lit(1)))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def line_code(text: Column) -> Column:
    """The two capitals that stand alone before an amount of a form line, else at its start; null without any.

    Words of a label can look like it (``DE 3 ANS``), so join it with the codes of the form.
    """
    before = F.regexp_extract(text, r"(?:^|[ |])([A-Z]{2})(?=[ |]+[-(]?[0-9]++(?![0-9]*[/.][0-9]))", 1)
    start = F.regexp_extract(text, r"^[ |]*([A-Z]{2})(?=[ |]|$)", 1)
    return F.nullif(F.when(before != "", before).otherwise(start), F.lit(""))


def plain_number(text: Column) -> Column:
    """A text that is one number, as table cells have it: thousands apart, in brackets or with a minus if negative; else null."""
    pattern = r"^[ |]*([-(]?) *([0-9](?:[0-9 .\x{00A0}\x{202F}]*[0-9])?)(?:,([0-9]{1,2}))? *\)?[ |]*$"
    whole = F.translate(F.regexp_extract(text, pattern, 2), " .\u00a0\u202f", "")
    value = F.concat(whole, F.lit("."), F.rpad(F.regexp_extract(text, pattern, 3), 2, "0")).try_cast("decimal(18,2)")
    return F.when(whole != "", value * F.when(F.regexp_extract(text, pattern, 1) != "", -1).otherwise(1)).cast("decimal(18,2)")


def luhn(digits: Column, length: int = 9) -> Column:
    """Luhn check of a string of ``length`` digits; false for any other string. Plain arithmetic, in whole-stage code."""
    total = F.lit(0)
    for k in range(length):
        d = F.substring(digits, length - k, 1).try_cast("int")
        total = total + (d if k % 2 == 0 else (2 * d) % 10 + (2 * d / 10).cast("int"))
    return F.coalesce(digits.rlike(f"^[0-9]{{{length}}}$") & (total % 10 == 0), F.lit(False))


def identifiers(text: Column) -> Column:
    """Company identifiers of a text: (kind, value) with kind SIREN (9 digits, 3-3-3) or SIRET (14, 3-3-3-5).

    Fourteen digits are never cut to a SIREN; both kinds must pass their check digit.
    """
    found = F.regexp_extract_all(text, F.lit(r"(?<![0-9])[0-9]{3}[ .]?[0-9]{3}[ .]?[0-9]{3}(?:[ .]?[0-9]{5})?(?![0-9]| [0-9]{5}(?![0-9]))"), F.lit(0))
    plain = F.transform(found, lambda x: F.regexp_replace(x, "[^0-9]", ""))
    return F.transform(
        F.filter(plain, lambda x: F.when(F.length(x) == 9, luhn(x, 9)).otherwise(luhn(x, 14))),
        lambda x: F.struct(F.when(F.length(x) == 9, "SIREN").otherwise("SIRET").alias("kind"), x.alias("value")),
    )


def near_word(word: Column, wanted: str, distance: int = 1) -> Column:
    """Whether a token is ``wanted`` but for OCR errors."""
    return F.coalesce(F.levenshtein(folded(word), F.lit(wanted), distance) >= 0, F.lit(False))


def company_name(text: Column) -> Column:
    """A name's normal form: capitals without accents, punctuation and legal form; null if it is unknown."""
    plain = F.upper(F.translate(text, ACCENTED, FOLDED))
    plain = F.regexp_replace(plain, r"\b([A-Z])\.(?=[A-Z]\b)", "$1")
    plain = F.regexp_replace(plain, r"[^A-Z0-9]+", " ")
    plain = F.regexp_replace(plain, rf"\b(?:{'|'.join(LEGAL_FORMS)})\b", " ")
    plain = F.trim(F.regexp_replace(plain, " +", " "))
    return F.when(~plain.isin("", UNKNOWN_NAME), plain)


def content_key(data: Column) -> Column:
    """SHA-256 of bytes: the identity of a document."""
    return F.sha2(data, 256)


def upload_bytes(text: Column) -> Column:
    """Decoded bytes of a base64 upload; null if it is invalid."""
    return F.try_to_binary(text, F.lit("base64"))
