"""Personal data: base patterns, and terms whose co-occurrence in the corpus reveals protected entities.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. Every distinct value found is a
protected entity c. Terms are words (runs of digits, ASCII letters and non-ASCII characters, A-Z lower-cased) that meet no base span,
within WINDOW words of an occurrence, that have a character within REACH characters of it; those of more than LONGEST bytes stand as
128-bit hashes. With N documents, n(c) that hold c, n(t) that
hold t, and n(c, t) in which t stands near c,

    PMI(c; t) = log2(N n(c, t) / (n(c) n(t))),    IC(c) = log2(N / n(c)),

a term discloses c if PMI(c; t) >= DISCLOSURE * IC(c): knowing t then gives nearly all information of c. Only
pairs seen in SUPPORT documents or more count, for below that the estimate says nothing. A disclosing term is
generalised to the kind of the entity it reveals (``[near EMAIL]``), if saying the kind discloses at most
GENERAL * IC(c), where the kind's own information is log2(N / n(kind)); otherwise, and if it reveals entities of
several kinds, it is removed (``[removed]``). This holds wherever the term stands, as its text alone reveals c.

Counts cover all documents: pairs and frequencies are aggregated in each task before any shuffle. n(t) is counted in one pass,
for terms of sufficient support only; these are broadcast up to ``block_terms`` (under 64 MB), and joined with the counts of all
terms beyond. Disclosing terms are broadcast up to ``block_terms``; beyond, documents look up those of their own words in chunks
(lookups.py), so the number of passes over the corpus is the same for any number of terms. No text is shuffled. A document's spans and the words about them are handled in time linear in its length.

A null text counts as empty and stays null when sanitised. Each row is a document, so repeated rows count as
often as they occur; ties and other columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm import lookups
from folioscope.llm.carried import parted
from folioscope.llm.words import alnum_words
from folioscope.storage import bounded_batches, frugal, land

KINDS = ["email", "ip", "card", "phone"]
WINDOW, REACH, LONGEST, SUPPORT, DISCLOSURE, GENERAL = 10, 1000, 48, 3, 0.9, 0.75

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}")
_PART = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum((2 * d) // 10 + (2 * d) % 10 for d in map(int, digits[-2::-2]))) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from the @ signs: a local part ends at one and holds none."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        free = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", free)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Four parts at a time from every run of dotted numbers; failing fours are dropped."""
    out = []
    for run in _DOTTED.finditer(text):
        parts = [m.span() for m in _PART.finditer(text, *run.span())]
        for k in range(0, len(parts) - 3, 4):
            if all(len(x := text[a:b].lstrip("0")) <= 3 and int(x or 0) <= 255 for a, b in parts[k : k + 4]):
                out.append((parts[k][0], parts[k + 3][1]))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind in the order of KINDS, then start; code points."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    out += [("ip", a, b) for a, b in ips(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def entity(kind: str, value: str) -> str:
    """A value's normal form, by which its occurrences are one entity."""
    return f"{kind}:" + (value.lower() if kind == "email" else value if kind == "ip" else re.sub("[^0-9]", "", value))


def long_term(word: bytes) -> str:
    """What stands for a lower-cased word of more than LONGEST bytes; no word has a #."""
    return "#" + hashlib.blake2b(word, digest_size=16).hexdigest()


def term(word: str) -> str:
    """A word's normal form, by which its occurrences are one term."""
    word = word.translate(_LOWER)
    return word if 4 * len(word) <= LONGEST or len(x := word.encode("utf-8")) <= LONGEST else long_term(x)


def terms_of(text: str | None) -> Iterator[str]:
    """The terms of a text's words, with repeats."""
    return (w.decode("utf-8") if len(w) <= LONGEST else long_term(w) for w in alnum_words(text))


def word_start(text: str, at: int) -> int:
    """Where the word that holds the characters before and after ``at`` begins; ``at`` if there is none."""
    step, start = 64, at
    while start and _WORD.match(text, start, start + 1):
        lo = max(0, start - step)
        last = None
        for last in _WORD.finditer(text, lo, start):
            pass
        if not last or last.end() < start:
            break
        start, step = last.start(), 2 * step
    return start


class Covered:
    """The union of spans (kind, start, end), to look up what meets it."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for _, a, b in sorted(spans, key=lambda x: x[1:]):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a), self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        k = bisect.bisect_left(self.starts, b) - 1
        return k >= 0 and self.ends[k] > a


def near(text: str, spans: list[tuple[str, int, int]]) -> set[tuple[str, str | None]]:
    """(entity, term) pairs of a document, and (entity, None) for every entity.

    Words are read once per stretch of text that spans with overlapping reach share, and looked up by bisection.
    """
    out: set[tuple[str, str | None]] = set()
    covered, order, at = Covered(spans), sorted(spans, key=lambda x: x[1]), 0
    while at < len(order):
        lo, hi, first = max(0, order[at][1] - REACH), 0, at
        while at < len(order) and (at == first or order[at][1] - REACH <= hi):
            hi = max(hi, min(len(text), order[at][2] + REACH))
            at += 1
        starts, ends = array("q"), array("q")
        for m in _WORD.finditer(text, word_start(text, lo), hi):
            starts.append(m.start()), ends.append(m.end())
        if ends and ends[-1] == hi:
            ends[-1] = _WORD.match(text, starts[-1]).end()
        for kind, a, b in order[first:at]:
            c = entity(kind, text[a:b])
            out.add((c, None))
            i, j = bisect.bisect_right(ends, a), bisect.bisect_left(starts, b)
            for k in (*range(max(0, i - WINDOW), i), *range(j, min(len(starts), j + WINDOW))):
                if ends[k] > a - REACH and starts[k] < b + REACH and not covered.meets(starts[k], ends[k]):
                    out.add((c, term(text[starts[k] : ends[k]])))
    return out


def clean(text: str, spans: list[tuple[str, int, int]], actions: dict[str, str]) -> str:
    """``text`` with every span replaced; spans that overlap are replaced as one, by the first one's mark.

    ``spans`` are base ones by their kind, and (term, start, end) for terms in ``actions``.
    """
    out, at, last = [], 0, 0
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= last:
            out += [text[at:a], actions.get(kind, f"[{kind.upper()}]")]
        at = last = max(last, b)
    return "".join([*out, text[at:]])


def _pairs(batches):
    for batch in batches:
        count: Counter[tuple[str, str | None]] = Counter()
        n = 0
        for text in batch.column(0).to_pylist():
            n += 1
            if text and (spans := base_spans(text)):
                count.update(near(text, spans))
                count.update((f"{k}:", None) for k in {k for k, _, _ in spans})
        count["", None] += n
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in count], pa.string()), pa.array([t for _, t in count], pa.string()), pa.array(count.values(), pa.int64())], ["entity", "term", "n"])


def _frequencies(terms, most: int = 500_000):
    """Number of documents per term: of the broadcast ``terms``, or of all terms if it is None."""

    def run(batches):
        wanted, count = terms.value if terms else None, Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                count.update(wanted.intersection(terms_of(text)) if terms else set(terms_of(text)))
                if len(count) >= most:
                    yield _counted(count)
                    count = Counter()
        yield _counted(count)

    return run


def _counted(count: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(count.values(), pa.int64())], ["term", "n"])


def disclosing_terms(documents: DataFrame, block_terms: int = 500_000) -> DataFrame:
    """(term, action) of every term that discloses a protected entity of ``documents``, landed; long terms as ``long_term`` has them."""
    spark = documents.sparkSession
    bounded_batches(spark)
    texts = documents.select(F.col("text").cast("string").alias("text"))
    counts = land(texts.mapInArrow(frugal(_pairs), "entity string, term string, n long").groupBy("entity", "term").agg(F.sum("n").alias("n")), "pairs")
    total = counts.where("entity = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    kinds = {r.entity: r.n for r in counts.where(F.col("entity").isin([f"{k}:" for k in KINDS])).collect()}
    joint = counts.where((F.col("n") >= SUPPORT) & F.col("term").isNotNull())
    single = counts.where("term is null and n >= %d" % SUPPORT).select("entity", F.col("n").alias("n_c"))
    terms = land(joint.select("term").distinct(), "terms")
    known = None
    if terms.count() <= block_terms:
        known = spark.sparkContext.broadcast(frozenset(r.term for r in terms.collect()))
    found = texts.mapInArrow(frugal(_frequencies(known)), "term string, n long")
    if known is None:
        found = found.join(terms, "term", "left_semi")
    found = found.groupBy("term").agg(F.sum("n").alias("n_t"))
    joined = joint.join(land(single, "entities"), "entity").join(land(found, "frequencies"), "term")
    # PMI - DISCLOSURE * IC as one sum of logarithms
    log = lambda c: F.log2(c.cast("double"))
    margin = log(F.col("n")) - log(F.col("n_t")) + (1 - DISCLOSURE) * (math.log2(max(total, 1)) - log(F.col("n_c")))
    kind = F.substring_index("entity", ":", 1)
    said = F.create_map(*[F.lit(x) for k in KINDS for x in (k, math.log2(max(total, 1) / max(1, kinds.get(f"{k}:", 1))))])
    general = said[kind] <= GENERAL * (math.log2(max(total, 1)) - log(F.col("n_c")))
    by_term = joined.where(margin >= 0).groupBy("term").agg(F.min(kind).alias("lo"), F.max(kind).alias("hi"), F.min(general).alias("general"))
    action = F.when((F.col("lo") == F.col("hi")) & F.col("general"), F.concat(F.lit("[near "), F.upper("lo"), F.lit("]"))).otherwise("[removed]")
    return land(by_term.select("term", action.alias("action")), "disclosing")


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("action", pa.string())]))


def words_of(text: str | None) -> set[str]:
    """The distinct terms of a text."""
    return set(terms_of(text))


def _spans(text: str, known: dict[str, str]) -> list[tuple]:
    """(kind, start, end, action) of base patterns and of terms in ``known``."""
    spans = [(k, a, b, None) for k, a, b in base_spans(text)]
    if known and not known.keys().isdisjoint(terms_of(text)):
        covered = Covered([x[:3] for x in spans])
        for m in _WORD.finditer(text):
            if (action := known.get(term(m[0]))) and not covered.meets(*m.span()):
                spans.append(("term", *m.span(), action))
    return spans


def _find(of_batch, carried: int):
    """Replaces the last ``carried`` columns by spans and the clean text; ``of_batch`` gives the terms that each row looks for."""

    def run(batches):
        for batch in batches:
            out, texts = [], []
            for said, known in zip(batch.column(0).to_pylist(), of_batch(batch)):
                spans = _spans(said or "", known)
                out.append([dict(zip(("kind", "start", "end", "action"), x)) for x in spans])
                texts.append(_cleaned(said or "", spans) if spans else said)
            n = len(batch.columns) - carried
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(out, _SPANS), pa.array(texts, pa.string())], [*batch.schema.names[:n], "spans", "clean"])

    return run


def _cleaned(text: str, spans: list[tuple]) -> str:
    return clean(text, [(action or kind, a, b) for kind, a, b, action in spans], {action: action for *_, action in spans if action})


def sanitise(documents: DataFrame, block_terms: int = 500_000) -> DataFrame:
    """For every row of ``documents``: ``row``, its columns, ``spans`` (kind, start, end, action) and the ``clean`` text.

    Spans are ordered by kind as in KINDS, terms last, then by start. At most ``block_terms`` terms are broadcast, and a chunk
    of documents has about as many distinct words at most.
    """
    terms = disclosing_terms(documents, block_terms)
    rows, row = parted(documents)
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("spans array<struct<kind: string, start: long, end: long, action: string>>, clean string").fields])
    if terms.count() <= block_terms:
        known = documents.sparkSession.sparkContext.broadcast({r.term: r.action for r in terms.collect()})
        out = rows.mapInArrow(frugal(_find(lambda batch: [known.value] * len(batch), 0)), schema)
    else:
        chunks = lookups.chunked(rows, words_of, block_terms)
        folder = lookups.found(chunks, words_of, "term", terms)

        def run(batches):
            of = lookups.by_chunk(folder, lambda found: dict(zip(found["term"].to_pylist(), found["action"].to_pylist())) if found else {})
            yield from _find(lambda batch: (of(p, c) for p, c in zip(*(batch.column(len(batch.columns) - k).to_pylist() for k in (2, 1)))), 2)(batches)

        out = chunks.mapInArrow(frugal(run), schema)
    return out.select(row.alias("row"), "spans", "clean")
