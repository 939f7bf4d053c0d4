"""Documents as running text that still knows its boxes: reading order, matches across line ends, and evidence.

A document's lines are joined in reading order by line feeds. Offsets (code points, from 0) are running sums over ranges (scan.py), and the
text is kept in blocks of ``size`` lines with ``margin`` more on either side, so no document is one row or one task. A match belongs
to the block in whose own lines it begins; it may run over line and page ends, over ``margin`` of them at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import french
from folioscope.operators import scan
from folioscope.storage import land

SIZE, MARGIN = 64, 8

# --- text with a map --------------------------------------------------------------------------------------


def in_reading_order(lines: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``seq``, a line's number from 0 in its document, and ``offset``, where it begins in the text; landed.

    ``lines`` are (doc_id, page, pos, text, box); ``order``, which must be total in a document, is the reading order, for instance page, row (of
    ``accounts.text_rows``) and left edge. A null text is an empty line.
    """
    rows = scan.ranged(lines.withColumn("text", F.coalesce("text", F.lit(""))), ["doc_id"], order)
    out = scan.running(rows, ["doc_id"], order, {"seq": F.lit(1), "offset": F.length("text") + 1})
    return out.withColumn("seq", F.col("seq") - 1).withColumn("offset", F.col("offset") - F.length("text") - 1).drop(scan.PART)


def blocks(ordered: DataFrame, size: int = SIZE, margin: int = MARGIN) -> DataFrame:
    """doc_id, block, text, start (the text's offset in the document), own and until (those of its own lines' first and last end), and
    map: its lines as structs (offset, length, page, pos, box), in order. The margin must not exceed the size."""
    if not 0 <= margin <= size:
        raise ValueError("a margin must not exceed the size of a block")
    own = F.expr(f"seq div {size}")
    near = F.array_distinct(F.array(own, F.greatest(F.expr(f"(seq - {margin}) div {size}"), F.lit(0)), F.expr(f"(seq + {margin}) div {size}")))
    line = F.struct("seq", "offset", F.length("text").alias("length"), "page", "pos", "box", "text")
    rows = ordered.select("doc_id", own.alias("own"), F.explode(near).alias("block"), line.alias("line"))
    mine = F.when(F.col("own") == F.col("block"), F.col("line"))
    # size + 2 * margin lines at most
    out = rows.groupBy("doc_id", "block").agg(F.sort_array(F.collect_list("line")).alias("x"), F.min(mine["offset"]).alias("own"), F.max(mine["offset"] + mine["length"] + 1).alias("until"))
    out = out.where("own is not null")  # no block of margins alone
    kept = F.transform("x", lambda x: x["text"])
    return out.select("doc_id", "block", F.array_join(kept, "\n").alias("text"), F.col("x")[0]["offset"].alias("start"), "own", "until", F.transform("x", lambda x: x.dropFields("seq", "text")).alias("map"))


def covered(at: Column, end: Column, lines: Column) -> Column:
    """Of a block's map, the lines that the span of offsets touches, as structs (page, pos, box)."""
    hit = F.filter(lines, lambda x: (x["offset"] < end) & (x["offset"] + x["length"] > at))
    return F.transform(hit, lambda x: F.struct(x["page"].alias("page"), x["pos"].alias("pos"), x["box"].alias("box")))


def matches(found: DataFrame, pattern: str, *context: str) -> DataFrame:
    """All matches of a pattern in blocks: doc_id, at and end (offsets in the document), text, and lines (page, pos, box) that it touches.

    Places are read off the pieces between matches, since Spark gives texts of matches only. The pattern must not match the empty text.
    ``context``: further columns of the blocks to keep.
    """
    pieces, texts = F.split("text", pattern, -1), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    lengths = found.select("*", pieces.alias("_pieces"), texts.alias("_texts")).where("size(_texts) > 0")
    # one array of (gap before, match), and running sums of both by the explode's place
    pairs = F.arrays_zip(F.transform("_pieces", F.length).alias("gap"), F.col("_texts").alias("said"))
    rows = lengths.select("doc_id", "block", "start", "own", "until", "map", *context, F.posexplode(pairs).alias("k", "pair")).where("pair.said is not null")
    w = Window.partitionBy("doc_id", "block").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.col("start") + F.sum(F.col("pair.gap") + F.length("pair.said")).over(w))
    rows = rows.withColumn("at", F.col("end") - F.length("pair.said")).where("at >= own and at < until")
    return rows.select("doc_id", "at", "end", F.col("pair.said").alias("text"), covered(F.col("at"), F.col("end"), F.col("map")).alias("lines"), *context)


def union_boxes(lines: Column) -> Column:
    """One box per page that holds the boxes of a match's lines, as structs (page, box), by page; lines without box don't count."""

    def of(page: Column) -> Column:
        own = F.filter(lines, lambda x: (x["page"] == page) & x["box"].isNotNull())
        side = lambda k, f: f(F.transform(own, lambda x: x["box"][k]))
        box = F.array(side(0, F.array_min), side(1, F.array_min), side(2, F.array_max), side(3, F.array_max))
        return F.struct(page.alias("page"), F.when(F.size(own) > 0, box).alias("box"))

    return F.transform(F.array_sort(F.array_distinct(F.transform(lines, lambda x: x["page"]))), of)


# --- movements of shares ----------------------------------------------------------------------------------

_S = r"[\s;,]+"
_TITLE = r"(?:M\.|MM\.|Mr|Mme|MME|Mlle|MLLE|Monsieur|MONSIEUR|Madame|MADAME|Mademoiselle|[Ll]a soci[ée]t[ée]|LA SOCI[EÉ]T[EÉ]|[Ll]a (?:SARL|SAS|SA|SCI)|LA (?:SARL|SAS|SA|SCI))"
_WORD = r"(?:[A-ZÀ-Ý][\w'’À-ÿ-]+|[A-Z]\.)"
# a title and a name may stand on two lines, the words of a name don't
_PARTY = rf"{_TITLE}{_S}{_WORD}(?:[ \x{{00A0}}]+{_WORD})*"
_COUNT = r"(?<!\w)(?:[0-9]{1,3}(?:[ \x{00A0}\x{202F}.][0-9]{3})+|[0-9]+)"
_SHARES = rf"{_COUNT}\s+(?:[Pp]arts?|[Aa]ctions?|PARTS?|ACTIONS?)"
_TO = r"(?:à|À|a|A|au profit de|AU PROFIT DE)"
_OF = r"[^0-9;]{0,60}?"
# a taker and a number of shares in either order, and several of these after one verb
_PAIR = rf"(?:{_TO}\s+{_PARTY}{_S}(?:[a-zéèà', ]{{0,40}}\s)?{_SHARES}|{_SHARES}{_OF}\s{_TO}\s+{_PARTY})"
_CEDES = rf"{_PARTY}{_S}(?:cède|CÈDE|CEDE|cede)(?: et transporte)?\s+{_PAIR}(?:[^0-9.;]{{0,40}}?\bet\s+{_PAIR})*"
_CESSION = rf"(?:[Cc]ession|CESSION)\s+(?:de|DE)\s+{_SHARES}{_OF}\s(?:par|PAR)\s+{_PARTY}\s+{_TO}\s+{_PARTY}"
_SUBSCRIBES = rf"{_PARTY}{_S}(?:souscrit|SOUSCRIT)(?:\s+(?:à|À|A))?\s+{_SHARES}"
#: Sentences that move shares: ``X cède à Y n parts (et à Z m parts)``, ``cession de n parts par X à Y``, ``Y souscrit n actions``.
MOVEMENT = f"(?:{_CEDES}|{_CESSION}|{_SUBSCRIBES})"


def party(text: Column) -> Column:
    """A holder's name in normal form, without title."""
    return french.company_name(F.regexp_replace(text, rf"^{_TITLE}[\s;,]+", ""))


def _number(text: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(text, _SHARES, 0), "[^0-9]", "").try_cast("long")


def movements(found: DataFrame) -> DataFrame:
    """Movements of shares that blocks of text tell: doc_id, at (the sentence's offset), k (from 0 in it), giver, taker, shares, date, text and lines.

    A sentence with several takers gives one row for each. A subscription has no giver. ``date`` is the last date at or
    before the sentence's end in the block, null if there is none; one that the text gives as its deposit's is passed over.
    """
    said = matches(found.withColumn("before", F.struct("text", "start")), MOVEMENT, "before")
    whole = F.substring(F.col("before.text"), F.lit(1), (F.col("end") - F.col("before.start")).cast("int"))
    first = F.regexp_extract("text", rf"^({_PARTY}){_S}(?:cède|CÈDE|CEDE|cede|souscrit|SOUSCRIT)\b", 1)
    each = F.regexp_extract_all("text", F.lit(_PAIR), F.lit(0))
    row = lambda giver, taker, shares: F.struct(party(giver).alias("giver"), party(taker).alias("taker"), shares.alias("shares"))
    none = F.lit(None).cast("string")
    # in a pair the taker is the only party; after "par" there are two, giver first
    ceded = F.transform(each, lambda x: row(first, F.regexp_extract(x, _PARTY, 0), _number(x)))
    tail = F.regexp_extract("text", rf"(?s)\s(?:par|PAR)\s+({_PARTY}\s+{_TO}\s+{_PARTY})$", 1)
    giver = F.regexp_extract(tail, rf"(?s)^({_PARTY})\s+{_TO}\s+{_PARTY}$", 1)
    taker = F.regexp_extract(tail, rf"(?s)^{_PARTY}\s+{_TO}\s+({_PARTY})$", 1)
    moves = (
        F.when(F.col("text").rlike(rf"^{_SUBSCRIBES}$"), F.array(row(none, first, _number(F.col("text")))))
        .when(F.col("text").rlike(r"^(?i:cession)\s"), F.array(row(giver, taker, _number(F.col("text")))))
        .otherwise(ceded)
    )
    rows = said.select("doc_id", "at", "text", "lines", french.last_date(whole).alias("date"), F.posexplode(moves).alias("k", "m"))
    return rows.select("doc_id", "at", "k", "m.giver", "m.taker", "m.shares", "date", "text", "lines")


# --- evidence ---------------------------------------------------------------------------------------------


def tokens(text: Column) -> Column:
    """Distinct runs of letters and digits, without accents and case."""
    return F.array_distinct(F.regexp_extract_all(french.folded(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)))


def evidence(decisions: DataFrame, lines: DataFrame, least: float = 0.5) -> DataFrame:
    """The line that best holds each decision's words: doc_id, decision_id, page, pos, box, score; nulls where none reaches ``least``.

    ``decisions`` are (doc_id, decision_id, text), ``lines`` (doc_id, page, pos, text, box). A word weighs 1000 ln(1 + documents / documents
    with it), rounded, over the lines of all documents. The score is the weight of the decision's words that the line has too, by that
    of all its words; words that no line has weigh as if one document had them. Best is the highest score, then the line of fewest words, then the first. Both sides meet in an
    inverted index by document and word, so only lines that share a word with a decision are looked at.
    """
    # lines are parsed once; of their words only those that some decision has are counted
    parsed = land(lines.select("doc_id", "page", "pos", tokens(F.col("text")).alias("tokens")), "tokens")
    index = parsed.select("doc_id", "page", "pos", F.size("tokens").alias("size"), F.explode("tokens").alias("token"))
    n = parsed.agg(F.count_distinct("doc_id").alias("n"))
    asked = land(decisions.select("doc_id", "decision_id", F.explode(tokens(F.col("text"))).alias("token")), "asked")
    df = index.select("doc_id", "token").join(asked.select("token").distinct(), "token", "left_semi").distinct().groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    # the only row of n is a scalar of the plan
    weight = F.round(1000 * F.log1p(n.scalar() / F.coalesce("df", F.lit(1)))).cast("long")
    asked = asked.join(df, "token", "left").select("doc_id", "decision_id", "token", weight.alias("weight"))
    total = asked.groupBy("doc_id", "decision_id").agg(F.sum("weight").alias("total"))
    hit = asked.join(index, ["doc_id", "token"]).groupBy("doc_id", "decision_id", "page", "pos", "size").agg(F.sum("weight").alias("hit"))
    order = F.struct((-F.col("hit")).alias("less"), "size", "page", "pos")
    best = hit.groupBy("doc_id", "decision_id").agg(F.min(order).alias("best"))
    best = best.join(total, ["doc_id", "decision_id"]).select("doc_id", "decision_id", "best.page", "best.pos", (-F.col("best.less") / F.col("total")).alias("score"))
    best = best.where(F.col("score") >= least).join(lines.select("doc_id", "page", "pos", "box"), ["doc_id", "page", "pos"])
    return decisions.select("doc_id", "decision_id").join(best, ["doc_id", "decision_id"], "left").select("doc_id", "decision_id", "page", "pos", "box", "score")
