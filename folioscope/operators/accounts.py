"""Values of annual accounts: choosing, deriving and checking them. Fields and formulas are tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import french
from folioscope.storage import land

#: The one field whose code is known, and two that are named; users supply the registry for others.
FIELDS = [("BS_TOTAL_ASSETS_FRGAAP", "total assets", True), (None, "cost of goods sold", True), (None, "average workforce", False)]


def latest(filings: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``, which must be total."""
    ranked = filings.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def document_unit(lines: DataFrame, key: str, thousands: str = r"(?i)\b(k€|keur|milliers d.euros?)") -> DataFrame:
    """(key, unit): kEUR if any line says so, else EUR."""
    return lines.groupBy(key).agg(F.when(F.max(F.coalesce(F.col("text").rlike(thousands), F.lit(False))), "kEUR").otherwise("EUR").alias("unit"))


def _marked(lines: DataFrame) -> DataFrame:
    """Lines with their own code and the form that their page names, null if it names several: one scan, one sort per page."""
    page = Window.partitionBy("doc_id", "page")
    own = lines.withColumn("_own", french.form_number(F.col("text"))).withColumn("code", french.line_code(F.col("text")))
    lo, hi = F.min("_own").over(page), F.max("_own").over(page)
    return own.withColumn("form", F.when(lo == hi, lo)).drop("_own")


def field_candidates(lines: DataFrame, registry: DataFrame) -> DataFrame:
    """Lines that a registry of (field, form, code) names by their page's form and their own line code.

    ``lines`` are (doc_id, page, pos, text) and other columns, which are kept. A page's form is the one number on it, null if
    there are several.
    """
    return _marked(lines).join(registry, ["form", "code"]).select("field", *lines.columns)


def right_of(labels: DataFrame, values: DataFrame) -> DataFrame:
    """For each label box (doc_id, page, pos) the values whose y range meets its own, as structs, numbered from 1 to the right.

    Both are (doc_id, page, pos, box); the join is on document and page, the geometry a residual condition.
    """
    a, b = labels.alias("a"), values.alias("b")
    same = (F.col("a.doc_id") == F.col("b.doc_id")) & (F.col("a.page") == F.col("b.page"))
    meets = (F.col("a.box")[1] < F.col("b.box")[3]) & (F.col("b.box")[1] < F.col("a.box")[3]) & (F.col("b.box")[0] >= F.col("a.box")[2])
    order = Window.partitionBy("a.doc_id", "a.page", "a.pos").orderBy(F.col("b.box")[0], "b.pos")
    ranked = a.join(b, same & meets).withColumn("_rank", F.row_number().over(order))
    return ranked.select("a.doc_id", "a.page", "a.pos", F.struct("b.*").alias("value"), F.col("_rank").alias("rank"))


def label_values(labels: DataFrame, values: DataFrame, column: int = 0) -> DataFrame:
    """For each label box the value on its row: the (column + 1)-th to its right."""
    found = right_of(labels, values).where(F.col("rank") == column + 1)
    return found.select("doc_id", "page", "pos", F.col("value.pos").alias("value_pos"), F.col("value.box").alias("value_box"))


#: A number as statements print it, and the numbers that end a line.
_TOKEN = r"[-(]?(?:[0-9]{1,3}(?:[ .\x{00A0}\x{202F}][0-9]{3})+(?![0-9])|[0-9]+)(?:,[0-9]{1,2})?\)?"
_TAIL = rf"^(.*[^ |0-9(,.-].*?[ |]+)({_TOKEN}(?:[ |]+{_TOKEN})*)[ |]*$"
#: What heads the column of the year, and of the year before; folded.
_HEADS = r"^ *(?:exercice|annee|montants?|net|total)? *:? *(n)( *- *1)?(?: *net)? *$"


def _numbers(text: Column, code: Column, box: Column) -> Column:
    """A line's numbers as structs (k, after: numbers that follow it, number, box): the line itself, or those after a label and code, each
    with its share of the box; only the last one's right edge is then known, the others' are estimates."""

    def at(label: Column, tail: Column, said: Column) -> Column:
        pieces = F.arrays_zip(F.split(tail, _TOKEN, -1).alias("gap"), F.regexp_extract_all(tail, F.lit(_TOKEN), F.lit(0)).alias("token"))
        pieces = F.filter(pieces, lambda p: p["token"].isNotNull())
        width = (box[2] - box[0]) / F.length(said)

        def one(p: Column, k: Column) -> Column:
            end = F.length(label) + F.aggregate(F.slice(pieces, 1, k + 1), F.lit(0), lambda n, x: n + F.length(x["gap"]) + F.length(x["token"]))
            place = F.array(box[0] + width * (end - F.length(p["token"])), box[1], box[0] + width * end, box[3])
            return F.struct(k.alias("k"), (F.size(pieces) - 1 - k).alias("after"), french.plain_number(p["token"]).alias("number"), place.alias("box"))

        return F.transform(pieces, one)

    whole = french.plain_number(text)
    alone = F.array(F.struct(F.lit(0).alias("k"), F.lit(0).alias("after"), whole.alias("number"), box.alias("box")))
    inline = at(F.regexp_extract(text, _TAIL, 1), F.regexp_extract(text, _TAIL, 2), text)
    return F.when(whole.isNotNull(), alone).when(code.isNotNull() & text.rlike(_TAIL), inline)


def columns(numbers: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Adds ``column``, from 1 at the left, to (doc_id, page, pos, k, after, number, box).

    Numbers whose right edges follow each other within ``tolerance`` times the page's mean height of a number share a column. A
    number that others follow in one line has no edge of its own: it goes to the nearest of the columns left of its line's last number, and
    where there is none to a column of its place in the line. All joins are within a page.
    """
    page = Window.partitionBy("doc_id", "page")
    edge = F.col("box")[2]
    order = page.orderBy(edge, "pos")
    height = F.avg(F.col("box")[3] - F.col("box")[1]).over(page)
    new = F.coalesce(edge - F.lag(edge).over(order) > tolerance * height, F.lit(True))
    sure = numbers.where("after = 0").withColumn("_new", new.cast("int")).withColumn("_at", F.sum("_new").over(order)).drop("_new")
    known = sure.groupBy("doc_id", "page", F.col("_at").alias("_c")).agg(F.avg(edge).alias("_edge"))
    ends = sure.select("doc_id", "page", "pos", F.col("_at").alias("_end"))
    near = numbers.where("after > 0").join(ends, ["doc_id", "page", "pos"]).join(known, ["doc_id", "page"], "left")
    best = F.min_by(F.when(F.col("_c") < F.col("_end"), F.col("_c")), F.when(F.col("_c") < F.col("_end"), F.struct(F.abs(F.col("_edge") - edge), "_c")))
    near = near.groupBy(*numbers.columns).agg(best.alias("_at")).withColumn("_at", F.coalesce("_at", -F.col("after")))
    return sure.unionByName(near).withColumn("column", F.dense_rank().over(page.orderBy("_at"))).drop("_at")


def column_years(placed: DataFrame, heads: DataFrame) -> DataFrame:
    """(doc_id, page, column, year) of the columns that stand for the year (0) and the year before (1).

    A head (doc_id, page, pos, year, box) names the column whose width it overlaps most (ties: the left one). On a page where no head meets a
    column the first column is the year's and the second that of the year before.
    """
    sure = lambda f, k: F.coalesce(f(F.when(F.col("after") == 0, F.col("box")[k])), f(F.col("box")[k]))
    # a number read with its label has no left edge of its own either, but its share of the box is near it
    wide = placed.groupBy("doc_id", "page", "column").agg(sure(F.min, 0).alias("x0"), sure(F.max, 2).alias("x1"))
    met = wide.join(heads, ["doc_id", "page"]).withColumn("shared", F.least("x1", F.col("box")[2]) - F.greatest("x0", F.col("box")[0])).where("shared > 0")
    named = met.groupBy("doc_id", "page", "year").agg(F.min(F.struct((-F.col("shared")).alias("less"), "column")).alias("best"))
    named = named.select("doc_id", "page", F.col("best.column").alias("column"), "year")
    plain = wide.join(named.select("doc_id", "page").distinct(), ["doc_id", "page"], "left_anti").where("column <= 2")
    return named.unionByName(plain.select("doc_id", "page", "column", (F.col("column") - 1).cast("int").alias("year")))


def field_values(lines: DataFrame, registry: DataFrame) -> DataFrame:
    """Values of the registry's fields: field, doc_id, page, pos, unit, value (year N) and previous (N-1).

    ``lines`` are (doc_id, page, pos, text, box). A field's line is found by form and code. Its values are the numbers on its row in the columns
    that the page has for both years, scaled by the document's unit; a blank stays null, whatever the other column holds. A line that
    OCR read together with its numbers is split. Of several numbers in one column and row the one that overlaps the row most counts.
    Lines are read and parsed once, and landed.
    """
    marked = _marked(lines)
    head = F.regexp_extract(french.folded("text"), _HEADS, 1) != ""
    before = F.regexp_extract(french.folded("text"), _HEADS, 2) != ""
    parsed = land(marked.select("doc_id", "page", "pos", "text", "box", "form", "code", _numbers(F.col("text"), F.col("code"), F.col("box")).alias("numbers"), F.when(head, before.cast("int")).alias("year")), "parsed")
    numbers = parsed.select("doc_id", "page", "pos", F.explode("numbers").alias("n")).select("doc_id", "page", "pos", "n.*").where("number is not null")
    placed = columns(numbers)
    years = column_years(placed, parsed.where("year is not null").select("doc_id", "page", "pos", "year", "box"))
    dated = placed.join(years, ["doc_id", "page", "column"]).select("doc_id", "page", F.col("pos").alias("n_pos"), "k", "number", "year", F.col("box").alias("n_box"))
    fields = parsed.join(registry, ["form", "code"]).select("field", "doc_id", "page", "pos", "box")
    shared = F.least(F.col("box")[3], F.col("n_box")[3]) - F.greatest(F.col("box")[1], F.col("n_box")[1])
    row = fields.join(dated, ["doc_id", "page"]).withColumn("shared", shared).where("shared > 0 and (n_pos = pos or n_box[0] >= box[2])")
    of = lambda y: F.max_by(F.when(F.col("year") == y, F.col("number")), F.when(F.col("year") == y, F.struct("shared", -F.col("n_pos"), -F.col("k"))))
    read = row.groupBy("field", "doc_id", "page", "pos").agg(of(0).alias("value"), of(1).alias("previous"))
    out = fields.drop("box").join(read, ["field", "doc_id", "page", "pos"], "left").join(document_unit(parsed, "doc_id"), "doc_id")
    scaled = [french.scaled(F.col(c), F.col("unit")).alias(c) for c in ("value", "previous")]
    return out.select("field", "doc_id", "page", "pos", "unit", *scaled)


def text_rows(lines: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Adds ``row``: lines whose vertical centres lie within ``tolerance`` of a line's height follow on one row."""
    centre = (F.col("px_y0") + F.col("px_y1")) / 2
    order = Window.partitionBy("doc_id", "page").orderBy("_c", "pos")
    out = lines.withColumn("_c", centre)
    new = F.coalesce(F.col("_c") - F.lag("_c").over(order) > tolerance * (F.col("px_y1") - F.col("px_y0")), F.lit(False))
    return out.withColumn("_new", new.cast("int")).withColumn("row", F.sum("_new").over(order)).drop("_c", "_new")


def unbalanced(rows: DataFrame, a: Column, b: Column, tolerance: float) -> DataFrame:
    """Rows whose two sides differ by more than the tolerance, with the difference."""
    return rows.withColumn("difference", a - b).where(F.abs("difference") > tolerance)


def derived(components: DataFrame, registry: DataFrame, keys: list[str]) -> DataFrame:
    """Σ coefficient * value per key over the registry's components; null if a required one is missing.

    ``components``: keys, component, value; a component given several times counts with the sum of its values, and is there
    if one of them is not null. ``registry``: component, coefficient, required; it is small by nature.
    """
    joined = components.join(registry, "component")
    need = registry.where("required").select("component").distinct().count()
    # of distinct components, so no more than the registry has
    has = F.size(F.collect_set(F.when(F.col("required") & F.col("value").isNotNull(), F.col("component"))))
    summed = joined.groupBy(*keys).agg(F.sum(F.col("value") * F.col("coefficient")).alias("_sum"), has.alias("_has"))
    return summed.select(*keys, F.when(F.col("_has") == need, F.col("_sum")).alias("value"))


def restatements(values: DataFrame, keys: list[str], year: str, value: str) -> DataFrame:
    """A year's value beside that of the year before, joined on the year itself: skipped years have no neighbour."""
    before = values.select(*keys, (F.col(year) + 1).alias(year), F.col(value).alias("before"))
    return values.join(before, [*keys, year])


def run_costs(metrics: DataFrame, by: str) -> DataFrame:
    """Cost and seconds per page: ratios of sums, null without pages."""
    pages = F.sum("pages")
    return metrics.groupBy(by).agg(F.try_divide(F.sum("cost_eur"), pages).alias("cost_per_page"), F.try_divide(F.sum("seconds"), pages).alias("seconds_per_page"))
