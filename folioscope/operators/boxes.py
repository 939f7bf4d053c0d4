"""Boxes of whole pages: their skew fitted on the text, rows of turned pages, and submitted boxes against the text they hit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import geometry
from folioscope.operators import accounts
from folioscope.storage import land, release

#: Cells along each side of a page, for boxes of fractions.
CELLS = 16
#: Boxes of one side up to which a page is matched as one value; beyond, its pairs are rows of a table.
MOST = 256
_PAGE = ["doc_id", "page"]


def page_skew(lines: DataFrame) -> DataFrame:
    """(doc_id, page, fitted, n_lines): the angle of a page's text in degrees, positive where lines fall to the right.

    ``lines`` are (doc_id, page, pos, polygon). A line's angle is that of its first edge (upper left to upper right), its weight
    the edge's length in whole pixels; the page's is the weighted median, the least angle at which half of all weight is reached, so that stamps and
    upright text don't count as long as they are the lesser part. Lines without two points or without length take no part.
    """
    at = lambda i, k: F.get(F.get("polygon", F.lit(i)), F.lit(k))
    dx, dy = at(1, 0) - at(0, 0), at(1, 1) - at(0, 1)
    edges = lines.select("doc_id", "page", "pos", F.degrees(F.atan2(dy, dx)).alias("angle"), F.round(F.sqrt(dx * dx + dy * dy)).cast("long").alias("weight")).where("weight > 0")
    page = Window.partitionBy("doc_id", "page")
    cum = F.sum("weight").over(page.orderBy("angle", "pos").rowsBetween(Window.unboundedPreceding, 0))
    ranked = edges.withColumn("_cum", cum).withColumn("_half", F.sum("weight").over(page) / 2)
    return ranked.groupBy("doc_id", "page").agg(F.min(F.when(F.col("_cum") >= F.col("_half"), F.col("angle"))).alias("fitted"), F.count(F.lit(1)).alias("n_lines"))


def skew_findings(fits: DataFrame, given: DataFrame, tolerance: float = 0.3) -> DataFrame:
    """Fits beside the ``skew_angle`` (doc_id, page, skew_angle) that a page came with, and a finding.

    ``agrees`` or ``opposite`` (it has the other sign) within ``tolerance`` degrees, ``differs`` otherwise, ``not given`` for a null. An angle that is
    near zero agrees rather than being opposite.
    """
    a, b = F.col("fitted"), F.col("skew_angle")
    finding = F.when(b.isNull(), "not given").when(F.abs(a - b) <= tolerance, "agrees").when(F.abs(a + b) <= tolerance, "opposite").otherwise("differs")
    return fits.join(given, ["doc_id", "page"], "left").withColumn("finding", finding)


def skew_sign(findings: DataFrame, by: str) -> DataFrame:
    """Per group the sign by which its skew angles have to be read: 1, -1 where more pages are opposite than agree, null where neither is seen."""
    agree, against = F.count_if(F.col("finding") == "agrees"), F.count_if(F.col("finding") == "opposite")
    return findings.groupBy(by).agg(F.when(agree + against > 0, F.when(agree >= against, 1).otherwise(-1)).alias("sign"), agree.alias("n_agree"), against.alias("n_opposite"))


def level_rows(lines: DataFrame, fits: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Lines with their box after the page is turned level (px_x0, px_y0, px_x1, px_y1) and ``row`` by it; pages without fit stay as they are.

    ``lines`` are (doc_id, page, pos, polygon) with four points, and other columns, which are kept.
    """
    angle = F.coalesce(F.col("fitted"), F.lit(0.0))
    joined = lines.join(fits.select("doc_id", "page", "fitted"), ["doc_id", "page"], "left")
    at = lambda i, k: F.get(F.get("polygon", F.lit(i)), F.lit(k))
    turned = [geometry.rotated(at(i, 0), at(i, 1), -angle) for i in range(4)]
    sides = [(n, f(*[p[k] for p in turned])) for n, f, k in (("px_x0", F.least, 0), ("px_y0", F.least, 1), ("px_x1", F.greatest, 0), ("px_y1", F.greatest, 1))]
    return accounts.text_rows(joined.select(*lines.columns, *[c.alias(n) for n, c in sides]).where("px_y0 is not null"), tolerance)


# --- submitted boxes --------------------------------------------------------------------------------------


def _cells(box: Column, cells: int) -> Column:
    """Numbers of the cells of a page that a box of fractions meets; what lies beyond the page is in its border cells."""
    place = lambda v: F.least(F.greatest(F.floor(v * cells), F.lit(0)), F.lit(cells - 1))
    xs, ys = F.sequence(place(box[0]), place(box[2])), F.sequence(place(box[1]), place(box[3]))
    return F.flatten(F.transform(ys, lambda y: F.transform(xs, lambda x: y * cells + x)))


def _usable(box: Column) -> Column:
    return box.isNotNull() & (box[0] <= box[2]) & (box[1] <= box[3])


def overlapping(a: DataFrame, b: DataFrame, cells: int = CELLS) -> DataFrame:
    """Pairs (doc_id, page, a, b, overlap: intersection over union) of boxes of one page that meet.

    Both are (doc_id, page, id, box) with boxes of fractions, x0 <= x1 and y0 <= y1. A tiled join: each box goes to all cells it
    meets, and a pair counts in the cell of the upper left corner of what both share, so it comes out once without a distinct.
    """
    tiled = lambda t, n: t.where(_usable(F.col("box"))).select("doc_id", "page", F.col("id").alias(n), F.col("box").alias(f"_{n}"), F.explode(_cells(F.col("box"), cells)).alias("cell"))
    x, y = F.greatest(F.col("_a")[0], F.col("_b")[0]), F.greatest(F.col("_a")[1], F.col("_b")[1])
    corner = _cells(F.array(x, y, x, y), cells)[0]
    pairs = tiled(a, "a").join(tiled(b, "b"), ["doc_id", "page", "cell"]).where(F.col("cell") == corner)
    return pairs.withColumn("overlap", geometry.overlap(F.col("_a"), F.col("_b"))).where("overlap > 0").select("doc_id", "page", "a", "b", "overlap")


def one_to_one(pairs: DataFrame, keys: list[str], a: str, b: str, order: list[Column]) -> DataFrame:
    """The pairs of the greedy matching: pairs are taken by ``order``, which must be total within ``keys``, if neither end is taken yet. Landed.

    Each round takes all pairs that are the first of both their ends and drops those that share an end with one; what it leaves has
    no smaller pair, so the result is the same as taking them one by one.
    """
    left = land(pairs.withColumn("_rank", F.struct(*order)), "pairs")
    taken, used = None, []
    while True:
        by = lambda end: left.groupBy(*keys, end).agg(F.min("_rank").alias("_first"))  # noqa: B023, E731
        first = left.join(by(a).withColumnRenamed("_first", "_fa"), [*keys, a]).join(by(b).withColumnRenamed("_first", "_fb"), [*keys, b])
        now = land(first.where("_rank = _fa and _rank = _fb").select(*left.columns), "taken")
        used.append(now)
        taken = now if taken is None else taken.unionByName(now)
        rest = left.join(now.select(*keys, a), [*keys, a], "left_anti").join(now.select(*keys, b), [*keys, b], "left_anti")
        rest = land(rest.select(*left.columns), "pairs")
        release(left)
        left = rest
        if left.isEmpty():
            out = land(taken.drop("_rank"), "matched")
            release(left, *used)
            return out


def _crowded(*sides: DataFrame, most: int) -> DataFrame:
    """Pages with more than ``most`` boxes of one side. Landed."""
    many = [t.groupBy(*_PAGE).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(*_PAGE) for t in sides]
    return land(reduce(DataFrame.unionByName, many).distinct(), "crowded")


def _by_page(submitted: DataFrame, lines: DataFrame) -> DataFrame:
    """``submitted`` with line, overlap and _read, each page matched as one value: both sides move once, and pairs are never rows.

    Boxes that aren't usable share nothing with others, so no filter sets the sides apart, and a caller's shuffle may serve both.
    """
    line = F.struct(F.col("id").alias("b"), "box", F.col("text").alias("_read"))
    listed = submitted.join(lines.groupBy(*_PAGE).agg(F.collect_list(line).alias("_lines")), _PAGE, "left")
    shared = lambda p, q, k: F.least(p[k + 2], q[k + 2]) - F.greatest(p[k], q[k])
    met = F.filter("_lines", lambda x: (shared(F.col("box"), x["box"], 1) > 0) & (shared(F.col("box"), x["box"], 0) > 0))
    less = lambda x: -F.round(geometry.overlap(F.col("box"), x["box"]), 9)
    pair = lambda x: F.struct(less(x).alias("less"), F.col("id").alias("a"), x["b"].alias("b"), x["_read"].alias("_read"))
    own = F.filter(F.transform(met, pair), lambda x: -x["less"] > 0)
    boxed = F.struct(*submitted.drop(*_PAGE).columns)
    pages = listed.select("*", own.alias("_own")).groupBy(*_PAGE).agg(F.collect_list(boxed).alias("_boxes"), F.sort_array(F.flatten(F.collect_list("_own"))).alias("_pairs"))
    free = lambda t, x: ~F.exists(t, lambda y: (y["a"] == x["a"]) | (y["b"] == x["b"]))
    greedy = F.aggregate("_pairs", F.slice("_pairs", 1, 0), lambda t, x: F.when(free(t, x), F.concat(t, F.array(x))).otherwise(t))
    once = lambda end: F.size(F.array_distinct(f"_pairs.{end}")) == F.size("_pairs")
    best = pages.select(*_PAGE, "_boxes", F.when(once("a") & once("b"), F.col("_pairs")).otherwise(greedy).alias("_best"))
    found = best.select(*_PAGE, F.map_from_arrays("_best.a", "_best").alias("_taken"), F.explode("_boxes").alias("_box"))
    found = found.select(*_PAGE, "_box.*", F.col("_taken")[F.col("_box.id")].alias("_pair"))
    return found.select(*submitted.columns, F.col("_pair.b").alias("line"), (-F.col("_pair.less")).alias("overlap"), "_pair._read")


def _by_pairs(submitted: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same for pages with any number of boxes, in rounds over a table of pairs; and the landed pairs that it reads."""
    pairs = overlapping(submitted, lines).withColumn("overlap", F.round("overlap", 9)).where("overlap > 0")
    best = one_to_one(pairs, _PAGE, "a", "b", [(-F.col("overlap")).alias("less"), F.col("a"), F.col("b")])
    read = lines.select(*_PAGE, F.col("id").alias("b"), F.col("text").alias("_read"))
    taken = best.join(read, [*_PAGE, "b"]).select(*_PAGE, F.col("a").alias("id"), F.col("b").alias("line"), "overlap", "_read")
    return submitted.join(taken, [*_PAGE, "id"], "left").select(*submitted.columns, "line", "overlap", "_read"), best


def accuracy(submitted: DataFrame, lines: DataFrame, least: float = 0.5, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """Which text each submitted box hits, and how often it is the right one.

    ``submitted`` are (id, doc_id, page, field, box, text), ``lines`` (id, doc_id, page, box, text), boxes as fractions; ids are unique in a
    page. A box is given the line it overlaps most and a line one box at most, the largest overlaps first, to nine digits (ties: smaller ids). It hits
    where the overlap is at least ``least``, and is right where the line's text then is the submitted one, white space at the ends aside.
    What has no id, document or page takes no part, though submitted boxes count. Pages with up to ``most`` boxes on either side are matched
    within a row of their own, others through a table of pairs; the result is the same.

    Returns the boxes with line, overlap, hit and right, which are landed, and per field and document n, hits, right and accuracy (right / n).
    """
    placed = "doc_id is not null and page is not null and id is not null"
    a, b = submitted.where(placed), lines.where(placed)
    crowded = _crowded(a, b, most=most)
    found, matched = _by_page(*(t.join(crowded, _PAGE, "left_anti") for t in (a, b))), None
    if not crowded.isEmpty():
        full, matched = _by_pairs(*(t.join(crowded, _PAGE, "left_semi") for t in (a, b)))
        found = found.unionByName(full)
    found = found.unionByName(submitted.where(f"not ({placed})"), allowMissingColumns=True)
    hit = F.coalesce(F.col("overlap") >= least, F.lit(False))
    found = found.withColumn("hit", hit).withColumn("right", hit & F.coalesce(F.trim("text") == F.trim("_read"), F.lit(False))).drop("_read")
    boxes = land(found, "boxes")
    release(crowded, matched)
    n, right = F.count(F.lit(1)), F.count_if("right")
    return boxes, boxes.groupBy("field", "doc_id").agg(n.alias("n"), F.count_if("hit").alias("hits"), right.alias("n_right"), (right / n).alias("accuracy"))
