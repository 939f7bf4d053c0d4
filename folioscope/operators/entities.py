"""Company names to identifiers, and the ownership graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.storage import land, release


def shortened(name: Column, distance: int) -> Column:
    """All strings that up to ``distance`` deletions make of a name, itself included."""

    def without_one(s: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.length(s)), lambda i: i > 0)
        return F.transform(places, lambda i: F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1)))

    out = F.array(name)
    for _ in range(distance):
        out = F.array_distinct(F.concat(out, F.flatten(F.transform(out, without_one))))
    return out


def resolved(mentions: DataFrame, companies: DataFrame, distance: int = 1) -> DataFrame:
    """Mentions (mention_id, name) with the company they name: company_id, or null with resolved = false.

    Names are in normal form. Two names within ``distance`` edits have a form in common that at most as many
    deletions make of each, so both sides are joined on these forms: near names meet, others hardly ever, also
    where all names begin alike. The nearest company wins; if two are equally near, none does.
    """
    # each name once, however often it is said
    a = mentions.where("name is not null").select(F.col("name").alias("said")).distinct().select("said", F.explode(shortened(F.col("said"), distance)).alias("form"))
    b = companies.where("name is not null").select("company_id", F.col("name").alias("known"), F.explode(shortened(F.col("name"), distance)).alias("form"))
    near = a.join(b, "form").select("said", "company_id", F.levenshtein("said", "known", distance).alias("d")).where("d >= 0")
    # of the nearest companies the smallest and the largest id, in one aggregate; ids may be numbers or texts
    best = near.groupBy(F.col("said").alias("name")).agg(F.min(F.struct("d", "company_id")).alias("lo"), F.max(F.struct((-F.col("d")).alias("minus"), "company_id")).alias("hi"))
    out = mentions.join(best, "name", "left")
    one = F.coalesce(F.col("lo.company_id") == F.col("hi.company_id"), F.lit(False))
    return out.select("mention_id", "name", F.when(one, F.col("lo.company_id")).alias("company_id"), one.alias("resolved"))


def closure(edges: DataFrame, depth: int | None = None) -> DataFrame:
    """All (owner, owned, hops) reachable over edges (owner, owned), hops least; cycles end.

    After a round all paths of up to n hops are known, and n doubles. A shortest way of more than n hops begins with one of exactly n,
    so only these are joined with the paths known: every pair comes from few of its possible middles, not from all. It ends when no path has n
    hops. With paths of more than ``depth`` hops, if it is given, it raises.
    """
    edges = edges.select("owner", "owned").where("owner is not null and owned is not null").distinct()
    found, n = land(edges.withColumn("hops", F.lit(1)), "paths"), 1
    while True:
        first = found.where(F.col("hops") == n).select("owner", F.col("owned").alias("via"))
        if first.isEmpty():
            break
        second = found.select(F.col("owner").alias("via"), "owned", (F.col("hops") + n).alias("hops"))
        more = first.join(second, "via").select("owner", "owned", "hops")
        last, found, n = found, land(found.unionByName(more).groupBy("owner", "owned").agg(F.min("hops").alias("hops")), "paths"), 2 * n
        release(last)
        if depth is not None and n > depth and not found.where(F.col("hops") > depth).isEmpty():
            raise ValueError(f"there are paths of more than {depth} hops")
    if depth is not None and not found.where(F.col("hops") > depth).isEmpty():
        raise ValueError(f"there are paths of more than {depth} hops")
    return found


def graph(edges: DataFrame, evidence: Column) -> tuple[DataFrame, DataFrame]:
    """Nodes (name, siren, resolved) and edges with evidence; an edge without evidence is left out."""
    kept = edges.where(evidence.isNotNull())
    ends = kept.select(F.col("from_name").alias("name"), F.col("from_siren").alias("siren")).unionByName(kept.select(F.col("to_name").alias("name"), F.col("to_siren").alias("siren")))
    nodes = ends.groupBy("name").agg(F.min("siren").alias("lo"), F.max("siren").alias("hi"))
    siren = F.when(F.col("lo") == F.col("hi"), F.col("lo"))
    return nodes.select("name", siren.alias("siren"), siren.isNotNull().alias("resolved")), kept
