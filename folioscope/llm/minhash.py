"""Near-duplicate documents: MinHash banding, signature and exact verification, connected components.

A document's set is its distinct ``size``-word shingles; a document with fewer words has its whole word
sequence as the one shingle, one without words has an empty set and is linked with nothing. Documents whose
sets have a Jaccard similarity of at least ``percent`` / 100 are linked; a group is a connected component.

1. One pass over the texts makes, per document, the number of shingles, a 128-bit digest of the set, the
   minima of BANDS * ROWS universal hashes as band keys, and one bit of each minimum.
2. Documents of equal sets form a class (a partial aggregate on the digest); only the smallest doc_id of a
   class goes on as a vertex, so that thousands of copies cost one row.
3. Of every band bucket with two vertices or more, all members are paired with one leader, the member whose
   buckets are the largest: the centre of a group of near copies. So a bucket of n members gives n - 1 pairs.
4. Pairs whose bits can't reach the similarity are dropped, the rest is confirmed on full sets, and components
   are found by alternating large-star and small-star. A leader's set is sent once per HUB pairs.
5. Only where members of one leader's buckets are in two components can a link still hide. All links among these members
   are found by a prefix filter, which is exact: with shingles in order from the rarest to the most frequent, two sets of
   the similarity share one of the first shingles of both, as many as their sizes tell. Shingles that no two components
   share come first and are never sent, so texts that have a template in common, however many, and words of their own in its gaps
   meet nowhere unless they are within about a hundredth of the similarity. Sizes are dealt to classes of a fiftieth. Up to PAIRED
   sets that meet at a shingle are paired. Those that meet at more frequent ones (versions of one text with scattered changes,
   just below the similarity) are compared leader by leader, the members outside the leader's component with all of them, in blocks
   of ASKED and OTHERS documents, as matrix products that return links only; their work grows with the square of such a
   group, divided by the blocks' sizes. Then components are found once more. After that every pair that shares a bucket is in one component or proven unlinked, but for
   the bits' error (under 1e-7 for a linked pair), and no bucket needs a cap.

At similarity 0.8, a pair shares no bucket with probability (1 - 0.8**5)**38 < 3e-7. Full sets are of 64-bit hashes: that any
two of a billion different shingles are taken for one has a probability below 0.03.

Nulls: a null text has no words. A row with null doc_id is linked with nothing; its component is null and it
is kept. Rows that repeat a doc_id are one vertex. An empty table gives an empty result. Landed tables are removed once
they are used up, but for the three that the result is read from.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.components import components
from folioscope.llm.words import WordHashes, blank_words, grams, mix
from folioscope.storage import BROADCAST_BYTES, bounded_batches, frugal, land, release

BANDS, ROWS = 38, 5
#: Pairs for which a leader's set is sent once; sizes up to which a class of sizes is one size, and the others' ratio.
HUB, SINGLE, RATIO = 256, 50, 1.02
#: Rows of a prefix shingle up to which they are paired; documents in a block of those that meet at more frequent ones.
PAIRED, ASKED, OTHERS = 64, 128, 256
#: 32-bit odd multipliers and addends of the hashes a * x + b (mod 2**32), from a fixed seed.
_RANDOM = np.random.default_rng(20_250_101)
_A = (_RANDOM.integers(0, 2**31, BANDS * ROWS, np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _RANDOM.integers(0, 2**32, BANDS * ROWS, np.uint32)
_BAND = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def shingles(hashes: WordHashes, text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = hashes.of(blank_words(text))
    return np.unique(grams(words, min(size, len(words)) or 1))


def minima(x: np.ndarray) -> np.ndarray:
    """Minimum of every hash over the (not empty) shingles."""
    x = (x >> np.uint64(32)).astype(np.uint32)
    out = None
    for k in range(0, len(x), 1024):
        y = np.multiply.outer(_A, x[k : k + 1024])
        y += _B[:, None]
        least = y.min(1)
        out = least if out is None else np.minimum(out, least)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    out = _BAND.copy()
    for column in least.reshape(BANDS, ROWS).T.astype(np.uint64):
        out = mix((out ^ column) * np.uint64(0x9E3779B97F4A7C15))
    return out.view(np.int64)


def bits(least: np.ndarray) -> np.ndarray:
    """One bit of every minimum, in three 64-bit integers."""
    one = ((least * np.uint32(0x9E3779B1)) >> np.uint32(31)).astype(np.uint8)
    return np.packbits(np.concatenate([one, np.zeros(192 - len(one), np.uint8)])).view(np.int64)


def _signatures(size: int):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            n, key, bands, sig = [], [], [], []
            for text in batch.column(1).to_pylist():
                x = shingles(hashes, text, size)
                n.append(len(x))
                if not len(x):
                    key.append(None), bands.append(None), sig.append(None)
                    continue
                key.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
                least = minima(x)
                bands.append(band_keys(least))
                sig.append(bits(least))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(bands, longs), pa.array(sig, longs)], ["doc_id", "n_shingles", "key", "bands", "bits"])

    return run


def _sets(size: int):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(hashes, t, size).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "set"])

    return run


def _least_equal_bits(percent: int) -> int:
    """Of BANDS * ROWS bits, so many are equal at the similarity, less six standard deviations."""
    n, p = BANDS * ROWS, (1 + percent / 100) / 2
    return int(n * p - 6 * (n * p * (1 - p)) ** 0.5)


def _alike(a: str, b: str, percent: int):
    """Whether sizes and bits of the vertices in structs ``a`` and ``b`` allow the similarity."""
    differ = sum((F.bit_count(F.col(f"{a}.bits")[i].bitwiseXOR(F.col(f"{b}.bits")[i])) for i in range(3)), F.lit(0))
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (100 * small >= percent * large) & (differ <= BANDS * ROWS - _least_equal_bits(percent))


def _possible(pairs: DataFrame, vertices: DataFrame, percent: int) -> DataFrame:
    """Of pairs (hub, id), those whose sizes and bits allow the similarity; landed."""
    named = lambda key, name: vertices.select(F.col("doc_id").alias(key), F.struct("n", "bits").alias(name))
    both = pairs.join(named("id", "v"), "id").join(named("hub", "w"), "hub")
    return land(both.where(_alike("v", "w", percent)).select("hub", "id"), "pairs")


def _sets_of(ids: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, set) of some documents, landed; their ids are broadcast only if they are few."""
    ids = land(ids, "ids")
    small = 8 * ids.count() <= BROADCAST_BYTES // 8
    some = docs.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")
    sets = land(some.mapInArrow(frugal(_sets(size)), "doc_id long, set array<long>"), "sets")
    release(ids)
    return sets


def _linked(percent: int):
    """Links of rows (hub, block, id, set) in order, where the row of null id has the hub's set."""

    def run(batches):
        hub, own = None, None
        for batch in batches:
            column, a, b = batch.column(3), [], []
            flat, ends = column.flatten().to_numpy(), np.cumsum([0, *column.value_lengths().to_pylist()])
            for k, (h, i) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                x = flat[ends[k] : ends[k + 1]].view(np.uint64)
                if i is None:
                    hub, own = h, x.copy()
                    continue
                if h != hub:
                    raise RuntimeError("a hub's set is missing")
                few, many = (x, own) if len(x) < len(own) else (own, x)
                common = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())
                if 100 * common >= percent * (len(x) + len(own) - common):
                    a.append(h), b.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Of landed pairs (hub, id), those linked by their full sets, as landed (a, b)."""
    sets = _sets_of(pairs.select(F.explode(F.array("hub", "id")).alias("doc_id")).distinct(), docs, size)
    blocks = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / HUB).cast("int").alias("blocks"))
    placed = land(pairs.join(blocks, "hub").select("hub", F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("block"), "id"), "placed")
    of = lambda rows, key: rows.join(sets, F.col(key) == F.col("doc_id")).select("hub", "block", "id", "set")
    hubs = of(placed.select("hub", "block").distinct().withColumn("id", F.lit(None).cast("long")), "hub")
    rows = hubs.unionByName(of(placed, "id")).repartition("hub", "block").sortWithinPartitions("hub", "block", F.asc_nulls_first("id"))
    links = land(rows.mapInArrow(frugal(_linked(percent)), "a long, b long"), "links")
    release(sets, placed)
    return links


def _class(n: Column) -> Column:
    """The class of a set's size."""
    return F.when(n <= SINGLE, n).otherwise(SINGLE + F.floor(F.log(n / SINGLE) / float(np.log(RATIO)))).cast("int")


def _least(c: Column) -> Column:
    """A class's least size, or less."""
    return F.when(c <= SINGLE, c).otherwise(F.floor(SINGLE * F.pow(F.lit(RATIO), c - SINGLE))).cast("long")


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """Of (id, c, set) the shingles to meet others by: (shingle, lo, hi, id, c, n, place, low, high), landed.

    ``place`` is the shingle's in the set, rarest first; lo and hi are the classes of sizes that meet, low and high whether
    the set is of the one or the other.
    """
    held = sets.select("id", "c", F.size("set").cast("long").alias("n"), F.explode("set").alias("shingle"))
    shared = held.groupBy("shingle").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("often")).where("lo < hi")
    shared = land(shared.select("shingle", "often"), "shared")
    held = held.join(shared, "shingle")
    by_set = held.groupBy("id", "c", "n").agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("held"))
    n, least = F.col("n"), F.expr(f"({percent} * n + 99) div 100")
    first = by_set.withColumn("before", n - F.size("held"))
    first = first.withColumn("held", F.slice("held", F.lit(1), F.greatest(F.lit(0), n - least + 1 - F.col("before")).cast("int")))
    placed = first.select("id", "c", "n", "before", F.posexplode("held").alias("at", "x"))
    placed = placed.select("id", "c", "n", (F.col("before") + F.col("at")).alias("place"), "x.shingle", _class(n).alias("own"), F.explode(F.sequence(_class(least), _class(F.expr(f"100 * n div {percent}")))).alias("other"))
    needed = F.ceil(percent * (n + _least(F.col("other"))) / (100 + percent))
    placed = placed.where(F.col("place") < n - needed + 1)
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    placed = placed.select("shingle", lo.alias("lo"), hi.alias("hi"), "id", "c", "n", "place", (F.col("own") == lo).alias("low"), (F.col("own") == hi).alias("high"))
    out = land(placed, "prefixes")
    release(shared)
    return out


def meetings(prefix: DataFrame, percent: int) -> DataFrame:
    """Pairs (hub, id) of sets of different components that share a prefix shingle and can still be similar."""
    a, b = prefix.where("low").alias("a"), prefix.where("high").alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("shingle", "lo", "hi")]
    apart = (F.col("a.c") != F.col("b.c")) & ((F.col("a.lo") < F.col("a.hi")) | (F.col("a.id") < F.col("b.id")))
    left = F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))
    met = a.join(b, [*same, apart, (100 + percent) * left >= percent * (F.col("a.n") + F.col("b.n"))])
    return met.select(F.least("a.id", "b.id").alias("hub"), F.greatest("a.id", "b.id").alias("id")).distinct()


def _block(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links between the asked and the others of (id, c, asked, set), by full sets; one for each two components that meet."""
    asked, others = [r for r in rows if r[2]], [r for r in rows if not r[2]]
    x, y = [r[3] for r in asked], [r[3] for r in others]
    common = np.zeros((len(x), len(y)))
    if x and y:
        known = np.intersect1d(np.concatenate(x), np.concatenate(y))
        for k in range(0, len(known), 4096):
            part = known[k : k + 4096]
            common += _held(x, part) @ _held(y, part).T
    sizes = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y])[None, :]
    found = {}
    for i, j in np.argwhere(100 * common >= percent * (sizes - common)).tolist():
        if asked[i][1] != others[j][1]:
            found.setdefault((asked[i][1], others[j][1]), (asked[i][0], others[j][0]))
    return list(found.values())


def _compare(percent: int):
    """Links of blocks of rows (leader, p, t, id, c, asked, set), which come block by block."""

    def run(batches):
        key, held = None, []
        for batch in batches:
            column, out = batch.column(6), []
            flat, ends = column.flatten().to_numpy(), np.cumsum([0, *column.value_lengths().to_pylist()])
            for k, (*own, i, c, asked) in enumerate(zip(*[batch.column(n).to_pylist() for n in range(6)])):
                if own != key:
                    out += _block(held, percent)
                    key, held = own, []
                held.append((i, c, asked, flat[ends[k] : ends[k + 1]].copy()))
            yield _links(out)
        yield _links(_block(held, percent))

    return run


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])


def _held(sets: list[np.ndarray], part: np.ndarray) -> np.ndarray:
    """Which of the sorted hashes each set holds, as 0.0 and 1.0."""
    out = np.zeros((len(sets), len(part)), np.float32)
    for row, s in zip(out, sets):
        row[np.searchsorted(part, s[np.isin(s, part, assume_unique=True)])] = 1
    return out


def _block_links(starred: DataFrame, hot: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the (id, c) in ``hot`` with those that share a leader with them, one for each two components of a block; landed.

    ``starred`` has (leader, id, c), each leader itself included. Those outside the leader's component are compared with all others.
    """
    main = starred.where("id = leader").select("leader", F.col("c").alias("main"))
    member = land(starred.join(hot.select("id"), "id").join(main, "leader").withColumn("apart", F.col("c") != F.col("main")), "hot")
    sizes = member.groupBy("leader").agg(F.count(F.lit(1)).alias("n"), F.count_if("apart").alias("n_apart")).where("n > 1 and n_apart > 0")
    sizes = sizes.select("leader", F.ceil(F.col("n") / OTHERS).cast("int").alias("others"), F.ceil(F.col("n_apart") / ASKED).cast("int").alias("askers"))
    placed = land(member.join(sizes, "leader"), "placed")
    place = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    others = placed.select("leader", "id", "c", all_of("askers").alias("p"), place(F.col("others")).alias("t"), F.lit(False).alias("asked"))
    asked = placed.where("apart").select("leader", "id", "c", place(F.col("askers")).alias("p"), all_of("others").alias("t"), F.lit(True).alias("asked"))
    both = others.unionByName(asked).join(sets.select(F.col("doc_id").alias("id"), "set"), "id").select("leader", "p", "t", "id", "c", "asked", "set")
    both = both.repartition("leader", "p", "t").sortWithinPartitions("leader", "p", "t")
    found = land(both.mapInArrow(frugal(_compare(percent)), "a long, b long").distinct(), "across")
    release(member, placed)
    return found


def _across(starred: DataFrame, comps: DataFrame, docs: DataFrame, vertices: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Links between components that meet at a leader, of (id, leader) pairs; see step 5. Landed; None if there are none."""
    own = starred.select(F.col("leader").alias("id"), "leader").distinct()
    member = starred.unionByName(own).join(comps, F.col("id") == F.col("node"), "left").select("leader", "id", F.coalesce("component", "id").alias("c"))
    member = land(member, "members")
    # with two members there is only the pair that has been judged
    apart = member.groupBy("leader").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("n > 2 and lo < hi")
    rest = land(member.join(apart.select("leader"), "leader").select("id", "c").distinct(), "rest")
    sets = _sets_of(rest.select(F.col("id").alias("doc_id")), docs, size)
    prefix = prefixes(rest.join(sets, F.col("id") == F.col("doc_id")).select("id", "c", "set"), percent)
    keys = prefix.groupBy("shingle", "lo", "hi").agg(F.min("c").alias("c1"), F.max("c").alias("c2"), F.count(F.lit(1)).alias("rows")).where("c1 < c2")
    keys = land(keys.select("shingle", "lo", "hi", (F.col("rows") > PAIRED).alias("hot")), "keys")
    kept = land(prefix.join(keys, ["shingle", "lo", "hi"]), "kept")
    links = None
    if not kept.isEmpty():
        pairs = _possible(meetings(kept.where("not hot"), percent), vertices, percent)
        few = _confirmed(pairs, docs, size, percent)
        hot = land(kept.where("hot").select("id", "c").distinct(), "hot")
        many = None if hot.isEmpty() else _block_links(member, hot, sets, percent)
        links = land(few if many is None else few.unionByName(many), "links")
        release(pairs, few, hot, many)
    release(member, rest, sets, prefix, keys, kept)
    return links


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id, kept (doc_id = component_id)."""
    spark = documents.sparkSession
    bounded_batches(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = land(docs.mapInArrow(frugal(_signatures(size)), "doc_id long, n_shingles long, key binary, bands array<long>, bits array<long>"), "signatures")

    known = rows.where("key is not null and doc_id is not null")
    classes = land(known.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("key", "rep"), "classes")
    vertices = land(known.join(classes, "key", "left").where("rep is null or rep = doc_id").select("doc_id", F.col("n_shingles").alias("n"), "bits", "bands"), "vertices")

    member = vertices.select(F.col("doc_id").alias("id"), F.explode("bands").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("members")).where("lo < hi").select("bucket", "members")
    shared = land(shared, "shared")
    buckets = land(member.join(shared, "bucket"), "buckets")
    weights = land(buckets.groupBy("id").agg(F.sum("members").alias("weight")), "weights")
    weighed = buckets.join(weights, "id").select("bucket", F.struct("weight", (-F.col("id")).alias("minus")).alias("rank"))
    leaders = land(weighed.groupBy("bucket").agg(F.max("rank").alias("top")).select("bucket", (-F.col("top.minus")).alias("leader")), "leaders")
    starred = land(buckets.join(leaders, "bucket").where("id <> leader").select("id", "leader").distinct(), "starred")
    release(shared, buckets, weights, leaders)

    pairs = _possible(starred.select(F.col("leader").alias("hub"), "id"), vertices, percent)
    links = _confirmed(pairs, docs, size, percent)
    release(pairs)
    comps = components(links)
    more = _across(starred, comps, docs, vertices, size, percent)
    if more is not None and not more.isEmpty():
        release(comps)
        comps = components(links.unionByName(more))
    release(links, more, starred, vertices)

    out = rows.select("doc_id", "n_shingles", "key").join(classes, "key", "left")
    out = out.withColumn("rep", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id"))).join(comps, F.col("rep") == F.col("node"), "left")
    component = F.coalesce("component", "rep")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
