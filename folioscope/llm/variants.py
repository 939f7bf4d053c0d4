"""Spelling variants: a trie self-join with active-node sets over a prefix-partitioned vocabulary.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. The vocabulary's trie is partitioned
by prefixes: every word goes to the subtree of its first ``base`` code points, and a subtree of more than ``most`` words
is opened, its words going to the subtrees one code point below the next branching, until none is larger.

* Within a subtree one task walks its trie in preorder. Every node carries its active nodes, those at distance one from it: a
  child's are the children of its parent's active nodes by the same character, its larger siblings (one replaced character),
  and its parent (one inserted). Where both nodes end a word, the pair is emitted. A node of one word is looked up instead of
  walked, and unbranched stretches are crossed at once, so long words cost little.
* At an opened node active nodes lie in other subtrees. Below a spent edit only equal characters follow, so the
  descent of all of them is one equality join: words that share what is left without the character at that depth, and the word
  that is this rest. Such a group has one word per character of the alphabet at most.

An edit counts at the first place where the two words differ, so every pair is found once. Pairs are added up where they are
found: a word's number of near words and its best one, the one of most occurrences (ties: smallest in code-point order), which is its
form if it has at least ``ratio`` times the word's own. Roots follow forms by pointer doubling; a form's count is
``ratio`` times larger, so chains are short.

Words are the distinct values of a counted vocabulary; null and empty words take no part. Counts of a repeated word are added up. Long words,
words that begin others, and vocabularies under one prefix need no special case. An empty table gives an empty result; other
columns don't matter.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.storage import BROADCAST_BYTES, land, release

#: Code points of the least prefix, words in a subtree, and words a task of subtrees should have.
BASE, MOST, A_TASK = 3, 20_000, 25_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Node:
    """The words ``lo`` to ``hi`` of a sorted list, which share their first ``depth`` code points."""

    __slots__ = ("depth", "hi", "kids", "lo")

    def __init__(self, lo: int, hi: int, depth: int):
        self.lo, self.hi, self.depth, self.kids = lo, hi, depth, None


class Subtree:
    """Near pairs among sorted distinct words that share their first ``depth`` code points, by counts and best words."""

    def __init__(self, words: list[str], numbers: list[int], depth: int):
        self.words, self.numbers, self.depth = words, numbers, depth
        self.index = {w: i for i, w in enumerate(words)}
        self.near, self.best = [0] * len(words), [-1] * len(words)

    def children(self, node: Node) -> dict[str, Node]:
        if node.kids is None:
            words, d, lo, hi, node.kids = self.words, node.depth, node.lo, node.hi, {}
            if len(words[lo]) == d:
                lo += 1
            while lo < hi:
                c = words[lo][d]
                end = bisect_right(words, c, lo, hi, key=lambda w: w[d])
                node.kids[c] = Node(lo, end, d + 1)
                lo = end
        return node.kids

    def below(self, node: Node, segment: str) -> Node | None:
        """The node that ``segment`` leads to."""
        if len(segment) == 1:
            return self.children(node).get(segment)
        d, e = node.depth, node.depth + len(segment)
        lo = bisect_left(self.words, segment, node.lo, node.hi, key=lambda w: w[d:e])
        hi = bisect_right(self.words, segment, lo, node.hi, key=lambda w: w[d:e])
        return Node(lo, hi, e) if lo < hi else None

    def emit(self, i: int, j: int) -> None:
        for a, b in ((i, j), (j, i)):
            self.near[a] += 1
            best = self.best[a]
            # words are sorted, so the smaller place is the smaller word
            if best < 0 or (-self.numbers[b], b) < (-self.numbers[best], best):
                self.best[a] = b

    def walk(self) -> None:
        words, index = self.words, self.index
        # a node, and its active nodes, each with the character that must not follow it ("": any may)
        stack = [(Node(0, len(words), self.depth), [])]
        while stack:
            u, active = stack.pop()
            d, first = u.depth, words[u.lo]
            if u.hi - u.lo == 1:
                tail = first[d:]
                for v, ban in active:
                    if not ban or tail[:1] != ban:
                        j = index.get(words[v.lo][: v.depth] + tail)
                        if j is not None:
                            self.emit(u.lo, j)
                continue
            many = []
            for v, ban in active:
                if v.hi - v.lo > 1:
                    many.append((v, ban))
                else:
                    tail = words[v.lo][v.depth :]
                    if not ban or tail[:1] != ban:
                        j = index.get(first[:d] + tail)
                        if j is not None:
                            self.emit(j, v.lo)
            last = words[u.hi - 1]
            if len(first) > d and first[d] == last[d]:
                end, e = min(len(first), len(last)), d + 1
                while e < end and first[e] == last[e]:
                    e += 1
                segment = first[d:e]
                moved = [(self.below(v, segment), "") for v, ban in many if ban != first[d]]
                stack.append((Node(u.lo, u.hi, e), [x for x in moved if x[0]]))
                continue
            if len(first) == d:
                for v, _ in many:
                    if len(words[v.lo]) == v.depth:
                        self.emit(u.lo, v.lo)
            kids = self.children(u)
            others = list(kids.items())
            for at, (c, kid) in enumerate(others):
                below = [(x, "") for v, ban in many if ban != c and (x := self.children(v).get(c))]
                below += [(x, "") for _, x in others[at + 1 :]]
                below.append((u, c))
                stack.append((kid, below))


def _walked(batches):
    """Rows (prefix, word, n), sorted, to (word, n_near, best: -n and word) of words that have near ones."""
    prefix, words, numbers = None, [], []

    def done():
        if len(words) < 2:
            return
        tree = Subtree(words, numbers, len(prefix))
        tree.walk()
        found = [(words[i], tree.near[i], -numbers[b], words[b]) for i, b in enumerate(tree.best) if b >= 0]
        if found:
            word, near, least, best = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.int64()), pa.array(least, pa.int64()), pa.array(best, pa.string())], ["word", "n_near", "less", "best"])

    for batch in batches:
        for p, w, n in zip(*(c.to_pylist() for c in batch.columns)):
            if p != prefix:
                yield from done()
                prefix, words, numbers = p, [], []
            words.append(w)
            numbers.append(n)
    yield from done()


def _subtrees(words: DataFrame, base: int, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """word, n, cut (the depth of its subtree's prefix; null if the word ends above) and opens (depths opened above it)."""
    left = words.select("word", "n", F.lit(base).alias("cut"), F.array(*[F.lit(d) for d in range(base)]).cast("array<int>").alias("opens"))
    settled, used = None, []
    while True:
        groups = left.groupBy(F.expr("substring(word, 1, cut)").alias("prefix"), F.col("cut").alias("depth"))
        groups = groups.agg(F.count(F.lit(1)).alias("k"), F.min("word").alias("a"), F.max("word").alias("z")).where(F.col("k") > most)
        # the least and the largest word share what all share; then the trie branches, or a word ends
        shared = F.expr("cast(array_position(zip_with(split(a, ''), split(z, ''), (x, y) -> coalesce(x <> y, true)), true) - 1 as int)")
        groups = land(groups.select("prefix", "depth", shared.alias("at")), "opened")
        used.append(groups)
        size, n = groups.agg(F.coalesce(F.sum(F.octet_length("prefix") + 64), F.lit(0)), F.count(F.lit(1))).first()
        if not n:
            return (left if settled is None else settled.unionByName(left)), used
        if size <= BROADCAST_BYTES:
            groups = F.broadcast(groups)
        joined = left.join(groups, (F.expr("substring(word, 1, cut)") == F.col("prefix")) & (F.col("cut") == F.col("depth")), "left")
        joined = land(joined.drop("prefix", "depth"), "subtrees")
        used.append(joined)
        some = joined.where("at is null").drop("at")
        some = some.unionByName(joined.where("length(word) = at").select("word", "n", F.lit(None).cast("int").alias("cut"), F.array_append("opens", F.col("at")).alias("opens")))
        settled = some if settled is None else settled.unionByName(some)
        left = joined.where("length(word) > at").select("word", "n", (F.col("at") + 1).alias("cut"), F.array_append("opens", F.col("at")).alias("opens"))


def near_words(words: DataFrame, base: int = BASE, most: int = MOST) -> tuple[DataFrame, list[DataFrame]]:
    """word, n_near and best (struct of less, -n, and word) of every word of (word, n) that has near ones.

    ``base`` must not exceed the least length of a word. The second value lists landed tables to release.
    """
    trees, used = _subtrees(words, base, most)
    tasks = max(16, -(-words.count() // A_TASK))
    cut = trees.where("cut is not null").select(F.expr("substring(word, 1, cut)").alias("prefix"), "word", "n")
    walked = cut.repartition(tasks, "prefix").sortWithinPartitions("prefix", "word")
    walked = walked.mapInArrow(_walked, "word string, n_near long, less long, best string")
    walked = walked.select("word", "n_near", F.struct("less", F.col("best").alias("word")).alias("best"))
    # opened nodes: what is left without the character at the node's depth, and words that are such a rest themselves
    opened = trees.select("word", "n", F.explode("opens").alias("depth"))
    letter, rest = F.expr("substring(word, depth + 1, 1)"), F.expr("concat(substring(word, 1, depth), substring(word, depth + 2))")
    keys = F.when(F.length("word") > F.col("depth"), F.array(rest, F.col("word"))).otherwise(F.array("word"))
    opened = opened.select("depth", F.explode(keys).alias("key"), F.struct((-F.col("n")).alias("less"), "word", letter.alias("letter")).alias("member"))
    groups = opened.groupBy("depth", "key").agg(F.collect_list("member").alias("members")).where("size(members) > 1")
    each = groups.select("members", F.explode("members").alias("own"))
    each = each.select("own", F.expr("filter(members, x -> x.letter <> own.letter)").alias("near")).where("size(near) > 0")
    best = F.array_min(F.transform("near", lambda x: F.struct(x["less"].alias("less"), x["word"].alias("word"))))
    each = each.select("own.word", F.size("near").cast("long").alias("n_near"), best.alias("best"))
    found = walked.unionByName(each).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return found, used


def roots(links: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """word and root of (word, form): forms followed to the last, by doubling; links must have no cycle."""
    used = []
    out = links.select("word", F.col("form").alias("root"))
    while True:
        out = land(out, "roots")
        used.append(out)
        step = out.select(F.col("word").alias("root"), F.col("root").alias("next"))
        out = out.join(step, "root", "left")
        if out.where("next is not null").isEmpty():
            return used[-1], used
        out = out.select("word", F.coalesce("next", "root").alias("root"))


def spelling_groups(vocabulary: DataFrame, ratio: int = 10, base: int = BASE, most: int = MOST) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``vocabulary`` (word, n)."""
    words = vocabulary.where("word is not null and word <> ''").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = land(words, "vocabulary")
    found, used = near_words(words, base, most)
    fits = -F.col("best.less") >= ratio * F.col("n")
    out = words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best.word")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")
    )
    out = land(out, "forms")
    release(words, *used)
    found, used = roots(out.where("form is not null"))
    out = land(out.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "groups")
    release(*used)
    return out


def vocabulary(runs: DataFrame, least_length: int = 7, least_count: int = 2) -> DataFrame:
    """word and n (occurrences) of the rows of (word) that are long and frequent enough."""
    counted = runs.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)


def runs(documents: DataFrame, pattern: str = r"[A-Za-zÀ-ÿ]", least_length: int = 7) -> DataFrame:
    """doc_id and word of every maximal run of ``pattern`` of at least ``least_length`` code points, A-Z lower-cased.

    A null text has no runs; repeated rows and doc_ids each count.
    """
    found = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"{pattern}{{{least_length},}}"), F.lit(0))
    return documents.select("doc_id", F.explode(found).alias("word")).select("doc_id", F.translate("word", UPPER, LOWER).alias("word"))


def with_lost_letters(found: DataFrame, every: int = 31) -> DataFrame:
    """Takes one code point out of some of (doc_id, word): where ``every`` divides the checksum h of ``<doc_id>:<word>``
    (a null doc_id is empty), the one at h modulo the word's length."""
    h: Column = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    found = found.select("word", h.alias("h"))
    cut = F.expr("concat(substring(word, 1, cast(h % length(word) as int)), substring(word, cast(h % length(word) as int) + 2))")
    return found.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("word")).alias("word"))
