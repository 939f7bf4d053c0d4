from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from oracle import SF, assert_same

from folioscope.llm import queries, variants


def rests(w):
    return {(i, w[:i] + w[i + 1 :]) for i in range(len(w))}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(a == r for _, r in rests(b))


def brute(words: dict[str, int], ratio=10):
    """By all pairs."""
    out = {}
    for w, n in words.items():
        near = sorted((-words[x], x) for x in words if is_near(w, x))
        form = near[0] if near and -near[0][0] >= ratio * n else None
        out[w] = (form and form[1], n, len(near), form and -form[0])
    for w, (form, n, near, form_n) in list(out.items()):
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w] = (form, root, n, near, form_n)
    return out


def rows(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def some_words(rng, n, letters, least, most):
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(least, most))) for _ in range(n)}
    for w in list(words)[: n // 2]:
        i = rng.randrange(len(w))
        words.add(w[:i] + rng.choice(letters) + w[i:])
        words.add(w[:i] + rng.choice(letters) + w[i + 1 :])
    return {w: rng.choice([1, 1, 2, 5, 10, 20, 100, 1000, 10_000]) for w in words if len(w) >= 3}


@pytest.mark.parametrize("kind", ["two letters", "many letters", "long", "one prefix", "runs"])
@pytest.mark.parametrize("most", [9, 20_000])
def test_equals_all_pairs(spark, kind, most):
    rng = random.Random(f"{kind}{most}")
    words = {
        "two letters": lambda: some_words(rng, 250, "ab", 3, 9),
        "many letters": lambda: some_words(rng, 250, "abcdefgéÿ中🙂", 3, 6),
        "long": lambda: {"x" * 3000 + k: v for k, v in some_words(rng, 60, "ab", 3, 6).items()} | {"x" * k: k for k in range(2990, 3003)},
        "one prefix": lambda: {"prefix" + k: v for k, v in some_words(rng, 200, "abc", 3, 6).items()},
        "runs": lambda: {"a" * i + "b" * j: 1 + 50 * i for i in range(6) for j in range(6) if i + j >= 3},
    }[kind]()
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows(variants.spelling_groups(df, most=most)) == brute(words)


def test_a_pair_is_emitted_once_and_only_near_ones():
    words = sorted(some_words(random.Random(5), 400, "abc", 4, 8))
    tree = variants.Subtree(words, [1] * len(words), 0)
    pairs = Counter()
    tree.emit = lambda i, j: pairs.update([(min(i, j), max(i, j))])
    tree.walk()
    assert set(pairs.values()) == {1}
    assert set(pairs) == {(i, j) for i in range(len(words)) for j in range(i) if is_near(words[i], words[j])} or set(pairs) == {(j, i) for i in range(len(words)) for j in range(i) if is_near(words[i], words[j])}


def test_work_in_a_subtree_is_in_proportion_to_its_words():
    rng = random.Random(6)

    def steps(n):
        words = sorted({"pre" + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(n)})
        tree, count = variants.Subtree(words, [1] * len(words), 3), 0
        inner = tree.children

        def counted(node):
            nonlocal count
            count += 1
            return inner(node)

        tree.children = counted
        tree.walk()
        return count

    assert steps(8000) < 12 * steps(1000)


def test_lost_letters(spark):
    texts = {1: "Réponse ÉTÉ administration x administrationsadministrations", 2: None, 3: "", 4: "mot " * 3000 + "z" * 30_000, None: "quelque chose autrement"}
    many = {i: " ".join(["Vocabulaire", "Orthographe"]) for i in range(10, 200)}
    docs = spark.createDataFrame([*texts.items(), *many.items(), (1, texts[1])], "doc_id long, text string")
    wanted = Counter()
    for i, t in [*texts.items(), *many.items(), (1, texts[1])]:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            w = w if h % 31 else w[: h % len(w)] + w[h % len(w) + 1 :]
            wanted[w] += len(w) >= 7
    got = {r.word: r.n for r in variants.vocabulary(variants.with_lost_letters(variants.runs(docs))).collect()}
    assert got == {w: n for w, n in wanted.items() if n >= 2}


def test_odd_vocabularies(spark):
    rows_ = [(None, 5, "k"), ("", 5, "k"), ("abcdefg", 1, "k"), ("abcdefg", 2, "k"), ("abcdefh", 30, "k"), ("abcdefi", 30, "k"), ("abcdef", 300, "k")]
    df = spark.createDataFrame(rows_, "word string, n long, prefix string").withColumnRenamed("prefix", "root")
    got = rows(variants.spelling_groups(df))
    assert got == {
        "abcdefg": ("abcdef", "abcdef", 3, 3, 300),
        "abcdefh": ("abcdef", "abcdef", 30, 3, 300),
        "abcdefi": ("abcdef", "abcdef", 30, 3, 300),
        "abcdef": (None, "abcdef", 300, 3, None),
    }
    assert variants.spelling_groups(df.where("false")).count() == 0


def test_roots_of_long_chains(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(40)] + [("v", "w5")], "word string, form string")
    found, _ = variants.roots(links)
    assert {r.word: r.root for r in found.collect()} == defaultdict(str, {f"w{i}": "w40" for i in range(40)} | {"v": "w40"})


def test_query_agrees_with_sql(spark):
    assert_same(queries.QUERIES["op11_variants"](spark, SF), queries.ORACLE_SQL["op11_variants"])
