from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter

from folioscope.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def slow_luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def slow_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 16 <= len(digits(m)) <= 19 and slow_luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(digits(m)) <= 15]


def test_base_patterns_equal_regular_expressions():
    rng = random.Random(3)
    pieces = ["a", "b.", "@", "1", "22", "300", "4", ".", "+", "-", " ", "é", "(", ")", "4242 4242 4242 4242", "x@y.z", "1.2.3.4"]
    for _ in range(20_000):
        t = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(t) == slow_spans(t), t
    for t in ("a" * 200_000, "1" * 200_000, "1.2.3 " * 50_000, "a." * 100_000 + "@", "+1" + "(" * 100_000, "1." * 100_000):
        pii.base_spans(t)  # linear, also on long runs


def test_terms_that_disclose(spark):
    rng = random.Random(5)
    common = [f"w{i}" for i in range(60)]
    filler = lambda n: " ".join(rng.choice(common) for _ in range(n))
    texts = [filler(30) for _ in range(300)]
    for _ in range(5):  # a name that stands with one address only
        texts.append(f"{filler(4)} Zebrowski jz@firm.example.com {filler(4)}")
    texts.append("call Zebrowski w1")  # the name alone gives the address away
    texts.append("ask +1 (222) 555-0101 w2")
    texts += [f"{filler(9)} user{k}@mail.example.com" for k in range(60)]  # so that the kind itself says little
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.row.doc_id: r for r in pii.sanitise(docs).collect()}
    for i, t in enumerate(texts):
        base = [(x["kind"], x["start"], x["end"]) for x in got[i].spans if x["kind"] != "term"]
        assert base == slow_spans(t)
        terms = [t[x["start"] : x["end"]] for x in got[i].spans if x["kind"] == "term"]
        assert terms == (["Zebrowski"] if "Zebrowski" in t else [])
        if i < 300:
            assert got[i].clean == t
    assert "Zebrowski" not in got[305].clean and "[near EMAIL]" in got[305].clean
    assert got[306].clean == "ask [PHONE] w2"
    # the same where chunks of documents look terms up
    for block in (40, 0):
        again = {r.row.doc_id: (r.clean, r.spans) for r in pii.sanitise(docs, block_terms=block).collect()}
        assert again == {i: (r.clean, r.spans) for i, r in got.items()}


def slow_actions(texts):
    """Disclosing terms and what replaces them, from whole lists of words."""
    documents, together, seen, kinds = Counter(), Counter(), Counter(), Counter()
    for t in texts:
        spans = slow_spans(t)
        words = [(m.start(), m.end(), re.sub("[A-Z]", lambda c: c[0].lower(), m[0])) for m in re.finditer(r"[0-9A-Za-z\u0080-\U0010ffff]+", t)]
        seen.update({w for _, _, w in words})
        kinds.update({k for k, _, _ in spans})
        pairs = set()
        for kind, a, b in spans:
            value = (kind, t[a:b].lower() if kind == "email" else t[a:b] if kind == "ip" else re.sub("[^0-9]", "", t[a:b]))
            pairs.add((value, None))
            for p, q, w in [x for x in words if x[1] <= a][-10:] + [x for x in words if x[0] >= b][:10]:
                if q > a - 1000 and p < b + 1000 and not any(p < y and x < q for _, x, y in spans):
                    pairs.add((value, w))
        documents.update(c for c, w in pairs if w is None)
        together.update((c, w) for c, w in pairs if w is not None)
    reveals = {}
    for (c, w), n in together.items():
        pmi, information = math.log2(len(texts) * n / (documents[c] * seen[w])), math.log2(len(texts) / documents[c])
        if n >= 3 and pmi >= 0.9 * information - 1e-9:
            general = math.log2(len(texts) / kinds[c[0]]) <= 0.75 * information + 1e-9
            reveals.setdefault(w, set()).add((c[0], general))
    return {w: f"[near {min(x)[0].upper()}]" if len({k for k, _ in x}) == 1 and all(g for _, g in x) else "[removed]" for w, x in reveals.items()}


def test_term_spans_equal_brute_force(spark):
    from oracle import SF

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rng = random.Random(11)
    for k in range(120):  # names that stand with an address, a number or both, some of them elsewhere too
        parts = [f"name{k % 16} writes n{k % 16}@people.example.org", f"call{k % 9} at +33 1 23 45 6{k % 9} 00 or name{k % 3}", "some words"]
        texts[10**6 + k] = " and ".join(rng.sample(parts, rng.choice([1, 2, 3])))
    wanted = slow_actions(list(texts.values()))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.term: r.action for r in pii.disclosing_terms(docs).collect()}
    assert got == wanted and len(wanted) > 5
    assert {r.term: r.action for r in pii.disclosing_terms(docs, block_terms=3).collect()} == wanted
    for r in pii.sanitise(docs).collect():
        t, spans = texts[r.row.doc_id], slow_spans(texts[r.row.doc_id])
        words = [(m.start(), m.end()) for m in re.finditer(r"[0-9A-Za-z\u0080-\U0010ffff]+", t) if re.sub("[A-Z]", lambda c: c[0].lower(), m[0]) in wanted]
        terms = [w for w in words if not any(w[0] < y and x < w[1] for _, x, y in spans)]
        assert [(x["start"], x["end"]) for x in r.spans if x["kind"] == "term"] == terms


def test_many_values_in_one_text_take_linear_time():
    text = " ".join(f"some words about user{k}@mail{k}.example.com" for k in range(20_000))
    start = time.process_time()
    found = pii.near(text, pii.base_spans(text))
    assert time.process_time() - start < 6 and len(found) > 60_000
    long = "a@" + "1.2.3.4." * 2_000 + "com and so on"  # one address over many others
    assert ("email:" + long.split(" ")[0], "and") in pii.near(long, pii.base_spans(long))
    assert not any(w and w in "1234com" for _, w in pii.near(long, pii.base_spans(long)))


def test_query_and_odd_documents(spark, odd_documents):
    from oracle import SF

    from folioscope.llm import queries

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op1_pii"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = slow_spans(texts[r.doc_id])
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest() and r.spans.startswith(said)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in spans) for x in pii.KINDS]
    odd = pii.sanitise(odd_documents)
    assert odd.select("row.*").columns == odd_documents.columns
    assert sorted(map(repr, (r.clean for r in odd.collect()))) == sorted(map(repr, (r.text for r in odd_documents.collect())))
    assert pii.sanitise(odd_documents.where("false")).count() == 0


def test_long_terms_disclose(spark):
    rng = random.Random(9)
    filler = lambda n: " ".join(f"w{rng.randrange(60)}" for _ in range(n))
    long = [hashlib.sha256(b"account").hexdigest().upper(), "".join(chr(0x4E00 + k) for k in range(30)), "Ab" * 700]
    texts = [filler(30) for _ in range(300)]
    for k, word in enumerate(long):
        texts += [f"{filler(4)} {word} jz{k}@firm.example.com {filler(4)}" for _ in range(5)]
        texts += [f"{filler(4)} mail al{k}@firm.example.com {word}x {filler(4)}" for _ in range(5)]
    at = len(texts)
    texts += [f"call {word} w1 {word}x w2" for word in long]
    texts += [f"{filler(9)} user{k}@mail.example.com" for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (500_000, 8, 3):
        got = {r.row.doc_id: r.clean for r in pii.sanitise(docs, block_terms=block).collect()}
        assert [got[at + k] for k in range(len(long))] == ["call [near EMAIL] w1 [near EMAIL] w2"] * len(long)
        assert not any(word in x for word in long for x in got.values())


def test_words_at_the_window_edge_are_whole():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b" * 70, "é" * 40, " ", ". ", "x y "]) for _ in range(40))
        words = [m.span() for m in pii._WORD.finditer(text)]
        for at in range(len(text) + 1):
            assert pii.word_start(text, at) == next((a for a, b in words if a < at < b), at)
