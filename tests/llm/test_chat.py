from __future__ import annotations

import random

from folioscope.llm import chat


def test_round_trip(spark):
    rng = random.Random(11)
    pieces = ["a", "\\", "\\s", "\\l", "<", "</turn>", "<cut>", "<text>", "<turn>assistant<text>", "\n", "é🙂", " ", ""]
    rows = []
    for conv in range(60):
        for turn in range(rng.choice([1, 2, 3, 9, 30])):
            text = rng.choice([None, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))])
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "sys<tem\\", None]), text, "x"))
    rows += [(61, 0, "assistant", "long " * 50_000, "x")] + [(62, t, "assistant", "b", "x") for t in range(1500)] + [(0, 0, *rows[0][2:4], "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.loss_mask(chat.loss_text(chat.read_back(chat.formatted(table)))).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r or "", x or "") for c, t, r, x, _ in rows if c == conv))
        wanted = [(r, x) for _, r, x in own]
        assert [(t.role, t.text) for t in got[conv].turns] == wanted
        loss = [x for r, x in wanted if r == "assistant"]
        assert got[conv].loss == "".join(loss)
        undo = lambda s: s.replace("\\l", "<").replace("\\s", "\\")
        f = got[conv].formatted
        assert [undo(f[m.start : m.start + m.length]) for m in got[conv].mask] == loss
        assert f.count("<turn>") == 1 + sum(a[0] != b[0] for a, b in zip(wanted, wanted[1:]))
    assert chat.formatted(table.where("false")).count() == 0


def test_main_path_has_no_python(spark):
    from folioscope.llm import queries

    df = queries.QUERIES["op10_chat"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_loss_is_cut_by_the_mask(spark):
    from folioscope.llm import chat

    long = "🙂é" + "ab🙂" * 5000
    rows = [(long, [(0, 2), (4095, 2), (9000, 5000), (5, 0), (len(long) - 1, 1)]), ("x\\l", [(0, 3)]), ("none", [])]
    masked = spark.createDataFrame(rows, "formatted string, mask array<struct<start: long, length: long>>")
    got = {r.formatted: r.loss for r in chat.loss_text(masked).collect()}
    assert got == {f: "".join(f[a : a + n] for a, n in m).replace("\\l", "<") for f, m in rows}
