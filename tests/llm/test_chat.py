from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamlytics.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
MARKS = [m for pair in (*chat.MARKS.values(), chat.OTHER) for m in pair] + [chat.BEGIN, chat.NEXT, chat.NAMED]


def escape(text):
    """By hand: a backslash behind a bracket that the rest of a mark follows, once backslashes there are left out."""
    out, i = "", 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[j] == "\\":
            j += 1
        if text[i] in "<[" and any(text.startswith(m[1:], j) for m in MARKS):
            out += text[i] + "\\"
        else:
            out += text[i]
        i += 1
    return out


def brute(rows):
    """{conversation: (formatted, turns, loss texts)}."""
    out = {}
    for key in {r[0] for r in rows}:
        mine = [(t, r or "", x or "") for c, t, r, x in rows if c == key]
        mine.sort(key=lambda r: ((r[0] is not None, r[0] or 0), r[1], r[2]))
        text, last = chat.BEGIN, None
        for _, role, said in mine:
            opening, closing = chat.MARKS.get(role, (chat.OTHER[0] + escape(role) + chat.NAMED, chat.OTHER[1]))
            text += chat.NEXT if last and last[0] == role else (last[1] if last else "") + opening
            text += escape(said)
            last = role, closing
        out[key] = (text + last[1], [(r, x) for _, r, x in mine], [x for _, r, x in mine if r == "assistant"])
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS formatted", "2 AS loss", "3 AS n", "4 AS place")
    made = chat.format_conversations(df).withColumn("turns", chat.read_back(F.col("formatted"))).withColumn(
        "under", chat.loss_text(F.col("formatted"), F.col("loss")))
    got = {r.conv_id: r for r in made.collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for key, (text, turns, loss) in want.items():
        row = got[key]
        assert row.formatted == text
        assert [tuple(t) for t in row.turns] == turns
        assert row.under == "".join(loss)
        assert [text[s.start:s.start + s.chars] for s in row.loss] == [escape(x) for x in loss]


def awkward(rng):
    return "".join(rng.choice([*MARKS, "<", "[", "\\", "/", "s>", "INST]", "é", " ", "\n", "😀", "ok", ""]) for _ in range(rng.randrange(6)))


def conversations(rng, n):
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "to[:]ol[/ROLE]", "", None]
    return [(c, t, rng.choice(roles), awkward(rng) if rng.random() < 0.9 else None)
            for c in range(n) for t in range(rng.randrange(1, 9))]


def test_random_conversations(spark):
    check(spark, conversations(random.Random(3), 120))


@pytest.mark.parametrize("slice_", [1, 2, 64])
def test_slices_and_ties_do_not_change_the_text(spark, monkeypatch, slice_):
    monkeypatch.setattr(chat, "SLICE", slice_)
    rng = random.Random(4)
    rows = conversations(rng, 8) + [(77, t // 5 if t % 7 else None, rng.choice(["user", "assistant"]), awkward(rng)) for t in range(150)]
    rows += [rows[-3], rows[-3], (None, None, None, None), (None, 2, "user", "x"), (5, None, "user", "")]
    check(spark, rows)


def test_long_conversations_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(chat, "LONG", 20)
    rng = random.Random(5)
    rows = conversations(rng, 20)
    for key in (900, 901, None):
        rows += [(key, t, rng.choice(["user", "assistant", "assistant"]), awkward(rng)) for t in range(300)]
    rows += [(900, 7, "assistant", "the same")] * 40
    rng.shuffle(rows)
    check(spark, rows)
    df = spark.createDataFrame(rows, SCHEMA)
    plan = chat.format_conversations(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_very_long_text_and_no_rows(spark):
    check(spark, [(1, 0, "user", "</s>" * 200_000), (1, 1, "assistant", "é[INST]" * 100_000)])
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_escaping_leaves_no_mark_and_is_reversible(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice([*MARKS, "<", "[", "\\", "s>", "]"]) for _ in range(rng.randrange(9))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("made", chat.escaped(F.col("text")))
    for r in df.withColumn("back", chat.unescaped(F.col("made"))).collect():
        assert r.back == r.text and r.made == escape(r.text) and not any(m in r.made for m in MARKS)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<[\\/s>INSTYROLEAX:]", max_size=30))
def test_the_escape_written_here_is_reversible(text):
    import re

    assert re.sub(chat.UNESCAPE, r"\1\2\3", escape(text)) == text
