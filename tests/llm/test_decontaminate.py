from __future__ import annotations

import random
import re

import pytest

from streamlytics.llm.decontaminate import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            x = words(t)
            n = min(13, len(x))
            grams = {tuple(x[i:i + n]) for i in range(len(x) - n + 1)} if x else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams and item is not None:
                    hit |= set(range(i, i + n))
                    found.add(str(item))
        out.append((key, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [100_000, 7])
def test_equal_to_brute_force(spark, block):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["Éa", "ñ9", "It's"]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(some(rng.choice([14, 20, 40])))) for i in range(8)]
    items += [(20, "x1 y2, z3"), (21, "lonely"), (22, ""), (23, None), (None, "w1"), (3, items[3][1]), (24, items[4][1]),
              (25, " ".join(some(9)))]
    docs = []
    for i in range(40):
        text = some(rng.randrange(0, 60))
        if i % 2:
            source = rng.choice(items)[1] or ""
            text[5:5] = source.split()[rng.randrange(3):]
        if i % 7 == 0:
            text += ["x1", "y2;z3", "-", "LONELY"]
        docs.append((i, rng.choice([" ", "\n", ", "]).join(text)))
    docs += [(90, None), (91, ""), (7, docs[7][1]), (7, "other lonely"), (None, "lonely"), (None, "lonely"),
             (92, "lonely " * 3000)]
    got = contamination(
        spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, n_words int"),
        spark.createDataFrame(items, "item_id bigint, text string"), block=block)
    found = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got.collect()), key=repr)
    assert found == brute(docs, items)


def test_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert contamination(docs.limit(0), items).collect() == []
    got = contamination(docs, items.limit(0)).collect()
    assert [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got] == [(1, 2, 0, [])]
