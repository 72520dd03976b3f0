from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from streamlytics.llm import divergence
from streamlytics.llm.divergence import audit, count_terms

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, least=30, top=50):
    rows = [(a or "", b or "", terms(t)) for a, b, t in rows]
    seen, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, found in rows:
        seen[lang].update(set(found))
        count[lang, source].update(found)
    out = set()
    for lang in {r[0] for r in rows}:
        kept = {t for t, n in seen[lang].items() if n >= least}
        sources = sorted({s for a, s, _ in rows if a == lang})
        of = {s: {t: count[lang, s][t] for t in kept} for s in sources}
        whole = {t: sum(of[s][t] for s in sources) for t in kept}

        def share(counts):
            return {t: 1 + 10 ** 9 * (n + 5) // (sum(counts.values()) + 5 * len(kept)) for t, n in counts.items()}

        q, p = share(whole), {s: share(of[s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            more = [(p[s][t] - q[t], t) for t in kept if of[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", more, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])}
    return out


WORDS = ["Of", "the", "naïve", "ÉTÉ", "straße", "eightlet", "nineletter"[:9], "sixteenlettersab", "seventeenletters1"[:17] + "q",
         "日本語", "x" * 40, "y" * 33, "z" * 70, "\U0001F600", "a1b", "é" * 200]


def corpus(seed, n, sources=5):
    rng, rows = random.Random(seed), []
    for _ in range(n):
        lang = rng.choice(["en", "en", "en", "fr", None])
        source = rng.choice([None, *(f"s{i}" for i in range(sources))])
        words = rng.choices(WORDS, range(1, len(WORDS) + 1), k=rng.randrange(0, 25))
        rows.append((lang, source, rng.choice([" ", "\n", "-", "\x00", "[", "7"]).join(words) if words else rng.choice([None, ""])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string").selectExpr(
        "*", "1 AS term", "2 AS n", "3 AS value", "4 AS place")


def result(df):
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_against_brute_force(spark):
    rows = corpus(1, 600) + [("de", "lonely", "only few words"), ("de", "other", None), ("it", "one", "x")] + [("en", "s1", "the of")] * 50
    assert result(audit(frame(spark, rows))) == brute(rows)


def test_blocks_chunks_and_held_counts_change_nothing(spark, monkeypatch):
    rows = corpus(2, 500, sources=9)
    want = brute(rows, least=3)
    for name, value in (("TERMS", 4), ("SOURCES", 3), ("CHUNK", 300), ("HELD", 20), ("HELD_LONG", 3)):
        monkeypatch.setattr(divergence, name, value)
    assert result(audit(frame(spark, rows), least=3)) == want


def test_a_document_is_one_document_in_however_many_parts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK", 64)
    rows = [("en", "a", " ".join(["again"] * 200 + ["w" * 100] * 5))] * 2 + [("en", "b", "again other")]
    assert result(audit(frame(spark, rows), least=3)) == brute(rows, least=3)
    assert result(audit(frame(spark, rows), least=4)) == brute(rows, least=4)


def test_long_texts_empty_tables_and_no_kept_terms(spark):
    rows = [("en", "a", "lorem " * 1_200_000 + "é" * 3_000_000), ("en", "b", "lorem")]
    assert result(audit(frame(spark, rows), least=1)) == brute(rows, least=1)
    assert result(audit(frame(spark, rows))) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}
    assert result(audit(frame(spark, rows).limit(0))) == set()


@pytest.mark.parametrize("seed", range(4))
def test_packed_counts(seed):
    rng = random.Random(seed)
    texts = sorted(((rng.randrange(3), " ".join(rng.choices(WORDS, k=rng.randrange(40)))) for _ in range(60)), key=lambda r: r[0])
    groups = np.array([g for g, _ in texts])
    n, docs = Counter(), Counter()
    for g, t in texts:
        n.update((g, x) for x in terms(t))
        docs.update((g, x) for x in set(terms(t)))
    got_n, got_docs = {}, {}
    held = divergence.Held()
    for words, of, found, count, seen in count_terms([t.encode() for _, t in texts], groups):
        held.add(words, of, found, count, seen)
        found = divergence.unpacked(found).tolist() if words else found
        for g, t, a, b in zip(of.tolist(), found, count.tolist(), seen.tolist(), strict=True):
            assert (g, t.decode()) not in got_n
            got_n[g, t.decode()], got_docs[g, t.decode()] = a, b
    assert got_n == dict(n) and got_docs == dict(docs)
    for words, of, found, count, seen in count_terms([t.encode() for _, t in texts], groups):
        held.add(words, of, found, count, seen)  # a second time
    twice = {(int(g), t.as_py().decode()): (int(a), int(b)) for of, t_, n_, d_ in held.take() for g, t, a, b in zip(of, t_, n_, d_, strict=True)}
    assert twice == {k: (2 * n[k], 2 * docs[k]) for k in n} and not list(held.take())


def test_shares_beyond_64_bits(spark):
    df = spark.createDataFrame([(10 ** 13, 3 * 10 ** 13, 10 ** 6)], "n bigint, total bigint, kept bigint")
    got = df.select(divergence._share("n", "total", "kept").alias("p")).first().p
    assert got == 1 + 10 ** 9 * (10 ** 13 + 5) // (3 * 10 ** 13 + 5 * 10 ** 6)
