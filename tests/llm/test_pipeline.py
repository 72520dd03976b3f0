from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

import corpus_pipeline
from streamlytics.llm.line_dedup import MIN_PAGES, RATIO
from test_decontaminate import brute as brute_hits
from test_dedup import brute as brute_groups

tiktoken = pytest.importorskip("tiktoken")


def prose(rng, n):
    return " ".join("".join(rng.choices(["ta", "lo", "mi", "er", "na", "so"], k=rng.randrange(1, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(8)
    docs, labels = [], []
    items = [(i, prose(rng, 40)) for i in range(4)] + [(9, "short one")]
    for i in range(700):
        text = "\n".join(prose(rng, rng.randrange(10, 60)) for _ in range(rng.randrange(1, 4)))
        toxic = i % 6 == 0
        if toxic:
            text += " grobz" + rng.choice(["en", "ish", "or"]) + " vlaxum"
        if i % 11 == 0:
            text += "\nread more here"
        if i % 17 == 1:
            text += " " + items[i % 4][1]
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, int(toxic)))
    docs += [(1000 + i, docs[i][1].replace("ta ", "ta  ", 1), "en", "s1", None) for i in range(1, 60, 4)]
    docs += [(2000, None, None, None, None), (2001, "", "en", None, 0), (2002, "", "en", None, 0), (3, docs[3][1], "fr", "s0", 5)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect()), key=repr)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "minhash_dedup", "decontaminate", "byte_bpe"]

    kept = stages["toxicity"](spark, docs, folder)
    assert kept.columns == corpus_pipeline.COLUMNS
    given, mild = rows_of(docs), rows_of(kept)
    assert not Counter(mild) - Counter(given)
    wrong = [r for r in mild if "grobz" in (r[1] or "")] + [r for r in (Counter(given) - Counter(mild)) if "grobz" not in (r[1] or "")]
    assert len(wrong) <= 3

    pages, seen = Counter(), Counter()
    for source, text in {(r[3], r[1]) for r in mild if r[1] is not None}:
        pages[source] += 1
        seen.update((source, line) for line in set(text.split("\n")) if line.strip(" "))
    bad = {k for k, n in seen.items() if n >= MIN_PAGES and n > RATIO * pages[k[0]]}
    want = []
    for i, text, lang, source, n in mild:
        lines = text.split("\n") if text is not None else []
        left = [x for x in lines if (source, x) not in bad]
        new = "\n".join(left) if text is not None else None
        want.append((i, new, lang, source, len(new) if len(left) < len(lines) else n))
    lined = stages["line_dedup"](spark, kept, folder)
    assert rows_of(lined) == sorted(want, key=repr) and bad

    single = stages["minhash_dedup"](spark, lined, folder)
    group = brute_groups([(r[0], r[1]) for r in want])
    assert sorted(r[0] for r in rows_of(single)) == sorted(i for i, (_, c) in group.items() if i == c)
    assert not Counter(rows_of(single)) - Counter(want)

    clean = stages["decontaminate"](spark, single, folder)
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hits = {k: (n, hit) for k, n, hit, _ in brute_hits([r[:2] for r in rows_of(single)], items)}
    assert rows_of(clean) == [r for r in rows_of(single) if not (hits[r[0]][1] and 20 * hits[r[0]][1] >= hits[r[0]][0])]

    got = {r.doc_id: r for r in stages["byte_bpe"](spark, clean, folder).collect()}
    ranks, pattern = corpus_pipeline.tokenizer()
    reference = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    assert set(got) == {r[0] for r in rows_of(clean)}
    for i, text, *_ in rows_of(clean):
        ids = reference.encode_ordinary(text or "")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_run_applies_the_stages_and_takes_no_rows(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 300
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
