from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from streamlytics.llm import bpe

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(2)
    out = ["", "a", "  \n\t x", "it's 12 000€ — naïve 北京 🙂🙂", "a" * 5000, "ab" * 3000, "<|endoftext|>", "\x00\x1c\x85  "]
    out += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FF), rng.randrange(0x4E00, 0x9FFF), 32]))
                    for _ in range(rng.randrange(200))) for _ in range(150)]
    return out + ["".join(rng.choice("etaoin") for _ in range(700)), *out[:3]]


@pytest.mark.parametrize("settings", [
    {}, {"CHUNK": 100, "HELD_WORDS": 50}, {"LONG_PART": 5, "CHUNK": 3000}, {"SQUARES": 5000, "DECODED": 700}, {"CUT_FROM": 1, "HELD_CHARS": 90},
    {"CUT_FROM": 10 ** 9, "LONG_PART": 300}])
def test_encode_and_decode_equal_the_library(monkeypatch, ranks, reference, settings):
    for name, value in settings.items():
        monkeypatch.setattr(bpe, name, value)
    codec = bpe.Codec(ranks, P.PATTERN)
    got = list(codec.encode(texts()))
    assert [x.tolist() for x, _ in got] == [reference.encode_ordinary(t) for t in texts()]
    assert [s for _, s in got] == [",".join(map(str, x.tolist())) for x, _ in got]
    assert codec.decode([x for x, _ in got]) == [t.encode() for t in texts()]
    with pytest.raises(ValueError):
        codec.decode([np.array([50256])])


def unspaced(rng, n):
    """Letters without blanks: common and rare ones of a script."""
    return "".join(chr(0x4E00 + min(int(rng.expovariate(0.002)), 0x51FF)) for _ in range(n))


def same(codec, reference, texts):
    got = [x.tolist() for x, _ in codec.encode(texts)]
    assert got == [reference.encode_ordinary(t) for t in texts]
    assert codec.decode([np.array(x, np.int32) for x in got]) == [t.encode() for t in texts]


def test_texts_without_blanks(ranks, reference):
    """Under the memory limit of the codec's database."""
    rng, codec = random.Random(3), bpe.Codec(ranks, P.PATTERN)
    same(codec, reference, [unspaced(rng, 4000) for _ in range(256)])
    same(codec, reference, ["。".join(unspaced(rng, rng.randrange(5, 60)) for _ in range(12_000))])
    same(codec, reference, [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=240)) for _ in range(1500))])
    same(codec, reference, ["a" * 100_000 + "é" * 50_000 + " " * 70_000 + "\n\t" * 9_000 + "the" * 30_000 + "!?" * 20_000])


def test_one_very_long_word(ranks, reference):
    same(bpe.Codec(ranks, P.PATTERN), reference, [unspaced(random.Random(4), 5_000_000)])


def test_cuts_lie_where_no_token_occurs(ranks):
    codec, rng = bpe.Codec(ranks, P.PATTERN), random.Random(5)
    for _ in range(20):
        words = [unspaced(rng, rng.randrange(1, 30)).encode() + rng.choice([b"", b"abc", bytes(rng.choices(range(256), k=9))]) for _ in range(3)]
        want, first = [0], 0
        for w in words:
            crossed = {i for a in range(len(w)) for b in range(a + 2, len(w) + 1) if w[a:b] in ranks for i in range(a + 1, b)}
            want += [first + i for i in range(1, len(w) + 1) if i not in crossed]
            first += len(w)
        assert codec._cuts(words).tolist() == want


def test_frames(spark, ranks, reference):
    rows = [*enumerate(texts()), (None, "ab"), (2 ** 60 + 1, None), (1, "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS ids", "'x' AS decoded")
    want = sorted(((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=repr)
    got = bpe.round_trip(df, ranks, P.PATTERN).collect()
    assert sorted(((r.doc_id, r.decoded_sha256) for r in got), key=repr) == want
    by = {r.doc_id: r for r in got}
    assert by[3].n_tokens == len(reference.encode_ordinary(rows[3][1]))
    coded = bpe.encode(df, ranks, P.PATTERN)
    back = bpe.decode(coded, ranks, P.PATTERN).collect()
    assert sorted(((r.doc_id, hashlib.sha256(bytes(r.decoded)).hexdigest()) for r in back), key=repr) == want
    assert bpe.round_trip(df.limit(0), ranks, P.PATTERN).collect() == []
