from __future__ import annotations

import random
import re

import pytest

from streamlytics.llm import pii


def naive(text):
    def digits(x):
        return re.sub("[^0-9]", "", x)

    out = [(*m.span(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(*m.span(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(*m.span(), 2) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 12 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [(*m.span(), 3) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[0], x[2]))


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    pieces = ["a", "B.", "x@y", "@", "m.n@o-p.q", "1.2.3.4", "300.1.1.1", "001.2.3.255", ".", "4111 1111 1111 1111", "+1 (988) 555-2485",
              "4111111111111112", "-", " ", "+", "é", "\n", "7", "12", "@a.b@c.d", "1.2.3.4.5.6.7.8", "+49-30"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(9)))
        assert pii.base_spans(text) == naive(text), text
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_long_runs_take_linear_time():
    assert len(pii.base_spans("1." * 150_000)) == 37_500
    for text in ("a" * 300_000, "1" * 300_000, "@" * 300_000, "+1" + " " * 300_000, "a@" * 100_000, "é" * 300_000):
        assert pii.base_spans(text) == [] and isinstance(pii.tokens(text), list)


@pytest.fixture(scope="module")
def net():
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefg", k=rng.randrange(2, 8)))

    def card():
        while True:
            x = "4" + "".join(rng.choices("0123456789", k=15))
            if pii.luhn(x):
                return x

    def thing():
        return rng.choice([
            lambda: f"{word()}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", lambda: ".".join(str(rng.randrange(256)) for _ in range(4)),
            card, lambda: f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", lambda: str(rng.randrange(10 ** rng.randrange(1, 17))),
            lambda: f"v{rng.randrange(9)}.{rng.randrange(9)}"])()

    return pii.fit([" ".join(w for _ in range(rng.randrange(1, 6)) for w in (*(word() for _ in range(rng.randrange(1, 9))), thing()))
                    for _ in range(600)])


def all_spans(net, *texts):
    base = [pii.base_spans(t) for t in texts]
    return [[(t[s:e], pii.KINDS[k]) for s, e, k in m] for t, m in zip(texts, pii.added_spans(list(texts), base, net), strict=True)]


def test_what_the_field_adds(net):
    # Greedy patterns run the number before into the card or the phone, and drop both.
    got = all_spans(net, "pay 4111111111111111 12 now", "call +1 (988) 555-2485 4041894974608795 ok", "only words", "", "1 2 3 4 in 2024")
    assert got[2:] == [[], [], []]
    assert ("4111111111111111", "card") in got[0] or ("4111111111111111 12", "card") in got[0]
    assert any(kind in ("phone", "card") for _, kind in got[1])


def drawn(rng, edges, n, scale=1.0):
    """A graph of bare tokens with chain edges and random weights."""
    graph = pii.Graph([])
    graph.spans, graph.doc = [(i, i + 1) for i in range(n)], [0] * n
    graph.feature, graph.owner = pii.np.arange(n), pii.np.arange(n)
    graph.chain = pii.np.array(edges, int).reshape(-1, 2)
    graph.skip = pii.np.empty((0, 2), int)
    graph.edges, graph.left, graph.right = graph.chain, pii.np.empty(0, int), pii.np.empty(0, int)
    graph.part = graph._parts()
    net = pii.initial()
    net["node"] = rng.normal(size=net["node"].shape)
    net["chain"] = rng.normal(size=net["chain"].shape) * scale
    return graph, net


def exact(graph, net):
    """Marginals by the sum over all labellings."""
    import itertools

    n, total = len(graph), pii.np.zeros((len(graph), pii.LABELS))
    for y in itertools.product(range(pii.LABELS), repeat=n):
        p = pii.np.exp(sum(net["node"][i, k] for i, k in enumerate(y)) + sum(net["chain"][y[a], y[b]] for a, b in graph.chain))
        for i, k in enumerate(y):
            total[i, k] += p
    return total / total.sum(1, keepdims=True)


@pytest.mark.parametrize("edges", [
    [(0, 1), (1, 2), (2, 3), (3, 4)], [(0, 3), (1, 3), (2, 3), (3, 4)], [(0, 1), (0, 2), (2, 4), (3, 4)], [(0, 2), (1, 2), (1, 4)], []])
def test_marginals_of_trees_are_exact(edges):
    graph, net = drawn(pii.np.random.default_rng(len(edges)), edges, 5)
    assert pii.np.allclose(pii.infer(graph, net)[0], exact(graph, net), atol=1e-4)


@pytest.mark.parametrize("edges", [[(0, 1), (1, 2), (0, 2)], [(0, 1), (1, 2), (2, 3), (0, 3), (1, 4)], [(0, 1), (0, 2), (1, 2), (2, 3), (2, 4), (3, 4)]])
def test_marginals_of_loops_are_near(edges):
    graph, net = drawn(pii.np.random.default_rng(7), edges, 5, scale=0.3)
    assert abs(pii.infer(graph, net)[0] - exact(graph, net)).max() < 0.02


def test_messages_that_oscillate_come_to_rest():
    graph, net = drawn(pii.np.random.default_rng(8), [(a, b) for a in range(7) for b in range(a + 1, 7)], 7)
    net["chain"] = -8.0 * pii.np.eye(pii.LABELS)
    assert pii.np.isfinite(pii.infer(graph, net)[0]).all()


def test_skip_edges_carry_a_label_through_a_document(net):
    """One strong mention among weak ones: first, last, in the middle."""
    np = pii.np
    net = pii.initial() | {"skip": np.full(pii.LABELS, 2.0)}
    for n, strong in ((31, 0), (31, 30), (31, 15), (400, 399)):
        graph = pii.Graph([" x ".join(["4111111111111111"] * n)])
        assert len(graph.skip) == n - 1 and not len(graph.chain)
        graph.feature, graph.owner = np.array([5]), np.array([strong])
        net["node"][5] = [0, 0, 0, 8.0, 0]
        got = pii.infer(graph, net)[0]
        # By hand: on a chain of equal edges a message shrinks by the same map at each hop.
        pair = np.exp(np.diag(net["skip"]))
        message, want = np.exp(net["node"][5]) / np.exp(net["node"][5]).sum(), np.zeros((n, pii.LABELS))
        for hop in range(n):
            for place in {strong - hop, strong + hop} & set(range(n)):
                want[place] = message
            message = message @ pair / (message @ pair).sum()
        assert np.allclose(got, want, atol=1e-4)
        assert (got.argmax(1)[max(0, strong - 15):strong + 16] == 3).all()


def test_many_equal_tokens_take_linear_time(net):
    graph = pii.Graph([" x ".join(["4111111111111111"] * 20_000)])
    assert len(pii.infer(graph, net)[0]) == 20_000


def test_frames(spark, net):
    rows = [(1, "me a.b@c.de"), (2, None), (None, ""), (2 ** 60 + 1, "10.0.0.1 10.0.0.1"), (1, "me a.b@c.de"), (5, "é🙂 +49 (30) 901-820-11")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS base", "'x' AS spans")
    got = sorted(([r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base] for r in pii.find(df, net).collect()), key=repr)
    assert got == sorted([
        [1, 1, 0, 0, 0, "email:3:11"], [1, 1, 0, 0, 0, "email:3:11"], [2, 0, 0, 0, 0, ""], [None, 0, 0, 0, 0, ""],
        [2 ** 60 + 1, 0, 2, 0, 0, "ip:0:8,ip:9:17"], [5, 0, 0, 0, 1, "phone:3:22"]], key=repr)
    assert pii.find(df.limit(0), pii.train(df.limit(0))).collect() == []
    for r in pii.find(df, pii.train(df)).collect():
        assert set(filter(None, r.base.split(","))) <= set(r.spans.split(","))
