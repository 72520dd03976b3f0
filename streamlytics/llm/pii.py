"""Personal data: base patterns and a skip-chain conditional random field.

Base spans are the matches of four patterns (e-mail, ip, card, phone) with their checks. The field reads the tokens of a
document (runs without white space) and adds spans the patterns miss. Its chain joins neighbouring tokens; skip edges join
a token to the one before it with the same letters and digits, or the same run of six or more digits, and reward equal
labels, so what is marked in one place is marked in all. Tokens without a digit or ``@`` cannot be such data: their label
is fixed, which cuts the chain around them, so only the other tokens need messages.

Loopy message passing runs over many documents at once, forwards and backwards along the order of the tokens, so evidence
crosses a document in one sweep. Each connected part is swept until none of its messages changes by ``STILL`` or more;
parts that oscillate are damped more and more until they stand still.

The field is trained on some ``SAMPLE`` texts of up to ``SAMPLE_CHARS`` characters (a documented bound: the sample is
brought to the driver; a hash of the text decides), labelled by the base spans. A run of tokens of one label, each
with a marginal of ``SURE`` or more, is added unless it touches a base span.

Offsets are code points, the end exclusive. Null texts are empty and have no spans; every row gives a row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.llm.sampling import hashed_sample

KINDS = ("email", "ip", "card", "phone")
SAMPLE, SAMPLE_CHARS = 3_000, 8_000
SURE = 0.95
STILL, PATIENCE = 1e-5, 20  # least change of a message; sweeps before the damping of what still moves is doubled
STEPS, RATE = 120, 0.1
BUCKETS = 1 << 11
LABELS = 1 + len(KINDS)  # 0: none of them

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match that fails at the first digit of a run fails at all of them, so runs are entered at their start only.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_EDGE = ".,;:!?\"'()[]{}<>"

Span = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(x for d in digits[-2::-2] for x in divmod(2 * int(d), 10))
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text[start - 1]):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns, by start and then kind."""
    out = [(s, e, 0) for s, e in _emails(text)]
    out += [(m.start(), m.end(), 1) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    out += [(m.start(), m.end(), 2) for m in _CARD.finditer(text)
            if len(m[0]) >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[0], x[2]))


def tokens(text: str) -> list[tuple[int, int]]:
    """The tokens with a digit or ``@``, without marks at their ends."""
    out = []
    for m in _TOKEN.finditer(text):
        word = m[0].rstrip(_EDGE)
        start = m.start() + len(word) - len(word.lstrip(_EDGE))
        if start < m.start() + len(word):
            out.append((start, m.start() + len(word)))
    return out


def _features(word: str, before: str) -> list[str]:
    digits = _digits(word)
    shape = re.sub("(.)\\1{2,}", "\\1\\1+", re.sub("[^\\W\\d_]", "a", re.sub("[0-9]", "9", word)))[:24]
    out = ["all", f"shape {shape}", f"digits {min(len(digits), 20)}", f"before {before[-2:]}"]
    if 12 <= len(digits) <= 19 and not re.search("[^0-9 -]", word):
        out.append(f"luhn {luhn(digits)}")
    parts = word.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        out.append(f"octets {all(len(p) <= 3 and int(p) <= 255 for p in parts)}")
    name, at, domain = word.partition("@")
    if at:
        out.append(f"email {bool(name) and bool(_DOMAIN.fullmatch(domain))}")
    if word[:1] == "+":
        out.append("plus")
    return out


class Graph:
    """Tokens of many documents with their features and edges."""

    def __init__(self, texts: list[str]):
        from zlib import crc32

        self.spans, self.doc, feature, owner = [], [], [], []
        chain, skip, left, right = [], [], [], []
        for number, text in enumerate(texts):
            last, seen, previous = -1, {}, -1
            for start, end in tokens(text):
                i = len(self.spans)
                word = text[start:end]
                self.spans.append((start, end))
                self.doc.append(number)
                for name in _features(word, text[max(0, start - 2):start]):
                    feature.append(crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS)
                    owner.append(i)
                # Neighbours in the text, if nothing but marks and white space lies between.
                near = previous >= 0 and not text[last:start].strip(" \t\r\n" + _EDGE)
                if near:
                    chain.append((previous, i))
                else:
                    left.append(i)
                    if previous >= 0:
                        right.append(previous)
                for key in {re.sub(r"[\W_]", "", word).lower(), d if len(d := _digits(word)) >= 6 else ""} - {""}:
                    if key in seen and seen[key] != i:
                        skip.append((seen[key], i))
                    seen[key] = i
                previous, last = i, end
            if previous >= 0:
                right.append(previous)
        self.feature, self.owner = np.array(feature, int), np.array(owner, int)
        self.chain, self.skip = (np.array(sorted(set(x)), int).reshape(-1, 2) for x in (chain, skip))
        self.left, self.right = np.array(left, int), np.array(right, int)  # next to tokens fixed to label 0
        self.edges = np.concatenate([self.chain, self.skip])
        self.part = self._parts()

    def _parts(self) -> np.ndarray:
        """The connected part of each token, named by its first token."""
        part, (a, b) = np.arange(len(self)), self.edges.T
        while True:
            least = np.minimum(part[a], part[b])
            new = part.copy()
            for x in (a, b, part[a], part[b]):
                np.minimum.at(new, x, least)
            new = new[new]
            if (new == part).all():
                return part
            part = new

    def levels(self) -> np.ndarray:
        """For each edge (from an earlier token to a later one) the length of the longest way to its earlier token."""
        depth = [0] * len(self)
        order = np.argsort(self.edges[:, 0], kind="stable")
        for a, b in self.edges[order].tolist():  # all edges into a token come before those out of it
            depth[b] = max(depth[b], depth[a] + 1)
        return np.array(depth, int)[self.edges[:, 0]]

    def __len__(self) -> int:
        return len(self.spans)


def initial() -> dict[str, np.ndarray]:
    return {"node": np.zeros((BUCKETS, LABELS)), "chain": np.zeros((LABELS, LABELS)), "skip": np.zeros(LABELS),
            "differ": np.zeros(1)}


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class Messages:
    """The messages along the edges of a graph, down to the later token and up to the earlier one.

    ``ordered`` sends them level by level, forwards and then backwards; otherwise all are sent at once, which suits
    small changes from messages that were still before."""

    def __init__(self, graph: Graph, ordered: bool = True):
        self.graph = graph
        self.down, self.up = np.zeros((2, len(graph.edges), LABELS))
        level = graph.levels() if ordered else np.zeros(len(graph.edges), int)
        self.order = np.argsort(level, kind="stable")
        self.level = level[self.order]

    def settle(self, node: np.ndarray, weight: np.ndarray, still: float = STILL) -> np.ndarray:
        """Sends messages until they stand still; returns the beliefs."""
        a, b = self.graph.edges.T
        belief = node.copy()
        np.add.at(belief, b, self.down)
        np.add.at(belief, a, self.up)
        active, part = np.ones(len(a), bool), self.graph.part[a]
        sweep = 0
        while active.any():
            step = 0.5 ** (sweep // PATIENCE) * (1.0 if self.level[-1] else 0.5)
            moved = np.zeros(len(a))
            picked = active[self.order]
            order, level = self.order[picked], self.level[picked]
            groups = np.split(order, np.flatnonzero(level[1:] != level[:-1]) + 1)
            for edges, way in (*((g, 0) for g in groups), *((g, 1) for g in reversed(groups))):
                source, target, mine, back = (a, b, self.down, self.up) if way == 0 else (b, a, self.up, self.down)
                rest = (belief[source[edges]] - back[edges])[:, :, None] + (
                    weight[edges] if way == 0 else weight[edges].transpose(0, 2, 1))
                new = _log_sum(rest, 1)
                new = step * (new - new.max(1, keepdims=True) - mine[edges])
                moved[edges] = np.maximum(moved[edges], np.abs(new).max(1))
                mine[edges] += new
                np.add.at(belief, target[edges], new)
            restless = np.zeros(len(self.graph), bool)
            restless[part[moved >= still]] = True
            active = restless[part]
            sweep += 1
        return belief


def infer(graph: Graph, net: dict, messages: Messages | None = None, still: float = STILL) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of the tokens, and of the pairs along chain and skip edges, by loopy message passing."""
    node = np.zeros((len(graph), LABELS))
    np.add.at(node, graph.owner, net["node"][graph.feature])
    np.add.at(node, graph.left, net["chain"][0][None].repeat(len(graph.left), 0))
    np.add.at(node, graph.right, net["chain"][:, 0][None].repeat(len(graph.right), 0))
    pair = np.diag(net["skip"]) + net["differ"] * (1 - np.eye(LABELS))
    weight = np.concatenate([net["chain"][None].repeat(len(graph.chain), 0), pair[None].repeat(len(graph.skip), 0)])
    messages = messages or Messages(graph)
    belief = messages.settle(node, weight, still)
    a, b = graph.edges.T
    both = (belief[a] - messages.up)[:, :, None] + weight + (belief[b] - messages.down)[:, None, :]
    both = np.exp(both - both.max((1, 2), keepdims=True))
    both /= both.sum((1, 2), keepdims=True)
    single = np.exp(belief - belief.max(1, keepdims=True))
    single /= single.sum(1, keepdims=True)
    return single, both[:len(graph.chain)], both[len(graph.chain):]


def fit(texts: list[str]) -> dict[str, np.ndarray]:
    """The field's weights, by gradient ascent on the likelihood of the labels that the base spans give."""
    graph, net = Graph(texts), initial()
    if not len(graph):
        return net
    spans = [base_spans(t) for t in texts]
    y = np.zeros(len(graph), int)
    for i, (number, (start, end)) in enumerate(zip(graph.doc, graph.spans, strict=True)):
        y[i] = next((k + 1 for s, e, k in spans[number] if s < end and start < e), 0)
    one = np.eye(LABELS)
    seen = {"node": np.zeros_like(net["node"])}
    np.add.at(seen["node"], graph.feature, one[y][graph.owner])
    moments = {k: (np.zeros_like(p), np.zeros_like(p)) for k, p in net.items()}
    messages = Messages(graph, ordered=False)  # those of a step are nearly those of the one before
    for step in range(1, STEPS + 1):
        single, chain, skip = infer(graph, net, messages, still=1e-3)
        grad = {"node": seen["node"].copy(), "chain": np.zeros((LABELS, LABELS)), "skip": np.zeros(LABELS)}
        np.add.at(grad["node"], graph.feature, -single[graph.owner])
        np.add.at(grad["chain"], (y[graph.chain[:, 0]], y[graph.chain[:, 1]]), 1)
        grad["chain"] -= chain.sum(0)
        grad["chain"][0] += np.bincount(y[graph.left], minlength=LABELS) - single[graph.left].sum(0)
        grad["chain"][:, 0] += np.bincount(y[graph.right], minlength=LABELS) - single[graph.right].sum(0)
        same = y[graph.skip[:, 0]] == y[graph.skip[:, 1]]
        grad["skip"] += np.bincount(y[graph.skip[same, 0]], minlength=LABELS) - np.einsum("ekk->k", skip)
        grad["differ"] = np.array([(~same).sum() - (skip.sum() - np.einsum("ekk->", skip))])
        for k, p in net.items():
            m, v = moments[k]
            g = grad[k] - 0.05 * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    return net


def added_spans(texts: list[str], base: list[list[Span]], net: dict, sure: float = SURE) -> list[list[Span]]:
    """What the field adds to the base spans of each text."""
    graph, out = Graph(texts), [[] for _ in texts]
    if not len(graph):
        return out
    single = infer(graph, net)[0]
    label, good = single.argmax(1), single.max(1) >= sure
    joined = {int(b): int(a) for a, b in graph.chain}
    runs: list[list[int]] = []
    for i in np.flatnonzero(good & (label > 0)):
        if runs and joined.get(int(i)) == runs[-1][-1] and label[i] == label[runs[-1][-1]]:
            runs[-1].append(int(i))
        else:
            runs.append([int(i)])
    starts = [np.array([s for s, _, _ in b]) for b in base]
    ends = [np.maximum.accumulate([e for _, e, _ in b]) if b else np.array([]) for b in base]
    for run in runs:
        number = graph.doc[run[0]]
        s, e = graph.spans[run[0]][0], graph.spans[run[-1]][1]
        before = int(np.searchsorted(starts[number], e))  # base spans that start before the run ends
        if not before or ends[number][before - 1] <= s:
            out[number].append((s, e, int(label[run[0]]) - 1))
    return out


def train(df: DataFrame, text: str = "text", sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> dict[str, np.ndarray]:
    rows = df.select(F.col(text).alias("text")).filter((F.length("text") <= chars) & F.col("text").rlike("[0-9@]"))
    rows = hashed_sample(rows, F.col("text"), sample).distinct().collect()  # copies of a text count once
    return fit(sorted(r["text"] for r in rows)[:2 * sample])


def find(df: DataFrame, net: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base, spans)`` for each row: the numbers of base spans, and the base
    and all spans as ``kind:start:end`` by start, then kind, joined by commas."""

    def listed(spans: list[Span]) -> str:
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1])))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            base = [base_spans(t) for t in texts]
            more = added_spans(texts, base, net)
            out = {"doc_id": batch["doc_id"]}
            for k, kind in enumerate(KINDS):
                out[f"n_{kind}"] = [sum(x[2] == k for x in b) for b in base]
            yield pd.DataFrame(out | {
                "base": [listed(b) for b in base], "spans": [listed(b + m) for b, m in zip(base, more, strict=True)]})

    # Ids pass through pandas as strings: numbers with nulls among them would become floats.
    return df.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).mapInPandas(
        run, "doc_id string, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, spans string"
    ).withColumn("doc_id", F.col("doc_id").cast("bigint"))
