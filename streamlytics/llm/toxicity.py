"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Inputs of a word are its own (a hashed embedding and the log-odds of the word in toxic texts) and those of its characters
(the mean embedding of its 3- to 5-grams and the largest and mean of their log-odds). The network reads overlapping
windows of words forwards and backwards, pools the states by attention and gives a log-odds for each window; a text's
score is a calibrated logistic function of its highest window. All windows of the whole text are scored.

Training uses labelled rows of the caller's choice, some ``SAMPLE`` texts of up to ``SAMPLE_CHARS`` characters (a
documented bound: the sample is brought to the driver; a hash of the id decides). Six sevenths of
it train the network in two folds, each with the log-odds counted in the other; the rest calibrates the score, so no text
vouches for itself. Labels are of whole texts, so
each round trains on the windows that the last round found highest.

Defined results: null and empty texts, and texts without words, score 0. Every row gives a row. Where the sample has no
two classes, every score is 0. Rows with a null label are not labelled; of several labels of one id the largest counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.llm.sampling import hashed_sample

SAMPLE, SAMPLE_CHARS = 4_000, 8_000
WINDOW, STRIDE = 24, 12  # a passage of up to 13 words is whole in some window
HIDDEN, EMBED = 8, 6
BUCKETS, EMBED_BUCKETS = 1 << 18, 1 << 12
HELD_WORDS = 250_000
AT_ONCE = 10_000  # words whose inputs are made in one step of the training
ROUNDS, STEPS, BATCH, RATE = 5, 800, 64, 0.01  # rounds of each fold at least, and steps in all
_PLAIN = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in lower case: runs of ASCII letters and digits and of any other characters."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split() if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _A
    x ^= x >> np.uint64(29)
    x = x * _B
    return x ^ (x >> np.uint64(32))


def _hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: a hash, and the hashes of its 3- to 5-grams (ends marked) with the place of its first one."""
    marked = [b"\x02" + w + b"\x03\x03\x03" for w in words]
    size = np.array([len(m) for m in marked])
    raw = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    start = np.cumsum(size) - size
    three = _mix(_mix(raw[:-2] + np.uint64(1)) + _mix(raw[1:-1] * np.uint64(257)) * np.uint64(3) + raw[2:] * np.uint64(65537))
    power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(int(size.max()), _A))))
    at = np.arange(len(raw)) - np.repeat(start, size)
    whole = _mix(np.add.reduceat(_mix(raw + np.uint64(1)) * power[at], start))
    n = size - 4  # grams that start at each of the word's characters, and one more at its beginning
    keep = at < np.repeat(n + 1, size)
    place = np.flatnonzero(keep)
    pad = np.concatenate((three, np.zeros(4, np.uint64)))
    grams = np.stack([pad[place], _mix(pad[place] + pad[place + 1] * np.uint64(5)), _mix(pad[place] + pad[place + 2] * np.uint64(7))], 1)
    return whole, grams.reshape(-1), np.cumsum(3 * (n + 1)) - 3 * (n + 1)


class Features:
    """The inputs of words; ``odds`` holds log-odds by bucket, of words and of grams."""

    def __init__(self, odds: np.ndarray, embed_word: np.ndarray, embed_gram: np.ndarray):
        self.odds, self.embed_word, self.embed_gram = odds, embed_word, embed_gram

    def __call__(self, words: list[bytes]):
        return self.inputs(*_hashes(words))

    def inputs(self, whole: np.ndarray, grams: np.ndarray, first: np.ndarray):
        """The inputs from :func:`_hashes`, and what the gradient of the embeddings needs."""
        count = np.diff(np.append(first, len(grams)))
        gram_odds = self.odds[1][grams % np.uint64(BUCKETS)]
        in_word, in_gram = (whole >> np.uint64(40)) % np.uint64(EMBED_BUCKETS), (grams >> np.uint64(40)) % np.uint64(EMBED_BUCKETS)
        x = np.empty((len(whole), 3 + 2 * EMBED), np.float32)
        x[:, 0] = self.odds[0][whole % np.uint64(BUCKETS)]
        x[:, 1] = np.maximum.reduceat(gram_odds, first)
        x[:, 2] = np.add.reduceat(gram_odds, first) / count
        x[:, 3:3 + EMBED] = self.embed_word[in_word]
        x[:, 3 + EMBED:] = np.add.reduceat(self.embed_gram[in_gram], first, 0) / count[:, None]
        return x, (in_word, in_gram, first, count)


def log_odds(texts: list[list[bytes]], toxic: np.ndarray) -> np.ndarray:
    """Smoothed log-odds of words and grams by the number of toxic and other texts that hold them."""
    seen = np.zeros((2, 2, BUCKETS), np.float32)
    for words, label in zip(texts, toxic, strict=True):
        if words:
            whole, grams, _ = _hashes(sorted(set(words)))
            for kind, x in enumerate((whole, grams)):
                seen[kind, int(label), np.unique(x % np.uint64(BUCKETS))] += 1
    share = (seen[:, 1] + 0.2) / (toxic.sum() + 0.4), (seen[:, 0] + 0.2) / (len(toxic) - toxic.sum() + 0.4)
    odds = np.log(share[0] / share[1])
    odds[seen.sum(1) < 3] = 0
    return (odds / 3).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(inputs: int, seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    made = {}
    for side in "fb":
        made[f"W{side}"] = rng.normal(0, 0.3, (inputs, 3 * HIDDEN))
        made[f"U{side}"] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
        made[f"c{side}"] = np.zeros(3 * HIDDEN)
    made |= {"v": rng.normal(0, 0.3, 2 * HIDDEN), "w": rng.normal(0, 0.3, 2 * HIDDEN), "b": np.zeros(1)}
    return {k: x.astype(np.float32) for k, x in made.items()}


def _direction(gates: np.ndarray, at: np.ndarray, there: np.ndarray, u: np.ndarray, back: bool,
               keep: list | None = None) -> np.ndarray:
    """States (windows, places, hidden) of one direction; ``gates`` by word, ``at`` the words of the windows; ``keep``
    gets what the gradient needs."""
    n, places = at.shape
    h, out = np.zeros((n, HIDDEN), np.float32), np.empty((n, places, HIDDEN), np.float32)
    for t in range(places - 1, -1, -1) if back else range(places):
        x, hu = gates[at[:, t]], h @ u
        zr = 1 / (1 + np.exp(-(x[:, :2 * HIDDEN] + hu[:, :2 * HIDDEN])))
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        new = np.tanh(x[:, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
        m = there[:, t]
        after = new + z * (h - new)
        if not m.all():
            after = np.where(m[:, None], after, h)
        if keep is not None:
            keep.append((t, h, z, r, new, hu[:, 2 * HIDDEN:], m))
        h = after
        out[:, t] = h
    return out


def _pool(states: np.ndarray, there: np.ndarray, net: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    score = np.where(there, states @ net["v"], -1e9)
    weight = np.exp(score - score.max(1, keepdims=True))
    weight /= weight.sum(1, keepdims=True)
    pooled = np.einsum("nt,nth->nh", weight, states)
    return pooled @ net["w"] + net["b"][0], weight, pooled


def forward(gates: dict[str, np.ndarray], at: np.ndarray, net: dict) -> np.ndarray:
    there = at > 0
    states = np.concatenate([_direction(gates[s], at, there, net[f"U{s}"], s == "b") for s in "fb"], 2)
    return _pool(states, there, net)[0]


def gradients(inputs: np.ndarray, at: np.ndarray, y: np.ndarray, net: dict) -> tuple[dict, np.ndarray]:
    """Of the mean log loss: by parameter, and by the inputs of each place; ``inputs`` by word, word 0 pads."""
    there, x = at > 0, inputs[at]
    kept, states = {"f": [], "b": []}, []
    for s in "fb":
        states.append(_direction(inputs @ net[f"W{s}"] + net[f"c{s}"], at, there, net[f"U{s}"], s == "b", kept[s]))
    both = np.concatenate(states, 2)
    logit, weight, pooled = _pool(both, there, net)
    d = ((_sigmoid(logit) - y) / len(y)).astype(np.float32)
    grad = {"w": pooled.T @ d, "b": d.sum(keepdims=True)}
    d_pooled = d[:, None] * net["w"]
    along = np.einsum("nh,nth->nt", d_pooled, both)
    d_score = weight * (along - (weight * along).sum(1, keepdims=True))
    grad["v"] = np.einsum("nt,nth->h", d_score, both)
    d_states = weight[:, :, None] * d_pooled[:, None] + d_score[:, :, None] * net["v"]
    d_x = np.zeros_like(x)
    for k, s in enumerate("fb"):
        u, d_u, d_gates = net[f"U{s}"], np.zeros_like(net[f"U{s}"]), np.zeros((*at.shape, 3 * HIDDEN), np.float32)
        d_h = np.zeros((len(x), HIDDEN), np.float32)
        for t, h, z, r, new, hun, m in reversed(kept[s]):
            d_h = d_h + d_states[:, t, k * HIDDEN:(k + 1) * HIDDEN]
            d_new = d_h * (1 - z) * (1 - new * new)
            d_z = d_h * (h - new) * z * (1 - z)
            d_r = d_new * hun * r * (1 - r)
            g = np.concatenate([d_z, d_r, d_new], 1) * m[:, None]
            to_u = np.concatenate([d_z, d_r, d_new * r], 1) * m[:, None]
            d_gates[:, t] = g
            d_u += h.T @ to_u
            d_h = np.where(m[:, None], d_h * z, d_h) + to_u @ u.T
        grad[f"U{s}"], grad[f"c{s}"] = d_u, d_gates.sum((0, 1))
        grad[f"W{s}"] = np.einsum("nti,ntg->ig", x, d_gates)
        d_x += d_gates @ net[f"W{s}"].T
    return grad, d_x


def windows(n: int) -> np.ndarray:
    """The first places of the overlapping windows of ``n`` words; together they hold every word."""
    return np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)


def _spread(numbers: np.ndarray, pad: int) -> np.ndarray:
    """(windows, places) word numbers, padded."""
    at = windows(len(numbers))
    held = np.full(at[-1] + WINDOW, pad, numbers.dtype)
    held[:len(numbers)] = numbers
    return np.lib.stride_tricks.sliding_window_view(held, WINDOW)[at]


class Scorer:
    """Scores texts; remembers the gate inputs of the words it has met."""

    def __init__(self, features: Features, net: dict, scale: tuple[float, float] = (1.0, 0.0)):
        self.features, self.net, self.scale = features, net, scale
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.gates = {s: np.zeros((1, 3 * HIDDEN), np.float32) for s in "fb"}  # place 0 pads

    def _learn(self, words: set[bytes]) -> None:
        if words:
            words = sorted(words)
            self.number.update(zip(words, range(len(self.number) + 1, len(self.number) + 1 + len(words)), strict=True))
            x = self.features(words)[0]
            for s in "fb":
                self.gates[s] = np.concatenate([self.gates[s], x @ self.net[f"W{s}"] + self.net[f"c{s}"]])

    def highest(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Of each text, the log-odds of its highest window (-inf without words) and that window's number."""
        best, which = np.full(len(texts), -np.inf), np.zeros(len(texts), int)
        held: list[int] = []
        n = 0
        todo = [i for i, words in enumerate(texts) if words]
        for k, i in enumerate(todo):
            held.append(i)
            n += len(texts[i])
            if n >= 60_000 or k == len(todo) - 1:
                if len(self.number) > HELD_WORDS:
                    self._forget()
                self._learn(set().union(*(texts[j] for j in held)).difference(self.number))
                number = self.number
                parts = [_spread(np.array([number[w] for w in texts[j]], np.int32), 0) for j in held]
                for j, logit in zip(held, self._logits(parts), strict=True):
                    which[j] = logit.argmax()
                    best[j] = logit[which[j]]
                held, n = [], 0
        return best, which

    def _logits(self, parts: list[np.ndarray]) -> list[np.ndarray]:
        rows = np.concatenate(parts)
        out = []
        for i in range(0, len(rows), 1024):
            part = rows[i:i + 1024]
            out.append(forward(self.gates, part, self.net))
        return np.split(np.concatenate(out), np.cumsum([len(p) for p in parts])[:-1])

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        best, _ = self.highest([words_of(t) for t in texts])
        return np.where(np.isfinite(best), _sigmoid(self.scale[0] * best + self.scale[1]), 0.0)


def fit(texts: list[str], toxic: np.ndarray, seed: int = 1) -> Scorer | None:
    """A scorer from labelled texts, or None without two classes among them."""
    rng, pool = np.random.default_rng(seed), {}
    cut = [[pool.setdefault(w, w) for w in words_of(t)] for t in texts]  # one object for all uses of a word
    toxic = np.asarray(toxic, float)
    use = np.array([i for i, words in enumerate(cut) if words], int)
    if len(use) < 6 or len(np.unique(toxic[use])) < 2:
        return None
    parts: list[list[int]] = [[], [], []]
    for label in (0, 1):  # each part gets its share of both classes
        for k, i in enumerate(rng.permutation(use[toxic[use] == label])):
            parts[(0, 1, 2, 1, 0, 1, 0)[k % 7]].append(i)
    # With few texts of a class, parts share texts rather than go without.
    parts = [p if len(set(toxic[p])) == 2 else list(use) for p in parts]
    odds = [log_odds([cut[i] for i in p], toxic[p]) for p in (parts[1], parts[0], parts[0] + parts[1])]
    features = Features(odds[2], *(rng.normal(0, 0.1, (EMBED_BUCKETS, EMBED)).astype(np.float32) for _ in range(2)))
    net = initial(3 + 2 * EMBED, seed)
    listed = sorted({w for p in parts[:2] for i in p for w in cut[i]})
    number = {w: k + 1 for k, w in enumerate(listed)}
    pieces = [_hashes(listed[i:i + AT_ONCE]) for i in range(0, len(listed), AT_ONCE)]
    offsets = np.cumsum([0, *(len(p[1]) for p in pieces)])
    hashed = (np.concatenate([p[0] for p in pieces]), np.concatenate([p[1] for p in pieces]),
              np.concatenate([p[2] + o for p, o in zip(pieces, offsets)]))
    ends = np.append(hashed[2], len(hashed[1]))
    folds = []
    for p in parts[:2]:
        spread = [_spread(np.array([number[w] for w in cut[i]], np.int32), 0) for i in p]
        folds.append((toxic[p], np.concatenate(spread), np.cumsum([0, *map(len, spread)])))
    params = net | {"embed_word": features.embed_word, "embed_gram": features.embed_gram}
    moments = {k: (np.zeros_like(p), np.zeros_like(p)) for k, p in params.items()}
    step = 0
    for round_ in range(2 * max(ROUNDS, -(-STEPS * BATCH // (4 * len(parts[0]))))):
        # Each fold is read with the log-odds of the other.
        y, rows, first_row = folds[round_ % 2]
        features.odds = odds[round_ % 2]
        x = np.concatenate([np.zeros((1, 3 + 2 * EMBED), np.float32), *(
            features.inputs(hashed[0][i:i + AT_ONCE], hashed[1][ends[i]:ends[min(i + AT_ONCE, len(listed))]],
                            hashed[2][i:i + AT_ONCE] - ends[i])[0] for i in range(0, len(listed), AT_ONCE))])
        if round_ > 1:
            gates = {s: x @ net[f"W{s}"] + net[f"c{s}"] for s in "fb"}
            found = np.concatenate([forward(gates, rows[i:i + 1024], net) for i in range(0, len(rows), 1024)])
        else:  # before any training, the window with the largest log-odds
            found = x[:, :3].max(1)[rows].max(1)
        chosen = []
        for k, label in enumerate(y):
            a, b = first_row[k], first_row[k + 1]
            chosen.append((a + found[a:b].argmax(), label))
            if not label:
                chosen.append((rng.integers(a, b), label))
        order = rng.permutation(len(chosen))
        for i in range(0, len(order), BATCH):
            part = np.array([chosen[j][0] for j in order[i:i + BATCH]], int)
            label = np.array([chosen[j][1] for j in order[i:i + BATCH]], np.float32)
            used, at = np.unique(np.append(rows[part].reshape(-1), 0), return_inverse=True)
            own = used[1:] - 1
            size = ends[own + 1] - ends[own]
            grams = hashed[1][np.repeat(ends[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            x, (in_word, in_gram, _, count) = features.inputs(hashed[0][own], grams, np.cumsum(size) - size)
            x = np.concatenate([np.zeros((1, x.shape[1]), np.float32), x])
            at = at[:-1].reshape(len(part), WINDOW)
            grad, d_x = gradients(x, at, label, net)
            d_word = np.zeros_like(x)
            np.add.at(d_word, at.reshape(-1), d_x.reshape(-1, x.shape[1]))
            grad["embed_word"], grad["embed_gram"] = np.zeros_like(features.embed_word), np.zeros_like(features.embed_gram)
            np.add.at(grad["embed_word"], in_word, d_word[1:, 3:3 + EMBED])
            np.add.at(grad["embed_gram"], in_gram, np.repeat(d_word[1:, 3 + EMBED:] / count[:, None], count, 0))
            step += 1
            for k, p in params.items():
                g = grad[k].astype(np.float32)
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    features.odds = odds[2]
    scorer = Scorer(features, net)
    held, label = scorer.highest([cut[i] for i in parts[2]])[0], toxic[parts[2]]
    scorer.scale = _calibrated(held, label)
    scorer._forget()
    return scorer


def _calibrated(logit: np.ndarray, y: np.ndarray, rounds: int = 300) -> tuple[float, float]:
    """A logistic line through held-back texts, with a weak pull to the log-odds themselves."""
    a, b = 1.0, 0.0
    for _ in range(rounds):
        e = _sigmoid(a * logit + b) - y
        w = np.maximum(_sigmoid(a * logit + b) * (1 - _sigmoid(a * logit + b)), 1e-4)
        g = np.array([(e * logit).sum() + 2 * (a - 1), e.sum() + 0.2 * b])
        h = np.array([[(w * logit * logit).sum() + 2, (w * logit).sum()], [(w * logit).sum(), w.sum() + 0.2]])
        move = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a - move[0], b - move[1]
    return (float(a), float(b)) if a > 0.05 else (1.0, 0.0)


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are not learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Scorer | None:
    """A scorer from the labelled ``docs`` that are not held out; both have ``doc_id``, ``labels`` has ``toxic``."""
    known = labels.filter(F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # The sample is chosen by ids alone; only its own texts are moved.
    short = docs.filter(F.length("text") <= chars)
    known = hashed_sample(short.select("doc_id").distinct().join(known, "doc_id"), F.col("doc_id"), sample)
    rows = short.select("doc_id", "text").join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id", "text"]).collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["text"]))[:2 * sample]
    return fit([r["text"] for r in rows], np.array([float(r["toxic"]) for r in rows]))


def score(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """``docs`` with column ``score`` (an input column of that name is replaced)."""
    rows = docs.drop("score")
    if scorer is None:
        return rows.withColumn("score", F.lit(0.0))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Scorer(scorer.features, scorer.net, scorer.scale)
        for batch in batches:
            yield pd.Series(own([t if isinstance(t, str) else None for t in batch]))

    return rows.withColumn("score", F.pandas_udf(run, "double")(F.col("text")))
