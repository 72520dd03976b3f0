"""Byte-level BPE encoding and decoding with recursive DuckDB queries, one database per partition.

Texts are cut into words by a pattern. The words a partition has not met yet become rows (word, position, token), one
per byte. A recursive query joins neighbouring tokens with the merge table and contracts each word's pair of least
rank, the leftmost of equals, until no pair of the word can be merged; words that are tokens themselves need no query.
Decoding joins token ids with the vocabulary, sorts by position once and aggregates the bytes in that order, which the
database's one thread keeps.

Words without end, such as those of scripts without blanks, are cut first where no occurrence of any token of the
vocabulary lies across the cut: no merge can cross it, so the parts are merged apart. A recursion step copies all rows of
an unfinished word, so a query takes as many words as keep the sum of their squared lengths below ``SQUARES``. Parts that
are still longer than ``LONG_PART`` bytes (runs in which token occurrences overlap all along) are merged by a heap, as
their steps would be too many; the ids are the same.

The vocabulary (ranks) is a file of public origin, read on the driver from a path given by the caller, and travels with
the task. What a task remembers, encodes and decodes at once is bounded; a text's own ids are held whole, and an
uncut run takes some 60 bytes for each of its own.

Null texts are empty and have no ids; no special tokens are known. Every row gives a row.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CUT_FROM = 16  # characters of a word that is cut
LONG_PART = 256  # bytes
SQUARES = 3_000_000  # rows of all steps of a query
HELD_WORDS, HELD_CHARS = 600_000, 16_000_000  # remembered by a task before it starts anew
CHUNK = 2_000_000  # characters encoded at once
DECODED = 400_000  # tokens decoded at once

_CONTRACT = """
WITH RECURSIVE step(n, w, p, tok, q, nxt) AS (
    SELECT 0::SMALLINT, w, p, tok, q, nxt FROM piece
    UNION ALL
    (WITH best AS (
        SELECT s.w, min(m.tok::BIGINT * 65536 + s.p) AS k, arg_min(s.q, m.tok::BIGINT * 65536 + s.p) AS q
        FROM step s JOIN merges m ON m.a = s.tok AND m.b = s.nxt GROUP BY s.w),
    cut AS (
        SELECT b.w, (b.k // 65536)::INT AS made, (b.k % 65536)::INT AS p, b.q, s.q AS next_q, s.nxt AS next_tok
        FROM best b JOIN step s ON s.w = b.w AND s.p = b.q)
    SELECT r.n + 1, r.w, r.p,
           CASE WHEN r.p = c.p THEN c.made ELSE r.tok END,
           CASE WHEN r.p = c.p THEN c.next_q ELSE r.q END,
           CASE WHEN r.p = c.p THEN c.next_tok WHEN r.q = c.p THEN c.made ELSE r.nxt END
    FROM step r JOIN cut c ON r.w = c.w WHERE r.p <> c.q))
SELECT s.w, s.tok FROM step s JOIN (SELECT w, max(n) AS n FROM step GROUP BY w) l ON s.w = l.w AND s.n = l.n
ORDER BY s.w, s.p
"""
_DECODE = """
SELECT d, string_agg(bytes, '') AS bytes, count(bytes) = count(*) AS known
FROM (SELECT i.d, v.bytes FROM ids i LEFT JOIN vocabulary v USING (tok) ORDER BY i.p) GROUP BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb
        import pyarrow as pa
        import regex

        self.ranks, self.arrow = ranks, pa
        self.pattern = regex.compile(pattern)
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        merges = self._merges()
        a, b, made = (pa.array(x, pa.int32()) for x in (zip(*merges, strict=True) if merges else ((), (), ())))
        self.db.register("given", pa.table({"a": a, "b": b, "tok": made}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.db.register("given", pa.table({
            "tok": pa.array(list(ranks.values()), pa.int32()), "bytes": pa.array([t.decode("latin-1") for t in ranks], pa.string())}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self._forget()

    def _merges(self) -> list[tuple[int, int, int]]:
        """(left, right, made) of all pairs of tokens that make a token."""
        return [(a, b, rank) for token, rank in self.ranks.items() for i in range(1, len(token))
                if (a := self.ranks.get(token[:i])) is not None and (b := self.ranks.get(token[i:])) is not None]

    @functools.cached_property
    def _made(self) -> dict[int, int]:
        return {a << 32 | b: made for a, b, made in self._merges()}

    @functools.cached_property
    def _prefixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The tree of all prefixes of tokens: sorted (node, byte) keys, the node each leads to, and which nodes are
        tokens of two bytes or more."""
        number: dict[bytes, int] = {b"": 0}
        keys = []
        for token in self.ranks:
            for i in range(1, len(token) + 1):
                if token[:i] not in number:
                    keys.append(number[token[:i - 1]] << 8 | token[i - 1])
                    number[token[:i]] = len(number)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        whole = np.zeros(len(number), bool)
        whole[[number[t] for t in self.ranks if len(t) > 1]] = True
        return np.array(keys, np.int64)[order], order + 1, whole

    def _cuts(self, words: list[bytes]) -> np.ndarray:
        """The places in the joined words that no occurrence of a token within a word lies across, both ends included."""
        raw, size = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
        end = np.repeat(np.cumsum(size), size)
        keys, leads, whole = self._prefixes
        change = np.zeros(len(raw) + 1, np.int32)
        for first in range(0, len(raw), 1 << 20):
            at = np.arange(first, min(first + (1 << 20), len(raw)))
            node, depth = np.zeros(len(at), np.int64), 0
            while len(at):
                key = node << 8 | raw[at + depth]
                found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                alive = keys[found] == key
                at, node, depth = at[alive], leads[found[alive]], depth + 1
                token = at[whole[node]]
                change[token + 1] += 1
                np.subtract.at(change, token + depth, 1)
                room = at + depth < end[at]
                at, node = at[room], node[room]
        return np.flatnonzero(np.cumsum(change) == 0)

    def _parts(self, word: str) -> Iterator[bytes]:
        """The word's bytes, cut where no merge can cross."""
        data = word.encode("utf-8", "surrogatepass")
        cuts, first = self._cuts([data]), 0
        for i in range(1, len(cuts), 4096):
            for last in cuts[i:i + 4096].tolist():
                yield data[first:last]
                first = last

    def _all_parts(self, words: list[str]) -> dict[str, list[bytes]]:
        """The same for many words at once."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        cuts, data = self._cuts(raw), b"".join(raw)
        parts = [data[a:b] for a, b in itertools.pairwise(cuts.tolist())]
        at = np.searchsorted(cuts, np.cumsum([0, *map(len, raw)])).tolist()
        return {w: parts[a:b] for w, (a, b) in zip(words, itertools.pairwise(at), strict=True)}

    def _forget(self) -> None:
        self.number: dict[str | bytes, int] = {}
        self.chars = 0
        self.listed = np.empty(0, object)  # the ids of each word, as text
        self.flat, self.start = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _contract(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words in order, and how many each has."""
        size = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(len(words), dtype=np.int32), size)
        at = (np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
        last = at + 1 == size[row]
        after, token = self.arrow.array(at + 1, mask=last), self.bytes[raw]
        self.db.register("piece", self.arrow.table({
            "w": row, "p": at, "tok": token, "q": after, "nxt": self.arrow.array(np.roll(token, -1), mask=last)}))
        found = self.db.sql(_CONTRACT).to_arrow_table()
        return found["tok"].to_numpy(), np.bincount(found["w"].to_numpy(), minlength=len(words))

    def _merge_long(self, word: bytes) -> np.ndarray:
        """The same contraction for one long part: pairs in a heap, stale entries passed over."""
        made, n = self._made, len(word)
        token = array("i", self.bytes[np.frombuffer(word, np.uint8)].tolist())
        after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))
        heap = [rank * n + i for i in range(n - 1) if (rank := made.get(token[i] << 32 | token[i + 1])) is not None]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                rank = made.get(token[i] << 32 | token[after[i]])
                if rank is not None:
                    heapq.heappush(heap, rank * n + i)

        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            j = after[i]
            if token[i] < 0 or j >= n or made.get(token[i] << 32 | token[j]) != rank:
                continue
            token[i], token[j], after[i] = rank, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        whole = np.frombuffer(token, np.int32)
        return whole[whole >= 0]

    def _learn(self, words: set[str | bytes]) -> None:
        """Adds words: those that are tokens, those in parts, the long ones, and the others by the query, some at a time."""
        cut = [w for w in words if len(w) > CUT_FROM and isinstance(w, str)]
        words = list(words.difference(cut))
        raw = [w if isinstance(w, bytes) else w.encode("utf-8", "surrogatepass") for w in words]
        rank = list(map(self.ranks.get, raw))
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        at = np.array([r is None for r in rank], bool)
        whole, long, rest = np.flatnonzero(~at).tolist(), np.flatnonzero(at & (size > LONG_PART)).tolist(), np.flatnonzero(at & (size <= LONG_PART))
        merged = [self._merge_long(raw[i]) for i in long]
        found = [*whole, *long]  # in the order of the tokens, which are added together
        tokens = [np.array([rank[i] for i in whole], np.int32), *merged]
        sizes = [np.ones(len(whole), np.int64), np.array(list(map(len, merged)), np.int64)]
        rows = np.cumsum(size[rest] ** 2)
        if len(rows) and rows[-1] > SQUARES:
            rest = rest[np.argsort(size[rest], kind="stable")]  # words of a query end after about as many steps
            rows = np.cumsum(size[rest] ** 2)
        first = 0
        while first < len(rest):
            last = max(first + 1, int(np.searchsorted(rows, (rows[first - 1] if first else 0) + SQUARES, "right")))
            here = rest[first:last].tolist()
            made, counts = self._contract([raw[i] for i in here])
            found += here
            tokens.append(made)
            sizes.append(counts)
            first = last
        self._add([words[i] for i in found], np.concatenate(tokens), np.concatenate(sizes))
        if cut:
            parts = self._all_parts(cut)
            self._learn({p for word in cut for p in parts[word]} - self.number.keys())
            ids = [[self.flat[self.start[i]:self.start[i + 1]] for i in map(self.number.get, parts[word])] for word in cut]
            self._add(cut, np.concatenate([x for of in ids for x in of]), np.array([sum(map(len, of)) for of in ids]))

    def _add(self, words: list[str], tokens: np.ndarray, sizes: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words)), strict=True))
        self.chars += sum(map(len, words))
        text, end = list(map(str, tokens.tolist())), np.cumsum(sizes).tolist()
        listed = np.empty(len(words), object)
        listed[:] = [",".join(text[a:b]) for a, b in zip([0, *end], end)]
        self.listed = np.concatenate([self.listed, listed])
        self.flat = np.concatenate([self.flat, tokens.astype(np.int32)])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])

    def _cut(self, text: str) -> Iterator[list[str | bytes]]:
        """The words of a long text, a bounded number at a time, long ones in parts."""
        words = itertools.chain.from_iterable(
            self._parts(m[0]) if m.end() - m.start() > CUT_FROM else (m[0],) for m in self.pattern.finditer(text))
        while part := list(itertools.islice(words, CHUNK // 4)):
            yield part

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """The ids of each text, as an array and as decimal text joined by commas."""
        done = 0
        while done < len(texts):
            size = list(itertools.accumulate(len(t) for t in texts[done:]))
            n = max(1, int(np.searchsorted(size, CHUNK, "right")))
            if n == 1 and len(texts[done]) > CHUNK:
                parts = [ids for words in self._cut(texts[done]) for ids in self._ids([words])]
                yield np.concatenate([p[0] for p in parts]), ",".join(p[1] for p in parts if p[1])
            else:
                yield from self._ids([self.pattern.findall(t) for t in texts[done:done + n]])
            done += n

    def _ids(self, texts: list[list[str | bytes]]) -> Iterator[tuple[np.ndarray, str]]:
        """The ids of texts given in words."""
        if len(self.number) > HELD_WORDS or self.chars > HELD_CHARS:
            self._forget()
        words = list(itertools.chain.from_iterable(texts))
        at = np.fromiter(map(self.number.get, words, itertools.repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            self._learn({words[i] for i in new})
            at[new] = [self.number[words[i]] for i in new]
        start, size = self.start[at], self.start[at + 1] - self.start[at]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(start - (ends - size), size) + np.arange(size.sum())]
        listed, first, before = self.listed[at].tolist(), 0, 0
        for text in texts:
            last = first + len(text)
            until = int(ends[last - 1]) if last else 0
            yield ids[before:until], ",".join(listed[first:last])
            first, before = last, until

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each array of ids; long arrays are decoded in pieces, short ones together."""
        out: list[list[bytes]] = [[] for _ in ids]
        pieces = [(d, x[i:i + DECODED]) for d, x in enumerate(ids) for i in range(0, len(x), DECODED)]
        first, total = 0, 0
        for i, (_, x) in enumerate(pieces):
            total += len(x)
            if i + 1 == len(pieces) or total + len(pieces[i + 1][1]) > DECODED:
                part = pieces[first:i + 1]
                flat = np.concatenate([p for _, p in part]).astype(np.int32)
                self.db.register("ids", self.arrow.table({
                    "d": np.repeat(np.arange(len(part), dtype=np.int32), [len(p) for _, p in part]),
                    "p": np.arange(len(flat), dtype=np.int32), "tok": flat}))
                found: list[bytes] = [b""] * len(part)
                for d, text, known in self.db.execute(_DECODE).fetchall():
                    if not known:
                        raise ValueError("a token id is not in the vocabulary")
                    found[d] = text.encode("latin-1")  # a character stands for a byte
                for (d, _), data in zip(part, found, strict=True):
                    out[d].append(data)
                first, total = i + 1, 0
        return [b"".join(x) for x in out]


def _texts(column: pd.Series) -> list[str]:
    return [t if isinstance(t, str) else "" for t in column]


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>)`` for each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(ranks, pattern)
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "ids": pd.Series([i for i, _ in codec.encode(_texts(batch["text"]))], dtype=object)})

    return _numbered(_input(df, doc_id, text).mapInPandas(run, "doc_id string, ids array<int>"))


def decode(df: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(doc_id, decoded binary)`` for each row; null ids decode to nothing, unknown ids are an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(ranks, pattern)
        for batch in batches:
            given = [np.asarray(x if x is not None else [], np.int32) for x in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "decoded": codec.decode(given)})

    return _numbered(df.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(ids).alias("ids")).mapInPandas(
        run, "doc_id string, decoded binary"))


def round_trip(df: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: encodes each text, decodes the ids, and digests both without
    moving the ids between processes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(ranks, pattern)
        for batch in batches:
            out, ids = [], []
            for x, listed in codec.encode(_texts(batch["text"])):
                ids.append(x)
                out.append((len(x), hashlib.sha256(listed.encode()).hexdigest()))
            decoded = [hashlib.sha256(x).hexdigest() for x in codec.decode(ids)]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "n_tokens": [n for n, _ in out], "ids_sha256": [h for _, h in out],
                "decoded_sha256": decoded})

    return _numbered(_input(df, doc_id, text).mapInPandas(
        run, "doc_id string, n_tokens bigint, ids_sha256 string, decoded_sha256 string"))


def _input(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Ids pass through pandas as strings: numbers with nulls among them would become floats."""
    return df.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))


def _numbered(df: DataFrame) -> DataFrame:
    return df.withColumn("doc_id", F.col("doc_id").cast("bigint"))
