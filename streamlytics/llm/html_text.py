"""Main text of web pages by a linear-chain conditional random field over the leaf blocks of the DOM.

A page is read tag by tag into blocks: runs of text between block-level tags, each with its open elements. Elements that
are not known as block-level are inline, unknown ones too; those that hold all of a block are among its elements. A block's
features are the names, classes, ids and roles of those elements, the way of sectioning elements down to it, and the
lengths, marks and shares of link text of itself and its neighbours. The field, with weights for features and for pairs of neighbouring labels, is trained on labelled pages by gradient ascent;
Viterbi decoding gives each page its most likely labelling, and the blocks of the article are its text.

White space in a block becomes one space (line breaks too), blocks are trimmed and joined by newlines, character
references are decoded. Scripts, styles, comments and what stands in the head are never blocks; the head ends at the first
element or text that may not stand in it. Formulas are text of their block. A tag that is not
closed at the end of a page is dropped as markup. A null page is empty, and a page without article blocks has
the empty text. Every row gives a row.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlytics.llm.page_samples import pages

BUCKETS = 1 << 14
SAMPLE_PAGES, STEPS, RATE = 1000, 120, 0.1

_TAG = re.compile(
    r"<!--(?:(?s:.*?)-->|(?s:.*))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[/!?a-zA-Z][^>]*+(?:>|\Z)")
_MARK = re.compile(r"(?i)\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
# Elements whose text is never shown, read up to their end tag.
_RAW = {"script", "style", "template", "noscript", "iframe", "svg", "object", "title", "textarea"}
# Elements that begin and end a block.
_BLOCK = set("address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption "
             "figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li link main menu meta nav "
             "noframes ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
# Inline elements whose names say nothing about their text.
_PLAIN = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img input kbd mark nobr q s samp small span strike "
             "strong sub sup time tt u var wbr br ruby rt rp picture source "
             "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose mfenced maction "
             "msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mlabeledtr mtd semantics "
             "annotation annotation-xml".split())
_SECTIONS = {"article", "main", "section", "header", "footer", "nav", "aside", "form"}
# Elements that may stand in the head; any other one, or text, ends a head that is not closed.
_IN_HEAD = set("html head base link meta title style script noscript template noframes".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# An opening tag ends an open element of these names.
_ENDS = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}

Block = tuple[str, tuple[str, ...], int]  # text, features of its elements, characters in links


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    out = [tag]
    for kind, *values in _MARK.findall(attributes) if attributes else ():
        for word in re.findall("[a-z]+", re.sub("([a-z])([A-Z])", "\\1 \\2", max(values)).lower()):
            out.append(f"{'role ' if kind.lower() == 'role' else '.'}{word}")
    return tuple(out)


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order."""
    out: list[Block] = []
    if not page:
        return out
    stack: list[tuple[str, tuple[str, ...]]] = []
    inline: list[tuple[str, tuple[str, ...], int]] = []  # open elements with names, and the depth they stand at
    around: list | None = None  # those that hold all text of the block so far
    parts: list[str] = []
    links, in_link, pos = 0, False, 0

    def text(piece: str) -> None:
        nonlocal links, around
        if piece:
            parts.append(piece)
            if in_link:
                links += len(piece)
            if (inline or around) and not piece.isspace():
                around = list(inline) if around is None else [x for x in around if x in inline]
            elif around is None and not piece.isspace():
                around = []

    def flush() -> None:
        nonlocal links, around
        if parts:
            words = " ".join(entities.unescape("".join(parts)).split())
            if words and stack and stack[-1][0] == "head":
                stack.pop()
            if words and not any(tag == "head" for tag, _ in stack):
                out.append((words, tuple(x for _, names in stack for x in names)
                            + tuple(x for _, names, _ in around or () for x in names), links))
            parts.clear()
            links = 0
        around = None

    while found := _TAG.search(page, pos):
        text(page[pos:found.start()])
        pos = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        closing = found[1] == "/"
        if not closing and tag not in _IN_HEAD and any(name == "head" for name, _ in stack):
            flush()
            while stack and stack.pop()[0] != "head":
                pass
        if tag == "svg" and not closing and found[3].endswith("/"):
            parts.append(" ")
            continue
        if tag in _RAW and not closing:
            if tag != "title":
                parts.append(" ")
            end = re.compile(rf"(?i)</{tag}\b[^>]*+(?:>|\Z)").search(page, pos)
            if end or tag != "svg":  # an svg without an end is dropped as markup
                pos = end.end() if end else len(page)
            continue
        if tag not in _BLOCK:
            if tag == "a":
                in_link = not closing
            elif tag in ("br", "img", "input"):
                parts.append(" ")
            elif tag not in _PLAIN and tag not in _VOID:
                if not closing and not found[3].endswith("/"):
                    inline.append((tag, _names(tag, found[3]), len(stack)))
                elif closing and any(tag == x[0] for x in inline):
                    while (last := inline.pop())[0] != tag:
                        pass
                    if last[2] < len(stack):  # what was opened in it ends with it
                        flush()
                        del stack[last[2]:]
            continue
        known = any(tag == name for name, _ in stack)
        if closing and not known and tag != "p":
            continue  # an end without a beginning is no boundary, but for a paragraph's
        flush()
        if closing:
            if known:
                while stack.pop()[0] != tag:
                    pass
                in_link = False
                while inline and inline[-1][2] > len(stack):
                    inline.pop()
            continue
        if tag == "body":
            stack[:] = [x for x in stack if x[0] == "html"]
        ends = _ENDS.get(tag, set()) | (set() if tag in ("select", "option", "optgroup") else {"p"})
        while stack and stack[-1][0] in ends:
            stack.pop()
        if tag not in _VOID and not found[3].endswith("/"):
            stack.append((tag, _names(tag, found[3])))
    text(page[pos:])
    flush()
    return out


def _features(chain: list[Block]) -> list[list[int]]:
    """The features of each block of a page."""
    own, out = [], []
    for text, _, links in chain:
        own.append((f"words {min((text.count(' ') + 1).bit_length(), 7)}", f"links {round(4 * min(1, links / len(text)))}",
                    f"end {text[-1] in '.!?…'}"))
    titled = False
    for i, (text, names, _) in enumerate(chain):
        path = " ".join([x for x in names if x in _SECTIONS][-3:])
        last = next((x for x in reversed(names) if x[0] != "." and not x.startswith("role ")), "")
        titled = titled or "h1" in names
        found = {*own[i], f"mark {text[0] if not text[0].isalnum() else ''}", f"last {last}", f"path {path}", f"titled {titled}",
                 f"{last} {own[i][0]}", f"{last} {own[i][1]}", *names}
        for side, j in (("before", i - 1), ("after", i + 1)):
            found.update(f"{side} {x}" for x in (own[j] if 0 <= j < len(chain) else ("none",)))
        out.append([crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in sorted(found)])
    return out


def initial() -> dict[str, np.ndarray]:
    return {"node": np.zeros((BUCKETS, 2)), "pair": np.zeros((2, 2)), "first": np.zeros(2)}


def viterbi(node: np.ndarray, net: dict) -> list[int]:
    """The most likely labels of a chain of scores; the smaller label of equals."""
    pair = net["pair"].tolist()
    best, back = (node[0] + net["first"]).tolist(), []
    for zero, one in node[1:].tolist():
        a, b = best[0] + pair[0][0], best[1] + pair[1][0]
        c, d = best[0] + pair[0][1], best[1] + pair[1][1]
        back.append((int(b > a), int(d > c)))
        best = [max(a, b) + zero, max(c, d) + one]
    out = [int(best[1] > best[0])]
    for step in reversed(back):
        out.append(step[out[-1]])
    return out[::-1]


def fit(labelled: list[tuple[list[Block], list[int]]]) -> dict[str, np.ndarray]:
    """Weights from chains of blocks and their labels (1: of the article)."""
    labelled = [x for x in labelled if x[0]]
    net = initial()
    n, places = len(labelled), max((len(b) for b, _ in labelled), default=0)
    if not n:
        return net
    y, there = np.zeros((n, places), int), np.zeros((n, places), bool)
    feature, at = [], []
    for i, (chain, labels) in enumerate(labelled):
        y[i, :len(chain)], there[i, :len(chain)] = labels, True
        for t, f in enumerate(_features(chain)):
            feature += f
            at += [i * places + t] * len(f)
    feature, at = np.array(feature), np.array(at)
    one = np.eye(2)
    gold = np.zeros_like(net["node"])
    np.add.at(gold, feature, one[y.reshape(-1)[at]])
    both = there[:, 1:]
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (y[:, :-1][both], y[:, 1:][both]), 1)
    moments = {k: (np.zeros_like(p), np.zeros_like(p)) for k, p in net.items()}
    for step in range(1, STEPS + 1):
        node = np.stack([np.bincount(at, net["node"][feature, k], n * places) for k in (0, 1)], 1).reshape(n, places, 2)
        # Forwards and backwards with probabilities that are brought to a sum of one at each place.
        score = np.exp(node - node.max(2, keepdims=True))
        pair, first = np.exp(net["pair"]), np.exp(net["first"])
        ahead, behind = np.zeros((n, places, 2)), np.ones((n, places, 2))
        ahead[:, 0] = score[:, 0] * first
        for t in range(1, places):
            new = (ahead[:, t - 1] @ pair) * score[:, t]
            ahead[:, t] = new / (new[:, :1] + new[:, 1:])
        for t in range(places - 2, -1, -1):
            new = (score[:, t + 1] * behind[:, t + 1]) @ pair.T
            behind[:, t] = np.where(there[:, t + 1, None], new / (new[:, :1] + new[:, 1:]), 1)
        single = ahead * behind
        single = single / single.sum(2, keepdims=True) * there[..., None]
        double = ahead[:, :-1, :, None] * pair * (score * behind)[:, 1:, None, :]
        double = double / double.sum((2, 3), keepdims=True) * both[..., None, None]
        grad = {"node": gold.copy(), "pair": pairs - double.sum((0, 1)), "first": one[y[:, 0]].sum(0) - single[:, 0].sum(0)}
        grad["node"] -= np.stack([np.bincount(feature, single.reshape(-1, 2)[at, k], BUCKETS) for k in (0, 1)], 1)
        for k, p in net.items():
            m, v = moments[k]
            g = grad[k] - 0.3 * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    return net


def labelled_blocks(pieces: list[tuple[str, bool]]) -> tuple[list[Block], list[int]]:
    """A page given in pieces, as one page's blocks and their labels: a mark in each text tells where it came from."""
    marked = "".join(re.sub(r">([^<>]*\w)", lambda m, k=k: f">{m[1]}\x01" if k else f">{m[1]}\x02", piece) for piece, k in pieces)
    found = blocks(marked)
    labels = [int(text.count("\x01") > text.count("\x02")) for text, _, _ in found]
    return [(re.sub("[\x01\x02]", "", text), names, links) for text, names, links in found], labels


def train(n: int = SAMPLE_PAGES, seed: int = 1) -> dict[str, np.ndarray]:
    return fit([labelled_blocks(p) for p in pages(n, seed)])


def main_text(page: str | None, net: dict) -> str:
    chain = blocks(page)
    if not chain:
        return ""
    listed = _features(chain)
    sizes = np.array([len(f) for f in listed])
    node = np.add.reduceat(net["node"][np.array([x for f in listed for x in f])], np.cumsum(sizes) - sizes, 0)
    return "\n".join(b[0] for b, label in zip(chain, viterbi(node, net), strict=True) if label)


def extract(df: DataFrame, net: dict, html: str = "html") -> DataFrame:
    """``df`` with column ``text`` (an input column of that name is replaced)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(p if isinstance(p, str) else None, net) for p in batch], dtype=object)

    kept = [c for c in df.columns if c == html or c != "text"]
    return df.select(*[F.col(f"`{c}`") for c in kept]).withColumn(
        "text", F.pandas_udf(run, "string")(F.col(html)))
