from __future__ import annotations

import numpy as np
import pytest

from streamlytics.llm import html_text as H
from streamlytics.llm.page_samples import pages


@pytest.fixture(scope="module")
def net():
    return H.train()


def test_held_out_pages(net):
    right = total = 0
    for page in pages(200, seed=99):
        chain, labels = H.labelled_blocks(page)
        if chain:
            node = np.array([net["node"][f].sum(0) for f in H._features(chain)])
            right += sum(a == b for a, b in zip(H.viterbi(node, net), labels, strict=True))
            total += len(labels)
    assert right / total > 0.98


def test_viterbi_equals_the_best_of_all_labellings():
    import itertools

    rng = np.random.default_rng(1)
    for _ in range(50):
        net = {"pair": rng.normal(size=(2, 2)), "first": rng.normal(size=2)}
        node = rng.normal(size=(6, 2))
        score = {y: net["first"][y[0]] + sum(node[t, k] for t, k in enumerate(y)) + sum(
            net["pair"][a, b] for a, b in zip(y, y[1:])) for y in itertools.product((0, 1), repeat=6)}
        assert tuple(H.viterbi(node, net)) == max(score, key=score.get)


@pytest.mark.parametrize("page,texts", [
    ("<p>a &amp; b&nbsp;\n c<br>d<p>e <b>f</b><script>if (a<b) x('</p>')</script> g", ["a & b c d", "e f g"]),
    ("<title>t</title><div title='>'>x</div><!-- <p>no --> y", ["x", "y"]),
    ("a < b and <3 <em>c</em> <p cla", ["a < b and <3 c"]),
    ("<ul><li>one<li><a href=x>two</a></ul>three</div></div> four", ["one", "two", "three four"]),
    ("<STYLE>p{}</STYLE ><P>Caf&eacute; &#x1F642; &am", ["Café 🙂 &am"]), ("", []), (None, []), ("<!-- open <p>x", []),
    ("<script>never closed <p>x</p>", []), ('<a href="unclosed>x</a><p>y</p>', ["x", "y"]),
])
def test_blocks(page, texts):
    assert [b[0] for b in H.blocks(page)] == texts


@pytest.mark.parametrize("page,texts", [
    ("<p>a <svg class='x'/> b</p><p>c</p>", ["a b", "c"]), ("<p>a<svg viewBox=\"0 0\" /></p><p>b <svg><text>no</text></svg>c</p>", ["a", "b c"]),
    ("<p>a <svg> b</p><p>c</p>", ["a b", "c"]), ("<p>a <math/> b</p><p>c</p>", ["a b", "c"]),
    ("<head><title>t</title><meta name=x><p>a</p><p>b", ["a", "b"]),
    ("<html><head><title>t</title><style>no</style><article><p>a</p></article>", ["a"]),
    ("<head><link href=x><b>a</b> b<p>c", ["a b", "c"]), ("<head><title>t</title> a <p>b", ["a", "b"]),
    ("<head><title>t</title><svg/><p>a", ["a"]), ("<head><script>no</script></head><body><p>a", ["a"]),
    ("<p>so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> holds</p>", ["so x=12 holds"]),
])
def test_nothing_behind_icons_heads_and_formulas_is_lost(page, texts):
    assert [b[0] for b in H.blocks(page)] == texts


@pytest.mark.parametrize("page,texts", [
    ("<p>a <ins>b</ins> <button>c</button> <label>d</label> e</p>", ["a b c d e"]),
    ("<p>a<data value=1>b</data><nobr>c</nobr><my-mark class='x y'>d</my-mark> e", ["abcd e"]),
    ("<div>a <blink>b<marquee>c</blink> d</div><p>e", ["a bc d", "e"]), ("<p>a <slot/>b</p><foo><p>c</foo>d", ["a b", "c", "d"]),
    ("<p><bdi>a</bdi><p><canvas>b</canvas> <output>c</output>", ["a", "b c"]),
])
def test_inline_and_unknown_elements_do_not_split_a_block(page, texts):
    assert [b[0] for b in H.blocks(page)] == texts


def test_an_inline_element_around_all_of_a_block_names_it():
    found = H.blocks("<div>x<ins class=ad>y</ins></div><ins class=ad>buy</ins><p>z <ins class=ad>w</ins>")
    assert [(t, ".ad" in names) for t, names, _ in found] == [("xy", False), ("buy", True), ("z w", False)]


ARTICLE = ["The old harbour is quiet now", "For most of a century the harbour of this town was the place where everything began and ended.",
           "Ships came in from the north, and with them salt, timber and news. Nobody counted the days then.", "What is left",
           "Two cranes, a shed and the long wall are all that is left of it; the rest went when the new port was opened.",
           "Yes.", "The council has promised to keep the wall."]
LINES = [f"<h1>{ARTICLE[0]}</h1>", *(f"<p>{x}</p>" for x in ARTICLE[1:3]), f"<h2>{ARTICLE[3]}</h2>", *(f"<p>{x}</p>" for x in ARTICLE[4:])]
BODY = "".join(LINES)
MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li><li><a href='/c'>Contact us</a></li></ul></nav>"
FOOT = "<footer><p>&copy; 2024 The Harbour Post. All rights reserved.</p><ul><li><a href='/p'>Privacy</a></li></ul></footer>"
LAYOUTS = {
    "bare": (BODY, ARTICLE), "div": (f"<div>{BODY}</div>", ARTICLE), "section": (f"<section>{BODY}</section>", ARTICLE),
    **{name: (f'<div class="{name}">{BODY}</div>', ARTICLE) for name in ("page", "wrapper", "container", "text", "foo", "x9-qq")},
    "paragraphs alone": ("".join(LINES[1:3]) + LINES[4], [ARTICLE[i] for i in (1, 2, 4)]),
    "menu and footer": (f"{MENU}{BODY}{FOOT}", ARTICLE),
    "in one wrapper with menu and footer": (f'<div class="page">{MENU}{BODY}{FOOT}</div>', ARTICLE),
    "thirty paragraphs": (f'{MENU}<div class="page">' + LINES[0] + "".join(f"<p>{ARTICLE[1 + i % 2]} {i}</p>" for i in range(30)) + f"</div>{FOOT}",
                          [ARTICLE[0], *(f"{ARTICLE[1 + i % 2]} {i}" for i in range(30))]),
    "header of the article": (f"{MENU}<article><header><h1>{ARTICLE[0]}</h1><p class='byline'>By Ann Other</p></header>{''.join(LINES[1:])}</article>{FOOT}",
                              [ARTICLE[0], "By Ann Other", *ARTICLE[1:]]),
    "table": (f"{MENU}<div>{LINES[0]}{LINES[1]}<table><tr><th>Year</th><th>Ships</th></tr><tr><td>1900</td><td>412</td></tr></table>{LINES[2]}</div>",
              [ARTICLE[0], ARTICLE[1], "Year", "Ships", "1900", "412", ARTICLE[2]]),
    "lists and quotes": (f"<section class='k3'>{LINES[0]}{LINES[1]}<ul><li>salt from the north</li><li>timber</li></ul><blockquote><p>It was loud.</p></blockquote></section>{FOOT}",
                         [ARTICLE[0], ARTICLE[1], "salt from the north", "timber", "It was loud."]),
    "all around": (f"<header><a href='/'>The Harbour Post</a>{MENU}</header><div id='wrap'><div class='cookie-notice'><p>We use cookies to keep this site running.</p>"
                   f"<button>Accept</button></div><div class='col'>{''.join(LINES[:3])}<div class='ad'>Buy a boat today!</div>{''.join(LINES[3:])}</div>"
                   "<aside><h3>Read on</h3><ul><li><a href='/1'>The lighthouse keeper retires</a></li><li><a href='/2'>A bridge too few</a></li></ul></aside>"
                   "<section id='comments'><h2>Comments</h2><div class='comment'><p>My father worked there all his life.</p></div></section>"
                   f"<form><label>Your e-mail</label><input><button>Subscribe</button></form></div>{FOOT}", ARTICLE),
    "links in text": (f"<div class='zz'>{LINES[0]}<p>For most of a century <a href='/h'>the harbour</a> of this <a href='/t'>town</a> was all there was, and more.</p></div>",
                      [ARTICLE[0], "For most of a century the harbour of this town was all there was, and more."]),
    "classes on all": (f"<div class='a1'><h1 class='t0'>{ARTICLE[0]}</h1>" + "".join(f"<p class='p{i}'>{x}</p>" for i, x in enumerate(ARTICLE[1:3])) + "</div>", ARTICLE[:3]),
}


def f1(got, want):
    from collections import Counter

    both = sum((Counter(got) & Counter(want)).values())
    return 2 * both / (len(got) + len(want)) if got or want else 1.0


@pytest.mark.parametrize("name", LAYOUTS)
def test_articles_outside_named_elements(net, name):
    page, want = LAYOUTS[name]
    got = H.main_text(f"<!DOCTYPE html><html><head><title>T</title></head><body>{page}</body></html>", net).split("\n")
    assert f1(got, want) >= 0.95, (got, want)


def test_block_f1_over_all_layouts(net):
    got, want = [], []
    for k, (page, texts) in enumerate(LAYOUTS.values()):
        got += [(k, x) for x in H.main_text(page, net).split("\n")]
        want += [(k, x) for x in texts]
    assert f1(got, want) >= 0.95


def test_main_text(net):
    page = ('<html><head><title>T</title></head><body><header><a href="/">Home</a></header><nav><ul><li><a href="/a">Menu item</a></li></ul>'
            '</nav><article><h1>The title of it</h1><p>First part of the text.</p><div class="ad">Buy now</div><p>Con.</p></article>'
            '<section class="comments"><p>A reader said this and more.</p></section><form><label>Name</label></form>'
            "<footer>&copy; all rights</footer>")
    assert H.main_text(page, net) == "The title of it\nFirst part of the text.\nCon."
    for text in ("<" * 20_000, "<a " * 20_000, "<p>" * 20_000, "&" * 20_000, "<a href='" * 5_000, "<!--" * 20_000):
        assert isinstance(H.main_text(text, net), str)


def test_frames(spark, net):
    rows = [(1, "u", "<article><h1>A b</h1><p>Some text here.</p></article>"), (2, None, None), (None, "x", ""), (1, "u", "<nav>m</nav>")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "7 AS text")
    got = H.extract(df, net)
    assert got.columns == ["page_id", "url", "html", "text"]
    assert sorted(((r.page_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(1, "A b\nSome text here."), (2, ""), (None, ""), (1, "")], key=repr)
    assert H.extract(df.limit(0), net).collect() == []
