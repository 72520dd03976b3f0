"""Labelled pages for training, made from layouts: where an article may stand and what may stand around and in it.

Words are drawn from a list of syllables, so nothing but structure, lengths, links and marks can be learned from them. Most
articles stand in no element that names them: bare in the body, in elements without a class, or with a class that says
nothing (drawn anew, or one that also wraps whole pages).
"""

from __future__ import annotations

import random

SYLLABLES = "ta re mi lo san ver den kul fra ost nim bel por tis gan hul".split()
WRAPPERS = [
    ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
    ('<div class="content">', "</div>"), ('<div id="main-content"><div class="post-body">', "</div></div>"),
    ('<article class="post entry"><div class="entry-content">', "</div></article>"),
    ('<section class="story article-body">', "</section>"), ('<div role="main">', "</div>"),
]
NEUTRAL = "page wrapper container text inner wrap row col main-wrap site layout block box foo center shell root app".split()


class _Writer:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        rng = self.rng
        return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(rng.randint(low, high)))

    def sentence(self, low: int, high: int) -> str:
        text = self.words(low, high)
        return text[:1].upper() + text[1:] + self.rng.choice([".", ".", ".", "!", "?", ""])

    def paragraph(self) -> str:
        return " ".join(self.sentence(1, 14) for _ in range(self.rng.choice([1, 1, 2, 3, 5, 8])))

    def links(self, n: int) -> str:
        items = "".join(f'<li><a href="/{i}">{self.words(1, 3)}</a></li>' for i in range(n))
        return f"<ul>{items}</ul>"

    def around(self) -> str:
        """One piece that is not of the article; some may stand in it too."""
        rng, p = self.rng, self.paragraph
        name = rng.choice(["ad", "ads", "advert", "banner", "sponsor", "promo", "ad-slot"])
        side = rng.choice(["sidebar", "widget", "related", "side", "more-stories", "share", "social", "newsletter"])
        note = rng.choice(["notice", "cookie", "cookie-notice", "consent", "alert", "gdpr", "popup", "disclaimer"])
        talk = rng.choice(["comments", "comment", "comment-list", "discussion", "replies", "respond"])
        return rng.choice([
            lambda: f"<nav>{self.links(rng.randint(2, 8))}</nav>",
            lambda: f'<div class="{rng.choice(["menu", "nav", "navbar", "breadcrumb", "pagination"])}">{self.links(rng.randint(2, 8))}</div>',
            lambda: f'<div class="{name}">{p()}</div>', lambda: f'<div id="{name}"><p>{p()}</p></div>',
            lambda: f'<ins class="{name}">{p()}</ins>',
            lambda: f"<aside><h3>{self.sentence(1, 4)}</h3><p>{p()}</p></aside>", lambda: f"<aside>{p()}</aside>",
            lambda: f'<div class="{side}"><h4>{self.sentence(1, 4)}</h4>{self.links(3)}<p>{p()}</p></div>',
            lambda: f'<div class="{note}"><p>{p()}</p><button>{self.words(1, 2)}</button></div>',
            lambda: f'<div class="{note}">{p()}</div>', lambda: f'<div role="alert">{p()}</div>',
            lambda: f"<form><label>{self.words(1, 4)}</label><input><p>{p()}</p><button>{self.words(1, 2)}</button></form>",
            lambda: f'<section class="{talk}"><h2>{self.sentence(1, 3)}</h2>' + "".join(
                f'<div class="{rng.choice(["comment", "reply", "item"])}"><p>{p()}</p></div>' for _ in range(rng.randint(1, 5))) + "</section>",
            lambda: f'<div id="{talk}">' + "".join(f"<p>{p()}</p>" for _ in range(rng.randint(1, 5))) + "</div>",
            lambda: f'<ol class="{talk}">' + "".join(
                f"<li><article><p>{p()}</p></article></li>" for _ in range(rng.randint(1, 4))) + "</ol>",
        ])()

    def name(self) -> str:
        """An attribute that says nothing."""
        rng = self.rng
        word = rng.choice([lambda: rng.choice(NEUTRAL), lambda: self.words(1, 1), lambda: f"{self.words(1, 1)}-{rng.randrange(99)}"])()
        return rng.choice(["", f' class="{word}"', f' class="{word}"', f' id="{word}"'])

    def wrapper(self) -> tuple[str, str]:
        """Where an article begins and ends."""
        rng = self.rng
        if rng.random() < 0.35:
            return rng.choice(WRAPPERS)
        tags = [rng.choice(["div", "div", "section"]) for _ in range(rng.choice([0, 0, 1, 1, 1, 2]))]
        return "".join(f"<{t}{self.name()}>" for t in tags), "".join(f"</{t}>" for t in reversed(tags))

    def block(self) -> str:
        """One piece of the article."""
        rng, p = self.rng, self.paragraph
        row = lambda tag: "<tr>" + "".join(f"<{tag}>{self.words(1, 4)}</{tag}>" for _ in range(3)) + "</tr>"
        return rng.choice([
            *[lambda: f"<p>{p()}</p>"] * 6, lambda: f"<p>{p()}", lambda: f"<p{self.name()}>{p()}</p>", lambda: f"<h2>{self.sentence(1, 6)}</h2>",
            lambda: f"<h3{self.name()}>{self.sentence(1, 6)}</h3>",
            lambda: f"<p><b>{self.sentence(1, 8)}<br>", lambda: f"<blockquote><p>{p()}</p></blockquote>",
            lambda: f"<ul><li>{p()}</li><li>{p()}</li></ul>", lambda: f'<p>{p()} <a href="/">{self.words(1, 4)}</a> {p()}</p>',
            lambda: f"<ol>{''.join(f'<li>{self.sentence(2, 9)}</li>' for _ in range(4))}</ol>",
            lambda: f"<div>{p()}</div>", lambda: f"<div{self.name()}><p>{p()}</p></div>", lambda: f"<section{self.name()}><h2>{self.sentence(1, 5)}</h2><p>{p()}</p></section>",
            lambda: f"<table>{row('th')}{row('td')}{row('td')}</table>", lambda: f"<table><caption>{self.sentence(1, 5)}</caption>{row('td')}</table>",
            lambda: f"<dl><dt>{self.words(1, 3)}</dt><dd>{p()}</dd></dl>",
            lambda: f"<pre>{self.words(2, 9)}</pre>", lambda: f"<figure><figcaption>{self.sentence(2, 9)}</figcaption></figure>",
        ])()

    def header(self) -> str:
        """What stands above a page's article."""
        rng = self.rng
        return rng.choice([
            lambda: f"<header><h1>{self.sentence(1, 4)}</h1>{self.links(4)}</header>", lambda: f'<div class="header">{self.sentence(1, 5)}</div>',
            lambda: f"<header>{self.sentence(1, 9)}</header>", lambda: f'<header><a href="/">{self.words(1, 2)}</a></header>',
            lambda: f'<header{self.name()}><div class="logo">{self.words(1, 2)}</div><nav>{self.links(3)}</nav></header>',
            lambda: f"<div{self.name()}>{self.links(5)}</div>"])()

    def title(self) -> str:
        """The beginning of an article in its element."""
        rng = self.rng
        title = f"<h1{self.name()}>{self.sentence(1, 12)}</h1>"
        byline = f'<p class="{rng.choice(["byline", "meta", "date", "author"])}">{self.words(2, 5)}</p>'
        return rng.choice([title, title, title + byline, f"<header>{title}</header>", f"<header>{title}{byline}</header>",
                           f"<header{self.name()}>{title}<p>{self.sentence(4, 16)}</p></header>", f"<h2>{self.sentence(1, 9)}</h2>", ""])

    def page(self) -> list[tuple[str, bool]]:
        """Pieces of a page in order, and whether they are of the article."""
        rng = self.rng
        out = [(f"<!DOCTYPE html><html><head><title>{self.sentence(2, 8)}</title></head><body>", False)]
        bare = rng.random() < 0.15  # nothing but an article
        whole = [] if bare or rng.random() < 0.6 else [rng.choice(["div", "div", "main", "section"]) for _ in range(rng.choice([1, 1, 2]))]
        out += [(f"<{t}{self.name()}>", False) for t in whole]
        if not bare:
            if rng.random() < 0.5:
                out.append((self.header(), False))
            out += [(self.around(), False) for _ in range(rng.randint(0, 3))]
        begin, end = self.wrapper()
        titled = self.title()
        if "<header" in titled and not begin.startswith(("<article", "<main")):
            titled = f"<h1>{self.sentence(1, 12)}</h1>"  # elsewhere a header is the page's
        outside = not begin.startswith(("<article", "<main")) and titled.startswith("<h1") and rng.random() < 0.3
        out.append((titled + begin if outside else begin + titled, True))
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 14, 30])):
            out.append((self.block(), True))
            if not bare and rng.random() < 0.08:
                out.append((self.around(), False))
        if begin and rng.random() < 0.1:
            out.append((f"<footer>{self.sentence(1, 6)}</footer>", False))
        out.append((end, True))
        if not bare:
            out += [(self.around(), False) for _ in range(rng.randint(0, 3))]
            if rng.random() < 0.8:
                legal = rng.choice(["footer", "site-footer", "copyright", "legal"])
                out.append((rng.choice([
                    f"<footer>&copy; {self.sentence(1, 12)} {self.sentence(1, 9)}</footer>", f"<footer><p>{self.paragraph()}</p>{self.links(3)}</footer>",
                    f'<div class="{legal}">{self.paragraph()}</div>', f"<p>&copy; {self.sentence(1, 9)}</p>",
                    f"<footer{self.name()}><div><p>{self.paragraph()}</p></div></footer>"]), False))
        out += [(f"</{t}>", False) for t in reversed(whole)]
        return out


def pages(n: int, seed: int = 1) -> list[list[tuple[str, bool]]]:
    writer = _Writer(seed)
    return [writer.page() for _ in range(n)]
