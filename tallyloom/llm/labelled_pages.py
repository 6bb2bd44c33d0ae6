"""Labelled pages: made pages whose blocks are known to be main text or not.

No page of a crawl comes with labels, so training pages are drawn from a grammar of page layouts: a site
frame of menus, headers, notices, adverts, sidebars, forms, comments and footers around and inside an
article, under the tags and class names in common use. The text of every kind of block is drawn from
the same distributions, from prose to lists and junk, so what a model can learn is chiefly
layout. The number of pages is a parameter.
"""

from __future__ import annotations

import random
from html import escape

from .html_blocks import leaf_blocks

MARKS = ("\ue000", "\ue001")

# Class names in common use, by what they mark.
MAIN = "article content post entry story body main text page primary".split()
MENU = "nav menu navbar navigation breadcrumb breadcrumbs topbar toolbar pagination pager tabs".split()
HEADER = "header masthead banner branding logo hero top".split()
SIDEBAR = "sidebar aside related widget rail recommended trending popular secondary teaser more".split()
NOTICE = "cookie consent notice alert gdpr popup modal overlay newsletter subscribe paywall warning".split()
ADVERT = "ad ads advert advertisement adbox sponsor sponsored promo promotion commercial banner".split()
FORM = "form search login signup register contact poll feedback".split()
COMMENTS = "comment comments replies reply discussion disqus respond thread reviews".split()
FOOTER = "footer copyright legal colophon bottom social share sharing tags meta credits".split()
NEUTRAL = "wrap wrapper container row col inner outer block box section group item grid".split()

SYLLABLES = "the an re on er in th at es ou de la en que ung sch ie ver ta do ci on ra mo".split()


def _word(rng: random.Random) -> str:
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def _text(rng: random.Random) -> str:
    """A block's text, of any kind."""
    n = rng.choice((1, 3, 6, 12, 12, 25, 40, 60))
    words = [_word(rng) for _ in range(n)]
    kind = rng.random()
    if kind < 0.7:
        words[0] = words[0].capitalize()
        end = rng.choice((".", ".", ".", "!", "?", ""))
        words = [w + rng.choice(("", "", "", "", ",", ".")) for w in words]
        return " ".join(words) + end
    if kind < 0.78:
        return " ".join(w.upper() + "!!" for w in words)
    if kind < 0.86:
        return " ".join(w + rng.choice(("###", "***", "%%%")) for w in words)
    if kind < 0.94:
        return " | ".join(words)
    return "© " + " ".join(words) + f" {rng.randint(1, 2030)}"


Made = list[tuple[str, int | None]]  # pieces of markup (None) and of text (its label)


def _attribute(rng: random.Random, names: list[str], p: float = 1.0) -> str:
    if rng.random() > p:
        return ""
    name = rng.choice(names)
    if rng.random() < 0.4:
        name = rng.choice(
            (
                f"{name}-{rng.choice(NEUTRAL)}",
                f"{rng.choice(NEUTRAL)}-{name}",
                f"{name} {rng.choice(NEUTRAL)}",
                f"site-{name}",
            )
        )
    return f' {rng.choice(("class", "class", "id"))}="{name}"'


def _around(tag: str, attribute: str, inside: Made) -> Made:
    return [(f"<{tag}{attribute}>", None), *inside, (f"</{tag}>", None)]


def _links(rng: random.Random, label: int) -> Made:
    out: Made = []
    for _ in range(rng.randint(2, 7)):
        out += [('<li><a href="#">', None), (_word(rng), label), ("</a></li>", None)]
    return _around("ul", "", out)


def _paragraphs(rng: random.Random, label: int, most: int, tags: tuple[str, ...]) -> Made:
    out: Made = []
    for _ in range(rng.randint(1, most)):
        tag = rng.choice(tags)
        text: Made = [(_text(rng), label)]
        if rng.random() < 0.1:
            text = [("<b>", None), *text, ("<br>", None)]
        elif rng.random() < 0.1:
            text += [(' <a href="#">', None), (_word(rng), label), ("</a>", None)]
        out += [(f"<{tag}>", None), *text] + ([(f"</{tag}>", None)] if rng.random() < 0.9 else [])
    return out


def _unknown(rng: random.Random) -> str:
    """A name that is in no list."""
    name = _word(rng) + rng.choice(("", "-", "_")) + _word(rng)
    return rng.choice(("", f' class="{name}"', f' id="{name}"', f' class="{_word(rng)} {name}"'))


def _listed(rng: random.Random) -> Made:
    """Main text in a list, in terms or in a table."""
    out: Made = []
    kind = rng.choice(("ul", "ol", "dl", "table"))
    for _ in range(rng.randint(3, 9)):
        if kind == "dl":
            out += [("<dt>", None), (_word(rng), 1), ("<dd>", None), (_text(rng), 1)]
        elif kind == "table":
            out += [("<tr><td>", None), (_word(rng), 1), ("</td><td>", None), (_text(rng), 1), ("</td></tr>", None)]
        else:
            out += [("<li>", None), (_text(rng), 1), ("</li>", None)]
    return _around(kind, "", out)


def _bare(rng: random.Random, label: int) -> Made:
    return [(_text(rng), label)]


def _frame(rng: random.Random, kind: str) -> Made:
    """A part of the page that is no main text."""
    names, tags = {
        "menu": (MENU, ("nav", "nav", "div", "ul")),
        "header": (HEADER, ("header", "header", "div")),
        "sidebar": (SIDEBAR, ("aside", "aside", "div", "section")),
        "notice": (NOTICE, ("div", "div", "section", "dialog")),
        "advert": (ADVERT, ("div", "div", "aside", "section")),
        "form": (FORM, ("form", "form", "div")),
        "comments": (COMMENTS, ("div", "section", "ol", "div")),
        "footer": (FOOTER, ("footer", "footer", "div")),
    }[kind]
    tag = rng.choice(tags)
    telling = tag in ("nav", "header", "aside", "form", "footer", "dialog")
    fill = rng.choice((_bare, _links, lambda r, y: _paragraphs(r, y, 3, ("p", "p", "div", "span"))))
    if kind == "comments":
        fill = lambda r, y: _paragraphs(r, y, 4, ("p", "li", "div"))
    if kind == "form":
        fill = lambda r, y: [
            ("<label>", None), (_word(r), y), ('</label><input name="q"><button>', None),
            (_word(r), y), ("</button>", None),
        ]
    inside = fill(rng, 0)
    if tag in ("ul", "ol"):
        inside = [("<li>", None), *inside, ("</li>", None)]
    return _around(tag, _attribute(rng, names, 0.5 if telling else 1.0), inside)


def labelled_page(rng: random.Random) -> tuple[str, list[int]]:
    """A page, and the label of each of its leaf blocks in order (1: main text)."""
    article: Made = []
    if rng.random() < 0.8:
        article += [("<h1>", None), (_text(rng), 1), ("</h1>", None)]
    for _ in range(rng.randint(1, 4)):
        article += _paragraphs(rng, 1, 5, ("p", "p", "p", "p", "h2", "h3", "blockquote", "div"))
        if rng.random() < 0.15:
            article += _around(rng.choice(("ul", "ol")), "", [("<li>", None), (_text(rng), 1)])
        if rng.random() < 0.1:
            article += _around("table", "", [("<tr><td>", None), (_text(rng), 1)])
        if rng.random() < 0.5:
            article += _frame(rng, rng.choice(("advert", "advert", "sidebar", "notice", "form")))
    if rng.random() < 0.25:
        article += _frame(rng, rng.choice(("comments", "footer", "menu")))
    if rng.random() < 0.12:  # a page that is chiefly a list, a table or terms
        article = article[:3] + _listed(rng)
    kind = rng.random()
    if kind < 0.42:
        article = _around("article", _attribute(rng, MAIN, 0.3), article)
    elif kind < 0.53:
        article = _around("main", _attribute(rng, MAIN, 0.3), article)
    elif kind < 0.8:
        article = _around("div", _attribute(rng, MAIN), article)
    elif kind < 0.95:  # names that say nothing
        for _ in range(rng.randint(1, 3)):
            tag = rng.choice(("div", "div", "div", "section", "td"))
            article = _around(tag, _unknown(rng), article)
            if tag == "td":
                article = _around("table", "", _around("tr", "", article))
        if rng.random() < 0.5:
            article = _around("div", _attribute(rng, MAIN), article)
    page: Made = [
        ('<!DOCTYPE html><html><head><meta charset="utf-8"><title>', None),
        (_text(rng), 0),
        ("</title><style>p{}</style><script>var a='<p>';</script></head><body>", None),
    ]
    before = ["menu", "header", "notice", "advert", "form", "sidebar"]
    after = ["sidebar", "comments", "advert", "menu", "footer", "form", "notice"]
    for kinds, most in ((before, 4), (after, 4)):
        some: Made = []
        for k in rng.sample(kinds, rng.randint(1, most)):
            some += _frame(rng, k)
        page += some if kinds is before else [*article, *some]
    if rng.random() < 0.3:
        page.insert(3, (f"<div{_attribute(rng, NEUTRAL)}>", None))
    page += [("</body></html>", None)] if rng.random() < 0.8 else []
    # A private character before each text tells which block it ends up in.
    marked = "".join(x if y is None else MARKS[y] + escape(x, quote=False) for x, y in page)
    labels = [int(MARKS[1] in b.text) for b in leaf_blocks(marked)]
    return marked.replace(MARKS[0], "").replace(MARKS[1], ""), labels


def labelled_pages(n: int = 1200, seed: int = 7) -> list[tuple[str, list[int]]]:
    rng = random.Random(seed)
    return [labelled_page(rng) for _ in range(n)]
