"""Labelled pages to train the extraction model: generated, with varied templates, content marked by data-y."""

from __future__ import annotations

import random

_SYLLABLES = "an be co do el fi ga ho in ka la me no or pa qui re so ta un ve wi ou éa ñe zü".split()


def _words(r: random.Random, n: int) -> str:
    out = ["".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) for _ in range(n)]
    for i in range(len(out)):
        if i and r.random() < 0.08:
            out[i - 1] += r.choice(",.")
    return " ".join(out).capitalize() + r.choice([".", ".", "", "!"])


def _links(r: random.Random, n: int) -> str:
    return "".join(f'<li><a href="/{i}">{_words(r, r.randint(1, 3))}</a></li>' for i in range(n))


def _junk(r: random.Random) -> str:
    """A block that is no content."""
    w = lambda a, b: _words(r, r.randint(a, b))
    name = r.choice
    return r.choice(
        [
            lambda: f'<nav><ul>{_links(r, r.randint(2, 8))}</ul></nav>',
            lambda: f'<div class="{name(["nav", "menu", "navbar", "breadcrumb", "top-menu", "main-nav"])}"><ul>{_links(r, r.randint(2, 8))}</ul></div>',
            lambda: f'<header class="{name(["site-header", "page-header", "top", ""])}"><div class="logo"><a href="/">{w(1, 3)}</a></div><p>{w(2, 8)}</p></header>',
            lambda: f'<div id="header"><h2>{w(1, 4)}</h2><p>{w(2, 8)}</p></div>',
            lambda: f'<aside class="{name(["sidebar", "side", ""])}"><h3>{w(1, 3)}</h3><p>{w(3, 30)}</p><ul>{_links(r, r.randint(1, 5))}</ul></aside>',
            lambda: f'<div class="{name(["sidebar", "widget", "related", "related-posts", "recommended", "trending"])}"><h3>{w(1, 3)}</h3><p>{w(3, 30)}</p><ul>{_links(r, r.randint(1, 5))}</ul></div>',
            lambda: f'<div class="{name(["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "ad-slot"])}">{w(2, 40)}</div>',
            lambda: f'<div class="{name(["ad", "advert", "promo", "sponsor"])}"><p>{w(2, 40)}</p></div>',
            lambda: f'<div class="{name(["cookie", "cookie-notice", "notice", "consent", "alert", "newsletter", "subscribe", "popup", "modal", "gdpr", "disclaimer", "paywall"])}"><p>{w(4, 40)}</p><button>{w(1, 2)}</button></div>',
            lambda: f'<form action="/q" class="{name(["search", "login", "contact", ""])}"><label>{w(1, 3)}</label><input name="q"><select><option>{w(1, 2)}</option></select><p>{w(1, 20)}</p><button>{w(1, 2)}</button></form>',
            lambda: f'<aside class="{name(["", "", "pull", "box"])}">{w(1, 3)}: <a href="/r">{w(1, 4)}</a> {w(1, 12)}</aside>',
            lambda: f'<aside><p>{w(2, 40)}</p></aside>',
            lambda: f'<form><p>{w(1, 6)}</p><input></form>',
            lambda: f'<form method="post"><fieldset><legend>{w(1, 3)}</legend><div><label>{w(1, 3)}</label><input></div><div><p>{w(2, 30)}</p></div></fieldset><div><p>{w(1, 12)}</p><button>{w(1, 2)}</button></div></form>',
            lambda: f'<div class="{name(["share", "social", "tags", "meta", "toolbar", "pagination"])}"><a href="#">{w(1, 2)}</a> <a href="#">{w(1, 2)}</a></div>',
        ]
    )()


def _comments(r: random.Random) -> str:
    """A thread of reader comments: named or plain entries, as blocks, items or articles, some with replies inside."""
    entry = r.choice(["div", "div", "li", "article", "p"])
    named = r.random() < 0.6

    def one(depth: int = 0) -> str:
        name = r.choice(["comment", "comment-body", "reply", "post-reply", "thread-item", "reader-comment", "message"])
        text = _words(r, r.randint(1, 60))
        if entry == "p":
            return f"<p>{text}</p>"
        inner = f"<p>{text}</p>" if r.random() < 0.6 else text
        if r.random() < 0.4:
            inner = f'<div class="{r.choice(["author", "meta", "byline"])}">{_words(r, r.randint(1, 3))}</div>' + inner
        if depth < 2 and r.random() < 0.25:
            inner += f'<ul class="{r.choice(["replies", "children"])}"><li>{_words(r, r.randint(1, 30))}</li></ul>' if entry == "li" else one(depth + 1)
        return f'<{entry} class="{name}">{inner}</{entry}>' if named else f"<{entry}>{inner}</{entry}>"

    tag = r.choice(["ol", "ul"]) if entry == "li" else r.choice(["section", "section", "div"])
    name = r.choice("comments comment-list commentlist disqus responses discussion thread replies feedback reader-comments conversation respond talkback".split())
    head = "" if entry == "li" or r.random() < 0.3 else f"<h3>{_words(r, 2)}</h3>"
    return f'<{tag} {r.choice(["class", "id"])}="{name}">{head}' + "".join(one() for _ in range(r.randint(1, 5))) + f"</{tag}>"


def _footer(r: random.Random) -> str:
    tag = r.choice(["footer", "footer", *(f'div {r.choice(["class", "id"])}="{n}"' for n in ("footer", "footer", "ft", "copyright", "colophon", "legal", "bottom")), 'footer class="site-footer"'])
    inner = f"&copy; {_words(r, r.randint(1, 30))}"
    if r.random() < 0.5:
        inner = f"<p>{inner}</p><ul>{_links(r, r.randint(0, 4))}</ul>"
    return f"<{tag}>{inner}</{tag.split()[0]}>"


def _content(r: random.Random) -> str:
    def mark(tag: str, inner: str) -> str:
        return f'<{tag} data-y="1">{inner}</{tag.split()[0]}>'

    def inline(n: int) -> str:
        text = _words(r, n)
        if r.random() < 0.3:
            text += f' <a href="/x">{_words(r, r.randint(1, 4))}</a> {_words(r, r.randint(1, 10))}'
        if r.random() < 0.2:
            text = f"<{(t := r.choice(['b', 'em', 'strong', 'span']))}>{text}</{t}>"
        return text

    out = []
    if r.random() < 0.85:
        head = mark("h1", _words(r, r.randint(2, 12)))
        out.append(head if r.random() < 0.85 else f'<header data-y="1">{head}</header>')
    for _ in range(r.randint(1, 10)):
        kind = r.random()
        if r.random() < 0.18:  # blocks without a telling element or name
            out.append(_plain(r, mark, inline))
        elif kind < 0.68:
            out.append(mark("p", inline(r.choice([1, 2, 4, 8, 15, 30, 60, 120]))))
        elif kind < 0.76:
            out.append(mark(r.choice(["h2", "h3"]), _words(r, r.randint(1, 8))))
        elif kind < 0.81:
            out.append(mark(r.choice(["ul", "ol"]), "".join(mark("li", inline(r.randint(1, 20))) for _ in range(r.randint(1, 5)))))
        elif kind < 0.84:
            out.append(mark("blockquote", mark("p", inline(r.randint(3, 40)))))
        elif kind < 0.87:
            out.append(mark("pre", _words(r, r.randint(2, 30))))
        elif kind < 0.90:
            out.append(mark("table", mark("tr", "".join(mark("td", _words(r, r.randint(1, 4))) for _ in range(3)))))
        elif kind < 0.92:
            out.append(mark("figure", '<img src="x">' + mark("figcaption", _words(r, r.randint(2, 10)))))
        else:
            out.append(_junk(r))
    if r.random() < 0.25:
        out.append(_comments(r))
    return "".join(out)


_NAMES = "ad advert alert banner comment cookie footer header menu meta nav notice promo share sidebar social sponsor tags widget".split()


def _plain(r: random.Random, mark, inline) -> str:
    """Content in containers that say nothing, or whose name has a word that junk has alone."""
    own = "".join(r.choices(_SYLLABLES, k=r.randint(1, 3)))
    name = r.choice([own, f"{own}-{r.randint(1, 9)}", f"{r.choice(_NAMES)}-{own}", f"{own}-{r.choice(_NAMES)}"])
    tag = r.choice(["div", "div", "section", f'div class="{name}"', f'div class="{name}"', f'section id="{name}"'])
    inner = r.choice([lambda: inline(r.randint(2, 60)), lambda: "".join(mark("p", inline(r.randint(3, 60))) for _ in range(r.randint(1, 4))), lambda: mark("div", inline(r.randint(3, 40)))])()
    return mark(tag, inner)


def labelled_page(seed: int) -> str:
    r = random.Random(seed)
    shell = r.choice(["article"] * 5 + ["main", 'div class="content"', 'div id="main-content"', 'div class="post-body"', 'div class="article-text"', 'div class="entry"'])
    body = f'<{shell} data-y="1">{_content(r)}</{shell.split()[0]}>'
    own = r.random() < 0.06  # text that stands in the body itself is content where the page says nothing else
    if own:
        body = "".join(_words(r, r.randint(3, 60)) + r.choice(["<p data-y=\"1\">" + _words(r, r.randint(2, 40)) + "</p>", "<hr>"]) for _ in range(r.randint(1, 4))) + _words(r, r.randint(2, 20))
    elif r.random() < 0.1:  # no element of its own around the content
        body = _content(r)
    if r.random() < 0.3:
        body = f"<main>{_junk(r) if r.random() < 0.4 else ''}{body}</main>"
    before = "".join(_junk(r) for _ in range(r.randint(0, 4)))
    after = "".join(_junk(r) for _ in range(r.randint(0, 2))) + (_comments(r) if r.random() < 0.3 else "") + (_footer(r) if r.random() < 0.9 else "")
    wrap = ("", "") if own else ("<div>", "</div>") if r.random() < 0.3 else ('<div class="container">', "</div>") if r.random() < 0.2 else ("", "")
    return f"<!DOCTYPE html><html><head><title>{_words(r, 4)}</title><style>p{{}}</style><script>x()</script></head><body{' data-y="1"' if own else ''}>{wrap[0]}{before}{body}{after}{wrap[1]}</body></html>"
