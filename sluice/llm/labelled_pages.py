"""Labelled pages the extraction model is trained on.

Each page is built from labelled parts: ``data-y="1"`` marks elements of the article,
``data-y="0"`` the rest of the page. Wrappers, class names, the order of the parts and
the lengths of the texts vary by page. The texts carry no signal but their length,
punctuation and links.
"""
from __future__ import annotations

import random

#: Names that page templates commonly give their parts (fixed values).
AROUND = {
    "nav": ("nav", "menu", "navbar", "breadcrumb", "topnav", "pagination"),
    "header": ("header", "masthead", "site-header", "topbar"),
    "footer": ("footer", "site-footer", "copyright", "bottom"),
    "aside": ("sidebar", "aside", "widget", "related", "rail"),
    "notice": ("cookie-notice", "notice", "consent", "alert", "banner", "gdpr", "popup", "modal"),
    "ad": ("ad", "ads", "advert", "promo", "sponsored", "advertisement"),
    "form": ("newsletter", "subscribe", "search", "login", "form"),
    "comments": ("comments", "comment-list", "replies", "discussion", "disqus"),
    "share": ("share", "social", "tags", "meta"),
}
INSIDE = ("article", "content", "main-content", "post", "entry", "story", "article-body", "text", "post-body")
WORDS = ("the", "river", "of", "stone", "runs", "under", "old", "bridges", "and", "people", "cross", "them", "when", "light", "is", "low")


def _text(r: random.Random, low: int, high: int, end: str = ".") -> str:
    ws = [r.choice(WORDS) for _ in range(r.randint(low, high))]
    step = r.choice((4, 6, 9, 9, 9, 14))
    for k in range(step - 2, len(ws), step):
        ws[k] += r.choice((",", ".", ""))
    return " ".join(ws).capitalize() + end


def _links(r: random.Random, tag: str) -> str:
    rows = "".join(f'<li data-y="0"><a href="/{k}">{_text(r, 1, 3, "")}</a></li>' for k in range(r.randint(3, 7)))
    return f'<{tag} data-y="0">{rows}</{tag}>'


def _around(r: random.Random, kind: str) -> str:
    name, y = r.choice(AROUND[kind]), 'data-y="0"'
    attr = f'{r.choice(("class", "id"))}="{name}"' if r.random() < 0.8 else ""
    own = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind)
    tag = own if own and (not attr or r.random() < 0.6) else r.choice(("div", "section"))
    if tag in ("div", "section"):
        attr = f'{r.choice(("class", "id"))}="{name}"'
    body = {
        "nav": lambda: _links(r, "ul"),
        "header": lambda: r.choice((_links(r, "ul"), f'<h1 {y}>{_text(r, 1, 4, "")}</h1>', f'<div {y}><a href="/">{_text(r, 1, 3, "")}</a></div>')),
        "footer": lambda: r.choice(("&copy; " + _text(r, 3, 20), f'<p {y}>{_text(r, 4, 30)}</p>', _links(r, "ul"))),
        "aside": lambda: f'<h3 {y}>{_text(r, 1, 4, "")}</h3>' + r.choice((_links(r, "ul"), f'<p {y}>{_text(r, 6, 30)}</p>')),
        "notice": lambda: r.choice((_text(r, 5, 30), f'<p {y}>{_text(r, 5, 30)}</p><p {y}><a href="#">{_text(r, 1, 2, "")}</a></p>')),
        "ad": lambda: r.choice((_text(r, 3, 25), f'<p {y}>{_text(r, 3, 25)}</p>', f'<a href="/x">{_text(r, 3, 12)}</a>')),
        "form": lambda: f'<p {y}>{_text(r, 3, 12)}</p><input type="text">',
        "comments": lambda: f'<h3 {y}>{_text(r, 1, 2, "")}</h3>' + "".join(
            f'<div {y} class="{r.choice(("comment", "reply", "comment-body"))}"><p {y}>{_text(r, 5, 60)}</p></div>' for _ in range(r.randint(1, 4))),
        "share": lambda: r.choice((_links(r, "ul"), f'<a href="/s">{_text(r, 1, 3, "")}</a>')),
    }[kind]()
    return f"<{tag} {y} {attr}>{body}</{tag}>"


def _part(r: random.Random) -> str:
    y, k = 'data-y="1"', r.random()
    if k < 0.68:
        inner = _text(r, *r.choice(((1, 4), (8, 30), (30, 120))))
        if r.random() < 0.3:
            inner += f' <a href="/r">{_text(r, 1, 4, "")}</a> ' + _text(r, 2, 20)
        return f"<p {y}>{inner}</p>"
    if k < 0.78:
        return f'<{(h := r.choice(("h2", "h3")))} {y}>{_text(r, 1, 7, "")}</{h}>'
    if k < 0.86:
        rows = "".join(f"<li {y}>{_text(r, 3, 25)}</li>" for _ in range(r.randint(2, 4)))
        return f"<ul {y}>{rows}</ul>"
    if k < 0.92:
        return f"<blockquote {y}><p {y}>{_text(r, 8, 40)}</p></blockquote>"
    if k < 0.96:
        return f"<table {y}><tr {y}><td {y}>{_text(r, 1, 8)}</td><td {y}>{_text(r, 1, 8)}</td></tr></table>"
    return f"<pre {y}>{_text(r, 5, 30)}</pre>"


def _article(r: random.Random) -> str:
    y = 'data-y="1"'
    title = r.choice((f'<h1 {y}>{_text(r, 3, 12, "")}</h1>', f'<header {y}><h1 {y}>{_text(r, 3, 12, "")}</h1></header>', ""))
    parts = [_part(r) for _ in range(r.randint(1, 9))]
    for kind in ("ad", "share", "aside", "form", "notice"):
        if r.random() < 0.15:
            parts.insert(r.randint(0, len(parts)), _around(r, kind))
    name = f'class="{r.choice(INSIDE)}"' if r.random() < 0.7 else f'id="{r.choice(INSIDE)}"'
    tag = r.choice(("article", "article", "article", "div", "section", "main"))
    if tag in ("article", "main") and r.random() < 0.5:
        name = ""
    body = title + "".join(parts) + (_around(r, "comments") if r.random() < 0.2 else "")
    return f"<{tag} {y} {name}>{body}</{tag}>"


def _prose(r: random.Random) -> str:
    """Text of an article that stands in no paragraph elements."""
    return "<br><br>".join(_text(r, *r.choice(((8, 30), (30, 120)))) for _ in range(r.randint(1, 5)))


def _plain(r: random.Random) -> str:
    """An article without names: in unnamed wrappers of any depth, directly in its wrapper
    or in few paragraphs."""
    y, k = 'data-y="1"', r.random()
    if k < 0.2:
        body = f"<div {y}>{_prose(r)}</div>"
    elif k < 0.4:
        body = "".join(f"<div {y}>{_text(r, *r.choice(((6, 20), (20, 90))))}</div>" for _ in range(r.randint(1, 5)))
    elif k < 0.6:
        body = f"<p {y}>{_text(r, 8, 100)}</p>"
    elif k < 0.75:
        body = f'<p {y}>See <a href="/r">{_text(r, 2, 8, "")}</a></p><p {y}>{_text(r, 1, 3)}</p>'
    elif k < 0.85:
        body = f"<pre {y}>{_text(r, 8, 60)}</pre><p {y}>{_text(r, 4, 30)}</p>"
    else:
        body = "".join(_part(r) for _ in range(r.randint(1, 6)))
    for _ in range(r.choice((0, 1, 1, 2, 3, 12))):
        body = f"<div {y}>{body}</div>"
    tag = r.choice(("", "", "div", "article", "main", "section"))
    return f"<{tag} {y}>{body}</{tag}>" if tag else body


def labelled_pages(count: int = 160, seed: int = 7) -> list[str]:
    """``count`` pages with named parts and three quarters as many without names."""
    out = []
    for k in range(3 * count // 4):
        r = random.Random(f"{seed}-plain-{k}")
        if k % 8 == 0:  # text alone
            out.append(_prose(r))
            continue
        if k % 8 == 1:
            out.append(f'<html><head><title>{_text(r, 2, 6, "")}</title></head><body data-y="1">{_prose(r)}</body></html>')
            continue
        top = [_around(r, kind) for kind in ("header", "nav", "notice", "ad") if r.random() < 0.25]
        below = [_around(r, kind) for kind in ("comments", "aside", "share", "footer") if r.random() < 0.25]
        body = "".join([*top, _plain(r), *below])
        if k % 2:  # a wrapper of all parts is no part of the article
            body = f'<div data-y="0">{body}</div>'
        out.append(f'<html><body data-y="0">{body}</body></html>')
    for k in range(count):
        r = random.Random(f"{seed}-{k}")
        top = [_around(r, kind) for kind in ("header", "nav", "notice", "ad", "form") if r.random() < 0.5]
        below = [_around(r, kind) for kind in ("comments", "aside", "share", "ad", "notice", "footer") if r.random() < 0.5]
        r.shuffle(top)
        wrap = r.choice(("{}", '<div class="wrapper">{}</div>', '<div id="page"><div class="container">{}</div></div>'))
        out.append(f"<html><head><title>{_text(r, 2, 6, '')}</title></head><body>" + wrap.format("".join([*top, _article(r), *below])) + "</body></html>")
    return out
