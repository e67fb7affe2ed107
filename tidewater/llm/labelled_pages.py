"""Labelled pages for fitting the page model.

The tables hold no labelled pages, so the training set is made here: pages of
many layouts (semantic tags, class names only, neither; comments, notices,
forms, menus, adverts) whose text runs are marked as main text or not.  The
words are random, so the model can only learn structure.
"""

from __future__ import annotations

import random

# Private-use marks that carry a run's label through the parser
MAIN, OTHER = "\ue001", "\ue000"

_MENU = ["nav", "menu", "navbar", "main-nav", "breadcrumb", "topbar", "site-menu", "nav-links"]
_SIDE = ["sidebar", "side", "widget", "related", "more-stories", "popular", "tags", "aside", "recommended"]
_AD = ["ad", "ads", "advert", "sponsored", "promo", "banner-ad", "ad-slot"]
_NOTICE = ["cookie", "cookie-notice", "consent", "banner", "gdpr", "notice", "alert", "newsletter", "subscribe"]
_FOOT = ["footer", "site-footer", "bottom", "copyright", "legal", "page-footer"]
_HEAD = ["header", "site-header", "masthead", "top", "page-header", "logo"]
_TALK = ["comments", "comment-list", "discussion", "replies", "comment-section", "user-comments", "disqus"]
_MAIN = ["content", "article", "post", "entry-content", "story", "main", "article-body", "post-body", "text"]
_FLAT = ["c1", "box", "row", "wrap", "x7", "col", "inner", "block", ""]


class _Writer:
    def __init__(self, rng: random.Random):
        self.rng, self.out, self.n = rng, [], 0

    def words(self, lo: int, hi: int, stop: bool = True) -> str:
        n = self.rng.randint(lo, hi)
        out = []
        for i in range(n):
            w = "".join(self.rng.choice("abcdefghijklmnopqrstuvwxyzéüß") for _ in range(self.rng.randint(2, 9)))
            if stop and i and self.rng.random() < 0.09:
                w += self.rng.choice([",", ",", "."])
            out.append(w)
        return " ".join(out).capitalize() + ("." if stop else "")

    def run(self, main: bool, text: str) -> str:
        return (MAIN if main else OTHER) + text


def labelled_page(seed: int) -> str:
    """A page whose text runs each begin with MAIN or OTHER."""
    rng = random.Random(seed)
    w = _Writer(rng)
    semantic, named = rng.random() < 0.5, rng.random() < 0.75

    def element(tag: str, names: list[str], inner: str) -> str:
        name = rng.choice(names) if named or (not semantic and rng.random() < 0.6) else rng.choice(_FLAT)
        t = tag if semantic else "div"
        key = rng.choice(["class", "class", "id"])
        return f'<{t} {key}="{name}">{inner}</{t}>' if name and (t == "div" or rng.random() < 0.6) else f"<{t}>{inner}</{t}>"

    def links(lo: int, hi: int) -> str:
        items = "".join(f'<li><a href="/{i}">{w.run(False, w.words(1, 4, False))}</a></li>' for i in range(rng.randint(lo, hi)))
        return f"<ul>{items}</ul>" if rng.random() < 0.8 else items.replace("<li>", "").replace("</li>", " | ")

    def para(main: bool, lo: int = 5, hi: int = 90) -> str:
        t = w.run(main, w.words(lo, hi))
        if rng.random() < 0.2:
            t += f" <a href='#'>{w.words(1, 5, False)}</a> {w.words(3, 20)}"
        if rng.random() < 0.1:
            t = f"<b>{t}</b>"
        return f"<p>{t}</p>" if rng.random() < 0.97 else f"<p>{t}<br>"

    def short() -> str:
        t = w.run(False, w.words(2, 14, rng.random() < 0.6))
        return t if rng.random() < 0.6 else f"<p>{t}</p>"

    body = []
    for _ in range(rng.randint(0, 9) if rng.random() < 0.85 else rng.randint(10, 40)):
        body.append(para(True))
        if rng.random() < 0.08:
            body.append(f"<h{rng.randint(2, 3)}>{w.run(True, w.words(2, 8, False))}</h3>")
        if rng.random() < 0.06:
            body.append("<ul>" + "".join(f"<li>{w.run(True, w.words(4, 20))}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        if rng.random() < 0.04:
            body.append(f"<blockquote>{para(True)}</blockquote>")
        if rng.random() < 0.03:
            body.append("<table>" + "".join(f"<tr><td>{w.run(True, w.words(1, 5, False))}<td>{w.run(True, w.words(1, 5, False))}" for _ in range(3)) + "</table>")
        if rng.random() < 0.03:
            body.append(f"<pre>{w.run(True, w.words(4, 30, False))}</pre>")
        if rng.random() < 0.07:
            body.append(element("aside", _AD + _SIDE, short()))
    title = f"<h1>{w.run(True, w.words(2, 12, False))}</h1>"
    if not body or rng.random() < 0.12:      # very short articles
        body = [para(True, *rng.choice([(1, 3), (1, 6), (4, 12), (8, 40)]))]
    article = element("article", _MAIN, title + "".join(body) + (short_share(w) if rng.random() < 0.15 else ""))
    if rng.random() < 0.5:
        article = element("main", _MAIN, article)
    before, after = [], []
    before.append(element("header", _HEAD, w.run(False, w.words(1, 5, False)) + (element("nav", _MENU, links(2, 9)) if rng.random() < 0.5 else "")) if rng.random() < 0.5 else "")
    before.append(element("nav", _MENU, links(2, 9)) if rng.random() < 0.85 else "")
    before.append(f'<div class="{rng.choice(_AD + _NOTICE)}">{short()}</div>' if rng.random() < 0.6 else "")
    if rng.random() < 0.15:
        before.append(f'<form action="/s"><label>{w.run(False, w.words(1, 3, False))}</label><input name=q><p>{w.run(False, w.words(1, 4, False))}</p></form>')
    if rng.random() < 0.3:
        talk = "".join(f'<div class="{rng.choice(["comment", "reply", "c"])}"><p>{w.run(False, w.words(1, 2, False))}</p>{para(False, 4, 60)}</div>' for _ in range(rng.randint(1, 6)))
        after.append(f'<{"section" if semantic else "div"} {rng.choice(["id", "class"])}="{rng.choice(_TALK)}"><h3>{w.run(False, w.words(1, 3, False))}</h3>{talk}</{"section" if semantic else "div"}>')
    if rng.random() < 0.4:
        after.append(element("aside", _SIDE, f"<h4>{w.run(False, w.words(1, 3, False))}</h4>" + links(2, 8)))
    if rng.random() < 0.25:
        after.append(f'<div class="{rng.choice(_NOTICE + _AD + _SIDE)}">{para(False, 6, 40)}</div>')
    if rng.random() < 0.15:
        after.append(f"<form>{w.run(False, w.words(2, 9))}<textarea>x</textarea></form>")
    after.append(element("footer", _FOOT, w.run(False, "&copy; site.example.net &middot; " + w.words(2, 25)) + (links(1, 4) if rng.random() < 0.3 else "")) if rng.random() < 0.9 else "")
    if rng.random() < 0.3:
        rng.shuffle(before)
    return f"<html><head><title>t</title></head><body>{''.join(before)}{article}{''.join(after)}</body></html>"


def short_share(w: _Writer) -> str:
    return f'<div class="share">{w.run(False, w.words(1, 4, False))}</div>'
