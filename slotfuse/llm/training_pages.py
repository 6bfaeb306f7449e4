"""Labelled pages in many layouts, made from a seed, to train the block labeller on."""

from __future__ import annotations

import random
from collections.abc import Iterator

# Words that page furniture is made of, and names its elements go by.
FURNITURE_WORDS = (
    "home about contact login register search menu news sports help privacy policy terms cookies accept subscribe "
    "newsletter copyright rights reserved advertisement sponsored share tweet follow related popular comments reply "
    "next previous more archive tags category sign email password submit send"
).split()
KINDS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    # kind: elements, names
    "menu": (("nav", "div", "ul", "menu"), ("nav", "menu", "navbar", "navigation", "topnav", "breadcrumb", "links", "tabs", "pagination")),
    "header": (("header", "div"), ("header", "masthead", "top", "site-header", "logo", "banner-top", "branding")),
    "footer": (("footer", "div"), ("footer", "bottom", "copyright", "site-footer", "colophon", "legal")),
    "sidebar": (("aside", "div", "section"), ("sidebar", "side", "widget", "related", "recommended", "popular", "trending", "author-box")),
    "notice": (("div", "section", "p"), ("cookie", "notice", "alert", "consent", "gdpr", "popup", "modal", "newsletter", "subscribe", "warning")),
    "advert": (("div", "aside", "section"), ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "adsbox", "sponsor")),
    "form": (("form",), ("search", "login", "contact", "signup", "form", "")),
    "comments": (("div", "section", "ol"), ("comments", "comment", "replies", "discussion", "respond", "comment-list", "disqus")),
    "share": (("div", "ul"), ("share", "social", "tools", "follow", "buttons", "meta")),
}
ARTICLE = (("article", "main", "div", "section"), ("content", "post", "entry", "article", "story", "main", "body", "text", "article-body", "entry-content", ""))
# Names of wrappers that speak of furniture and hold the article all the same, and of furniture
# that is one word of several.
WRAPPERS = (
    "page wrapper container row site layout main-wrapper sidebar-layout has-sidebar no-sidebar with-sidebar two-column "
    "comments-enabled post-comments-enabled has-comments header-fixed with-footer menu-open ad-free no-ads site-container "
    "content-sidebar-wrap page-with-ads l-sidebar-right article-with-related subscribe-ready"
).split()
COMPOUNDS = ("site-{}", "{}-area", "{}-box", "left-{}", "{}-right", "main-{}", "{}-wrapper", "{}-block", "widget-{}", "{}-list", "js-{}", "{}__inner", "{}-inner")
HEADINGS = ("About us", "Related", "More news", "{} comments", "Comments ({})", "{} replies", "Leave a reply", "Newsletter", "Sponsored", "Follow us", "Read more", "Categories")
LETTERS = "eeeeaaaiiooutnsrhldcmpgbfvyßäöüéèçñóí"


class Maker:
    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)
        self.syllables = ["".join(self.rng.choices(LETTERS, k=self.rng.randint(1, 4))) for _ in range(40)]
        self.labels: dict[str, int] = {}
        self.count = 0

    def prose(self, low: int, high: int) -> str:
        r = self.rng
        ends = r.choice((("", "", "", "", ",", "."),) * 6 + (("***", "&&&", "%%", "$$$", "###"), (" |",), ("!!",)))
        said = ["".join(r.choices(self.syllables, k=r.randint(1, 4))) + r.choice(ends) for _ in range(r.randint(low, high))]
        if r.random() < 0.05:
            said = [said[0]] + [r.choice(said)] * (len(said) - 1)
        text = " ".join(said)
        change = r.choice((str.capitalize,) * 6 + (str.upper, str.lower))
        return change(text) + r.choice((".", ".", ".", "", ":", "!"))

    def furniture(self, low: int, high: int) -> str:
        if self.rng.random() < 0.5:
            return self.prose(low, high)
        said = self.rng.choices(FURNITURE_WORDS, k=self.rng.randint(low, high))
        return self.rng.choice(("", "", "&copy; ")) + " ".join(said).capitalize()

    def leaf(self, text: str, label: int) -> str:
        """The text, made unique so that its block can be recognised."""
        self.count += 1
        marked = f"{text} q{self.count}z"
        self.labels[f"q{self.count}z"] = label
        return marked

    def named(self, names: tuple[str, ...]) -> str:
        name = self.rng.choice(names)
        if not name:
            return ""
        if self.rng.random() < 0.12:  # a name that says nothing
            name = self.rng.choice(("col-8", "col-md-9", "column", "grid", "unit", "box", "wide", "primary", "css-"))
            name += "".join(self.rng.choices("abcdefxyz0123", k=4)) if name == "css-" else ""
        elif self.rng.random() < 0.25:
            name = self.rng.choice(COMPOUNDS).format(name)
        extra = self.rng.choice(("", "", " clearfix", " row", " block wide"))
        return f' {self.rng.choice(("class", "class", "id"))}="{name}{extra}"'

    def heading(self) -> str:
        """A heading of page furniture, by words of its own or like any other."""
        said = self.rng.choice(HEADINGS).format(self.rng.randint(0, 99)) if self.rng.random() < 0.6 else self.furniture(1, 4)
        h = self.rng.choice(("h2", "h3", "h4", "h3", "div", "p"))
        return f"<{h}>{self.leaf(said, 0)}</{h}>"

    def part(self, kind: str) -> str:
        r, (elements, names) = self.rng, KINDS[kind]
        element = r.choice(elements)
        plain = element in ("nav", "footer", "aside", "form", "header", "menu")
        attribute = "" if plain and r.random() < 0.6 else self.named(names)
        if kind in ("menu", "share") or (kind in ("sidebar", "footer") and r.random() < 0.4):
            items = "".join(f'<li><a href="/{i}">{self.leaf(self.furniture(1, 3), 0)}</a></li>' for i in range(r.randint(2, 9)))
            inner = items if element in ("ul", "menu") else f"<ul>{items}</ul>"
        elif kind == "form":
            inner = "".join(f'<label>{self.leaf(self.furniture(1, 3), 0)}</label><input name="x">' for _ in range(r.randint(1, 3)))
            inner += f"<button>{self.leaf(self.furniture(1, 2), 0)}</button>"
        elif kind == "comments":
            one = "li" if element == "ol" else r.choice(("div", "p"))
            name = r.choice((' class="comment"', ' class="reply"', ""))
            inner = "".join(f"<{one}{name}><p>{self.leaf(self.prose(2, 40), 0)}</p></{one}>" for _ in range(r.randint(1, 8)))
        elif kind == "header" and r.random() < 0.5:
            h = r.choice(("h1", "div", "p", "h2"))
            inner = f'<{h}><a href="/">{self.leaf(self.furniture(1, 4), 0)}</a></{h}>' + (f"<p>{self.leaf(self.prose(2, 8), 0)}</p>" if r.random() < 0.4 else "")
        else:
            wrap = r.choice(("p", "div", ""))
            pieces = [self.leaf(self.furniture(2, 25), 0) for _ in range(1 if not wrap else r.randint(1, 3))]
            inner = "".join(f"<{wrap}>{p}</{wrap}>" if wrap else p for p in pieces)
        if element != "p" and kind in ("sidebar", "comments", "notice", "advert", "form", "footer") and r.random() < 0.45:
            inner = self.heading() + inner
        if element != "p" and r.random() < 0.2:
            inner = f"<div{self.named(('inner', 'wrap', 'container', ''))}>{inner}</div>"
        return f"<{element}{attribute}>{inner}</{element}>"

    def body(self) -> str:
        r = self.rng
        out = [f"<{h}>{self.leaf(self.prose(1, 12), 1)}</{h}>" for h in r.choice((("h1",), ("h1", "h2"), ("h2",), ()))]
        for _ in range(r.choice((1, 2, 4, 8, 16, 30))):
            roll = r.random()
            if roll < 0.72:
                link = '<a href="/x">link</a> ' if r.random() < 0.2 else ""
                out.append(f"<p>{link}{self.leaf(self.prose(1, r.choice((4, 12, 30, 120, 400))), 1)}" + r.choice(("</p>", "</p>", "")))
            elif roll < 0.8:
                out.append(f"<h{r.randint(2, 4)}>{self.leaf(self.prose(1, 7), 1)}</h{2}>")
            elif roll < 0.86:
                out.append("<ul>" + "".join(f"<li>{self.leaf(self.prose(2, 15), 1)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif roll < 0.9:
                out.append(f"<blockquote>{self.leaf(self.prose(4, 30), 1)}</blockquote>")
            elif roll < 0.93:
                out.append(f"<p><b>{self.leaf(self.prose(1, 12), 1)}<br>")
            elif roll < 0.945:
                terms = "".join(f"<dt>{self.leaf(self.prose(1, 4), 1)}</dt><dd>{self.leaf(self.prose(2, 20), 1)}</dd>" for _ in range(r.randint(1, 4)))
                out.append(f"<dl>{terms}</dl>")
            elif roll < 0.955:
                out.append(f'<figure{self.named(("figure", "image", "wp-caption", ""))}><img src="a.png"><figcaption>{self.leaf(self.prose(2, 15), 1)}</figcaption></figure>')
            elif roll < 0.965:
                linked = "".join(f'<li><a href="/{i}">{self.leaf(self.prose(3, 14), 1)}</a></li>' for i in range(r.randint(2, 5)))
                out.append(f"<ul>{linked}</ul>")
            elif roll < 0.975:
                out.append(f"<table><tr><td>{self.leaf(self.prose(1, 8), 1)}</td><td>{self.leaf(self.prose(1, 8), 1)}</td></tr></table>")
            else:
                out.append(self.part(r.choice(("advert", "advert", "share", "notice", "sidebar", "menu", "form", "form"))))
        if r.random() < 0.06:  # many short lines alike
            said = self.prose(1, 4)
            out += [f"<p>{self.leaf(said, 1)}" + r.choice(("</p>", "</p>", "<br>")) for _ in range(r.randint(4, 20))]
        if r.random() < 0.25:  # in sections, named or not
            size = r.randint(1, 5)
            element = r.choice(("div", "section", "div"))
            out = [f"<{element}{self.named(('section', 'chapter', 'block', 'paragraph', '', '', ''))}>{''.join(out[i:i + size])}</{element}>" for i in range(0, len(out), size)]
        return "".join(out)

    def page(self) -> str:
        r, (elements, names) = self.rng, ARTICLE
        before = [k for k in ("header", "menu", "notice", "advert", "form", "share", "menu") if r.random() < 0.4]
        after = [k for k in ("share", "comments", "sidebar", "advert", "form", "notice", "footer", "footer", "menu") if r.random() < 0.4]
        r.shuffle(before)
        element = r.choice(elements)
        attribute = "" if element in ("article", "main") and r.random() < 0.6 else self.named(names)
        article = f"<{element}{attribute}>{self.body()}</{element}>"
        roll = r.random()
        if roll < 0.15:
            article = self.body()
        elif roll < 0.3:  # nothing but elements without a name
            article = "<div>" * (depth := r.randint(1, 3)) + self.body() + "</div>" * depth
        middle = "".join(map(self.part, before)) + article + "".join(map(self.part, after))
        for _ in range(r.randint(0, 2)):
            middle = f'<div class="{r.choice(WRAPPERS)}">{middle}</div>' if r.random() < 0.7 else f"<div>{middle}</div>"
        return f"<html><head><title>{self.prose(2, 6)}</title></head><body{r.choice(("", "", f' class="{r.choice(WRAPPERS)} {r.choice(WRAPPERS)}"'))}>{middle}</body></html>"


def training_pages(count: int, seed: int = 5) -> Iterator[tuple[str, dict[str, int]]]:
    """(html, label by marker) of `count` pages; a block's marker is its last word."""
    for number in range(count):
        maker = Maker(seed * 1_000_003 + number)
        yield maker.page(), maker.labels
