"""Labelled web pages to train on: seeded pages in many layouts whose parts are known.

An element with ``data-main`` says whether the text below it, down to the next
such element, belongs to the main text.  Words are invented syllables, so a
model can only learn from structure, tags and attribute names.
"""

from __future__ import annotations

import random

PAGES = 600
SEED = 20

# Attribute names by the role of an element, as they are common on the web.
NAMES = {
    "ad": "ad ads advert ad-banner sponsored promo adsbygoogle advertisement ad-slot banner-ad sponsor-box commercial",
    "side": "sidebar side widget rail right-col secondary left-column sidebar-widget aside",
    "nav": "nav menu navbar topnav breadcrumb main-menu navigation site-nav pagination tabs",
    "notice": "cookie cookie-banner consent notice alert gdpr popup modal cookie-notice privacy-notice announcement",
    "comment": "comments comment-list responses disqus replies comment comment-thread discussion user-comments",
    "related": "related recommended more-stories read-next trending also-like popular",
    "social": "share social sharing share-buttons follow-us",
    "foot": "footer site-footer foot copyright bottom page-footer colophon",
    "head": "header masthead site-header top branding page-header topbar logo",
    "form": "newsletter signup subscribe login search search-form contact-form",
    "content": "content article post entry-content story-body main-content article-body text body-copy story page-content",
}
SYLLABLES = "an ba ce do er fi gu ha in ju ka lo mi no or pe qui ra st ti un ver wo xa ys zel é ü ñ ção".split()


class Writer:
    def __init__(self, rng: random.Random) -> None:
        self.rng = rng

    def chance(self, share: float) -> bool:
        return self.rng.random() < share

    def words(self, least: int, most: int, link: float = 0.0) -> str:
        out = []
        for k in range(self.rng.randint(least, most)):
            w = "".join(self.rng.choices(SYLLABLES, k=self.rng.randint(1, 4)))
            w = w.capitalize() if k == 0 or self.chance(0.06) else w
            w += self.rng.choice([",", ".", ".", ";", "!", "###", "***"]) if self.chance(0.15) else ""
            if self.chance(0.02):
                w = f"<{(t := self.rng.choice(['b', 'em', 'i', 'code', 'span', 'strong']))}>{w}</{t}>"
            if self.chance(link):
                w = f'<a href="/{w[:3]}">{w}</a>'
            out.append(w)
        return " ".join(out)

    def named(self, role: str, share: float = 0.85) -> str:
        """A class or id attribute of a role, or none."""
        if not self.chance(share):
            return ""
        name = self.rng.choice(NAMES[role].split())
        if self.chance(0.2):
            name += " " + self.rng.choice(["box", "wide", "clearfix", "row", "x12", "js-block"])
        return f' {self.rng.choice(["class", "class", "id"])}="{name}"'

    def element(self, tag: str, inner: str, attributes: str = "", main: int | None = None) -> str:
        mark = "" if main is None else f' data-main="{main}"'
        return f"<{tag}{attributes}{mark}>{inner}</{tag}>"

    def links(self, least: int, most: int, words: tuple[int, int] = (1, 3)) -> str:
        items = [f'<a href="/{k}">{self.words(*words)}</a>' for k in range(self.rng.randint(least, most))]
        if self.chance(0.75):
            return self.element(self.rng.choice(["ul", "ul", "ol"]), "".join(self.element("li", x) for x in items))
        return self.rng.choice([" | ", " ", " &middot; "]).join(items)

    def paragraph(self, link: float = 0.01) -> str:
        size = self.rng.choice([(1, 4), (5, 20), (20, 60), (40, 150)])
        parts = [self.words(*size, link=link)]
        while self.chance(0.2):
            parts.insert(self.rng.randint(0, len(parts)), f'<a href="/l">{self.words(2, 14)}</a>')
        return f'<a href="/l">{parts[0]}</a>' if self.chance(0.04) and "<a" not in parts[0] else " ".join(parts)

    def sources(self) -> str:
        """A list of links that belongs to an article."""
        head = self.element(self.rng.choice(["h2", "h3", "h4"]), self.words(1, 4)) * self.chance(0.5)
        items = [f'<a href="/s{k}">{self.words(2, 14)}</a>' + (" " + self.words(1, 8)) * self.chance(0.3)
                 for k in range(self.rng.randint(2, 8))]
        return head + self.element(self.rng.choice(["ul", "ul", "ol"]), "".join(self.element("li", x) for x in items))

    def prose(self) -> str:
        """The blocks of an article, now and then with parts that are not its own."""
        r, out = self.rng, []
        loose = self.chance(0.15)
        for _ in range(r.choice([1, 2, 4, 7, 12, 20])):
            kind = r.random()
            if kind < 0.62:
                text = self.paragraph()
                out.append(text + "<br>" * r.randint(1, 2) if loose else
                           f"<p><b>{text}<br>" if self.chance(0.08) else f"<p>{text}" + "</p>" * (not self.chance(0.1)))
            elif kind < 0.69:
                out.append(self.element(r.choice(["h2", "h3", "h4"]), self.words(1, 8)))
            elif kind < 0.75:
                out.append(self.element(r.choice(["ul", "ol"]), "".join(
                    "<li>" + (f'<a href="/l">{self.words(1, 14)}</a>' if self.chance(0.2) else self.words(2, 25, link=0.02)) + "</li>" * (not self.chance(0.2)) for _ in range(r.randint(2, 7)))))
            elif kind < 0.79:
                out.append(self.element("blockquote", self.element("p", self.words(6, 50))))
            elif kind < 0.82:
                out.append(self.element("table", "".join(self.element("tr", "".join(
                    self.element(r.choice(["td", "th"]), self.words(1, 3)) for _ in range(3))) for _ in range(r.randint(2, 5)))))
            elif kind < 0.84:
                out.append(self.element("pre", self.words(5, 30)))
            elif kind < 0.86:
                out.append(self.element("figure", '<img src="a.png">' + self.element("figcaption", self.words(3, 15))))
            elif kind < 0.93:
                out.append(self.sources())
            elif kind < 0.95:
                out.append(self.element(r.choice(["div", "section", "div"]), f"<p>{self.paragraph()}</p><p>{self.paragraph()}</p>"))
            else:
                # Within an article, link lists are its own unless they are named otherwise.
                out.append(r.choice([self.advert, lambda: self.social(1), lambda: self.related(1), self.signup, self.notice])())
        return "".join(out)

    def advert(self) -> str:
        inner = self.rng.choice([self.words(2, 25), f"<p>{self.words(3, 30)}</p>", f'<a href="/buy">{self.words(2, 12)}</a>'])
        return self.element(self.rng.choice(["div", "div", "section", "aside", "ins", "p"]), inner, self.named("ad", 1), 0)

    def social(self, named: float = 0.85) -> str:
        return self.element("div", self.links(2, 6, (1, 2)), self.named("social", named), 0)

    def related(self, named: float = 0.85) -> str:
        inner = (self.element("h3", self.words(1, 4)) if self.chance(0.5) else "") + self.links(2, 8, (3, 12))
        return self.element(self.rng.choice(["div", "section", "aside"]), inner, self.named("related", named), 0)

    def signup(self) -> str:
        fields = self.element("label", self.words(1, 4)) + '<input type="text">' + self.element("button", self.words(1, 2))
        inner = f"<p>{self.words(4, 30)}</p>" * self.chance(0.5) + fields
        return self.element("form", inner, self.named("form", 0.6), 0)

    def notice(self) -> str:
        inner = f"<p>{self.words(8, 40)}</p>" if self.chance(0.5) else self.words(8, 40, link=0.05)
        role = ' role="alert"' if self.chance(0.15) else ""
        return self.element(self.rng.choice(["div", "div", "section", "dialog", "aside", "p"]),
                            inner + self.element("button", self.words(1, 2)) * self.chance(0.4), self.named("notice", 1) + role, 0)

    def comments(self) -> str:
        def one() -> str:
            head = self.element(self.rng.choice(["span", "h4", "cite", "b"]), self.words(1, 3)) * self.chance(0.6)
            body = f"<p>{self.paragraph()}</p>" if self.chance(0.7) else self.paragraph()
            return self.element(self.rng.choice(["div", "li", "article"]), head + body, self.named("comment", 0.6))
        inner = self.element("h3", self.words(1, 4)) * self.chance(0.6) + "".join(one() for _ in range(self.rng.randint(1, 8)))
        inner += self.signup() * self.chance(0.3)
        return self.element(self.rng.choice(["div", "section", "ol", "aside"]), inner, self.named("comment", 1), 0)

    def menu(self) -> str:
        tag = self.rng.choice(["nav", "nav", "div", "ul"])
        if tag == "ul":
            inner = "".join(self.element("li", f'<a href="/{k}">{self.words(1, 2)}</a>') for k in range(self.rng.randint(2, 9)))
        else:
            inner = self.links(2, 9, (1, 2))
        return self.element(tag, inner, self.named("nav", 0.5 if tag == "nav" else 0.8), 0)

    def top(self) -> str:
        inner = self.rng.choice([self.element("a", self.words(1, 3), ' href="/"'), self.element("h1", self.words(1, 4)),
                                 self.element("p", self.words(2, 10))])
        return self.element(self.rng.choice(["header", "header", "div"]), inner + self.menu() * self.chance(0.5), self.named("head"), 0)

    def bottom(self) -> str:
        inner = "&copy; " * self.chance(0.6) + self.words(2, 30) + self.links(2, 6) * self.chance(0.4)
        inner = f"<p>{inner}</p>" if self.chance(0.4) else inner
        return self.element(self.rng.choice(["footer", "footer", "div"]), inner, self.named("foot", 1), 0)

    def sidebar(self) -> str:
        parts = [f"<h3>{self.words(1, 3)}</h3><p>{self.words(5, 40)}</p>", self.links(2, 9, (2, 8)), f"<p>{self.words(10, 60)}</p>"]
        inner = "".join(self.rng.sample(parts, self.rng.randint(1, 3)))
        return self.element(self.rng.choice(["aside", "aside", "div"]), inner, self.named("side", 1), 0)

    def article(self) -> str:
        r = self.rng
        title = self.element("h1", self.words(1, 12)) if self.chance(0.85) else ""
        if title and self.chance(0.1):
            title = self.element("header", title)
        inner = title + self.prose()
        if self.chance(0.3):
            inner = title + self.element("div", self.prose(), self.named("content", 0.7))
        inner += (self.social(1) * self.chance(0.1) + self.related(1) * self.chance(0.1) + self.comments() * self.chance(0.1))
        tag = r.choice(["article", "article", "article", "div", "div", "section", "main", "main"])
        return self.element(tag, inner, self.named("content", 0.4 if tag == "article" else 0.9), 1)

    def page(self) -> str:
        r = self.rng
        before = [f() for f, share in ((self.notice, 0.3), (self.top, 0.5), (self.menu, 0.6), (self.advert, 0.4),
                                       (self.sidebar, 0.15)) if self.chance(share)]
        after = [f() for f, share in ((self.advert, 0.2), (self.sidebar, 0.3), (self.comments, 0.35), (self.related, 0.25),
                                      (self.signup, 0.25), (self.notice, 0.15)) if self.chance(share)]
        r.shuffle(before)
        r.shuffle(after)
        middle = self.article()
        if self.chance(0.4):
            held = r.randint(0, len(after))
            middle = self.element(r.choice(["main", "div", "div", "section"]), "".join(before[2:]) + middle + "".join(after[:held]),
                                  r.choice(["", ' id="wrapper"', ' class="container"', ' id="main"']))
            before, after = before[:2], after[held:]
        body = "".join(before) + middle + "".join(after) + self.bottom() * self.chance(0.85)
        if self.chance(0.04):
            body = self.element("form", body, ' id="aspnetForm"')
        script = "<script>var t='<p>';</script>" * self.chance(0.5)
        end = "</body></html>" * (not self.chance(0.1))
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 8)}</title>{script}</head><body>{body}{script}{end}"


def pages() -> list[str]:
    rng = random.Random(SEED)
    return [Writer(rng).page() for _ in range(PAGES)]
