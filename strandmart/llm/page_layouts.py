"""Generated web pages with known main text: the labelled rows that the page model is fitted on.

Layouts vary in containers, names, order and nesting, boilerplate comes as links, sentences or forms, some boilerplate stands inside
the article and some markup is unclosed.  Main blocks are known because the generator wrote them.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

SYLLABLES = "an be co de en fa ge ha in jo ka le mi no or pa qua re sa to un ve wi xa yo ze ou ll er th ti on es ch tion ing ment ß é ó ä ñ".split()
LINKS = "Home About Contact News Sports World Business Login Register Help Privacy Terms Archive Shop Careers RSS Next Previous Menu".split()


class Writer:
    def __init__(self, rng: random.Random) -> None:
        self.rng = rng
        self.main: set[str] = set()
        self.words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(300)]

    def sentence(self, low: int = 4, high: int = 18) -> str:
        found = self.rng.choices(self.words, k=self.rng.randint(low, high))
        if self.rng.random() < 0.3:
            found[len(found) // 2] += ","
        return " ".join(found).capitalize() + self.rng.choice("....?!")

    def title(self, low: int, high: int) -> str:
        """A heading: mostly without an end mark."""
        text = self.sentence(low, high)
        return text if self.rng.random() < 0.2 else text[:-1]

    def prose(self, low: int, high: int) -> str:
        """Sentences; now and then a row of words, a repeated word or words with symbols, as careless pages have."""
        kind = self.rng.random()
        text = " ".join(self.sentence() for _ in range(self.rng.randint(low, high)))
        if kind < 0.05:
            return " | ".join(text.split())
        if kind < 0.09:
            return " ".join([self.rng.choice(self.words)] * self.rng.randint(1, 200))
        if kind < 0.13:
            return " ".join(w + self.rng.choice(("###", "%%%", "!!", "$$$")) for w in text.split())
        if kind < 0.2:
            return text[: max(3, self.rng.randint(3, 40))].strip()
        return text

    def wrap(self, tag: str, inside: str, names: str = "") -> str:
        """An element; names become a class or an id, in several spellings."""
        if not names:
            return f"<{tag}>{inside}</{tag}>"
        name = self.rng.choice(names.split())
        name = self.rng.choice([name, f"{name}-{self.rng.choice(['box', 'wrap', 'inner', '1'])}", f"site-{name}", f"{name} clearfix"])
        return f"<{tag} {self.rng.choice(['class', 'class', 'id'])}=\"{name}\">{inside}</{tag}>"

    def block(self, tag: str, text: str, closed: bool = True) -> str:
        """A main block."""
        self.main.add(" ".join(text.split()))
        if self.rng.random() < 0.25 and " " in text:
            first, rest = text.split(" ", 1)
            inner = self.rng.choice([f"<b>{first}</b> {rest}", f"<a href=\"/x\">{first}</a> {rest}", f"{first} <em>{rest}</em>", f"<b>{first} {rest}<br>"])
        else:
            inner = text
        return f"<{tag}>{inner}" + (f"</{tag}>" if closed else "")

    def links(self, low: int, high: int) -> str:
        names = [self.rng.choice(LINKS) if self.rng.random() < 0.5 else self.rng.choice(self.words) for _ in range(self.rng.randint(low, high))]
        if self.rng.random() < 0.7:
            return "<ul>" + "".join(f"<li><a href=\"/{n}\">{n}</a></li>" for n in names) + "</ul>"
        return " | ".join(f"<a href=\"/{n}\">{n}</a>" for n in names)

    def advert(self) -> str:
        inside = self.rng.choice([self.prose(1, 2), f"<a href=\"/b\">{self.sentence(2, 6)}</a>", f"<p>{self.prose(1, 3)}</p>"])
        return self.wrap(self.rng.choice(["div", "div", "aside", "section"]), inside, "ad ads advert sponsor promo advertisement")

    def notice(self) -> str:
        inside = self.rng.choice([f"<p>{self.prose(1, 3)}</p>", self.prose(1, 2)]) + self.rng.choice(["", "<button>Accept</button>", "<a href=\"/p\">More</a>"])
        return self.wrap(self.rng.choice(["div", "section"]), inside, "cookie notice consent popup banner alert")

    def form(self) -> str:
        inside = f"<label>{self.sentence(1, 4)}</label><input name=\"q\"><button>{self.sentence(1, 2)}</button>"
        if self.rng.random() < 0.5:
            inside = f"<p>{self.prose(1, 2)}</p>" + inside
        form = f"<form action=\"/s\">{inside}</form>"
        return form if self.rng.random() < 0.5 else self.wrap("div", form, "newsletter search subscribe login")

    def comments(self) -> str:
        one = lambda: self.wrap(self.rng.choice(["div", "li", "article"]), f"<h4>{self.title(1, 2)}</h4>" * self.rng.randint(0, 1) + f"<p>{self.prose(1, 5)}</p>" * self.rng.randint(1, 2), "comment reply")
        inside = f"<h3>{self.rng.choice(['Comments', 'Kommentare', self.title(1, 2)])}</h3>" + "".join(one() for _ in range(self.rng.randint(1, 6)))
        return self.wrap(self.rng.choice(["div", "section", "ul", "aside"]), inside, "comments discussion respond replies")

    def aside(self) -> str:
        parts = [f"<h3>{self.title(1, 5)}</h3>", self.rng.choice([self.links(3, 9), f"<p>{self.prose(1, 3)}</p>", self.advert()])]
        if self.rng.random() < 0.4:
            return self.wrap("aside", "".join(parts * self.rng.randint(1, 2)), self.rng.choice(["", "sidebar side"]))
        return self.wrap("div", "".join(parts * self.rng.randint(1, 3)), "sidebar side widget related recommended rail")

    def nav(self) -> str:
        if self.rng.random() < 0.6:
            return self.wrap("nav", self.links(3, 12), self.rng.choice(["", "nav menu"]))
        return self.wrap("div", self.links(3, 12), "nav menu navigation breadcrumbs topbar")

    def header(self) -> str:
        inside = self.rng.choice([f"<h1>{self.title(1, 6)}</h1>", f"<a href=\"/\">{self.sentence(1, 3)}</a>", f"<p>{self.prose(1, 2)}</p>", ""]) + self.rng.choice([self.nav(), self.form(), ""])
        return self.wrap("header", inside, self.rng.choice(["", "header"])) if self.rng.random() < 0.6 else self.wrap("div", inside, "header masthead top")

    def footer(self) -> str:
        inside = self.rng.choice([f"&copy; {self.sentence(1, 3)} &middot; {self.sentence(2, 9)}", f"<p>{self.prose(1, 3)}</p>", self.links(2, 8), self.links(2, 5) + f"<p>© 2024 {self.sentence(1, 5)}</p>"])
        return self.wrap("footer", inside, self.rng.choice(["", "footer"])) if self.rng.random() < 0.65 else self.wrap("div", inside, "footer copyright bottom legal")

    def share(self) -> str:
        return self.wrap("div", self.rng.choice([self.links(2, 5), self.sentence(1, 3)]), "share social meta")

    def article(self) -> str:
        """The main container with its blocks, and now and then something else inside."""
        r = self.rng
        title = self.block(r.choice(["h1", "h1", "h2"]), self.title(1, 14))
        if r.random() < 0.12:
            title = f"<header>{title}</header>"
        parts = []
        closed = r.random() < 0.7
        for _ in range(r.choice([1, 2, 3, 5, 8, 14])):
            kind = r.random()
            if kind < 0.72:
                parts.append(self.block("p", self.prose(1, r.choice([1, 3, 9])), closed or r.random() < 0.6))
            elif kind < 0.82:
                parts.append(self.block(r.choice(["h2", "h3"]), self.title(1, 9)))
            elif kind < 0.88:
                parts.append("<ul>" + "".join(self.block("li", self.sentence(2, 14)) for _ in range(r.randint(2, 6))) + "</ul>")
            elif kind < 0.92:
                parts.append("<blockquote>" + self.block("p", self.prose(1, 3)) + "</blockquote>")
            elif kind < 0.95:
                parts.append("<table>" + "".join("<tr>" + "".join(self.block("td", self.sentence(1, 4)) for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 4))) + "</table>")
            else:
                parts.append("<figure><img src=\"/i.png\">" + self.block("figcaption", self.sentence(3, 10)) + "</figure>")
        for extra, chance in ((self.advert, 0.25), (self.share, 0.2), (self.aside, 0.15), (self.form, 0.1), (self.nav, 0.06)):
            if r.random() < chance:
                parts.insert(r.randint(0, len(parts)), extra())
        if r.random() < 0.15:
            parts.append(self.comments())
        inside = title + "".join(parts)
        way = r.random()
        if way < 0.5:
            inside = self.wrap("article", inside, r.choice(["", "", "post article entry"]))
        elif way < 0.85:
            inside = self.wrap(r.choice(["div", "div", "section"]), inside, r.choice(["content post article story entry main", "content post article story entry main", ""]))
        if r.random() < 0.4:
            inside = self.wrap(r.choice(["main", "main", "div"]), inside, r.choice(["", "content main page"]))
        return inside

    def page(self) -> str:
        r = self.rng
        before = [f for f, chance in ((self.header, 0.5), (self.nav, 0.7), (self.notice, 0.3), (self.advert, 0.45), (self.aside, 0.2), (self.form, 0.12)) if r.random() < chance]
        after = [f for f, chance in ((self.comments, 0.4), (self.aside, 0.45), (self.share, 0.2), (self.advert, 0.25), (self.notice, 0.15), (self.nav, 0.1), (self.footer, 0.85)) if r.random() < chance]
        body = "".join(f() for f in before) + self.article() + "".join(f() for f in after)
        if r.random() < 0.3:
            body = self.wrap("div", body, r.choice(["page wrap container", ""]))
        head = f"<head><meta charset=\"utf-8\"><title>{self.sentence(2, 8)}</title><style>p{{margin:0}}</style><script>var t=\"</p>\";</script></head>"
        end = "</body></html>" if r.random() < 0.8 else ""
        return f"<!DOCTYPE html><html>{head}<body>{body}{end}"


def labelled_pages(n: int, seed: int) -> Iterator[tuple[str, set[str]]]:
    """``n`` pages, each with the set of its main blocks' texts."""
    rng = random.Random(seed)
    for _ in range(n):
        writer = Writer(rng)
        source = writer.page()
        yield source, writer.main
