"""HTML pages: links of listing pages and the parts of article pages, with the standard parser only."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements whose text is never shown, void elements, and elements that begin a new line.
HIDDEN = {"script", "style", "noscript", "iframe", "footer"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {"p", "div", "li", "tr", "h1", "h2", "h3", "h4", "br", "section", "article", "ul", "table"}
_SPACE = re.compile(r"[ \t\r\f\v\xa0]+")
_DATE = re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}|\d{1,2}[/-]\d{1,2}[/-]\d{4}\s*[-|]?\s*\d{1,2}:\d{2}(?:\s*[AP]M)?", re.IGNORECASE)


@dataclass
class Layout:
    """Where a site keeps what: class names in order of preference, and what counts as an article address."""

    noise: frozenset[str] = frozenset({"ads", "advertisement", "banner", "sidebar", "related", "share", "comment", "footer"})
    title: tuple[str, ...] = ("title", "detail-title", "article-title")
    lead: tuple[str, ...] = ("sapo", "chapeau", "lead")
    body: tuple[str, ...] = ("detail-content", "article-content", "contentdetail", "body", "entry-content")
    date: tuple[str, ...] = ("time", "date", "pdate")
    author: tuple[str, ...] = ("author",)
    article: str = r"https?://[^/]+/.+-?\w*\d.*\.(?:html|htm|chn)$"
    least_body: int = 300
    least_title: int = 12


@dataclass
class _Node:
    tag: str
    attrs: dict
    parts: list = field(default_factory=list)

    def text(self) -> str:
        out: list[str] = []
        self._collect(out)
        lines = [_SPACE.sub(" ", x).strip() for x in "".join(out).split("\n")]
        return "\n".join(x for x in lines if x)

    def _collect(self, out: list[str]) -> None:
        stack: list = [iter(self.parts)]
        while stack:
            part = next(stack[-1], None)
            if part is None:
                stack.pop()
            elif isinstance(part, str):
                out.append(part)
            else:
                if part.tag in BLOCKS:
                    out.append("\n")
                stack.append(iter([*part.parts, "\n"] if part.tag in BLOCKS else part.parts))

    def walk(self) -> Iterator[_Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [p for p in reversed(node.parts) if isinstance(p, _Node)]


class _Tree(HTMLParser):
    def __init__(self, noise: frozenset[str]) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("root", {})
        self.open = [self.root]
        self.noise, self.meta = noise, {}

    def handle_starttag(self, tag: str, attrs: list) -> None:
        values = {k: v or "" for k, v in attrs}
        if tag == "meta":
            self.meta.setdefault(values.get("property") or values.get("name") or "", values.get("content", ""))
        node = _Node(tag, values)
        if tag not in HIDDEN and not self.noise & set(values.get("class", "").split()):
            self.open[-1].parts.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].parts.append(re.sub(r"\s+", " ", data))


def _tree(html: str | None, layout: Layout) -> _Tree:
    tree = _Tree(layout.noise)
    tree.feed(html or "")
    tree.close()
    return tree


def links(html: str | None, base: str, layout: Layout = Layout()) -> list[tuple[str, str]]:
    """(address, title) of the article links of a page, each address once, in order."""
    seen: dict[str, str] = {}
    host, article = urlsplit(base).netloc, re.compile(layout.article, re.IGNORECASE)
    for node in _tree(html, layout).root.walk():
        if node.tag == "a" and node.attrs.get("href", "").strip():
            url = urldefrag(urljoin(base, node.attrs["href"].strip()))[0]
            title = " ".join((node.attrs.get("title") or node.text()).split())
            if urlsplit(url).netloc == host and article.match(url) and len(title) >= layout.least_title:
                seen.setdefault(url, title)
    return list(seen.items())


def article(html: str | None, layout: Layout = Layout()) -> dict[str, str]:
    """Title, lead, content, author and date text of an article page; what is not found is empty."""
    tree = _tree(html, layout)
    nodes = list(tree.root.walk())

    def first(names: tuple[str, ...], tags: tuple[str, ...] = (), least: int = 1) -> str:
        for name in (*tags, *names):
            for n in nodes:
                if n.tag == name or name in n.attrs.get("class", "").split():
                    if len(text := n.text()) >= least:
                        return text
        return ""

    meta = lambda *names: next((tree.meta[n] for n in names if tree.meta.get(n)), "")
    body = first(layout.body, least=layout.least_body) or first((), ("article",), layout.least_body)
    when = meta("article:published_time", "pubdate", "date")
    if not when:
        when = next((n.attrs.get("datetime") or n.text() for n in nodes if n.tag == "time"), "") or first(layout.date)
    if not when and (m := _DATE.search(tree.root.text())):
        when = m.group()
    return {"title": first(layout.title, ("h1",)) or meta("og:title", "title"), "lead": first(layout.lead, ("h2",)) or meta("description", "og:description"), "content": body, "author": first(layout.author), "published": when}


def parse_articles(pages: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """(url, title, lead, content, author, published) of pages (url, html)."""
    names = ["title", "lead", "content", "author", "published"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [article(h, layout) for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([f[n] for f in found], pa.string()) for n in names]], ["url", *names])

    return pages.select("url", "html").mapInArrow(run, "url string, " + ", ".join(f"{n} string" for n in names))


def parse_links(pages: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """(page, url, title) of the article links of pages (url, html)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [(p, u, t) for p, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for u, t in links(h, p, layout)]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.string()) for k in range(3)], ["page", "url", "title"])

    return pages.select("url", "html").mapInArrow(run, "page string, url string, title string")
