"""Pages of single records: labelled fields, sections, cited sources, media and links, as one nested row for each page.

A page is read into a small tree once. A field is a heading of the third or fourth level and what else its block holds; a
section is a heading of the second level and what follows it in its block; sources are the items of a section whose heading
says so, with a declared count. Nothing is corrected here: values stay as they stand on the page.

Tags of plain form are told by one regular expression; a page with any other markup is read by the standard parser. Both give
one tree.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from sedimenta.functions.text import decode_bytes
from sedimenta.operators.extract import DROPPED, VOID, tidy

SCHEMA = (
    "title string, fields array<struct<label: string, value: string, url: string>>, sections array<struct<heading: string, text: string>>, "
    "sources_section_present boolean, sources_declared int, sources array<struct<position: int, name: string, url: string, archive_url: string, tags: array<string>>>, "
    "media array<struct<kind: string, url: string, caption: string>>, links array<string>, json_ld array<string>"
)
_SOURCE = pa.struct({"position": pa.int32(), "name": pa.string(), "url": pa.string(), "archive_url": pa.string(), "tags": pa.list_(pa.string())})
#: The same for Arrow.
ARROW = [
    ("title", pa.string()),
    ("fields", pa.list_(pa.struct({"label": pa.string(), "value": pa.string(), "url": pa.string()}))),
    ("sections", pa.list_(pa.struct({"heading": pa.string(), "text": pa.string()}))),
    ("sources_section_present", pa.bool_()),
    ("sources_declared", pa.int32()),
    ("sources", pa.list_(_SOURCE)),
    ("media", pa.list_(pa.struct({"kind": pa.string(), "url": pa.string(), "caption": pa.string()}))),
    ("links", pa.list_(pa.string())),
    ("json_ld", pa.list_(pa.string())),
]
LINES = set("p div li ul ol section article h1 h2 h3 h4 h5 h6 br tr td th blockquote figcaption dd dt".split())
PARTS = {"h3": "field", "h4": "field", "h2": "section", "img": "media", "video": "media", "audio": "media", "iframe": "media", "a": "link"}
UNSEEN = ("script", "style", "noscript", "template")
ARCHIVE_WORDS = ("archive", "archived")
#: Text, an end tag, a start tag with its attributes, or markup that is not of plain form.
TOKEN = re.compile(r"""([^<]+)|</([a-z][a-z0-9]*)>|<([a-z][a-z0-9]*)((?: +[a-z][a-z-]*=(?:'[^'<>]*'|"[^"<>]*"|[\w.:-]+))*)>|(<)""", re.ASCII)
ATTRIBUTE = re.compile(r""" ([a-z-]+)=(?:'([^']*)'|"([^"]*)"|([^ ]*))""")
#: Elements whose content the parser reads by other rules.
RAW = set("script style textarea title iframe noembed noframes noscript plaintext xmp svg math template".split())


class Element:
    __slots__ = ("tag", "attrs", "children", "parent", "at", "end")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None, at: int = 0):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent
        self.at, self.end = at, None  # its place among the page's elements, and that behind its last one; None: the page's end

    def walk(self) -> Iterator[Element]:
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(c for c in reversed(node.children) if isinstance(c, Element))

    def find(self, *tags: str) -> list[Element]:
        return [e for e in self.walk() if e.tag in tags and e is not self]

    def text(self, without: Element | None = None) -> str:
        own = [c for c in self.children if c is not without]
        if all(isinstance(c, str) for c in own):
            one = "".join(own)
            if len(one.splitlines()) < 2 and self.tag not in UNSEEN:
                return " ".join(one.split())
        out: list[str] = []
        todo: list[Element | str] = [self]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                out.append(node)
            elif node is not without and node.tag not in UNSEEN:
                if node.tag in LINES:
                    out.append("\n")
                    todo.append("\n")
                todo.extend(reversed(node.children))
        return tidy("\n".join(line for line in "".join(out).split("\n") if line.strip()))

    def has_class(self, *words: str) -> bool:
        own = self.attrs.get("class", "").lower().split()
        return any(w in own for w in words)

    def within(self, tag: str) -> bool:
        node = self.parent
        while node is not None:
            if node.tag == tag:
                return True
            node = node.parent
        return False


class _Tree:
    """The elements of a page in their order, the first of them its root."""

    def __init__(self) -> None:
        self.at = Element("", {}, None)
        self.elements = [self.at]

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        node = Element(tag, attrs, self.at, len(self.elements))
        self.elements.append(node)
        self.at.children.append(node)
        if tag in VOID:
            node.end = node.at + 1
        else:
            self.at = node

    def stop(self, tag: str) -> None:
        node: Element | None = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            below: Element | None = self.at
            while below is not node.parent:
                below.end = len(self.elements)
                below = below.parent
            self.at = node.parent

    def text(self, data: str) -> None:
        self.at.children.append(data)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tree = _Tree()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tree.start(tag, {k: v or "" for k, v in attrs})

    def handle_endtag(self, tag: str) -> None:
        self.tree.stop(tag)

    def handle_data(self, data: str) -> None:
        self.tree.text(data)


def _plain_tree(text: str) -> _Tree | None:
    """The tree of a page whose tags all have the plain form; else None."""
    tree = _Tree()
    for data, closed, opened, attrs, other in TOKEN.findall(text):
        if data:
            tree.text(unescape(data) if "&" in data else data)
        elif closed:
            if closed in RAW:
                return None
            tree.stop(closed)
        elif other or opened in RAW or "&" in attrs:
            return None
        else:
            tree.start(opened, {k: a or b or c for k, a, b, c in ATTRIBUTE.findall(attrs)} if attrs else {})
    return tree


def elements_of(text: str) -> list[Element]:
    """The elements of a page in their order, the first of them its root."""
    tree = _plain_tree(text)
    if tree is None:
        builder = _Builder()
        builder.feed(text)
        builder.close()
        tree = builder.tree
    return tree.elements


def _count(heading: str) -> int | None:
    head, _, tail = heading.rpartition("(")
    digits = tail.rstrip(")").replace(",", "").strip()
    return int(digits) if head and digits.isdigit() else None


def _source(item: Element, position: int) -> dict | None:
    anchors = [a for a in item.find("a") if a.attrs.get("href")]
    archived = [a for a in anchors if a.has_class(*ARCHIVE_WORDS) or a.text().lower() in ARCHIVE_WORDS]
    direct = [a for a in anchors if a not in archived]
    if not anchors and not item.text():
        return None
    tags = [t.text() for t in item.find("li", "span") if t.has_class("tag")]
    return {
        "position": position,
        "name": direct[0].text() if direct else item.text().split("\n")[0],
        "url": direct[0].attrs["href"] if direct else None,
        "archive_url": archived[0].attrs["href"] if archived else None,
        "tags": tags,
    }


def parse(text: str) -> dict:
    """One page."""
    elements = elements_of(text)
    body = next((e for e in elements if e.tag in ("article", "main")), elements[0])
    inside = elements[body.at + 1 : body.end]
    of: dict[str, list[Element]] = {}
    for element in inside:
        of.setdefault(PARTS.get(element.tag, ""), []).append(element)
    fields: dict[tuple[str, str], dict] = {}
    for heading in of.get("field", ()):
        block, label = heading.parent, heading.text()
        value = block.text(without=heading) if block is not None else ""
        if label and value:
            url = next((a.attrs["href"] for a in elements[block.at + 1 : block.end] if a.tag == "a" and a.attrs.get("href")), None)
            fields.setdefault((label, value), {"label": label, "value": value, "url": url})
    sections, sources, declared, present = [], [], None, False
    for heading in of.get("section", ()):
        block, name = heading.parent, heading.text()
        sections.append({"heading": name, "text": block.text(without=heading)})
        if name.lower().startswith("sources"):
            present, declared = True, _count(name)
            items = [li for li in elements[block.at + 1 : block.end] if li.tag == "li" and not any(p.has_class("tag") for p in (li,)) and not (li.parent is not None and li.parent.within("li"))]
            sources += [s for s in (_source(li, len(sources) + i + 1) for i, li in enumerate(items)) if s]
    media = []
    for node in of.get("media", ()):
        url = node.attrs.get("src") or node.attrs.get("data-src")
        figure = node.parent
        while figure is not None and figure.tag != "figure":
            figure = figure.parent
        caption = next((c.text() for c in figure.find("figcaption")), "") if figure is not None else ""
        if url:
            media.append({"kind": {"img": "image", "iframe": "embed"}.get(node.tag, node.tag), "url": url, "caption": caption or node.attrs.get("alt") or None})
    json_ld = []
    for script in (e for e in elements if e.tag == "script"):
        if "ld+json" in script.attrs.get("type", ""):
            raw = "".join(c for c in script.children if isinstance(c, str))
            try:
                json_ld.append(json.dumps(json.loads(raw), ensure_ascii=False, sort_keys=True))
            except ValueError:
                continue
    title = next((t.text() for t in elements if t.tag == "title"), "")
    links = [a.attrs["href"] for a in of.get("link", ()) if a.attrs.get("href") and not any(a.within(t) for t in DROPPED)]
    return {
        "title": title,
        "fields": list(fields.values()),
        "sections": sections,
        "sources_section_present": present,
        "sources_declared": declared,
        "sources": sources,
        "media": media,
        "links": list(dict.fromkeys(links)),
        "json_ld": json_ld,
    }


def parse_pages(df: DataFrame, key: str, body: str, content_type: str | None = None) -> DataFrame:
    """key and what each page says; body is a text or bytes."""
    columns = [key, body] + ([content_type] if content_type else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(1).to_pylist()
            types = batch.column(2).to_pylist() if content_type else [None] * len(bodies)
            rows = [parse("" if b is None else b if isinstance(b, str) else decode_bytes(b, t)) for b, t in zip(bodies, types, strict=True)]
            found = [pa.array([r[name] for r in rows], kind) for name, kind in ARROW]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], [key, *(name for name, _ in ARROW)])

    return df.select(*columns).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, {SCHEMA}")
