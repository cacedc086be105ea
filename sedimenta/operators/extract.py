"""Text out of fetched bodies: HTML, JSON, feeds, office documents, tables, RTF and plain text.

Each body gives candidates with a priority; the best is the one of highest priority, then length (up to a cap), then order.
Parsing trees needs Python: bodies go through mapInPandas in Arrow batches and only text comes back. There is no HTML library
here, so the standard parser reads HTML. The main text of a page that marks none is the run of blocks with the greatest sum of
weights: words, less what every block and every linked word costs (main_run).
"""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions import fixed
from sedimenta.functions.text import decode_bytes

DROPPED = set("script style noscript template svg canvas nav footer header form aside".split())
BLOCKS = set("h1 h2 h3 p blockquote li figcaption pre td".split())
BREAKS = BLOCKS | set("div section article main ul ol table tr br h4 h5 h6 dt dd".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
ZIP_MEMBER_BYTES = 50_000_000
MOST_ALTERNATES = 8
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: What a block and a linked word take from a run of blocks, in words.
BLOCK_COST, LINK_COST = 12, 3

RESULT = "title string, author string, publication_date string, description string, text string, method string, candidate_count int, alternates array<string>"


def tidy(text: str | None) -> str:
    lines = [" ".join(line.split()) for line in (text or "").replace("\u00a0", " ").splitlines()]
    out: list[str] = []
    for line in lines:
        if line or (out and out[-1]):
            out.append(line)
    return "\n".join(out).strip()


def unique_blocks(blocks: list[str]) -> str:
    """Joined by a blank line, without repeats."""
    seen: dict[str, str] = {}
    for block in map(tidy, blocks):
        if block:
            seen.setdefault(" ".join(block.split()).casefold(), block)
    return "\n\n".join(seen.values())


@dataclass
class Found:
    """What a body holds."""

    title: str = ""
    author: str = ""
    date: str = ""
    description: str = ""
    candidates: list[tuple[int, str, str]] = field(default_factory=list)
    alternates: list[str] = field(default_factory=list)

    def add(self, priority: int, method: str, text: str | None) -> None:
        text = tidy(text)
        if text:
            self.candidates.append((priority, method, text))

    def row(self) -> dict:
        best = max(self.candidates, key=lambda c: (c[0], min(len(c[2]), fixed.CANDIDATE_LENGTH_CAP)), default=(0, "none", ""))
        return {
            "title": tidy(self.title),
            "author": tidy(self.author),
            "publication_date": self.date,
            "description": tidy(self.description),
            "text": best[2],
            "method": best[1],
            "candidate_count": len(self.candidates),
            "alternates": self.alternates[:MOST_ALTERNATES],
        }


def json_candidates(value: object, bonus: int = 0, prefix: str = "json") -> list[tuple[int, str, str]]:
    """Texts under telling keys, to a bounded depth and number of nodes."""
    out: list[tuple[int, str, str]] = []
    todo, seen = [(value, 0)], 0
    while todo and seen < fixed.JSON_NODES:
        node, depth = todo.pop(0)
        seen += 1
        if depth > fixed.JSON_DEPTH:
            continue
        if isinstance(node, dict):
            for key, inner in node.items():
                priority = fixed.TEXT_KEYS.get(str(key).casefold())
                if priority and isinstance(inner, str) and len(inner.strip()) >= fixed.TEXT_KEY_LEAST:
                    out.append((priority + bonus, f"{prefix}:{str(key).casefold()}", plain(inner)))
                elif isinstance(inner, (dict, list)):
                    todo.append((inner, depth + 1))
        elif isinstance(node, list):
            todo.extend((item, depth + 1) for item in node)
    return out


def plain(fragment: str) -> str:
    """A fragment's text, tags away."""
    if "<" not in fragment:
        return fragment
    reader = _Page()
    reader.feed(fragment)
    reader.close()
    return reader.body_text()


class _Page(HTMLParser):
    """Collects metadata, JSON scripts, links, and text by part."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.meta: dict[str, str] = {}
        self.scripts: list[tuple[str, str]] = []
        self.alternates: list[str] = []
        self.links: list[tuple[str, str]] = []
        self.title: list[str] = []
        self.h1: list[str] = []
        self.open: list[str] = []
        self.semantic: list[list[str]] = []
        self.roots: list[tuple[int, list[str]]] = []
        self.body: list[str] = []
        self.blocks: list[str] = []
        self.time = ""
        self.script: tuple[str, list[str]] | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        own = {k: v or "" for k, v in attrs}
        if tag == "meta":
            name = (own.get("property") or own.get("name") or own.get("itemprop") or "").lower()
            if name and own.get("content"):
                self.meta.setdefault(name, own["content"])
        elif tag == "link" and own.get("href") and ("amphtml" in own.get("rel", "") or "alternate" in own.get("rel", "") or "canonical" in own.get("rel", "")):
            self.alternates.append(own["href"])
        elif tag == "a" and own.get("href"):
            self.links.append((own["href"], ""))
        elif tag == "time" and own.get("datetime") and not self.time:
            self.time = own["datetime"]
        elif tag == "script":
            self.script = (own.get("type", "").lower(), [])
        if tag in BREAKS:
            self._break()
        if tag not in VOID:
            self.open.append(tag)
            if tag in ("article", "main") or own.get("role") == "main" or own.get("itemprop", "").lower() == "articlebody":
                self.roots.append((len(self.open), []))

    def handle_endtag(self, tag: str) -> None:
        if tag == "script" and self.script is not None:
            self.scripts.append((self.script[0], "".join(self.script[1])))
            self.script = None
        if tag in BREAKS:
            self._break()
        if tag in self.open:
            while self.open:
                while self.roots and self.roots[-1][0] >= len(self.open):
                    self.semantic.append(self.roots.pop()[1])
                if self.open.pop() == tag:
                    break

    def _break(self) -> None:
        for _, part in self.roots:
            part.append("\n")
        self.body.append("\n")

    def handle_data(self, data: str) -> None:
        if self.script is not None:
            self.script[1].append(data)
            return
        if "title" in self.open and "svg" not in self.open:
            self.title.append(data)
            return
        if any(t in DROPPED for t in self.open) or "head" in self.open and "body" not in self.open:
            return
        if "h1" in self.open:
            self.h1.append(data)
        for _, part in self.roots:
            part.append(data)
        self.body.append(data)

    def close(self) -> None:
        super().close()
        while self.roots:
            self.semantic.append(self.roots.pop()[1])

    def body_text(self) -> str:
        return unique_blocks("".join(self.body).split("\n"))


@dataclass
class Block:
    """A block of a page: the innermost tag that breaks lines, its text, and how much of it is in links."""

    tag: str
    text: str
    link_chars: int
    link_words: int
    aside: bool  # in a part that holds no text of the page's own


class _Blocks(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.blocks: list[Block] = []
        self.run: list[tuple[str, bool]] = []

    def flush(self) -> None:
        text = " ".join("".join(t for t, _ in self.run).split())
        linked = " ".join("".join(t for t, own in self.run if own).split())
        if text:
            tag = next((t for t in reversed(self.open) if t in BREAKS or t in DROPPED), "")
            self.blocks.append(Block(tag, text, len(linked), len(linked.split()), any(t in DROPPED for t in self.open)))
        self.run.clear()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BREAKS or tag in DROPPED:
            self.flush()
        if tag not in VOID:
            self.open.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BREAKS or tag in DROPPED:
            self.flush()
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if not any(t in ("script", "style", "template", "noscript", "title") for t in self.open):
            self.run.append((data, "a" in self.open))


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page in order, without scripts and its title."""
    reader = _Blocks()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.blocks


def block_weight(block: Block) -> int:
    """Words, less BLOCK_COST for any block but a heading and LINK_COST for each linked word; what stands aside counts against."""
    words = len(block.text.split())
    if block.aside:
        return -words
    return words - LINK_COST * block.link_words - (0 if block.tag in HEADINGS else BLOCK_COST)


def main_run(blocks: list[Block]) -> tuple[int, int]:
    """First and last (exclusive) of the contiguous blocks with the greatest sum of weights, the longest of equal ones; 0, 0 if none is above 0."""
    best, found, total, least, since = 0, (0, 0), 0, 0, 0
    for k, block in enumerate(blocks, 1):
        total += block_weight(block)
        if total - least >= best and total > least:
            best, found = total - least, (since, k)
        if total < least:
            least, since = total, k
    return found


def from_html(text: str) -> Found:
    page, out = _Page(), Found()
    page.feed(text)
    page.close()
    meta = page.meta
    pick = lambda *names: next((meta[n] for n in names if n in meta), "")
    out.title = pick("og:title", "twitter:title") or "".join(page.title) or "".join(page.h1)
    out.author = pick("author", "article:author", "twitter:creator")
    out.date = pick("article:published_time", "datepublished", "date", "pubdate") or page.time
    out.description = pick("og:description", "description", "twitter:description")
    out.alternates = list(dict.fromkeys(page.alternates))
    out.add(fixed.META_PRIORITY, "meta_description", out.description)
    for kind, script in page.scripts:
        if "json" not in kind:
            continue
        try:
            value = json.loads(script)
        except ValueError:
            continue
        linked = "ld+json" in kind
        for priority, method, candidate in json_candidates(value, fixed.JSON_LD_BONUS if linked else 0, "jsonld" if linked else "embedded:json"):
            out.add(priority, method, candidate)
        if linked:
            _metadata(value, out)
    roots = [unique_blocks("".join(r).split("\n")) for r in page.semantic]
    out.add(fixed.SEMANTIC_PRIORITY, "semantic_dom", max(roots, key=len, default=""))
    blocks = blocks_of(text)
    first, last = main_run(blocks)
    out.add(fixed.MAIN_RUN_PRIORITY, "main_run", "\n\n".join(b.text for b in blocks[first:last]))
    out.add(fixed.BODY_PRIORITY, "body_text", page.body_text())
    return out


def main_texts(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """key, first and last (exclusive) block, n_blocks and text (a line for each block) of each page's main run; a null html has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for page in batch.column(1).to_pylist():
                blocks = blocks_of(page or "")
                first, last = main_run(blocks)
                cells.append((first, last, len(blocks), "\n".join(b.text for b in blocks[first:last])))
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([c[k] for c in cells], t) for k, t in enumerate(kinds))], [key, "first", "last", "n_blocks", "text"])

    return pages.select(key, html).mapInArrow(run, f"{key} {pages.schema[key].dataType.simpleString()}, first int, last int, n_blocks int, text string")


def _metadata(value: object, out: Found) -> None:
    for node in value if isinstance(value, list) else [value]:
        if isinstance(node, dict):
            author = node.get("author")
            author = author.get("name") if isinstance(author, dict) else author
            out.title = out.title or str(node.get("headline") or node.get("name") or "")
            out.author = out.author or (author if isinstance(author, str) else "")
            out.date = out.date or str(node.get("datePublished") or "")


def from_json(text: str) -> Found:
    out = Found()
    try:
        value = json.loads(text)
    except ValueError:
        out.add(fixed.BODY_PRIORITY, "plain_text", text)
        return out
    for priority, method, candidate in json_candidates(value):
        out.add(priority, method, candidate)
    if isinstance(value, dict):
        _metadata(value, out)
        out.title = out.title or str(value.get("title") or "")
    if not out.candidates:
        out.add(1, "json_text_fallback", "\n".join(f"{path}: {v}" for path, v in walk(value)))
    return out


def walk(value: object, path: str = "$") -> Iterator[tuple[str, object]]:
    """Path and value of every leaf, in order, without recursion."""
    todo = [(path, value)]
    while todo:
        at, node = todo.pop()
        if isinstance(node, dict):
            todo.extend((f"{at}.{k}", v) for k, v in reversed(node.items()))
        elif isinstance(node, list):
            todo.extend((f"{at}[{i}]", v) for i, v in reversed(list(enumerate(node))))
        elif node is not None:
            yield at, node


def from_xml(body: bytes) -> Found:
    """RSS and Atom items, else all text."""
    out = Found()
    if b"<!ENTITY" in body or b"<!DOCTYPE" in body.upper()[:2048]:
        out.add(fixed.BODY_PRIORITY, "xml_text", plain(body.decode("utf-8", "replace")))
        return out
    try:
        root = ElementTree.fromstring(body)
    except ElementTree.ParseError:
        out.add(fixed.BODY_PRIORITY, "xml_text", plain(body.decode("utf-8", "replace")))
        return out
    local = lambda e: e.tag.rpartition("}")[2].lower() if isinstance(e.tag, str) else ""
    texts = []
    for item in (e for e in root.iter() if local(e) in ("item", "entry")):
        parts = {local(c): "".join(c.itertext()) for c in item}
        out.title = out.title or parts.get("title", "")
        out.date = out.date or parts.get("pubdate", "") or parts.get("published", "") or parts.get("updated", "")
        texts.append(plain(parts.get("encoded") or parts.get("content") or parts.get("description") or parts.get("summary") or ""))
    if any(texts):
        out.add(90, "feed_items", unique_blocks(texts))
    out.add(fixed.BODY_PRIORITY, "xml_text", unique_blocks([t for t in root.itertext()]))
    return out


def from_office(body: bytes) -> Found:
    """Paragraphs of a word-processor document, or cells and shapes of the others."""
    out = Found()
    try:
        with zipfile.ZipFile(io.BytesIO(body)) as archive:
            names = [i for i in archive.infolist() if i.file_size <= ZIP_MEMBER_BYTES and re.search(r"(word/document|xl/sharedStrings|ppt/slides/slide\d+)\.xml$", i.filename)]
            for info in sorted(names, key=lambda i: i.filename):
                root = ElementTree.fromstring(archive.read(info))
                lines = []
                for part in root.iter():
                    if isinstance(part.tag, str) and part.tag.rpartition("}")[2] in ("p", "si"):
                        lines.append("".join(t.text or "" for t in part.iter() if isinstance(t.tag, str) and t.tag.rpartition("}")[2] == "t"))
                out.add(100, "office_open_xml", "\n".join(lines))
    except (zipfile.BadZipFile, ElementTree.ParseError, RuntimeError):
        pass
    return out


def from_table(text: str, delimiter: str) -> Found:
    out = Found()
    rows = csv.reader(io.StringIO(text), delimiter=delimiter)
    out.add(100, "delimited_rows", "\n".join(" | ".join(cell.strip() for cell in row) for row in rows))
    return out


def from_text(text: str) -> Found:
    out = Found()
    if text.startswith("{\\rtf"):
        text = re.sub(r"\\'([0-9a-fA-F]{2})", lambda m: bytes.fromhex(m[1]).decode("windows-1252", "replace"), text)
        text = re.sub(r"\\(par|line)\b ?", "\n", text)
        text = re.sub(r"\{\\\*[^{}]*\}|\\[a-zA-Z]+-?\d* ?|[{}]", "", text)
        out.add(100, "rtf_text", text)
    elif text.count("\ufffd") + sum(c < " " and c not in "\n\r\t\f" for c in text[:4096]) <= max(4, len(text[:4096]) // 50):
        out.add(100, "plain_text", text)
    return out


def extract(body: bytes | None, content_type: str | None, kind: str) -> dict:
    """One body of a known format; PDF and unknown formats give no text."""
    body = bytes(body or b"")
    if kind == "html":
        return from_html(decode_bytes(body, content_type)).row()
    if kind == "json":
        return from_json(decode_bytes(body, content_type)).row()
    if kind == "xml":
        return from_xml(body).row()
    if kind == "office_open_xml":
        return from_office(body).row()
    if kind in ("csv", "tsv"):
        return from_table(decode_bytes(body, content_type), "," if kind == "csv" else "\t").row()
    if kind == "text":
        return from_text(decode_bytes(body, content_type)).row()
    return Found().row()


def extract_bodies(df: DataFrame, key: str, body: str, content_type: Column, kind: Column) -> DataFrame:
    """key and what each body holds; the body itself goes no further."""
    rows = df.select(key, F.col(body).cast("binary").alias("body"), content_type.alias("content_type"), kind.alias("kind"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([extract(b, t, k) for b, t, k in zip(batch["body"], batch["content_type"], batch["kind"], strict=True)], columns=[c.split()[0] for c in RESULT.split(", ")])
            found.insert(0, key, batch[key].to_numpy())
            yield found

    return rows.mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, {RESULT}")


def json_leaves(df: DataFrame, key: str, column: str) -> DataFrame:
    """key, path and value of every leaf of a JSON text; unreadable texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, text in zip(batch[key], batch[column], strict=True):
                try:
                    value = json.loads(text) if isinstance(text, str) else None
                except ValueError:
                    continue
                rows += [(k, path, v if isinstance(v, str) else json.dumps(v)) for path, v in walk(value)]
            yield pd.DataFrame(rows, columns=[key, "path", "value"])

    return df.select(key, column).mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, path string, value string")


def json_values(df: DataFrame, key: str, column: str, names: list[str]) -> DataFrame:
    """key and the values under any of the names, at any depth, in order."""
    leaf = F.regexp_extract("path", r"([^.\[\]]+)(?:\[\d+\])*$", 1)
    return json_leaves(df, key, column).where(leaf.isin(*names)).groupBy(key).agg(F.collect_list("value").alias("values"))


def credential_like(df: DataFrame, key: str, column: str) -> DataFrame:
    """Leaves whose name says that they hold a credential."""
    leaf = F.lower(F.regexp_extract("path", r"([^.\[\]]+)(?:\[\d+\])*$", 1))
    return json_leaves(df, key, column).where(leaf.rlike(r"password|passwd|secret|token|api_?key|authorization|cookie|credential"))


@dataclass(frozen=True)
class FieldRule:
    """Where a field is on a page: a regular expression with one group, whether it must be there, and how it is read."""

    name: str
    pattern: str
    required: bool = False
    many: bool = False


def extract_records(df: DataFrame, key: str, html: str, rules: list[FieldRule]) -> DataFrame:
    """key, fields (name -> text), lists (name -> texts) and missing (names of required fields) by rules kept as data.

    Rules are regular expressions that Spark runs itself.
    """
    page = F.coalesce(F.col(html), F.lit(""))
    value = lambda r: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract(page, r.pattern, 1), r"<[^>]+>", " "), r"\s+", " "))
    singles, lists = [r for r in rules if not r.many], [r for r in rules if r.many]
    fields = F.create_map(*[c for r in singles for c in (F.lit(r.name), value(r))]) if singles else F.create_map().cast("map<string,string>")
    many = F.create_map(*[c for r in lists for c in (F.lit(r.name), F.regexp_extract_all(page, F.lit(r.pattern), F.lit(1)))]) if lists else F.create_map().cast("map<string,array<string>>")
    missing = F.array_compact(F.array(*[F.when(value(r) == "", r.name) for r in singles if r.required])) if any(r.required for r in singles) else F.array().cast("array<string>")
    return df.select(key, F.map_filter(fields, lambda _, v: v != "").alias("fields"), many.alias("lists"), missing.alias("missing"))
