"""Main text of web pages through wrappers inferred for each host: union-free regular expressions over token streams.

A page's stream of tags and texts is folded: neighbours of one kind become a repeated group, and so do alternating runs; an
element whose whole content is one element of its own kind is one part with it. The streams of a host are aligned one after
another with its wrapper so far. Where texts in one place differ, the mismatch becomes a slot; texts that never differ are the
template's. What one side lacks becomes optional, what stands once here and several times there becomes repeated, and aligned
parts are resolved in the same way within. Each part keeps how much text it holds over all pages, how much of it in links, and on
how many pages it stands.

Alignment depends on its order, so the order is fixed: a host's different pages stand in a tree that their digests and their
number decide, nodes are aligned in order, and then their wrappers, FAN_IN at a time. Neither partitions nor files nor a task that
is done again change a wrapper, and no host is in one task as a whole. A wrapper has MOST_PARTS parts at most: beyond, parts
of one page are known by their tag alone, and then the deepest levels are counted for what is above them.

A host's wrapper decides what is read. Three kinds of evidence say that a part is boilerplate: its text is the template's (on
LEAST_PAGES pages at least; an optional part's on half of the pages), most of its text is in links, or it is so by its tag, role or
name. Names alone count only outside of what holds the content, but for comments, adverts and cookie notices, which are named for
what they are. Within article, main or parts named as content, other names need one of the other two; the template's text
stays there, and where it is a heading or paragraph between others that differ. Content parts are article, main, or a part named as
content with half of the text; a page without any is read whole. Each page's text is then read from its own stream: blocks of the
content parts without what goes, whole and in page order.

Defined results: a null, empty or textless html has an empty text. A page that lacks its host's content parts is read by a
wrapper of its own, without what goes on its host. A host with a page or two, or with the same page each time, has no
template. A null or unreadable url belongs to the host ''. Rows that repeat give a row each; an empty table gives an empty
result; other columns are left alone. Texts of any length and elements of any depth are read; below MAX_DEPTH parts of different
kinds the wrapper counts their text for their ancestor, and each page decides on boilerplate there.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import bounded_batches, written

#: Depth down to which a wrapper has parts of its own.
MAX_DEPTH = 100
#: Choices of hosts that a task keeps at once.
TASK_HOSTS = 2000
#: Wrappers of a host that one group merges, on average.
FAN_IN = 32
#: Pages of a host on which a text must stand unchanged to be the template's.
LEAST_PAGES = 3
#: Share of a part's text in links from which on it is a list of links.
LINK_SHARE = 0.5
#: Parts of a wrapper; each is some 60 bytes.
MOST_PARTS = 4000

# Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
CLOSES_P = set("address article aside blockquote details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Start tags that end open siblings, and where the search for these stops.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
P_SCOPE = set("table td th caption button object template html body".split())

# What names boilerplate and content. Fixed values.
DROPPED = set("nav footer aside form script style noscript template iframe button select textarea svg canvas object head title dialog menu xmp noembed noframes audio video map".split())
DROPPED_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form toolbar".split())
DROPPED_NAMES = set(
    "nav navbar navigation menu menus breadcrumb breadcrumbs masthead banner footer sidebar aside rail notice notices cookie cookies consent gdpr alert popup modal overlay ad ads advert adverts "
    "advertisement advertisements advertising adsense sponsor sponsored promo promotion promotions comment comments commentlist disqus replies respond share sharing social related recommended recommendations newsletter subscribe subscription signup "
    "pagination pager widget widgets toolbar login topbar".split()
)
HEADER_NAMES = set("header topbar masthead".split())
CONTENT_NAMES = set("article articlebody content post entry story main maincontent".split())
ASIDE_NAMES = set("comment comments ad advert sponsored".split())
#: Names that lead what is never an article's own text.
LEADING_NAMES = set("comment comments commentlist disqus replies respond ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored cookie cookies consent gdpr".split())
KEPT_TAGS = set("html body main article".split())
#: Blocks of running text.
FLOW = set("p h1 h2 h3 h4 h5 h6 blockquote pre dl figure figcaption #".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: What classes and ids lose: numbers of their own, as in post-17, and marks that kinds and paths use.
_NUMBERED = re.compile(r"(?<=[-_])\d+|[^A-Za-z0-9_-]+")


def _names(labels: str) -> set[str]:
    return {n.lower() for n in _NAME.findall(labels)}


class Linked(str):
    """Text within a link."""


class Node:
    """An element: its kind (tag with class, id and role), and its children and texts in order."""

    __slots__ = ("tag", "kind", "names", "labels", "role", "children", "holds")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children, self.holds = tag, [], False
        found = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)} if "=" in attributes else {}
        self.role = "main" if found.get("role") == "main" or "articlebody" in found.get("itemprop", "").lower() else re.sub("[^a-z]", "", found.get("role", "").lower())
        label = " ".join(found.get(k, "") for k in ("class", "id"))
        self.kind, self.names, self.labels = tag, set(), []
        if label.strip():
            self.name_by("".join(f".{n}" for n in sorted({_NUMBERED.sub("", n) for n in label.split()}) if n))
        if self.role:
            self.kind += f"@{self.role}"

    def name_by(self, labels: str) -> None:
        self.kind += labels
        self.names = _names(labels)
        self.labels = [[w.lower() for w in _NAME.findall(x)] for x in labels.split(".") if x]

    @property
    def by_tag(self) -> bool:
        return self.tag in DROPPED or self.role in DROPPED_ROLES

    @property
    def by_leading_name(self) -> bool:
        """A class or id that begins with a name of comments, adverts or notices, and doesn't name content besides."""
        return self.tag not in KEPT_TAGS and any(x and x[0] in LEADING_NAMES and not CONTENT_NAMES.intersection(x) for x in self.labels)

    @property
    def by_name(self) -> bool:
        """A class or id with a name of boilerplate and none of content."""
        return self.tag not in KEPT_TAGS and any(DROPPED_NAMES.intersection(x) and not CONTENT_NAMES.intersection(x) for x in self.labels)

    @property
    def boilerplate(self) -> bool:
        """Of elements within a text."""
        return self.by_tag or self.by_leading_name

    @property
    def deep_boilerplate(self) -> bool:
        """Below MAX_DEPTH: names don't count for elements that hold an article or main."""
        return self.by_tag or self.is_aside or ((self.by_name or self.by_leading_name) and not self.holds)

    @property
    def is_aside(self) -> bool:
        """An article that is a comment or an advert."""
        return self.tag == "article" and bool(self.names & ASIDE_NAMES) and not self.names & CONTENT_NAMES

    @property
    def is_content(self) -> bool:
        return self.tag == "main" or self.role == "main" or (self.tag == "article" and not self.is_aside)

    @property
    def is_named(self) -> bool:
        return bool(self.names & CONTENT_NAMES and not self.names & DROPPED_NAMES)

    @property
    def header(self) -> bool:
        return self.tag == "header" or (self.tag not in KEPT_TAGS and bool(self.names & HEADER_NAMES))

    def inmost(self) -> Node:
        """This, or what is within if that is all there is and of the same kind: both are one part."""
        node = self
        while True:
            within = None
            for child in node.children:
                if isinstance(child, str):
                    if child.strip():
                        return node
                elif within is not None or child.kind != node.kind:
                    return node
                else:
                    within = child
            if within is None:
                return node
            node = within


def tree(html: str | None) -> Node:
    """The page's elements; inline ones are part of the text unless they are boilerplate."""
    html = html or ""
    root = Node("")
    stack, at, n, link = [root], 0, len(html), 0  # link: how many elements were open where the link began
    open_tags: Counter[str] = Counter()

    def close(tags: set[str], stop: set[str]) -> None:
        if not any(open_tags[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                open_tags.subtract(x.tag for x in stack[i:])
                del stack[i:]
                return
            if stack[i].tag in stop:
                return

    while at < n:
        m = _TAG.search(html, at)
        text = html[at : n if m is None else m.start()]
        if len(stack) < link:
            link = 0
        if text:
            stack[-1].children.append(Linked(text) if link else text)
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag == "a":
            link = 0 if m[1] else len(stack)
        if m[1]:
            if tag == "br":
                stack[-1].children.append(" ")
            elif tag not in VOID:
                close({tag}, {"table"} if tag in INLINE else set())
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(html, at)
            at = end.end() if end else n
            continue
        if tag in VOID:
            if tag == "hr":
                close({"p"}, P_SCOPE)
                stack[-1].children.append(Node("hr"))
            else:
                stack[-1].children.append(" " if tag == "br" else "")
            continue
        if tag in CLOSES_P:
            close({"p"}, P_SCOPE)
        if tag in ENDS:
            close(*ENDS[tag])
        node = Node(tag, m[3])
        if (tag in INLINE and not node.boilerplate) or m[3].endswith("/") and tag in INLINE:
            continue
        stack[-1].children.append(node)
        stack.append(node)
        open_tags[tag] += 1
        if node.is_content and len(stack) > MAX_DEPTH:
            for above in reversed(stack[1:] if not stack[-2].holds else stack[-1:]):
                if above.holds:
                    break
                above.holds = True
    return root


# A wrapper part is [kind, flags, text, children, same, pages, links]: how much text it holds itself, a digest of all its text (None
# once it differs between pages: a slot), on how many pages it stands, and how much of its text is in links. A text has the
# kind "#", a group of several kinds "()", an element of a kind that isn't told apart "tag.*". A host's root also has how many
# different pages it has; its pages are then all of them.
OPTIONAL, REPEATED = 1, 2
TEXT, GROUP, ANY = "#", "()", ".*"


def _digest(parts: Iterable[str]) -> str:
    return xxhash.xxh64_hexdigest("\x00".join(parts).encode("utf-8", "surrogatepass"))


def folded(node: Node, depth: int = 0) -> list:
    """The wrapper of one element of one page: texts between its tags, neighbours of a kind and alternating runs repeated."""
    node = node.inmost()
    if depth < MAX_DEPTH:
        parts, run = [], []
        for child in [*node.children, None]:
            if isinstance(child, str):
                run.append(child)
                continue
            text = " ".join("".join(run).split())
            if text:
                links = sum(len(x.strip()) for x in run if isinstance(x, Linked))
                parts.append([TEXT, 0, len(text), [], _digest([text]), 1, min(links, len(text))])
            run.clear()
            if child is not None:
                parts.append(folded(child, depth + 1))
        return [node.kind, 0, 0, fold(parts), _digest([node.kind, *(p[4] for p in parts)]), 1, 0]
    texts, inner = [], [node]
    while inner:
        below = inner.pop()
        if isinstance(below, str):
            texts.append(below)
        elif below is node or not below.deep_boilerplate:
            inner.extend(reversed(below.children))
    size = lambda kind: sum(len(x.strip()) for x in texts if isinstance(x, kind))
    return [node.kind, 0, size(str), [], _digest([node.kind, *(x.strip() for x in texts)]), 1, size(Linked)]


def bounded(part: list, most: int = MOST_PARTS) -> list:
    """A wrapper of so many parts at most."""

    def levels(p: list, depth: int, n: Counter) -> Counter:
        n[depth] += 1
        for c in p[3]:
            levels(c, depth + 1, n)
        return n

    def by_tag(p: list) -> list:
        """Parts of one page, but texts and groups, lose what tells them from others of their tag."""
        out: list = []
        for c in map(by_tag, p[3]):
            bare = re.match(r"[^.@]*", c[0])[0]
            if c[5] <= 1 < p[5] and c[0] not in (TEXT, GROUP) and bare != c[0]:
                c = [bare + ANY, *c[1:]]
            if out and out[-1][0] == c[0]:
                out[-1] = aligned(out[-1], c, OPTIONAL | REPEATED)
            else:
                out.append(c)
        return [*p[:3], out, *p[4:]]

    def cut(p: list, depth: int) -> list:
        if depth == 0 and p[3]:
            text, links, todo = p[2], p[6], list(p[3])
            while todo:
                c = todo.pop()
                text, links = text + c[2], links + c[6]
                todo += c[3]
            return [p[0], p[1], text, [], p[4], p[5], links]
        return [*p[:3], [cut(c, depth - 1) for c in p[3]], *p[4:]]

    if sum(levels(part, 0, Counter()).values()) <= most:
        return part
    part = by_tag(part)
    n, total, depth = levels(part, 0, Counter()), 0, 0
    while depth in n and total + n[depth] <= most:
        total += n[depth]
        depth += 1
    return cut(part, max(0, depth - 1)) if depth in n else part


def fold(parts: list) -> list:
    out: list = []
    for part in parts:
        if out and out[-1][0] == part[0]:
            out[-1] = repeated(out[-1], part, REPEATED)
        else:
            out.append(part)
    for width in (2, 3):
        i = 0
        while i + 2 * width <= len(out):
            kinds = [p[0] for p in out[i : i + width]]
            ahead = i + width
            if len(set(kinds)) > 1 and GROUP not in kinds and [p[0] for p in out[ahead : ahead + width]] == kinds:
                group = out[i : i + width]
                while [p[0] for p in out[ahead : ahead + width]] == kinds:
                    group = [repeated(a, b, 0) for a, b in zip(group, out[ahead : ahead + width], strict=True)]
                    ahead += width
                out[i:ahead] = [[GROUP, REPEATED, 0, group, _digest(p[4] for p in group), 1, 0]]
            i += 1
    return out


def repeated(a: list, b: list, flags: int) -> list:
    """One part for two of a kind on one page: the same on another page only if both are, in this order."""
    return [a[0], a[1] | b[1] | flags, a[2] + b[2], aligned_lists(a[3], b[3], repeated), _digest([a[4], b[4]]), 1, a[6] + b[6]]


def aligned(a: list, b: list, flags: int = 0) -> list:
    """One part for two of a kind of different pages."""
    return [a[0], a[1] | b[1] | flags, a[2] + b[2], aligned_lists(a[3], b[3], aligned), a[4] if a[4] == b[4] else None, a[5] + b[5], a[6] + b[6]]


def aligned_lists(a: list, b: list, join: Callable) -> list:
    """Parts of both sides in order; what is in one only becomes optional. At a mismatch, the side whose next match is nearer moves on."""
    if [p[0] for p in a] == [p[0] for p in b]:
        return [join(x, y, 0) for x, y in zip(a, b, strict=True)]
    places: list[dict[str, list[int]]] = [{}, {}]
    for own, parts in zip(places, (a, b), strict=True):
        for k, part in enumerate(parts):
            own.setdefault(part[0], []).append(k)

    def ahead(side: int, kind: str, at: int) -> int | None:
        found = places[side].get(kind, [])
        k = bisect_left(found, at)
        return found[k] - at if k < len(found) else None

    out, i, j = [], 0, 0
    lone = lambda p: [p[0], p[1] | OPTIONAL, *p[2:]]
    while i < len(a) and j < len(b):
        if a[i][0] == b[j][0]:
            out.append(join(a[i], b[j], 0))
            i, j = i + 1, j + 1
            continue
        in_a, in_b = ahead(0, b[j][0], i), ahead(1, a[i][0], j)
        if in_a is None and in_b is None:
            out += [lone(a[i]), lone(b[j])]
            i, j = i + 1, j + 1
        elif in_a is None or (in_b is not None and in_b <= in_a):
            out += map(lone, b[j : j + in_b])
            j += in_b
        else:
            out += map(lone, a[i : i + in_a])
            i += in_a
    out += map(lone, [*a[i:], *b[j:]])
    # Neighbours that alignment brought together are one repeated part.
    met: list = []
    for part in out:
        if met and met[-1][0] == part[0]:
            more = join(met[-1], part, REPEATED)
            met[-1] = [*more[:5], max(met[-1][5], part[5]), more[6]]
        else:
            met.append(part)
    return met


def expression(part: list) -> str:
    """The wrapper as a regular expression, for reading: # is a slot, = a text of the template."""
    inner = "".join(expression(c) for c in part[3])
    own = f"({inner})" if part[0] == GROUP else ("#" if part[4] is None else "=") if part[0] == TEXT else f"<{part[0]}>{inner}</>"
    mark = {0: "", OPTIONAL: "?", REPEATED: "+", OPTIONAL | REPEATED: "*"}[part[1]]
    return f"({own}){mark}" if mark else own


def _parse_kind(kind: str) -> Node:
    node = Node("")
    head, _, node.role = kind.partition("@")
    node.tag, _, labels = head.partition(".")
    node.name_by(f".{labels}" if labels else "")
    node.kind = kind
    return node


def choices(wrapper: list, gone: Iterable[str] = ()) -> tuple[list[str], list[str], dict[str, list[str]]]:
    """Paths of the content parts, of what goes (gone goes in any case), and of parts whose rare children are known by tag, with the other kinds there."""
    text: dict[str, int] = {}
    links: dict[str, int] = {}
    nodes: dict[str, Node] = {"": _parse_kind("")}
    parent: dict[str, str] = {}
    kinds: dict[str, set[str]] = {}
    varies: set[str] = set()  # paths with a part that isn't the template's
    todo, pages = [("", wrapper)], wrapper[7] if len(wrapper) > 7 else wrapper[5]
    while todo:
        path, part = todo.pop()
        text[path], links[path] = text.get(path, 0) + part[2], links.get(path, 0) + part[6]
        needed = max(LEAST_PAGES, pages / 2 if part[1] & OPTIONAL else 0)
        if part[0] != GROUP and (part[4] is None or part[5] < needed):
            varies.add(path)
        for child in part[3]:
            if child[0] == GROUP:
                todo.append((path, child))
                continue
            below = f"{path}>{child[0]}"
            nodes.setdefault(below, _parse_kind(child[0]))
            parent[below] = path
            kinds.setdefault(path, set()).add(child[0])
            todo.append((below, child))
    order = sorted(nodes, key=lambda p: p.count(">"))
    holds: dict[str, bool] = {}  # whether an article or main lies within
    named: dict[str, bool] = {}  # or a part that is named as content
    of_text, of_links = dict(text), dict(links)  # with what lies within
    flows: set[str] = set()  # parts that directly hold blocks of text that differ
    for path in reversed(order):
        node = nodes[path]
        holds[path] = holds.get(path, False) or node.is_content
        named[path] = named.get(path, False) or node.is_named
        if path:
            above = parent[path]
            holds[above] = holds.get(above, False) or holds[path]
            named[above] = named.get(above, False) or named[path]
            of_text[above] += of_text[path]
            of_links[above] += of_links[path]
            if path in varies and node.tag in FLOW:
                flows.add(above)
    dropped: set[str] = set()
    flowing: set[str] = set()  # blocks of the template among others that differ, and what lies within
    within: dict[str, bool] = {}  # in an article or main
    in_named: dict[str, bool] = {}  # or in a part that is named as content
    known, has_template = set(gone), "" in varies
    for path in order:
        node = nodes[path]
        above = parent.get(path)
        inside = within.get(above, False)
        among = inside or in_named.get(above, False)
        within[path] = inside or node.is_content
        in_named[path] = in_named.get(above, False) or node.is_named
        template = path in known or (has_template and path not in varies)
        linked = of_text[path] > 0 and of_links[path] >= LINK_SHARE * of_text[path]
        # A layout's name, such as with-sidebar, doesn't count for what holds the content; comments may hold parts of any name.
        exempt = holds[path] or (named[path] and not node.names & ASIDE_NAMES)
        by_name = not exempt and (node.by_leading_name or (node.by_name and (not among or template or linked)))
        if above in flowing or (node.tag in FLOW and above in flows and not linked):
            flowing.add(path)
        by_template = template and not within[path] and not in_named[path] and not holds[path] and path not in flowing
        if above in dropped or node.by_tag or by_name or node.is_aside or (node.header and not inside and not exempt) or by_template:
            dropped.add(path)
    whole = {p: 0 if p in dropped else text[p] for p in order}
    for path in reversed(order):
        if path and path not in dropped:
            whole[parent[path]] += whole[path]
    live = [p for p in order if p and p not in dropped and whole[p] > 0]

    def outermost(paths: list[str]) -> list[str]:
        held = set(paths)

        def is_within(p: str) -> bool:
            while p in parent:
                p = parent[p]
                if p in held:
                    return True
            return False

        return [p for p in paths if not is_within(p)]

    articles = outermost([p for p in live if nodes[p].tag == "article"])
    mains = outermost([p for p in live if nodes[p].tag == "main" or nodes[p].role == "main"])
    if mains:
        # A headline and lead in main before its articles stay; articles beside it count if they hold as much as half of it.
        content = outermost([*mains, *articles]) if 2 * sum(whole[p] for p in articles) >= sum(whole[p] for p in mains) else mains
    elif articles:
        content = articles
    else:
        parts = outermost([p for p in live if nodes[p].tag in ("div", "section", "td") and nodes[p].names & CONTENT_NAMES])
        content = parts if parts and 2 * sum(whole[p] for p in parts) >= whole[""] else [""]
        if content == [""]:  # nothing is named: lists of links go as well
            for path in order:
                if path and (parent[path] in dropped or (nodes[path].tag not in FLOW and nodes[path].tag not in KEPT_TAGS and of_links[path] >= LINK_SHARE * of_text[path] > 0)):
                    dropped.add(path)
    wide = {p: sorted(k for k in kinds[p] if not k.endswith(ANY)) for p in kinds if any(k.endswith(ANY) for k in kinds[p])}
    return sorted(content), sorted(p for p in dropped if parent[p] not in dropped), wide


def text_of(root: Node, content: set[str], dropped: set[str], wide: dict[str, list[str]] | None = None) -> tuple[str, bool]:
    """The blocks of the content parts, and whether the page has any such part."""
    blocks: list[str] = []
    run: list[str] = []
    found = False

    def flush() -> None:
        text = " ".join(unescape("".join(run)).split())
        run.clear()
        if text:
            blocks.append(text)

    todo: list[tuple] = [(root.inmost(), "", "" in content, 0)]
    found, told = "" in content, {p: set(k) for p, k in (wide or {}).items()}
    while todo:
        item, path, inside, depth = todo.pop()
        if item is None:
            flush()
            continue
        if isinstance(item, str):
            run.append(item)
            continue
        own = item.tag not in INLINE
        later: list[tuple] = [(None, "", False, 0)] if own else []
        for child in item.children:
            if isinstance(child, str):
                if inside and (depth > MAX_DEPTH or f"{path}>{TEXT}" not in dropped):
                    later.append((child, path, True, 0))
                continue
            child = child.inmost()
            deep = depth >= MAX_DEPTH
            kind = child.tag + ANY if path in told and child.kind not in told[path] and child.kind != child.tag else child.kind
            below = path if deep else f"{path}>{kind}"
            if (child.deep_boilerplate if deep else below in dropped) or child.boilerplate and (child.tag in INLINE or kind.endswith(ANY)):
                later.append((None, "", False, 0) if child.tag not in INLINE else (" ", below, True, 0))
                continue
            starts = not deep and below in content
            found = found or starts
            later.append((child, below, inside or starts, depth + 1))
        if own:
            later.append((None, "", False, 0))
        todo.extend(reversed(later))
    flush()
    return "\n".join(blocks), found


def main_text(html: str | None, chosen: tuple[list[str], list[str]] | None = None) -> str:
    """The main text of one page, by its host's choices or, if it has no such parts, its own."""
    root = tree(html)
    if chosen is not None:
        text, found = text_of(root, set(chosen[0]), set(chosen[1]), *chosen[2:])
        if found:
            return text
    content, dropped, wide = choices(folded(root), chosen[1] if chosen else ())
    return text_of(root, set(content), set(dropped), wide)[0]


def host_of(url: str = "url") -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def wrappers(pages: DataFrame) -> DataFrame:
    """host and wrapper (JSON) of every host, over all its pages."""
    bounded_batches(pages.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [json.dumps(folded(tree(html)), separators=(",", ":")) for html in batch.column(1).to_pylist()]
            digests = [xxhash.xxh64_intdigest(w) >> 1 for w in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.int64()), pa.array(found, pa.string())], ["host", "at", "wrapper"])

    def merged(table: pa.Table) -> pa.Table:
        """A node: its wrappers in order. The root says how many pages there are, and how many different ones: copies prove no template."""
        found, rows, different = None, 0, 0
        for _, text, n in sorted(zip(table["at"].to_pylist(), table["wrapper"].to_pylist(), table["n"].to_pylist(), strict=True)):
            own = json.loads(text)
            rows, different = rows + n, different + (own.pop() if len(own) > 7 else 1)
            found = own if found is None else bounded(aligned(found, own))
        found = [*found[:5], rows, found[6], different]
        return pa.table({"host": table["host"][:1], "at": pa.array([table["node"][0].as_py()], pa.int64()), "n": pa.array([rows], pa.int64()), "wrapper": pa.array([json.dumps(found, separators=(",", ":"))], pa.string())})

    pages = pages.select(host_of().alias("host"), "html").mapInArrow(each, "host string, at bigint, wrapper string")
    # Pages that fold to the same stream are one row, so a host of copies is no hot node.
    level = written(pages.groupBy("host", "at").agg(F.min("wrapper").alias("wrapper"), F.count(F.lit(1)).alias("n")), "wrapper-pages")
    sizes = written(level.groupBy("host").agg(F.count(F.lit(1)).alias("wide")), "wrapper-sizes")
    most = sizes.agg(F.max("wide")).first()[0] or 0
    node = F.pmod("at", F.ceil(F.col("wide") / FAN_IN))  # digests first, then the numbers of nodes
    while True:
        dealt = level.join(sizes, "host").withColumn("node", node)
        level = written(dealt.select("host", "node", "at", "wrapper", "n").groupBy("host", "node").applyInArrow(merged, "host string, at bigint, n bigint, wrapper string"), "wrapper-level")
        most = -(-most // FAN_IN)
        if most <= 1:
            return level.select("host", "wrapper")
        node = F.floor(F.col("at") / FAN_IN)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [choices(json.loads(w)) for w in batch.column(1).to_pylist()]  # JSON of three parts
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([json.dumps(c) for c in found], pa.string())], ["host", "chosen"])

    chosen = written(wrappers(pages).mapInArrow(choose, "host string, chosen string"), "wrappers")
    # The table of choices is sent to all tasks only if Spark finds it small enough; else AQE splits hot hosts in the join.
    rows = pages.select("page_id", "url", "html", host_of().alias("host")).join(chosen, "host", "left").select("page_id", "url", "html", "chosen")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, tuple | None] = {None: None}
        for batch in batches:
            texts = []
            for html, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if own not in known:
                    if len(known) > TASK_HOSTS:
                        known = {None: None}
                    known[own] = tuple(json.loads(own))
                texts.append(main_text(html, known[own]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(read, f"page_id {kind}, url string, text string, n_chars bigint")
