"""Pages: tree, text with sup/sub marks, tables with spans, links with context.

A recursive tree is no table, so a page is parsed inside one vectorised function per distinct content and comes out as a
struct; everything after it (exploding, filtering, joining) is relational.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
CHROME = frozenset("script style nav footer form noscript template iframe".split())
CLOSED_BY = {"li": {"li"}, "p": BLOCKS, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
HEADINGS = ("h1", "h2", "h3", "h4")
# Words in the class or id of an element, and roles, that mark it as a frame of the site, not content.
_FRAME_WORDS = re.compile(r"cookie|consent|gdpr|mega-?menu|main-navigation|subnav|site-(?:header|footer|nav)", re.IGNORECASE)
_FRAME_ROLES = frozenset(("banner", "navigation", "contentinfo", "dialog"))
# Words in the class of an element whose children may be the rows of a table.
_GRID_WORDS = re.compile(r"spec|grid|table|param|attribut|card", re.IGNORECASE)

CELL = "struct<text:string,header:boolean,colspan:int,rowspan:int>"
PAGE = (
    "struct<title:string,heading:string,canonical:string,text:string,breadcrumbs:array<string>,"
    "links:array<struct<url:string,label:string,section:string,context:string>>,"
    f"tables:array<struct<index:int,section:string,notes:string,is_specification:boolean,rows:array<array<{CELL}>>>>,"
    "forms:array<struct<action:string,method:string,fields:map<string,string>>>>"
)


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "frame")

    def __init__(self, tag: str, attrs: dict, parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        names = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        self.frame = attrs.get("role", "") in _FRAME_ROLES or bool(_FRAME_WORDS.search(names))

    def elements(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]

    def walk(self):
        """All elements below, in order, without recursion: pages may be deeply nested."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def text(self, skip: frozenset[str] = CHROME) -> str:
        out: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                out.append(item)
            elif item is self or (item.tag not in skip and not item.frame):
                opening, closing = {"sup": ("^{", "}"), "sub": ("_{", "}")}.get(item.tag, (" ", " ") if item.tag in BLOCKS else ("", ""))
                stack.append(closing)
                stack.extend(reversed(item.children))
                stack.append(opening)
        text = " ".join("".join(out).split())
        # A trade mark in superscript is a mark, not a note.
        return re.sub(r"\^\{\s*([™®©])\s*\}", r"\1", text)


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = self.at
        # An element that may not nest closes its open sibling, within the nearest table or list.
        while node.parent and node.tag in CLOSED_BY and tag in CLOSED_BY[node.tag]:
            node = node.parent
        self.at = node
        child = Node(tag, {k: v if v is not None else "" for k, v in attrs}, node)
        node.children.append(child)
        if tag not in VOID:
            self.at = child

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node.parent and node.tag != tag:
            node = node.parent
        if node.parent:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        if self.at.tag not in ("script", "style"):
            self.at.children.append(data)


def parse_tree(markup: str) -> Node:
    """The tree of a page; unclosed and stray tags are recovered, never raised."""
    tree = _Tree()
    tree.feed(markup)
    tree.close()
    return tree.root


def span(value: str | None) -> int:
    """A span attribute: 1 where missing, empty or no number, else within 1..100."""
    return max(1, min(100, int(value))) if value and value.strip().isdigit() else 1


def table_rows(table: Node) -> list[list[dict]]:
    """Rows of cells as written, spans kept; rows of nested tables and rows without text are left out."""
    rows = []
    for node in table.walk():
        if node.tag != "tr" or _nearest(node, "table") is not table:
            continue
        cells = [
            {"text": c.text(CHROME | {"table"}), "header": c.tag == "th", "colspan": span(c.attrs.get("colspan")), "rowspan": span(c.attrs.get("rowspan"))}
            for c in node.children if isinstance(c, Node) and c.tag in ("td", "th")
        ]
        if any(c["text"] for c in cells):
            rows.append(cells)
    return rows


def grid_rows(node: Node) -> list[list[dict]]:
    """Rows of a table that is no ``table``: definition lists, elements with the roles of a table, and grids or cards of equally long rows; else none."""
    cell = lambda c, header=False: {"text": c.text(), "header": header, "colspan": span(c.attrs.get("aria-colspan")), "rowspan": span(c.attrs.get("aria-rowspan"))}
    if node.tag == "dl":
        rows: list[list[dict]] = []
        for c in node.walk():
            if c.tag == "dt" and _nearest(c, "dl") is node:
                rows.append([cell(c, True)])
            elif c.tag == "dd" and rows and _nearest(c, "dl") is node:
                rows[-1].append(cell(c))
        return [r for r in rows if len(r) > 1 and any(c["text"] for c in r)]
    if node.attrs.get("role") in ("table", "grid"):
        lines = [r for r in node.walk() if r.attrs.get("role") == "row"]
        rows = [[cell(c, c.attrs.get("role") in ("columnheader", "rowheader")) for c in r.elements() if c.attrs.get("role", "") in ("cell", "gridcell", "columnheader", "rowheader")] for r in lines]
        return [r for r in rows if any(c["text"] for c in r)]
    if node.tag not in ("div", "section", "ul") or not _GRID_WORDS.search(node.attrs.get("class", "")):
        return []
    lines = [c for c in node.elements() if c.tag not in HEADINGS]
    width = {len(r.elements()) for r in lines}
    bare = all(not any(isinstance(x, str) and x.strip() for x in r.children) and not any(x.tag in ("table", "div", "ul", "a", "p") for c in r.elements() for x in c.elements()) for r in lines)
    if len(lines) < 2 or len(width) != 1 or width == {0} or width == {1} or not bare:
        return []
    return [[cell(c) for c in r.elements()] for r in lines if any(c.text() for c in r.elements())]


def _nearest(node: Node, tag: str) -> Node | None:
    node = node.parent
    while node and node.tag != tag:
        node = node.parent
    return node


def _inside(node: Node, tags: frozenset[str], frames: bool = False) -> bool:
    """Whether a node is, or is in, one of the elements; with ``frames`` also in what frames the site."""
    while node:
        if node.tag in tags or (frames and node.frame):
            return True
        node = node.parent
    return False


_SPEC_WORDS = re.compile(r"specif|technical data|parameter|dimension|规格|参数|technische daten", re.IGNORECASE)
_SPEC_LABELS = frozenset("model,weight,dimensions,height,width,depth,voltage,current,power,capacity,efficiency,frequency,temperature,memory,interface".split(","))


def _tables(root: Node) -> list[dict]:
    out: list[dict] = []
    trail: dict[int, str] = {}
    last: dict | None = None
    for node in root.walk():
        if _inside(node, CHROME, frames=True):
            continue
        if node.tag in HEADINGS:
            level = int(node.tag[1])
            trail = {k: v for k, v in trail.items() if k < level} | {level: node.text()}
            last = None
        elif node.tag == "p" and last is not None and not _inside(node, frozenset({"table"})):
            last["notes"] = " ".join(filter(None, (last["notes"], node.text())))
        elif node.tag == "table" or node.tag in ("dl", "div", "section", "ul"):
            rows = table_rows(node) if node.tag == "table" else grid_rows(node)
            if not rows:
                continue
            if node.tag != "table":
                # A card's own heading comes after the card in the walk.
                title = next((c.text() for c in node.elements() if c.tag in HEADINGS), "")
                section = title or " / ".join(trail[k] for k in sorted(trail)[-2:])
                labels = {w for r in rows for w in re.findall(r"[a-z]+", r[0]["text"].lower())}
                out.append({"index": len(out) + 1, "section": section, "notes": "", "is_specification": bool(_SPEC_WORDS.search(section)) or len(labels & _SPEC_LABELS) >= 2, "rows": rows})
                continue
            caption = next((c.text() for c in node.walk() if c.tag == "caption" and _nearest(c, "table") is node), "")
            own = ""
            head = rows[0]
            if len(head) == 1 and len(rows) > 1 and len(head[0]["text"]) < 120 and (head[0]["colspan"] > 1 or head[0]["header"]):
                own, rows = head[0]["text"], rows[1:]
            section = caption or own or " / ".join(trail[k] for k in sorted(trail)[-2:])
            labels = {w for r in rows for w in re.findall(r"[a-z]+", r[0]["text"].lower())}
            named = bool(_SPEC_WORDS.search(section))
            last = {"index": len(out) + 1, "section": section, "notes": "", "is_specification": named or len(labels & _SPEC_LABELS) >= 2, "rows": rows}
            out.append(last)
    return out


def parse_page(markup: str | None, url: str | None = None) -> dict | None:
    """A page as a dict of the fields of ``PAGE``; null for null."""
    if markup is None:
        return None
    root = parse_tree(markup)
    title = next((n.text() for n in root.walk() if n.tag == "title"), "")
    heading = next((n.text() for n in root.walk() if n.tag == "h1"), "")
    canonical, crumbs, links, section, forms = "", [], [], "", []
    for node in root.walk():
        if node.tag == "link" and "canonical" in node.attrs.get("rel", "").lower():
            canonical = urljoin(url or "", node.attrs.get("href", ""))
        elif node.tag in HEADINGS:
            section = node.text()
        elif node.tag in ("nav", "ol", "ul", "div") and "breadcrumb" in (node.attrs.get("class", "") + node.attrs.get("aria-label", "")).lower() and not crumbs:
            crumbs = [t for t in (c.text() for c in node.walk() if c.tag in ("a", "li", "span") and not any(isinstance(x, Node) and x.tag in ("a", "li", "span") for x in c.children)) if t]
        if node.tag == "form":
            # Only hidden fields are what the page itself would send.
            fields = {c.attrs["name"]: c.attrs.get("value", "") for c in node.walk() if c.tag == "input" and c.attrs.get("name") and c.attrs.get("type", "").lower() == "hidden"}
            forms.append({"action": urljoin(url or "", node.attrs.get("action", "")), "method": (node.attrs.get("method") or "get").lower(), "fields": fields})
        href = node.attrs.get("href") if node.tag == "a" else node.attrs.get("data-href") or node.attrs.get("data-url") or (node.attrs.get("src") if node.tag == "iframe" else None)
        if href and not href.lower().startswith(("javascript:", "mailto:", "tel:", "#")):
            context = "site_navigation" if _inside(node, frozenset({"nav", "header", "footer"}), frames=True) else "page_body"
            links.append({"url": urldefrag(urljoin(url or "", href.strip()))[0], "label": node.text(), "section": section, "context": context})
    return {"title": title, "heading": heading, "canonical": canonical, "text": root.text(CHROME | {"head"}), "breadcrumbs": crumbs, "links": links, "tables": _tables(root), "forms": forms}


def pages(df: DataFrame, key: str, markup: str, url: str) -> DataFrame:
    """``<key>, page``: each distinct key parsed once; null markup gives a null page."""
    schema = f"`{key}` {dict(df.dtypes)[key]}, page {PAGE}"

    def parse(batches):
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "page": [parse_page(m, u) for m, u in zip(batch[markup], batch[url])]})

    return df.select(key, markup, url).dropDuplicates([key]).mapInPandas(parse, schema)


def flat_links(markup: Column) -> Column:
    """``href`` values of anchors by pattern, for pages where no tree is needed; stays in the JVM."""
    return F.regexp_extract_all(markup, F.lit(r'(?i)<a\b[^>]*?\bhref\s*=\s*["\']([^"\'#]+)'), F.lit(1))
