"""Other carriers of tables and records: office files, layout text, JSON and literal records, byte formats."""

from __future__ import annotations

import csv
import gzip
import html
import io
import json
import re
import zipfile
from xml.etree import ElementTree

#: Limits of what is unpacked from one file.
PART_BYTES, ARCHIVE_BYTES, PAGE_BYTES = 16 << 20, 128 << 20, 16 << 20

# Names of the office formats' published XML vocabularies.
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def document_kind(body: bytes | None, url: str = "", content_type: str = "") -> str | None:
    """Format by the bytes, not by what a server says: pdf, docx, xlsx, pptx, odt, ods, odp, zip, ole, rtf, gzip, csv, html, xml, json; null if unknown."""
    if not body:
        return None
    head = body[:1024].lstrip()
    if body[:1024].find(b"%PDF-") >= 0:
        return "pdf" if b"%%EOF" in body[-2048:] else None
    if body[:2] == b"\x1f\x8b":
        return "gzip"
    if body[:4] == b"PK\x03\x04":
        try:
            with zipfile.ZipFile(io.BytesIO(body)) as z:
                names = set(z.namelist())
                for part, kind in (("word/document.xml", "docx"), ("xl/workbook.xml", "xlsx"), ("ppt/presentation.xml", "pptx")):
                    if part in names:
                        return kind
                if "mimetype" in names:
                    return {b"text": "odt", b"spreadsheet": "ods", b"presentation": "odp"}.get(z.read("mimetype").rpartition(b".")[2].strip())
        except (zipfile.BadZipFile, KeyError):
            return None
        return "zip"
    if body[:8] == b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1":
        return "ole"
    if head.startswith(b"{\\rtf"):
        return "rtf"
    low = head[:256].lower()
    if low.startswith((b"<!doctype html", b"<html")) or b"<html" in low:
        return "html"
    if low.startswith(b"<?xml"):
        return "xml"
    if head[:1] in (b"{", b"["):
        try:
            json.loads(body)
            return "json"
        except ValueError:
            return None
    return "csv" if url.lower().split("?")[0].endswith(".csv") else None


def unpack(body: bytes, limit: int = PAGE_BYTES) -> bytes | None:
    """Gzip content, if it stays within the limit; other bytes as they are."""
    if body[:2] != b"\x1f\x8b":
        return body if len(body) <= limit else None
    try:
        with gzip.GzipFile(fileobj=io.BytesIO(body)) as f:
            out = f.read(limit + 1)
    except (OSError, EOFError):
        return None
    return out if len(out) <= limit else None


class _Parts:
    """XML parts of an office file, within the limits."""

    def __init__(self, body: bytes) -> None:
        self.zip = zipfile.ZipFile(io.BytesIO(body))
        if sum(i.file_size for i in self.zip.infolist()) > ARCHIVE_BYTES:
            raise ValueError("archive expands beyond its limit")

    def xml(self, name: str) -> ElementTree.Element | None:
        try:
            info = self.zip.getinfo(name)
        except KeyError:
            return None
        if info.file_size > PART_BYTES:
            raise ValueError(f"{name} expands beyond its limit")
        data = self.zip.read(info)
        if b"<!DOCTYPE" in data or b"<!ENTITY" in data:
            raise ValueError(f"{name} declares entities")
        return ElementTree.fromstring(data)

    def targets(self, part: str) -> dict[str, str]:
        """Relationship id -> part, for one part."""
        folder, _, name = part.rpartition("/")
        root = self.xml(f"{folder}/_rels/{name}.rels")
        out = {}
        for rel in root.iter(f"{_REL}Relationship") if root is not None else ():
            target = rel.get("Target", "")
            path = target.lstrip("/") if target.startswith("/") else f"{folder}/{target}"
            steps: list[str] = []
            for step in path.split("/"):
                if step == "..":
                    steps[-1:] = []
                elif step not in ("", "."):
                    steps.append(step)
            out[rel.get("Id", "")] = "/".join(steps)
        return out


def _texts(node: ElementTree.Element, tag: str) -> str:
    return " ".join("".join(t.text or "" for t in p.iter(tag)).strip() for p in [node]).strip()


def _docx(parts: _Parts) -> list[dict]:
    root, out = parts.xml("word/document.xml"), []
    for table in root.iter(f"{_W}tbl") if root is not None else ():
        rows = []
        for tr in table.findall(f"{_W}tr"):
            cells = []
            for tc in tr.findall(f"{_W}tc"):
                props = tc.find(f"{_W}tcPr")
                grid = props.find(f"{_W}gridSpan") if props is not None else None
                merge = props.find(f"{_W}vMerge") if props is not None else None
                text = " ".join(filter(None, (_texts(p, f"{_W}t") for p in tc.findall(f"{_W}p"))))
                cells.append({"text": text, "header": False, "colspan": int(grid.get(f"{_W}val", 1)) if grid is not None else 1, "rowspan": 1,
                              "vertical_merge": None if merge is None else merge.get(f"{_W}val", "continue")})
            rows.append(cells)
        if rows:
            out.append({"index": len(out) + 1, "section": "", "rows": rows})
    return out


def _column(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]*", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n


def _shared(strings: list[str], number: str) -> str:
    if not number.isdigit() or int(number) >= len(strings):
        raise ValueError(f"a cell names the shared string {number} of {len(strings)}")
    return strings[int(number)]


def _xlsx(parts: _Parts) -> list[dict]:
    shared_root = parts.xml("xl/sharedStrings.xml")
    shared = ["".join(t.text or "" for t in si.iter(f"{_S}t")) for si in shared_root.iter(f"{_S}si")] if shared_root is not None else []
    book, files, out = parts.xml("xl/workbook.xml"), parts.targets("xl/workbook.xml"), []
    for sheet in book.iter(f"{_S}sheet") if book is not None else ():
        root = parts.xml(files.get(sheet.get(f"{_R}id", ""), ""))
        if root is None:
            continue
        spans = {}
        for merged in root.iter(f"{_S}mergeCell"):
            a, _, b = merged.get("ref", "").partition(":")
            if b:
                rows_of = lambda r: int(re.sub(r"\D", "", r))
                spans[a] = (_column(b) - _column(a) + 1, rows_of(b) - rows_of(a) + 1)
        rows = []
        for row in root.iter(f"{_S}row"):
            cells = []
            for c in row.findall(f"{_S}c"):
                value, formula = c.find(f"{_S}v"), c.find(f"{_S}f")
                raw = value.text or "" if value is not None else ""
                text = _shared(shared, raw) if c.get("t") == "s" and raw else "".join(t.text or "" for t in c.iter(f"{_S}t")) if c.get("t") == "inlineStr" else raw
                colspan, rowspan = spans.get(c.get("r", ""), (1, 1))
                cells.append({"text": text, "header": False, "colspan": colspan, "rowspan": rowspan, "coordinate": c.get("r"), "formula": None if formula is None else formula.text, "style_index": int(c.get("s", 0))})
            if cells:
                rows.append(cells)
        if rows:
            out.append({"index": len(out) + 1, "section": sheet.get("name", ""), "rows": rows})
    return out


def _pptx(parts: _Parts) -> list[dict]:
    show, files, out = parts.xml("ppt/presentation.xml"), parts.targets("ppt/presentation.xml"), []
    for place, slide in enumerate(show.iter(f"{_P}sldId") if show is not None else (), 1):
        root = parts.xml(files.get(slide.get(f"{_R}id", ""), ""))
        for table in root.iter(f"{_A}tbl") if root is not None else ():
            rows = [
                [{"text": " ".join(filter(None, (_texts(p, f"{_A}t") for p in tc.iter(f"{_A}p")))), "header": False, "colspan": int(tc.get("gridSpan", 1)), "rowspan": int(tc.get("rowSpan", 1)),
                  "hMerge": int(tc.get("hMerge", 0)), "vMerge": int(tc.get("vMerge", 0))} for tc in tr.findall(f"{_A}tc")]
                for tr in table.findall(f"{_A}tr")
            ]
            out.append({"index": len(out) + 1, "section": f"slide {place}", "rows": rows})
    return out


def office_tables(body: bytes, kind: str) -> list[dict]:
    """Tables of a docx, xlsx or pptx file as written: spans, merges, coordinates and formulas kept."""
    return {"docx": _docx, "xlsx": _xlsx, "pptx": _pptx}[kind](_Parts(body))


def extract(body: bytes | None, kind: str | None) -> dict:
    """Tables of a document with method and status; what cannot be read is said, not raised."""
    from specloom.sources.html import parse_page

    if body is None or kind is None:
        return {"tables": [], "method": None, "status": "unreadable", "uncertainty": "no content or unknown format"}
    try:
        if kind == "html":
            page = unpack(body, ARCHIVE_BYTES)
            if page is None:
                raise ValueError("page is damaged or expands beyond its limit")
            return {"tables": parse_page(page.decode("utf-8", "replace"))["tables"], "method": "html", "status": "extracted", "uncertainty": None}
        if kind in ("docx", "xlsx", "pptx"):
            return {"tables": office_tables(body, kind), "method": "office", "status": "extracted", "uncertainty": None}
        if kind == "csv":
            lines = csv.reader(io.StringIO(body.decode("utf-8-sig", "replace"), newline=""))
            rows = [[{"text": t.strip(), "header": False, "colspan": 1, "rowspan": 1} for t in line] for line in lines if any(t.strip() for t in line)]
            return {"tables": [{"index": 1, "section": "", "rows": rows}] if rows else [], "method": "csv", "status": "extracted", "uncertainty": None}
    except Exception as e:  # noqa: BLE001  a damaged, encrypted or contradictory file must not end the job that reads the others
        return {"tables": [], "method": kind, "status": "failed", "uncertainty": f"{type(e).__name__}: {e}"}
    return {"tables": [], "method": kind, "status": "review_required", "uncertainty": "no native tables in this format"}


# Layout text: what a PDF tool prints, columns kept by blanks.

_GAP = re.compile(r"\s{2,}")


def segments(line: str) -> list[tuple[int, str]]:
    """Pieces of a line that two or more blanks separate, each with its start column."""
    return [(m.start(), m[0].rstrip()) for m in re.finditer(r"\S+(?: \S+)*", line)]


def layout_tables(text: str, least_rows: int = 3) -> list[dict]:
    """Tables of layout text, page by page (form feed): runs of lines of two or more pieces, of which at least ``least_rows`` hold figures.

    Lines that start with a footnote mark right after a run are its notes; the line before a run is its section.
    """
    out: list[dict] = []
    for page, body in enumerate(text.split("\f"), 1):
        run: list[list[dict]] = []
        notes: list[str] = []
        section = before = ""

        def close() -> None:
            if sum(any(c.isdigit() for cell in r[1:] for c in cell["text"]) for r in run) >= least_rows:
                out.append({"index": len(out) + 1, "page": page, "section": section, "rows": list(run), "notes": " ".join(notes)})
            run.clear()
            notes.clear()

        for line in body.split("\n"):
            parts = segments(line)
            if len(parts) >= 2 and not notes:
                if not run:
                    section = before
                run.append([{"text": t, "x": x} for x, t in parts])
            elif len(parts) == 1 and run and re.match(r"[*†‡]|\(?\d{1,2}\)\s|\d{1,2}\s+[A-Z]", parts[0][1]):
                notes.append(parts[0][1])
            elif parts:
                close()
                before = parts[0][1]
                if len(parts) >= 2:
                    section = before
                    run.append([{"text": t, "x": x} for x, t in parts])
        close()
    return out


def panel_rows(text: str, boundary: int) -> list[tuple[str, str]]:
    """Label and value pairs of the panel right of a column; a line without a label continues the value before, a lone label takes the next line."""
    pairs: list[list[str]] = []
    for line in text.split("\n"):
        parts = [(x, t) for x, t in segments(line) if x >= boundary]
        if len(parts) >= 2:
            pairs.append([parts[0][1], " ".join(t for _, t in parts[1:])])
        elif len(parts) == 1:
            x, t = parts[0]
            if x - boundary > 8 and pairs:
                pairs[-1][1] = f"{pairs[-1][1]} {t}".strip()
            elif t.startswith(("•", "-", "▪")) and pairs:
                pairs[-1][1] = f"{pairs[-1][1]} {t.lstrip('•-▪ ')}".strip()
            else:
                pairs.append([t, ""])
    return [(a, b) for a, b in pairs if b]


def bullets(text: str) -> list[str]:
    """Items of bulleted lists; an indented line continues its item."""
    out: list[str] = []
    for line in text.split("\n"):
        if m := re.match(r"\s*[•▪●‣]\s*(.+)", line):
            out.append(m[1].strip())
        elif out and line.startswith("  ") and line.strip():
            out[-1] += " " + line.strip()
    return out


def matrix_columns(lines: list[str]) -> list[tuple[str, list[tuple[str, str]]]]:
    """Models of a matrix of layout lines: columns split half way between the starts of the header's pieces; rows are (label, value)."""
    header = segments(lines[0]) if lines else []
    if len(header) < 2:
        return []
    starts = [x for x, _ in header]
    edges = [(a + b) / 2 for a, b in zip(starts, starts[1:])]
    models = [(name, []) for _, name in header[1:]]
    for line in lines[1:]:
        cells: dict[int, str] = {}
        for x, t in segments(line):
            at = sum(x >= e for e in edges)
            cells[at] = f"{cells[at]} {t}" if at in cells else t
        for i, (_, rows) in enumerate(models, 1):
            if cells.get(0) and cells.get(i):
                rows.append((cells[0], cells[i]))
    return models


# Records inside scripts and JSON.

# Names of the members of a component answer.
COMPONENT_ROWS, COMPONENT_CODE, COMPONENT_TITLE = "details", "response-code", "part-title"


def component_rows(text: str, rows: str = COMPONENT_ROWS, code: str = COMPONENT_CODE) -> tuple[list[tuple[str, str]], str]:
    """Name and value pairs of a component answer, exact duplicates once, in order; and ``extracted`` or ``nothing_stated``.

    Pairs that are no text or blank on either side are left out; an answer whose code is not 200 states nothing.
    """
    try:
        data = json.loads(text)
    except (ValueError, RecursionError):
        data = None
    if not isinstance(data, dict) or str(data.get(code)) != "200" or not isinstance(data.get(rows), list):
        return [], "nothing_stated"
    stated = ((r.get("name"), r.get("value")) for r in data[rows] if isinstance(r, dict))
    pairs = dict.fromkeys((n.strip(), v.strip()) for n, v in stated if isinstance(n, str) and isinstance(v, str) and n.strip() and v.strip())
    return list(pairs), "extracted" if pairs else "nothing_stated"


_LITERAL = re.compile(r'\s*(?:(?P<string>"(?:[^"\\]|\\.)*"|\'(?:[^\'\\]|\\.)*\')|(?P<number>-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)|(?P<bool>!0|!1)|(?P<word>[A-Za-z_$][\w$]*)|(?P<mark>[{}\[\]:,]))')


def script_literal(text: str):
    """A script's object literal as data: bare keys, both quotes, ``!0`` and ``!1``; anything that would have to be run raises ValueError."""
    out: list[str] = []
    at = 0
    while at < len(text.rstrip()):
        m = _LITERAL.match(text, at)
        if not m:
            raise ValueError(f"not a literal at {at}")
        at = m.end()
        if m["string"]:
            body = m["string"][1:-1]
            plain = re.sub(r"\\x([0-9a-fA-F]{2})", r"\\u00\1", body).replace("\\'", "'")
            if m["string"][0] == "'":
                plain = re.sub(r'(?<!\\)"', r'\\"', plain)
            out.append(f'"{plain}"')
        elif m["bool"]:
            out.append("true" if m["bool"] == "!0" else "false")
        elif m["word"]:
            if re.match(r"\s*:", text[at:]) and (not out or out[-1] in "{,"):
                out.append(json.dumps(m["word"]))
            elif m["word"] in ("true", "false", "null"):
                out.append(m["word"])
            else:
                raise ValueError(f"expression {m['word']}")
        else:
            out.append(m["number"] or m["mark"])
    return json.loads("".join(out))


def _bracketed(text: str, at: int) -> str | None:
    """The bracketed literal that starts at a place, strings in it aside; null if it is not closed."""
    depth, quote, i = 0, "", at
    while i < len(text):
        c = text[i]
        if quote:
            if c == "\\":
                i += 1
            elif c == quote:
                quote = ""
        elif c in "'\"":
            quote = c
        elif c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
            if not depth:
                return text[at : i + 1]
        i += 1
    return None


def print_rows(script: str, style: str = "specsTable") -> list[list[dict]]:
    """Rows of the table that a page's print definition draws in a style, read as a literal: cells ``text, header, colspan, rowspan``.

    The table is the first ``body: [...]`` after the style. Cells without text that span nothing are left out; what is no literal gives no rows.
    """
    styled = re.search(rf"style\s*:\s*['\"]{re.escape(style)}['\"]", script)
    body = re.search(r"\bbody\s*:\s*\[", script[styled.end() :]) if styled else None
    literal = _bracketed(script, styled.end() + body.end() - 1) if body else None
    if literal is None:
        return []
    try:
        # Line comments go, unless they are in a string.
        plain = re.sub(r"('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|//[^\n]*", lambda m: m[1] or "", literal)
        data = script_literal(re.sub(r",(\s*[\]}])", r"\1", plain))
    except (ValueError, RecursionError):
        return []
    rows = []
    for line in data:
        cells = [c if isinstance(c, dict) else {"text": c} for c in (line if isinstance(line, list) else [])]
        kept = [
            {"text": " ".join(html.unescape(str(c.get("text") or "")).split()), "header": "eader" in str(c.get("style", "")) or "ection" in str(c.get("style", "")), "colspan": int(c.get("colSpan") or 1), "rowspan": int(c.get("rowSpan") or 1)}
            for c in cells
        ]
        kept = [c for c in kept if c["text"] or c["colspan"] > 1]
        if any(c["text"] for c in kept):
            rows.append(kept)
    return rows


def parsed_literals(script: str) -> list:
    """Values of ``JSON.parse('...')`` calls in a script; what is no JSON is left out."""
    out = []
    for m in re.finditer(r"JSON\.parse\(\s*('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")\s*\)", script):
        try:
            text = script_literal(m[1])
            out.append(json.loads(text))
        except ValueError:
            continue
    return out


def colon_rows(text: str, limit: int = 80) -> list[tuple[str, str]]:
    """Label and value of lines that a colon within ``limit`` characters splits."""
    out = []
    for line in text.split("\n"):
        label, colon, value = line.partition(":" if ":" in line else "：")
        if colon and 0 < len(label.strip()) <= limit and value.strip():
            out.append((label.strip(), value.strip()))
    return out


def stream_section(chunks: list[str], name: str) -> str | None:
    """A named section of a chunked payload: ``<name>:T<hex length>,<text>`` counts bytes, ``<name>:<text>`` runs to the line's end."""
    data = "".join(chunks).encode()
    if m := re.search(rb"(?:^|\n)" + re.escape(name.encode()) + rb":T([0-9a-f]+),", data):
        return data[m.end() : m.end() + int(m[1], 16)].decode("utf-8", "replace")
    if m := re.search(rb"(?:^|\n)" + re.escape(name.encode()) + rb":([^\n]*)", data):
        return m[1].decode("utf-8", "replace")
    return None
