"""Declarative document formats as node tables: one parser for each, run over Arrow batches.

A node is (node_id, parent_id, seq, kind, level, text, marker, layer, rows): kind is title, heading, text, list, item,
table, picture, code, caption, group; layer is body or furniture; rows are a table's cells. Parsers never raise on bad
input: what cannot be read gives no nodes, and the reason stands in the error column of `parse`.
"""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from html.parser import HTMLParser
from xml.etree import ElementTree

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.arrays import map_columns, spread

# depth counts the lists above a node; in_picture tells whether it hangs under a picture
MORE = "depth int, in_picture boolean"
NODE = "node_id int, parent_id int, seq int, kind string, level int, text string, marker string, layer string, rows array<array<string>>"
# Extensions and the formats they name
EXTENSIONS = {"html": "html", "htm": "html", "xhtml": "html", "md": "markdown", "csv": "csv", "adoc": "asciidoc", "asciidoc": "asciidoc", "asc": "asciidoc", "xml": "jats", "nxml": "jats", "xlsx": "xlsx", "pptx": "pptx", "docx": "docx", "json": "json", "pdf": "pdf"}


class Tree:
    """Nodes in the order of their making."""

    def __init__(self):
        self.nodes: list[dict] = []

    def add(self, kind: str, text: str = "", parent: int | None = None, level: int | None = None, marker: str | None = None, layer: str = "body", rows: list | None = None) -> int:
        n = len(self.nodes)
        self.nodes.append({"node_id": n, "parent_id": parent, "seq": n, "kind": kind, "level": level, "text": text, "marker": marker, "layer": layer, "rows": rows})
        return n


class _Html(HTMLParser):
    """Events to nodes: block tags end a text; headings set the parents; scripts, styles and comments are dropped."""

    BLOCKS = {"p", "address", "summary", "div", "section", "article", "details", "figure", "body", "html", "main", "blockquote", "header", "footer", "nav"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tree, self.buffer, self.skip = Tree(), [], 0
        self.heads: dict[int, int] = {}
        self.lists: list[dict] = []
        self.table: list[list[list]] = []
        self.kind, self.level, self.headed = "text", None, False
        self.pre = False

    def parent(self) -> int | None:
        if self.lists:
            return self.lists[-1]["node"]
        return self.heads[max(self.heads)] if self.heads else None

    def flush(self) -> None:
        raw = "".join(self.buffer)
        self.buffer = []
        text = raw.strip("\n") if self.pre else re.sub(r"[ \t\r\f]*\n[ \t\r\f]*|[ \t\r\f]+", lambda m: "\n" if "\x00" in m[0] else " ", raw).replace("\x00", "\n").strip()
        if not text:
            return
        layer = "body" if self.headed else "furniture"
        if self.kind == "heading":
            self.headed = True
            level = self.level or 1
            for k in [k for k in self.heads if k >= level]:
                del self.heads[k]
            p = self.heads[max(self.heads)] if self.heads else None
            self.heads[level] = self.tree.add("title" if level == 1 else "heading", text, p, None if level == 1 else level - 1, layer="body")
        elif self.kind == "item" and self.lists:
            x = self.lists[-1]
            x["n"] += 1
            self.tree.add("item", text, x["node"], marker=f"{x['n']}." if x["ordered"] else "-", layer=layer)
        else:
            self.tree.add({"code": "code", "caption": "caption"}.get(self.kind, "text"), text, self.parent(), layer=layer)

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in ("script", "style", "noscript", "template"):
            self.skip += 1
            return
        if tag == "br":
            self.buffer.append("\x00")
            return
        if self.table:
            if tag == "tr":
                self.table[-1].append([])
            elif tag in ("td", "th"):
                if not self.table[-1]:
                    self.table[-1].append([])
                num = lambda v: int(v) if (v or "").isdigit() else 1
                self.table[-1][-1].append({"t": [], "c": min(num(a.get("colspan")), 200), "r": min(num(a.get("rowspan")), 1000), "h": tag == "th"})
            elif tag == "table":
                self.table.append([])
            return
        if re.fullmatch(r"h[1-6]", tag):
            self.flush()
            self.kind, self.level = "heading", int(tag[1])
        elif tag in ("ul", "ol"):
            self.flush()
            start = a.get("start", "1")
            self.lists.append({"node": self.tree.add("list", parent=self.parent(), layer="body" if self.headed else "furniture"), "ordered": tag == "ol", "n": int(start) - 1 if start.lstrip("-").isdigit() else 0})
        elif tag == "li":
            self.flush()
            self.kind = "item"
        elif tag == "table":
            self.flush()
            self.table.append([])
        elif tag == "img":
            self.flush()
            self.tree.add("picture", a.get("alt") or "", self.parent(), layer="body" if self.headed else "furniture")
        elif tag in ("pre", "code") and not self.pre:
            if tag == "pre":
                self.flush()
                self.kind, self.pre = "code", True
        elif tag == "figcaption":
            self.flush()
            self.kind = "caption"
        elif tag in self.BLOCKS:
            self.flush()
            self.kind = "text" if not (self.lists and self.kind == "item") else "item"

    def handle_endtag(self, tag):
        if tag in ("script", "style", "noscript", "template"):
            self.skip = max(0, self.skip - 1)
        elif self.table:
            if tag == "table":
                rows = self.table.pop()
                if not self.table:
                    g = grid([[{"text": re.sub(r"\s+", " ", "".join(c["t"])).strip(), "c": c["c"], "r": c["r"]} for c in r] for r in rows])
                    if g:
                        self.tree.add("table", "", self.parent(), rows=g, layer="body" if self.headed else "furniture")
        elif re.fullmatch(r"h[1-6]", tag) or tag in ("li", "pre", "figcaption") or tag in self.BLOCKS:
            self.flush()
            self.kind, self.level = "text", None
            if tag == "pre":
                self.pre = False
        elif tag in ("ul", "ol") and self.lists:
            self.flush()
            self.lists.pop()
            self.kind = "text"

    def handle_data(self, data):
        if self.skip:
            return
        if self.table:
            if self.table[0] and self.table[0][-1]:
                self.table[0][-1][-1]["t"].append(data)
            return
        self.buffer.append(data)


def grid(rows: list[list[dict]]) -> list[list[str]]:
    """Dense cells of rows with column and row spans; a spanning cell's text stands in each place."""
    out: list[list[str | None]] = []
    for i, row in enumerate(rows):
        while len(out) <= i:
            out.append([])
        k = 0
        for c in row:
            while k < len(out[i]) and out[i][k] is not None:
                k += 1
            for di in range(min(c["r"], len(rows) - i)):
                while len(out) <= i + di:
                    out.append([])
                line = out[i + di]
                line.extend([None] * (k + c["c"] - len(line)))
                for dk in range(c["c"]):
                    if line[k + dk] is None:
                        line[k + dk] = c["text"]
            k += c["c"]
    width = max((len(r) for r in out), default=0)
    return [[x or "" for x in r] + [""] * (width - len(r)) for r in out] if width else []


def html(data: str) -> list[dict]:
    p = _Html()
    p.feed(data)
    p.close()
    p.flush()
    if not p.headed:
        for n in p.tree.nodes:
            n["layer"] = "body"
    return p.tree.nodes


def markdown(data: str) -> list[dict]:
    """Headings, lists, fences, pipe tables, paragraphs; long underscore runs are cut; a text with HTML blocks is read as HTML."""
    data = re.sub(r"_{11,}", "_" * 10, data)
    if re.search(r"(?m)^<(?:div|table|p|section|ul|ol|h[1-6])\b", data):
        return html(re.sub(r"(?m)^(#{1,6})\s+(.*)$", lambda m: f"<h{len(m[1])}>{m[2]}</h{len(m[1])}>", data))
    t, heads, para, table, lists = Tree(), {}, [], [], []
    fence: list[str] | None = None

    def up() -> int | None:
        return heads[max(heads)] if heads else None

    def end() -> None:
        if para:
            t.add("text", " ".join(para), up())
            para.clear()
        if table:
            rows = [[c.strip() for c in r.strip()[1:-1].split("|")] for n, r in enumerate(table) if not (n == 1 and re.fullmatch(r"\s*\|[\s:|\-]*\|\s*", r))]
            width = max(map(len, rows))
            t.add("table", "", up(), rows=[r + [""] * (width - len(r)) for r in rows])
            table.clear()

    for line in data.split("\n"):
        if fence is not None:
            if line.strip().startswith("```"):
                t.add("code", "\n".join(fence), up())
                fence = None
            else:
                fence.append(line)
            continue
        if line.strip().startswith("```"):
            end()
            fence = []
            continue
        if m := re.match(r"(#{1,6})\s+(.*?)\s*#*\s*$", line):
            end()
            lists.clear()
            n = len(m[1])
            for k in [k for k in heads if k >= n]:
                del heads[k]
            heads[n] = t.add("title" if n == 1 else "heading", m[2], heads[max(heads)] if heads else None, None if n == 1 else n - 1)
        elif re.fullmatch(r"\s*\|.*\|\s*", line):
            if para:
                end()
            table.append(line)
        elif m := re.match(r"(\s*)([-*+•–]|\d{1,9}[.)])\s+(.*)$", line):
            end()
            depth = len(m[1])
            while lists and lists[-1][0] > depth:
                lists.pop()
            if not lists or lists[-1][0] < depth:
                lists.append((depth, t.add("list", parent=lists[-1][1] if lists else up())))
            t.add("item", m[3].strip(), lists[-1][1], marker=m[2] if m[2][0].isdigit() else "-")
        elif not line.strip():
            end()
            lists.clear()
        else:
            if table:
                end()
            para.append(line.strip())
    end()
    if fence:
        t.add("code", "\n".join(fence), up())
    return t.nodes


def csv_table(data: str) -> list[dict]:
    """One table; the delimiter is the one of , ; tab | : that parts the first lines most evenly."""
    head = [x for x in data.split("\n")[:20] if x.strip()]
    if not head:
        return []

    def rank(c: str) -> tuple:
        n = [x.count(c) for x in head]
        return (sum(k > 0 for k in n), -(max(n) - min(n)), sum(n))

    rows = [r for r in csv.reader(io.StringIO(data), delimiter=max(",;\t|:", key=rank)) if r]
    width = max(map(len, rows))
    t = Tree()
    t.add("table", rows=[r + [""] * (width - len(r)) for r in rows])
    return t.nodes


def asciidoc(data: str) -> list[dict]:
    """Line by line: = title, == section, list marks with indent, |tables, image::, .caption, paragraphs."""
    t, para, table = Tree(), [], []
    head: dict[int, int] = {}
    lists: list[tuple[int, int]] = []
    caption = ""

    def end() -> None:
        nonlocal caption
        if para:
            t.add("text", " ".join(para), head[max(head)] if head else None)
            para.clear()
        if table:
            width = max(map(len, table))
            n = t.add("table", "", head[max(head)] if head else None, rows=[r + [""] * (width - len(r)) for r in table])
            if caption:
                t.add("caption", caption, n)
                caption = ""
            table.clear()

    for line in data.split("\n"):
        if m := re.match(r"(={1,6})\s+(.*)$", line):
            end()
            n = len(m[1])
            for k in [k for k in head if k >= n]:
                del head[k]
            head[n] = t.add("title" if n == 1 else "heading", m[2].strip(), head[max(head)] if head else None, None if n == 1 else n - 1)
        elif line.startswith("|") and line.strip("|= \t"):
            if para:
                end()
            cells = [c.strip() for c in line.split("|")]
            table.append([c for c in cells if c])
        elif line.startswith("|==="):
            continue
        elif m := re.match(r"image::([^\[]*)\[", line):
            end()
            n = t.add("picture", m[1], head[max(head)] if head else None)
            if caption:
                t.add("caption", caption, n)
                caption = ""
        elif m := re.match(r"\.(\S.*)$", line):
            end()
            caption = m[1]
        elif m := re.match(r"(\s*)(\*+|-|\.+|\d+\.)\s+(.*)$", line):
            end()
            depth = len(m[1]) + (len(m[2]) if m[2][0] in "*." else 1)
            while lists and lists[-1][0] > depth:
                lists.pop()
            if not lists or lists[-1][0] < depth:
                lists.append((depth, t.add("list", parent=lists[-1][1] if lists else head[max(head)] if head else None)))
            t.add("item", m[3].strip(), lists[-1][1], marker="-" if m[2][0] in "*-" else m[2])
            continue
        elif not line.strip():
            end()
        else:
            para.append(line.strip())
            continue
        lists.clear() if not re.match(r"\s*(\*+|-|\.+|\d+\.)\s", line) else None
    end()
    return t.nodes


def _name(e) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def _text(e) -> str:
    return re.sub(r"\s+", " ", "".join(e.itertext())).strip()


def jats(data: str) -> list[dict]:
    """Title, authors and abstract, then sections of body and back: headings, paragraphs, lists, captions, tables, references."""
    root = ElementTree.fromstring(data.encode() if isinstance(data, str) else data)
    t = Tree()
    find = lambda n: next((e for e in root.iter() if _name(e) == n), None)
    top = None
    if (e := find("article-title")) is not None:
        top = t.add("title", _text(e))
    names = [" ".join(_text(x) for k in ("given-names", "surname") for x in c.iter() if _name(x) == k) for c in root.iter() if _name(c) == "contrib"]
    if any(names):
        t.add("text", ", ".join(x for x in names if x), top)
    if (e := find("abstract")) is not None:
        t.add("text", _text(e), t.add("heading", "Abstract", top, 1))

    def walk(e, parent, depth):
        for c in e:
            n = _name(c)
            if n in ("sec", "ack", "app"):
                title = next((x for x in c if _name(x) == "title"), None)
                walk(c, t.add("heading", _text(title) if title is not None else n.title(), parent, depth), depth + 1)
            elif n == "p":
                inner = [x for x in c if _name(x) in ("list", "table-wrap", "fig")]
                if s := re.sub(r"\s+", " ", (c.text or "") + "".join(("" if x in inner or _name(x) == "inline-formula" else _text(x)) + (x.tail or "") for x in c)).strip():
                    t.add("text", s, parent)
                walk([*inner], parent, depth) if inner else None
            elif n == "list":
                k = t.add("list", parent=parent)
                for x in c:
                    if _name(x) == "list-item":
                        t.add("item", _text(x), k, marker="-")
            elif n == "fig":
                k = t.add("picture", "", parent)
                if s := " ".join(_text(x) for x in c if _name(x) in ("label", "caption")):
                    t.add("caption", s, k)
            elif n == "table-wrap":
                rows = [[{"text": _text(x), "c": int(x.get("colspan") or 1), "r": int(x.get("rowspan") or 1)} for x in r if _name(x) in ("td", "th")] for r in c.iter() if _name(r) == "tr"]
                k = t.add("table", "", parent, rows=grid(rows))
                if s := " ".join(_text(x) for x in c if _name(x) in ("label", "caption")):
                    t.add("caption", s, k)
            elif n == "ref-list":
                k = t.add("list", parent=t.add("heading", "References", parent, depth))
                for x in c:
                    if _name(x) == "ref":
                        t.add("item", _text(x), k, marker="-")
            elif n == "tex-math":
                t.add("code", _text(c), parent)
            elif n not in ("title", "label"):
                walk(c, parent, depth)

    for part in ("body", "back"):
        if (e := find(part)) is not None:
            walk(e, top, 1)
    return t.nodes


def xlsx(data: bytes) -> list[dict]:
    """Tables of each sheet: a filled cell not yet taken anchors one, down and right to the first empty cell."""
    t = Tree()
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        shared = [_text(e) for e in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        for name in sorted(n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)):
            cells: dict[tuple[int, int], str] = {}
            for c in ElementTree.fromstring(z.read(name)).iter():
                if _name(c) == "c" and (m := re.fullmatch(r"([A-Z]+)(\d+)", c.get("r") or "")):
                    col = 0
                    for ch in m[1]:
                        col = col * 26 + ord(ch) - 64
                    v = next((x.text or "" for x in c if _name(x) == "v"), None)
                    if c.get("t") == "inlineStr":
                        v = _text(c)
                    elif c.get("t") == "s" and v is not None and int(v) < len(shared):
                        v = shared[int(v)]
                    if v is not None:
                        cells[int(m[2]), col] = v
            group, seen = t.add("group", name), set()
            for r, c in sorted(cells):
                if (r, c) in seen:
                    continue
                bottom, right = r, c
                while (bottom + 1, c) in cells:
                    bottom += 1
                while (r, right + 1) in cells:
                    right += 1
                seen |= {(i, j) for i in range(r, bottom + 1) for j in range(c, right + 1)}
                t.add("table", "", group, rows=[[cells.get((i, j), "") for j in range(c, right + 1)] for i in range(r, bottom + 1)])
    return t.nodes


def pptx(data: bytes) -> list[dict]:
    """Slides as groups: titles, list items of bulleted or indented paragraphs, texts, tables."""
    t = Tree()
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        slides = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0]))
        for i, name in enumerate(slides, 1):
            g = t.add("group", f"slide {i}")
            for sp in ElementTree.fromstring(z.read(name)).iter():
                if _name(sp) == "tbl":
                    t.add("table", "", g, rows=grid([[{"text": _text(c), "c": int(c.get("gridSpan") or 1), "r": int(c.get("rowSpan") or 1)} for c in r if _name(c) == "tc" and not c.get("hMerge") and not c.get("vMerge")] for r in sp.iter() if _name(r) == "tr"]))
                if _name(sp) != "sp":
                    continue
                title = any(_name(x) == "ph" and "itle" in (x.get("type") or "") for x in sp.iter())
                lst = None
                for p in (x for x in sp.iter() if _name(x) == "p"):
                    s = " ".join(x.text or "" for x in p.iter() if _name(x) == "t").strip()
                    if not s:
                        continue
                    pr = next((x for x in p if _name(x) == "pPr"), None)
                    marked = pr is not None and (int(pr.get("lvl") or 0) > 0 or any(_name(x) in ("buChar", "buAutoNum") for x in pr))
                    if title:
                        t.add("title", s, g)
                    elif marked:
                        lst = t.add("list", parent=g) if lst is None else lst
                        t.add("item", s, lst, marker="-")
                    else:
                        lst = None
                        t.add("text", s, g)
    return t.nodes


def docx(data: bytes) -> list[dict]:
    """Headings by style, numbered paragraphs as list items, tables, texts."""
    t = Tree()
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = next(e for e in ElementTree.fromstring(z.read("word/document.xml")).iter() if _name(e) == "body")
    head: dict[int, int] = {}
    lst = None
    for e in body:
        up = head[max(head)] if head else None
        if _name(e) == "tbl":
            rows = [["".join(x.text or "" for x in c.iter() if _name(x) == "t") for c in r if _name(c) == "tc"] for r in e if _name(r) == "tr"]
            width = max(map(len, rows), default=0)
            t.add("table", "", up, rows=[r + [""] * (width - len(r)) for r in rows])
        elif _name(e) == "p":
            s = "".join(x.text or "" for x in e.iter() if _name(x) == "t").strip()
            style = next((v for x in e.iter() if _name(x) == "pStyle" for k, v in x.attrib.items() if k.endswith("val")), "")
            numbered = any(_name(x) == "numPr" for x in e.iter())
            if not s:
                continue
            if style.lower() == "title":
                head = {0: t.add("title", s)}
            elif m := re.match(r"[Hh]eading\s*(\d)", style):
                n = int(m[1])
                for k in [k for k in head if k >= n]:
                    del head[k]
                head[n] = t.add("heading", s, head[max(head)] if head else None, n)
            elif numbered:
                lst = t.add("list", parent=up) if lst is None else lst
                t.add("item", s, lst, marker="-")
                continue
            else:
                t.add("text", s, up)
        lst = None
    return t.nodes


def stored(data: str) -> list[dict]:
    """Nodes written before as JSON."""
    return [{k: n.get(k) for k in ("node_id", "parent_id", "seq", "kind", "level", "text", "marker", "layer", "rows")} for n in json.loads(data)]


TEXT = {"html": html, "markdown": markdown, "csv": csv_table, "asciidoc": asciidoc, "jats": jats, "json": stored}
BINARY = {"xlsx": xlsx, "pptx": pptx, "docx": docx}


def parse(df: DataFrame, fmt: str, key: str = "doc_id", content: str = "content") -> DataFrame:
    """(key, error, nodes) of each row; error is null or why a row gave no nodes. A null content gives an empty array."""
    fn = TEXT.get(fmt) or BINARY[fmt]

    def one(x):
        if x is None:
            return {"error": None, "nodes": []}
        try:
            return {"error": None, "nodes": fn(x)}
        except Exception as e:  # bad input is data, not a failure
            return {"error": type(e).__name__, "nodes": []}

    u = F.udf(one, f"struct<error:string,nodes:array<struct<{', '.join(c.replace(' ', ':', 1) for c in NODE.split(', '))}>>>", useArrow=True).asNondeterministic()
    return spread(df.select(key, content)).select(key, u(F.col(content)).alias("x")).select(key, "x.error", "x.nodes")


def placed(found: list[dict]) -> list[dict]:
    """Nodes with depth and in_picture, from their parents, which come before them."""
    lists, pictures = {}, {}
    for n in found:
        up = n["parent_id"]
        lists[n["node_id"]] = lists.get(up, 0) + (n["kind"] == "list")
        pictures[n["node_id"]] = pictures.get(up, False) or n["kind"] == "picture"
        n["depth"], n["in_picture"] = max(0, lists.get(up, 0) - 1), pictures.get(up, False)
    return found


def nodes(df: DataFrame, fmt: str, key: str = "doc_id", content: str = "content") -> DataFrame:
    """The node table: key and the columns of NODE and MORE. A row is parsed once; what cannot be read gives no nodes."""
    fn = TEXT.get(fmt) or BINARY[fmt]
    names = [c.split(" ")[0] for c in f"{NODE}, {MORE}".split(", ")]

    def run(cols):
        keys, contents = cols[key].to_pylist(), cols[content]
        for at in range(0, len(keys), 64):  # rows of few documents at a time, which bounds memory
            out: dict[str, list] = {n: [] for n in (key, *names)}
            for k, x in zip(keys[at : at + 64], contents[at : at + 64].to_pylist()):
                try:
                    found = placed(fn(x)) if x is not None else []
                except Exception:  # bad input is data, not a failure
                    found = []
                out[key] += [k] * len(found)
                for n in names:
                    out[n] += [f[n] for f in found]
            yield out

    return map_columns(spread(df.select(key, content)), run, f"{key} {dict(df.dtypes)[key]}, {NODE}, {MORE}")


def sniff(name, head):
    """Column: the format of a file from its name and first characters."""
    ext = F.regexp_extract(F.lower(name), r"\.([a-z0-9]+)$", 1)
    known = F.create_map(*[F.lit(x) for kv in sorted(EXTENSIONS.items()) for x in kv])
    return (
        F.when(head.startswith("%PDF"), "pdf")
        .when(head.startswith("PK"), F.coalesce(F.try_element_at(known, ext), F.lit("zip")))
        .when(head.startswith("PATN\n") | head.startswith("PATN\r\n"), "patent")
        .when(F.lower(head).rlike(r"<!doctype html|<html"), "html")
        .when(head.rlike(r"(?i)<!doctype\s+article|<article"), "jats")
        .when(F.try_element_at(known, ext).isNotNull(), F.try_element_at(known, ext))
        .when(head.rlike(r"^[^\n]*[,;\t][^\n]*\n[^\n]*[,;\t]"), "csv")
        .otherwise("text")
    )
