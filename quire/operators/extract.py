"""Extraction with its failures kept as data, routing features of pages, requests to page models, repair of encodings."""

from __future__ import annotations

import html
import re

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from quire.functions import fixed
from quire.functions import records as R
from quire.functions import text as T
from quire.operators import tree as X
from quire.operators.layout import grouped
from quire.sources import formats as S

# what extraction logs say of damaged files
CORRUPT = "|".join(fixed.CORRUPT_LOGS)


def extract(df: DataFrame, fmt: str, key: str = "doc_id", content: str = "content", style: str = "plain") -> DataFrame:
    """(key, text, extraction_failed, route): parsed, serialised; rows that cannot be parsed go to `failed`, not away."""
    p = S.parse(df.withColumnRenamed(key, "doc_id"), fmt, "doc_id", content)
    n = p.select("doc_id", F.explode("nodes").alias("n")).select("doc_id", "n.*")
    t = X.serialised(n, style)
    bad = F.col("error").isNotNull()
    return p.join(t, "doc_id", "left").select(F.col("doc_id").alias(key), F.coalesce("text", F.lit("")).alias("text"), bad.alias("extraction_failed"), F.when(bad, "failed").otherwise("extracted").alias("route"))


def corrupted(log: Column, locked: Column | None = None) -> Column:
    """Whether an extraction log names damage, or the file is encrypted or needs a password."""
    bad = F.coalesce(log.rlike(CORRUPT), F.lit(False))
    return bad if locked is None else bad | F.coalesce(locked, F.lit(False))


def page_features(spans: DataFrame, page_area: float = 595.0 * 842.0) -> DataFrame:
    """(doc_id, page_no, fonts, chars, boxes, mean_area, text_share, hidden_chars) from spans with text, font, box, hidden."""
    a, n = R.area(F.col("box")), F.length("text")
    hidden = F.coalesce(F.col("hidden"), F.lit(False))
    return spans.groupBy("doc_id", "page_no").agg(F.count_distinct("font").alias("fonts"), F.sum(n).alias("chars"), F.count("*").alias("boxes"), F.round(F.avg(a), 6).alias("mean_area"), F.round(F.least(F.sum(a) / page_area, F.lit(1.0)), 6).alias("text_share"), F.sum(F.when(hidden, n).otherwise(0)).alias("hidden_chars"))


def junk_images(images: DataFrame, sampled: DataFrame, least: int = 3) -> DataFrame:
    """(doc_id, xref): images on all sampled pages of a document, if there are at least `least`."""
    n = sampled.groupBy("doc_id").agg(F.count_distinct("page_no").alias("pages"))
    on = images.join(sampled.select("doc_id", "page_no").distinct(), ["doc_id", "page_no"], "left_semi").groupBy("doc_id", "xref").agg(F.count_distinct("page_no").alias("on"))
    return on.join(n, "doc_id").where((F.col("on") == F.col("pages")) & (F.col("pages") >= least)).select("doc_id", "xref")


def merge_strips(images: DataFrame, width: float = 595.0, share: float = 0.9, align: float = 5.0, gap: float = 2.0) -> DataFrame:
    """(doc_id, page_no, strip, box): full-width bands of an image that lie on one another as one box; repeated boxes count once."""

    def one(rows: list[dict]) -> list[dict]:
        boxes = sorted({(r["box"]["t"], r["box"]["l"], r["box"]["b"], r["box"]["r"]) for r in rows})
        out: list[list[float]] = []
        for t, l, b, r in boxes:
            k = out[-1] if out else None
            if k and r - l >= share * width and k[3] - k[1] >= share * width and abs(k[1] - l) <= align and abs(k[3] - r) <= align and t - k[2] <= gap:
                k[1], k[2], k[3] = min(k[1], l), max(k[2], b), max(k[3], r)
            else:
                out.append([t, l, b, r])
        return [{"strip": i, "box": {"l": l, "t": t, "r": r, "b": b}} for i, (t, l, b, r) in enumerate(out)]

    return grouped(images.select("doc_id", "page_no", "box"), ["doc_id", "page_no"], one, "strip:int,box:struct<l:double,t:double,r:double,b:double>")


def page_requests(pages: DataFrame, prompt: str, longest: int = 1280, most_tokens: int = 2048) -> DataFrame:
    """(doc_id, page_no, request): what a page model is asked, from pages with width and height."""
    size = R.render_size(F.col("width"), F.col("height"), longest, most_tokens=most_tokens)
    return pages.select("doc_id", "page_no", F.to_json(F.struct(F.lit(prompt).alias("prompt"), size["width"].alias("width"), size["height"].alias("height"), F.lit(1.05).alias("repetition_penalty"))).alias("request"))


def check_requests(pages: DataFrame, langs: Column, text: Column, target: str, tokens: int = 1024) -> DataFrame:
    """Pages whose best language is the target, with their first words and the question about it."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    head = F.array_join(F.slice(words, 1, tokens), " ")
    return pages.where(langs == target).withColumn("request", F.concat(F.lit(f"Is the following text in {target}? Answer YES or NO.\n\n"), head))


def blank_candidates(pages: DataFrame, lang: str = "eng_Latn") -> DataFrame:
    """Adds `candidate`: pages in the language whose text begins with `The`, which models invent for blank pages."""
    return pages.withColumn("candidate", F.coalesce((F.col("best_lang") == lang) & F.col("text").startswith("The"), F.lit(False)))


def drop_blank(pages: DataFrame, answers: DataFrame) -> DataFrame:
    """Pages without candidates whose answer is not TEXT; an unanswered candidate goes too."""
    x = pages.join(answers.select("doc_id", "page_no", "answer").dropDuplicates(["doc_id", "page_no"]), ["doc_id", "page_no"], "left")
    return x.where(~F.col("candidate") | F.coalesce(F.trim("answer") == "TEXT", F.lit(False))).drop("answer")


def counted(df: DataFrame, name: str, route: str = "route") -> tuple[DataFrame, Observation]:
    """The rows unchanged and an observation of total, forwarded and dropped, filled when an action runs."""
    o = Observation(name)
    out = F.coalesce(F.col(route).isin("failed", "removed"), F.lit(False))
    return df.observe(o, F.count("*").alias("total"), F.count_if(~out).alias("forwarded"), F.count_if(out).alias("dropped")), o


def repair_encoding(text: str | None) -> str | None:
    """Text whose bytes were read in the wrong encoding, with HTML entities, odd line ends and control signs set right."""
    if text is None:
        return None
    if "&" in text and "<" not in text:
        text = html.unescape(text)
    if re.search("[\xc2\xc3\xe2][\x80-\xbfŒœŠšŽžŸƒˆ˜–-›€™]", text):
        for enc in ("cp1252", "latin-1"):
            try:
                text = text.encode(enc).decode("utf-8")
                break
            except UnicodeError:
                continue
    text = re.sub("\x1b\\[[0-9;]*[A-Za-z]", "", text)
    text = text.replace("\r\n", "\n").replace("\r", "\n").replace(" ", "\n").replace(" ", "\n\n").replace("\x85", "\n")
    return re.sub("[\x00-\x08\x0b\x0e-\x1f\x7f-\x9f﻿￹-￻\ud800-\udfff]", "", text)


def join_lines(cells: DataFrame) -> DataFrame:
    """(doc_id, page_no, cluster, text) from cells with cluster and box: lines in order, words divided by a hyphen joined,
    a blank where the gap is over a quarter of a character or a new line begins; a cell that lies in the last one is left out."""

    def one(rows: list[dict]) -> list[dict]:
        rows.sort(key=lambda r: (round(r["box"]["t"]), r["box"]["l"]))
        out, last = "", None
        for r in rows:
            b, t = r["box"], (r["text"] or "").replace("\x02", "-")
            if last is not None:
                same = min(last["b"], b["b"]) - max(last["t"], b["t"]) > 0.8 * min(last["b"] - last["t"], b["b"] - b["t"])
                if same and b["r"] <= last["r"] and b["l"] >= last["l"]:
                    continue
                wide = (b["r"] - b["l"]) / max(len(t), 1)
                if not same and len(out) > 1 and out[-1] == "-" and out[-2].isalnum() and t[:1].isalnum():
                    out = out[:-1]
                elif not same or b["l"] - last["r"] > 0.25 * wide:
                    out += " "
            out, last = out + t, b
        return [{"text": out}]

    return grouped(cells.select("doc_id", "page_no", "cluster", "text", "box"), ["doc_id", "page_no", "cluster"], one, "text:string")


def otsl(rows: list[list[dict]]) -> str:
    """Table tokens of rows of cells {text, c, r, h}: a cell opens where it starts, lcel, ucel and xcel go on with it."""
    width = max((sum(c.get("c", 1) for c in r) for r in rows), default=0)
    kind: dict[tuple[int, int], str] = {}
    for i, row in enumerate(rows):
        k = 0
        for c in row:
            while (i, k) in kind:
                k += 1
            for di in range(c.get("r", 1)):
                for dk in range(c.get("c", 1)):
                    if di or dk:
                        kind[i + di, k + dk] = "xcel" if di and dk else "ucel" if di else "lcel"
            kind[i, k] = ("ched" if c.get("h") else "fcel" if c["text"] else "ecel") + "\x00" + c["text"]
            k += c.get("c", 1)
            width = max(width, k)
    out = []
    for i in range(max((i for i, _ in kind), default=-1) + 1):
        for k in range(width):
            name, _, text = kind.get((i, k), "ecel\x00").partition("\x00")
            out.append(f"<{name}>{text}")
        out.append("<nl>\n")
    return "".join(out)


def from_otsl(data: str) -> list[list[dict]]:
    """Rows of cells {text, c, r, h} from table tokens: spans are measured along lcel to the right and ucel down.

    Short rows are filled as if the cell before went on.
    """
    grid = [[m.groups() for m in re.finditer(r"<(fcel|ched|rhed|srow|ecel|lcel|ucel|xcel)>([^<]*)", row)] for row in data.split("<nl>")]
    grid = [r for r in grid if r]
    width = max(map(len, grid), default=0)
    grid = [r + [("lcel", "")] * (width - len(r)) for r in grid]
    out = []
    for i, row in enumerate(grid):
        cells = []
        for k, (name, text) in enumerate(row):
            if name in ("lcel", "ucel", "xcel"):
                continue
            c = r = 1
            while k + c < width and row[k + c][0] == "lcel":
                c += 1
            while i + r < len(grid) and grid[i + r][k][0] == "ucel":
                r += 1
            cells.append({"text": text, "c": c, "r": r, "h": name == "ched"})
        out.append(cells)
    return out


def from_doctags(data: str) -> list[dict]:
    """Nodes of a text written with tags: titles, headings by level, items, texts, code, tables."""
    t = S.Tree()
    head: dict[int, int] = {}
    lst = None
    for m in re.finditer(r"(?s)<(title|section_header_level_\d+|text|list_item|code|caption|picture|otsl)>(.*?)</\1>", data):
        name, body = m.groups()
        up = head[max(head)] if head else None
        plain = html.unescape(re.sub(r"<loc_\d+>", "", body)).strip() if name != "otsl" else ""
        if name != "list_item":
            lst = None
        if name == "title":
            head = {0: t.add("title", plain)}
        elif name.startswith("section"):
            n = int(name.rsplit("_", 1)[1])
            head = {k: v for k, v in head.items() if k < n}
            head[n] = t.add("heading", plain, head[max(head)] if head else None, n)
        elif name == "list_item":
            lst = t.add("list", parent=up) if lst is None else lst
            t.add("item", plain, lst, marker="-")
        elif name == "otsl":
            t.add("table", "", up, rows=S.grid([[{**c, "text": html.unescape(c["text"])} for c in r] for r in from_otsl(body)]))
        else:
            t.add(name, plain, up)
    return t.nodes


def document_language(docs: DataFrame, predict: Column, chars: int = 40_000) -> DataFrame:
    """Adds full_doc_lid from `predict`, a column over `lid_input`: the first so many characters of the cleaned text.

    The limit belongs to the published feature of that name; the text itself goes on whole.
    """
    x = docs.withColumn("lid_input", F.substring(T.lid_text(F.col("text")), 1, chars))
    return x.withColumn("full_doc_lid", F.when(T.lid_eligible(F.col("lid_input")), predict).otherwise("unknown")).drop("lid_input")


def resampled(labels: DataFrame, pages: str = "num_pages", every: int = 32) -> DataFrame:
    """Rows of long documents repeated: one more for each `every` pages, with the number of the copy."""
    n = F.greatest(F.expr(f"coalesce({pages}, 0) div {every}"), F.lit(1))
    return labels.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), n.cast("bigint"))))


def last_label(df: DataFrame, key: str, order: str) -> DataFrame:
    """The latest row of each key."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
