"""Page-layout operators: cells and clusters with boxes, their assignment, overlaps, order and merging.

cells (doc_id, page_no, cell, text, box), clusters (doc_id, page_no, cluster, label, confidence, box); box is a struct
(l, t, r, b) with the origin at the top left. Joins have the page as equality key; what is ordered inside a page or a
document runs in one group of that page or document, which a page bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import fixed
from quire.functions import records as R

PAGE = ["doc_id", "page_no"]
BOX = "struct<l:double,t:double,r:double,b:double>"


def grouped(df: DataFrame, keys: list[str], fn, fields: str) -> DataFrame:
    """fn over the rows of each group, which a page or a document bounds: groups become arrays, arrays go through Arrow."""
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias("g"))
    # nondeterministic, so that no filter inferred from the explode runs it a second time
    u = F.udf(lambda g: fn([r.asDict() for r in g]), f"array<struct<{fields}>>", useArrow=True).asNondeterministic()
    return g.select(*keys, u("g").alias("xs")).select(*keys, F.explode("xs").alias("x")).select(*keys, "x.*")
# Least confidence by label
LEAST = {"list_item": 0.5, "formula": 0.5, "section_header": 0.45, "title": 0.45, "code": 0.45, "table": 0.5, "picture": 0.5}


def confident(clusters: DataFrame, default: float = 0.5) -> DataFrame:
    """Titles become section headers, and clusters below their label's confidence go."""
    label = F.when(F.col("label") == "title", "section_header").otherwise(F.col("label"))
    th = F.create_map(*[F.lit(x) for kv in sorted(LEAST.items()) for x in kv])
    return clusters.withColumn("label", label).where(F.col("confidence") >= F.coalesce(F.try_element_at(th, F.col("label")), F.lit(default)))


def assign_cells(cells: DataFrame, clusters: DataFrame, least: float = 0.2) -> DataFrame:
    """(doc_id, page_no, cell, cluster, share): the cluster that holds most of a cell, if more than `least` of it."""
    j = cells.select(*PAGE, "cell", F.col("box").alias("c")).join(clusters.select(*PAGE, "cluster", F.col("box").alias("k")), PAGE)
    over = (F.col("c.l") < F.col("k.r")) & (F.col("k.l") < F.col("c.r")) & (F.col("c.t") < F.col("k.b")) & (F.col("k.t") < F.col("c.b"))
    x = j.where(over).withColumn("share", R.share_inside(F.col("c"), F.col("k"))).where(F.col("share") > least)
    return x.groupBy(*PAGE, "cell").agg(F.max_by("cluster", F.struct("share", -F.col("cluster"))).alias("cluster"), F.max("share").alias("share"))


def orphans(cells: DataFrame, assigned: DataFrame) -> DataFrame:
    """Unassigned cells with text, each as a text cluster of its own."""
    x = cells.where(F.length(F.trim("text")) > 0).join(assigned.select(*PAGE, "cell"), [*PAGE, "cell"], "left_anti")
    return x.select(*PAGE, F.col("cell").alias("cluster"), F.lit("text").alias("label"), F.lit(1.0).alias("confidence"), "box")


def fitted(clusters: DataFrame, cells: DataFrame, assigned: DataFrame) -> DataFrame:
    """Boxes of clusters as the union of their cells; tables keep their own box in it. Clusters without cells stay."""
    b = assigned.join(cells.select(*PAGE, "cell", "box"), [*PAGE, "cell"]).groupBy(*PAGE, "cluster").agg(F.struct(F.min("box.l").alias("l"), F.min("box.t").alias("t"), F.max("box.r").alias("r"), F.max("box.b").alias("b")).alias("u"))
    x = clusters.join(b, [*PAGE, "cluster"], "left")
    new = F.when(F.col("u").isNull(), F.col("box")).when(F.col("label") == "table", R.enclosing(F.col("box"), F.col("u"))).otherwise(F.col("u"))
    return x.withColumn("box", new).drop("u")


def inside(clusters: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, page_no, parent, child): clusters that lie in a table, picture or form, which take them as children."""
    p = clusters.where(F.col("label").isin("table", "picture", "form")).select(*PAGE, F.col("cluster").alias("parent"), F.col("box").alias("p"))
    c = clusters.where(~F.col("label").isin("table", "picture", "form")).select(*PAGE, F.col("cluster").alias("child"), F.col("box").alias("c"))
    x = p.join(c, PAGE).withColumn("share", R.share_inside(F.col("c"), F.col("p"))).where(F.col("share") > least)
    return x.groupBy(*PAGE, "child").agg(F.max_by("parent", "share").alias("parent")).select(*PAGE, "parent", "child")


def without_overlaps(clusters: DataFrame, most: float = 0.8) -> DataFrame:
    """One cluster of each group that overlap by IoU or containment: list items before texts, then confidence, area, id."""

    def one(rows: list[dict]) -> list[dict]:
        root = list(range(len(rows)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        def area(b) -> float:
            return max(b["r"] - b["l"], 0) * max(b["b"] - b["t"], 0)

        by = sorted(range(len(rows)), key=lambda i: rows[i]["box"]["l"])
        for n, i in enumerate(by):
            a = rows[i]["box"]
            for j in by[n + 1 :]:
                b = rows[j]["box"]
                if b["l"] >= a["r"]:
                    break
                s = max(min(a["r"], b["r"]) - max(a["l"], b["l"]), 0) * max(min(a["b"], b["b"]) - max(a["t"], b["t"]), 0)
                if s and (s / (area(a) + area(b) - s + 1e-6) > most or s / max(min(area(a), area(b)), 1e-9) > most):
                    root[find(i)] = find(j)
        best: dict[int, dict] = {}
        for i, r in enumerate(rows):
            key = (r["label"] != "list_item", -r["confidence"], -area(r["box"]), r["cluster"])
            k = find(i)
            if k not in best or key < best[k][0]:
                best[k] = (key, r)
        return [v for _, v in best.values()]

    return grouped(clusters.select(*PAGE, "cluster", "label", "confidence", "box"), PAGE, one, f"cluster:bigint,label:string,confidence:double,box:{BOX}")


def in_order(clusters: DataFrame, assigned: DataFrame, how: str = "cells") -> DataFrame:
    """Adds `position`: by the least cell of a cluster, then top and left; `tblr` by top, left; `lrtb` by left, top."""
    first = assigned.groupBy(*PAGE, "cluster").agg(F.min("cell").alias("first"))
    x = clusters.join(first, [*PAGE, "cluster"], "left")
    last = F.lit(1 << 60)
    keys = {"cells": [F.coalesce("first", last), F.col("box.t"), F.col("box.l")], "tblr": [F.col("box.t"), F.col("box.l")], "lrtb": [F.col("box.l"), F.col("box.t")]}[how]
    return x.withColumn("position", F.row_number().over(Window.partitionBy(*PAGE).orderBy(*keys, "cluster"))).drop("first")


def reading_order(items: DataFrame) -> DataFrame:
    """(doc_id, page_no, item, position): headers, body, footers; inside each, columns from top to bottom.

    items (doc_id, page_no, item, label, box). An item is under another if it starts below it, shares its horizontal
    range and none stands between; items without one above, from the left, open walks down that take an item when
    all above it are taken.
    """

    def one(rows: list[dict]) -> list[dict]:
        rows.sort(key=lambda r: r["item"])
        part = {"page_header": 0, "page_footer": 2}
        out: list[int] = []
        for zone in (0, 1, 2):
            z = [r for r in rows if part.get(r["label"], 1) == zone]
            box = [r["box"] for r in z]
            n = len(z)

            def over(a, b) -> bool:
                return a["l"] < b["r"] - 1e-3 and b["l"] < a["r"] - 1e-3

            up: list[set[int]] = [set() for _ in range(n)]
            down: list[list[int]] = [[] for _ in range(n)]
            for i in range(n):
                above = [j for j in range(n) if j != i and box[j]["b"] <= box[i]["t"] + 1e-3 and over(box[i], box[j])]
                for j in above:
                    cut = any(k != j and box[k]["t"] >= box[j]["b"] - 1e-3 and box[k]["b"] <= box[i]["t"] + 1e-3 and over(box[k], box[j]) and over(box[k], box[i]) for k in above)
                    if not cut:
                        up[i].add(j)
                        down[j].append(i)
            place = lambda i: (round(box[i]["l"], 1), box[i]["t"], i)
            for d in down:
                d.sort(key=place)
            done: set[int] = set()
            heads = sorted((i for i in range(n) if not up[i]), key=lambda i: (box[i]["t"] if not down[i] and all(not over(box[i], box[j]) or j == i for j in range(n)) else -1, *place(i)))
            for h in heads:
                stack = [h]
                while stack:
                    i = stack.pop()
                    if i in done or not up[i] <= done:
                        continue
                    done.add(i)
                    out.append(z[i]["item"])
                    stack.extend(reversed(down[i]))
            out.extend(z[i]["item"] for i in sorted(set(range(n)) - done, key=lambda i: (box[i]["t"], box[i]["l"])))
        return [{"item": x, "position": i} for i, x in enumerate(out, 1)]

    return grouped(items.select(*PAGE, "item", "label", "box"), PAGE, one, "item:bigint,position:int")


def captions(items: DataFrame, parts: tuple[str, ...] = ("table", "picture", "code")) -> DataFrame:
    """(doc_id, caption, target): a caption belongs to the neighbour in reading order that is a table, picture or code, the next before the last."""
    w = Window.partitionBy("doc_id").orderBy("page_no", "position")
    x = items.withColumns({"nl": F.lead("label").over(w), "ni": F.lead("item").over(w), "pl": F.lag("label").over(w), "pi": F.lag("item").over(w)}).where(F.col("label") == "caption")
    t = F.when(F.col("nl").isin(*parts), F.col("ni")).when(F.col("pl").isin(*parts), F.col("pi"))
    return x.select("doc_id", F.col("item").alias("caption"), t.alias("target")).where("target IS NOT NULL")


def footnotes(items: DataFrame) -> DataFrame:
    """(doc_id, footnote, target): footnotes that follow a table or picture without anything else between."""
    w = Window.partitionBy("doc_id").orderBy("page_no", "position")
    x = items.withColumn("run", F.sum((F.col("label") != "footnote").cast("int")).over(w))
    head = x.where(F.col("label").isin("table", "picture")).select("doc_id", "run", F.col("item").alias("target"))
    return x.where("label = 'footnote'").select("doc_id", "run", F.col("item").alias("footnote")).join(head, ["doc_id", "run"]).select("doc_id", "footnote", "target")


def continued(items: DataFrame) -> DataFrame:
    """(doc_id, item, next_item): a text that goes on in the next one: it ends in a small letter, comma or hyphen, the next begins small."""
    w = Window.partitionBy("doc_id").orderBy("page_no", "position")
    x = items.withColumns({"nt": F.lead("text").over(w), "ni": F.lead("item").over(w), "nl": F.lead("label").over(w)})
    return x.where((F.col("label") == "text") & (F.col("nl") == "text") & F.col("text").rlike(r"[\p{Ll},-]\s*$") & F.col("nt").rlike(r"^\s*\p{Ll}")).select("doc_id", "item", F.col("ni").alias("next_item"))


def merge_cells(cells: DataFrame, same_line: float = 0.8, gap: float = 6, punctuation_gap: float = 30, space: float = 0.25) -> DataFrame:
    """Neighbouring cells of one line and label as one: (doc_id, page_no, cell, label, text, box).

    Lines overlap by `same_line` of the lower height; the gap, in mean character widths, is under `gap`, or under
    `punctuation_gap` before a punctuation sign; a gap over `space` leaves a blank.
    """

    def one(rows: list[dict]) -> list[dict]:
        out: list[dict] = []
        for r in sorted(rows, key=lambda r: r["cell"]):
            r["text"] = r["text"] or ""
            if out and out[-1]["label"] == r["label"]:
                a, b = out[-1]["box"], r["box"]
                h = min(a["b"], b["b"]) - max(a["t"], b["t"])
                width = max((a["r"] - a["l"]) / max(len(out[-1]["text"]), 1), 1e-6)
                d = (b["l"] - a["r"]) / width
                if h >= same_line * min(a["b"] - a["t"], b["b"] - b["t"]) and -1 <= d < (punctuation_gap if r["text"][:1] in ".,;:!?)" else gap):
                    out[-1]["text"] += (" " if d > space and r["text"][:1] not in ".,;:!?)" else "") + r["text"]
                    out[-1]["box"] = {"l": min(a["l"], b["l"]), "t": min(a["t"], b["t"]), "r": max(a["r"], b["r"]), "b": max(a["b"], b["b"])}
                    continue
            out.append(r)
        return out

    return grouped(cells.select(*PAGE, "cell", "label", "text", "box"), PAGE, one, f"cell:bigint,label:string,text:string,box:{BOX}")


def merge_paragraphs(items: DataFrame, width: float = 0.1, align: float = 5, gap: float = 1, full: float = 2) -> DataFrame:
    """Consecutive texts of a document that are one paragraph: (doc_id, item, text, items).

    Character widths differ by at most `width`, left sides by `align` characters, the vertical gap is at most `gap`
    lines, the upper line is full to `full` characters, has no stop sign, and the lower begins with no digit or
    capital. A hyphen at the seam goes.
    """
    w = Window.partitionBy("doc_id").orderBy("page_no", "position")
    cw = (F.col("box.r") - F.col("box.l")) / F.greatest(F.length("text"), F.lit(1))
    x = items.withColumns({"cw": cw, "h": F.col("box.b") - F.col("box.t")})
    p = {c: F.lag(c).over(w) for c in ("text", "label", "page_no", "box", "cw", "h")}
    widest = F.max("box.r").over(Window.partitionBy("doc_id", "page_no"))
    x = x.withColumns({f"p_{k}": v for k, v in p.items()} | {"widest": widest})
    same = (
        (F.col("label") == "text") & (F.col("p_label") == "text") & (F.col("page_no") == F.col("p_page_no"))
        & (F.abs(F.col("cw") - F.col("p_cw")) <= width * F.greatest("cw", "p_cw"))
        & (F.abs(F.col("box.l") - F.col("p_box.l")) <= align * F.col("cw"))
        & (F.col("box.t") - F.col("p_box.b") <= gap * F.col("h"))
        & (F.col("widest") - F.col("p_box.r") < full * F.col("cw"))
        & ~F.col("p_text").rlike(r"[.!?:;]\s*$") & ~F.col("text").rlike(r"^\s*[\p{Nd}\p{Lu}]")
    )
    x = x.withColumn("paragraph", F.sum(F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).over(w))
    g = x.groupBy("doc_id", "paragraph").agg(F.array_sort(F.collect_list(F.struct("page_no", "position", "item", "text"))).alias("s"))
    seam = F.aggregate("s", F.lit(""), lambda a, y: F.when(a == "", y["text"]).when(a.rlike(r"\p{L}-$"), F.concat(F.substring(a, F.lit(1), F.length(a) - 1), y["text"])).otherwise(F.concat(a, F.lit(" "), y["text"])))
    return g.select("doc_id", F.col("s")[0]["item"].alias("item"), seam.alias("text"), F.size("s").alias("items"))


def tag_page_numbers(items: DataFrame) -> DataFrame:
    """Adds `is_page_number`: the first or last text of a page that is a number, alone or in one of the wordings of some
    fifty languages. Tables and pictures are no texts; list items, captions and formulas are never page numbers.
    """
    text = ~F.col("label").isin("table", "picture")
    w = Window.partitionBy(*PAGE)
    edge = text & ((F.col("position") == F.min(F.when(text, F.col("position"))).over(w)) | (F.col("position") == F.max(F.when(text, F.col("position"))).over(w)))
    valid = F.col("label").isin("title", "footnote", "text", "section_header", "heading")
    return items.withColumn("is_page_number", F.coalesce(edge & valid & F.regexp_replace("text", r"(?U)^\s+|\s+$", "").rlike("(?iuU)" + fixed.page_number_pattern()), F.lit(False)))


def list_marker(items: DataFrame) -> DataFrame:
    """Adds marker and body of list items: bullets, numbers, letters and roman numerals; a lone marker takes the next text."""
    m = F.regexp_extract("text", r"^\s*([-*•·–]|\(?(?:\d{1,3}|[ivxlcIVXLC]{1,6}|[A-Za-z])[.)])(?:\s+|$)", 1)
    w = Window.partitionBy("doc_id").orderBy("page_no", "position")
    body = F.regexp_replace("text", r"^\s*(?:[-*•·–]|\(?(?:\d{1,3}|[ivxlcIVXLC]{1,6}|[A-Za-z])[.)])(?:\s+|$)", "")
    x = items.withColumns({"marker": F.nullif(m, F.lit("")), "body": body})
    lone = F.col("marker").isNotNull() & (F.col("body") == "")
    x = x.withColumns({"lone": lone, "next_body": F.lead("body").over(w), "after_lone": F.coalesce(F.lag(lone).over(w), F.lit(False))})
    return x.where(~F.col("after_lone") | F.col("marker").isNotNull()).withColumn("body", F.when(F.col("lone"), F.coalesce("next_body", F.lit(""))).otherwise(F.col("body"))).drop("lone", "next_body", "after_lone")


def match_table_cells(table_cells: DataFrame, cells: DataFrame, least_iou: float | None = None) -> DataFrame:
    """(doc_id, page_no, cell, matches): table cells that a page cell meets, with the part of it that they share."""
    j = table_cells.select(*PAGE, F.col("cell").alias("table_cell"), F.col("box").alias("t")).join(cells.select(*PAGE, "cell", F.col("box").alias("c")), PAGE)
    s, i = R.share_inside(F.col("c"), F.col("t")), R.iou(F.col("c"), F.col("t"))
    x = j.withColumns({"share": s, "iou": i}).where(F.col("share") > 0 if least_iou is None else F.col("iou") >= least_iou)
    return x.groupBy(*PAGE, "cell").agg(F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("less"), "table_cell", "share"))).alias("m")).select(*PAGE, "cell", F.transform("m", lambda v: F.struct(v["table_cell"], F.round(v["share"], 6).alias("share"))).alias("matches"))
