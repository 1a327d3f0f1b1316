"""Node tables: walks, edits, checks, serialisation and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = "doc_id"


def _by_doc() -> Window:
    return Window.partitionBy(KEY).orderBy("seq")


def body(nodes: DataFrame, layers: tuple[str, ...] = ("body",)) -> DataFrame:
    """Nodes of the given layers, without what hangs under a picture."""
    if "in_picture" in nodes.columns:  # told by the parser
        return nodes.where(F.col("layer").isin(*layers) & ~F.col("in_picture"))
    p = nodes.where("kind = 'picture'").select(KEY, F.col("node_id").alias("parent_id"))
    keep = nodes.where(F.col("layer").isin(*layers))
    return keep.join(p, [KEY, "parent_id"], "left_anti").select(nodes.columns)


def broken(nodes: DataFrame) -> DataFrame:
    """(doc_id, node_id, fault): parents that don't exist or come later, and ids that stand twice."""
    p = nodes.select(KEY, F.col("node_id").alias("parent_id"), F.lit(True).alias("there")).dropDuplicates([KEY, "parent_id"])
    a = nodes.where("parent_id IS NOT NULL").join(p, [KEY, "parent_id"], "left").where(F.col("there").isNull() | (F.col("parent_id") >= F.col("node_id")))
    b = nodes.groupBy(KEY, "node_id").agg(F.count("*").alias("n")).where("n > 1")
    return a.select(KEY, "node_id", F.lit("parent").alias("fault")).union(b.select(KEY, "node_id", F.lit("repeated").alias("fault")))


def without(nodes: DataFrame, gone: DataFrame) -> DataFrame:
    """Nodes without the given ones and all under them, at any depth; seq closes up.

    A document's tree is walked in one fold: nodes come after their parents, so that a node goes where it is named or
    its parent has gone. A document is one group, which its own length bounds; repeated ids are told apart by seq.
    """
    named = gone.select(KEY, "node_id").distinct().withColumn("named", F.lit(True))
    marks = nodes.select(KEY, "node_id", "parent_id").join(named, [KEY, "node_id"], "left")
    g = marks.groupBy(KEY).agg(F.array_sort(F.collect_list(F.struct("node_id", "parent_id", F.coalesce("named", F.lit(False)).alias("named")))).alias("t"))
    drop = F.aggregate("t", F.array().cast("array<int>"), lambda a, x: F.when(x["named"] | F.coalesce(F.array_contains(a, x["parent_id"]), F.lit(False)), F.concat(a, F.array(x["node_id"].cast("int")))).otherwise(a))
    out = g.where(F.exists("t", lambda x: x["named"])).select(KEY, F.explode(drop).alias("node_id")).distinct()
    kept = nodes.join(out, [KEY, "node_id"], "left_anti")
    return kept.withColumn("seq", F.row_number().over(_by_doc()) - 1).select(nodes.columns)


def pipe_table(rows: Column) -> Column:
    """A table's cells as a pipe table, line ends as blanks."""
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"\n", " ")), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), F.size(rows[0])))
    return F.when(F.size(rows) > 0, F.concat_ws("\n", F.concat(F.array(line(rows[0]), rule), F.transform(F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))), line)))).otherwise("")


def triplets(rows: Column) -> Column:
    """A table as sentences `row, column = value`, the first row and column as names."""
    head = rows[0]
    one = lambda r: F.array_join(F.transform(F.slice(r, F.lit(2), F.greatest(F.size(r) - 1, F.lit(0))), lambda c, i: F.concat(r[0], F.lit(", "), F.get(head, i + 1), F.lit(" = "), c)), ". ")
    return F.array_join(F.transform(F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))), one), ". ")


def _depth(nodes: DataFrame) -> DataFrame:
    """Adds `depth`, how many lists are above an item's own, where the parser did not tell: level by level within a document."""
    if "depth" in nodes.columns:
        return nodes
    chain = nodes.where("kind = 'list'").groupBy(KEY).agg(F.map_from_entries(F.collect_list(F.struct("node_id", F.coalesce("parent_id", F.lit(-1))))).alias("lists"))
    # lists come before what they hold: the walk up is one fold over the lists in falling order
    order = F.reverse(F.array_sort(F.map_keys("lists")))
    up = F.aggregate(order, F.struct(F.col("parent_id").alias("at"), F.lit(0).alias("n")), lambda a, x: F.when(a["at"] == x, F.struct(F.try_element_at(F.col("lists"), x).alias("at"), (a["n"] + 1).alias("n"))).otherwise(a))
    return nodes.join(chain, KEY, "left").withColumn("depth", F.coalesce(F.greatest(up["n"] - 1, F.lit(0)), F.lit(0))).drop("lists")


def serialised(nodes: DataFrame, style: str = "markdown") -> DataFrame:
    """(doc_id, text): nodes in order as markdown, plain (tags around tables and pictures), html or doctags."""
    x = _depth(body(nodes))
    t = F.coalesce("text", F.lit(""))
    if style == "markdown":
        piece = (
            F.when(F.col("kind") == "title", F.concat(F.lit("# "), t))
            .when(F.col("kind") == "heading", F.concat(F.repeat(F.lit("#"), F.coalesce("level", F.lit(1)) + 1), F.lit(" "), t))
            .when(F.col("kind") == "item", F.concat(F.repeat(F.lit("    "), F.col("depth")), F.coalesce("marker", F.lit("-")), F.lit(" "), t))
            .when(F.col("kind") == "code", F.concat(F.lit("```\n"), t, F.lit("\n```")))
            .when(F.col("kind") == "table", pipe_table(F.col("rows")))
            .when(F.col("kind") == "picture", F.lit("<!-- image -->"))
            .otherwise(t)
        )
    elif style == "plain":
        letters = F.length(F.regexp_replace(t, r"[^\p{L}]", "")) / F.greatest(F.length(t), F.lit(1))
        tag = F.when(letters < 0.4, "docling_picture_annotation_non_text").otherwise("docling_picture_annotation")
        piece = (
            F.when(F.col("kind") == "table", F.concat(F.lit("<docling_table>"), pipe_table(F.col("rows")), F.lit("</docling_table>")))
            .when((F.col("kind") == "picture") & (t != ""), F.concat(F.lit("<"), tag, F.lit(">"), t, F.lit("</"), tag, F.lit(">")))
            .when(F.col("kind") == "item", F.concat_ws(" ", "marker", t))
            .otherwise(t)
        )
    else:
        e = F.replace(F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        cells = F.array_join(F.transform("rows", lambda r: F.concat(F.lit("<tr><td>"), F.array_join(F.transform(r, lambda c: F.coalesce(c, F.lit(""))), "</td><td>"), F.lit("</td></tr>"))), "")
        wrap = lambda a, b=e: F.concat(F.lit("<"), a, F.lit(">"), b, F.lit("</"), a, F.lit(">"))
        if style == "html":
            piece = F.when(F.col("kind") == "title", wrap(F.lit("h1"))).when(F.col("kind") == "heading", wrap(F.concat(F.lit("h"), (F.coalesce("level", F.lit(1)) + 1).cast("string")))).when(F.col("kind") == "item", wrap(F.lit("li"))).when(F.col("kind") == "code", wrap(F.lit("pre"))).when(F.col("kind") == "table", wrap(F.lit("table"), cells)).when(F.col("kind") == "picture", F.lit("<figure></figure>")).otherwise(wrap(F.lit("p")))
        else:
            otsl = F.concat(F.array_join(F.transform("rows", lambda r, i: F.concat(F.array_join(F.transform(r, lambda c: F.concat(F.when(i == 0, "<ched>").when(c == "", "<ecel>").otherwise("<fcel>"), F.coalesce(c, F.lit("")))), ""), F.lit("<nl>"))), ""))
            name = F.when(F.col("kind") == "heading", F.concat(F.lit("section_header_level_"), F.coalesce("level", F.lit(1)).cast("string"))).when(F.col("kind") == "item", "list_item").when(F.col("kind") == "table", "otsl").otherwise(F.col("kind"))
            piece = F.when(F.col("kind") == "table", wrap(F.lit("otsl"), otsl)).otherwise(wrap(name))
    s = x.where(~F.col("kind").isin("list", "group")).select(KEY, "seq", piece.alias("p")).where("p <> ''")
    g = s.groupBy(KEY).agg(F.array_sort(F.collect_list(F.struct("seq", "p"))).alias("s"))
    return g.select(KEY, F.array_join(F.transform("s", lambda v: v["p"]), "\n" if style in ("html", "doctags") else "\n\n").alias("text"))


def hierarchical_chunks(nodes: DataFrame) -> DataFrame:
    """(doc_id, chunk, headings, text): one for each item, a list's items together, under the headings in scope.

    A heading is in scope until one of its level or above follows; the last of each level by a window tells.
    """
    x = body(nodes).withColumn("lv", F.when(F.col("kind") == "title", 0).when(F.col("kind") == "heading", F.coalesce("level", F.lit(1))))
    w = _by_doc().rowsBetween(Window.unboundedPreceding, 0)
    deepest = 6
    for k in range(deepest + 1):
        x = x.withColumns({f"h{k}": F.last(F.when(F.col("lv") == k, F.struct("seq", "text")), ignorenulls=True).over(w)})
    scope = []
    for k in range(deepest + 1):
        over = [F.coalesce(F.col(f"h{j}.seq"), F.lit(-1)) for j in range(k)]
        alive = F.col(f"h{k}").isNotNull() & (F.col(f"h{k}.seq") > F.greatest(F.lit(-1), *(over or [F.lit(-1)])))
        scope.append(F.when(alive, F.col(f"h{k}.text")))
    x = x.withColumn("headings", F.filter(F.array(*scope), lambda h: h.isNotNull()))
    text = F.when(F.col("kind") == "table", triplets(F.col("rows"))).when(F.col("kind") == "item", F.concat_ws(" ", "marker", "text")).otherwise(F.col("text"))
    unit = F.when(F.col("kind") == "item", F.col("parent_id")).otherwise(F.col("node_id"))
    y = x.where(~F.col("kind").isin("title", "heading", "list", "group")).select(KEY, "seq", unit.alias("unit"), "headings", text.alias("t")).where("t <> ''")
    g = y.groupBy(KEY, "unit").agg(F.min("seq").alias("at"), F.first("headings").alias("headings"), F.array_sort(F.collect_list(F.struct("seq", "t"))).alias("s"))
    return g.select(KEY, F.row_number().over(Window.partitionBy(KEY).orderBy("at")).alias("chunk"), "headings", F.array_join(F.transform("s", lambda v: v["t"]), "\n").alias("text"))


def hybrid_chunks(nodes: DataFrame, most_tokens: int = 256) -> DataFrame:
    """(doc_id, chunk, headings, text, tokens): hierarchical chunks, the long ones split by words, equal neighbours under the same headings merged while they fit.

    Tokens are words here. A chunk that was split isn't merged again.
    """
    h = hierarchical_chunks(nodes)
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    n = F.greatest(F.ceil(F.size(words) / most_tokens), F.lit(1)).cast("int")
    part = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(n == 1, F.col("text")).otherwise(F.array_join(F.slice(words, i * most_tokens + 1, F.lit(most_tokens)), " ")))
    p = h.select(KEY, "chunk", "headings", F.posexplode(part).alias("part", "text"), (n > 1).alias("split")).withColumn("tokens", F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")))
    g = p.groupBy(KEY).agg(F.array_sort(F.collect_list(F.struct("chunk", "part", "headings", "text", "tokens", "split"))).alias("s"))
    kind = "array<struct<headings:array<string>,text:string,tokens:int,split:boolean>>"

    def fold(a, c):
        last = F.try_element_at(a, F.lit(-1))
        fits = last.isNotNull() & (last["headings"] == c["headings"]) & ~last["split"] & ~c["split"] & (last["tokens"] + c["tokens"] <= most_tokens)
        new = F.struct(c["headings"].alias("headings"), c["text"].alias("text"), c["tokens"].alias("tokens"), c["split"].alias("split"))
        both = F.struct(c["headings"].alias("headings"), F.concat(last["text"], F.lit("\n"), c["text"]).alias("text"), (last["tokens"] + c["tokens"]).alias("tokens"), F.lit(False).alias("split"))
        return F.when(F.coalesce(fits, F.lit(False)), F.concat(F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))), F.array(both))).otherwise(F.concat(a, F.array(new))).cast(kind)

    m = g.select(KEY, F.aggregate("s", F.array().cast(kind), fold).alias("m"))
    return m.select(KEY, F.posexplode("m").alias("i", "c")).select(KEY, (F.col("i") + 1).alias("chunk"), "c.headings", "c.text", "c.tokens")


def contextualised(chunks: DataFrame) -> DataFrame:
    """Adds `context`: headings and text, one to a line."""
    return chunks.withColumn("context", F.concat_ws("\n", "headings", "text"))


def page_breaks(nodes: DataFrame) -> DataFrame:
    """Adds `new_page`: whether a node's page is beyond that of the node before it; needs page_no."""
    return nodes.withColumn("new_page", F.coalesce(F.col("page_no") > F.lag("page_no").over(_by_doc()), F.lit(False)))
