"""Queries over page layout, document trees and measures, on structures derived from the texts of the tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import fixed
from quire.functions import records as R
from quire.functions import text as TX
from quire.operators import corpus as C
from quire.operators import evaluation as E
from quire.operators import extract as T
from quire.operators import layout as L
from quire.operators import tree as X
from quire.plans.corpus import PAGES
from quire.session import table
from quire.sources import formats as S

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def _box(l, t, r, b):
    return F.struct(*[x.cast("double").alias(n) for x, n in ((l, "l"), (t, "t"), (r, "r"), (b, "b"))])


def cells(spark, d):
    """Lines of the pages as cells: six units a character, twelve a line."""
    x = C.page_rows(table(spark, d, "documents")).select("doc_id", F.col("page_no").cast("int").alias("page_no"), F.posexplode(F.split("text", "\n")).alias("i", "text")).where(F.length(F.trim("text")) > 0)
    left = (F.length("text") - F.length(F.ltrim("text"))) * 6 + 50
    return x.select("doc_id", "page_no", F.col("i").cast("bigint").alias("cell"), "text", _box(left, F.col("i") * 12, F.lit(50) + F.length("text") * 6, F.col("i") * 12 + 10).alias("box"))


def clusters(spark, d):
    """Three lines each as a cluster whose box leaves the edges of its first line out."""
    x = cells(spark, d).withColumn("cluster", F.expr("cell div 3"))
    g = x.groupBy("doc_id", "page_no", "cluster").agg(F.min_by("text", "cell").alias("first"), F.min("box.l").alias("l"), F.min("box.t").alias("t"), F.max("box.r").alias("r"), F.max("box.b").alias("b"))
    label = F.when(F.col("first").startswith("|"), "table").when(F.col("first").rlike(r"^\s*[-*•]"), "list_item").when(F.col("first").startswith("#"), "title").otherwise("text")
    return g.select("doc_id", "page_no", "cluster", label.alias("label"), (F.lit(0.3) + (F.col("cluster") * 7 % 70) / 100).alias("confidence"), _box(F.col("l") + 2, F.col("t") + 4, F.col("r"), F.col("b") - 1).alias("box"))


def _items(spark, d):
    return cells(spark, d).select("doc_id", "page_no", F.col("cell").alias("item"), F.when(F.col("text").startswith("|"), "table").when(F.col("text").rlike(r"^\s*[-*•]"), "list_item").when(F.col("text").rlike(r"^\s*(?:Table|Figure|Abbildung|Tabelle)\b"), "caption").otherwise("text").alias("label"), "text", "box", F.col("cell").alias("position"))


_CELLS = f"(SELECT doc_id, page_no, i - 1 AS cell, line AS text, (length(line) - length(ltrim(line, ' '))) * 6 + 50 AS l, (i - 1) * 12 AS t, 50 + length(line) * 6 AS r, (i - 1) * 12 + 10 AS b FROM (SELECT doc_id, page_no, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM {PAGES}) WHERE length(trim(line, ' ')) > 0)"
_CLUSTERS = f"(SELECT doc_id, page_no, cell // 3 AS cluster, arg_min(text, cell) AS first, min(l) + 2 AS l, min(t) + 4 AS t, max(r) AS r, max(b) - 1 AS b FROM {_CELLS} GROUP BY doc_id, page_no, cell // 3)"
_ITEMS = f"(SELECT doc_id, page_no, cell AS item, CASE WHEN starts_with(text, '|') THEN 'table' WHEN regexp_matches(text, '^\\s*[-*•]') THEN 'list_item' WHEN regexp_matches(text, '^\\s*(?:Table|Figure|Abbildung|Tabelle)\\b') THEN 'caption' ELSE 'text' END AS label, text, l, t, r, b FROM {_CELLS})"
_ASSIGNED = f"(SELECT doc_id, page_no, cell, cluster, share FROM (SELECT c.doc_id, c.page_no, c.cell, k.cluster, greatest(least(c.r, k.r) - greatest(c.l, k.l), 0) * greatest(least(c.b, k.b) - greatest(c.t, k.t), 0) / nullif((c.r - c.l) * (c.b - c.t), 0) AS share, row_number() OVER (PARTITION BY c.doc_id, c.page_no, c.cell ORDER BY greatest(least(c.r, k.r) - greatest(c.l, k.l), 0) * greatest(least(c.b, k.b) - greatest(c.t, k.t), 0) / nullif((c.r - c.l) * (c.b - c.t), 0) DESC, k.cluster) AS rn FROM {_CELLS} c JOIN {_CLUSTERS} k ON k.doc_id = c.doc_id AND k.page_no = c.page_no AND c.l < k.r AND k.l < c.r AND c.t < k.b AND k.t < c.b) WHERE rn = 1 AND share > 0.2)"


@query(f"SELECT doc_id, page_no, cell, cluster, round(share, 6) AS share FROM {_ASSIGNED}")
def cell_assignment(spark, d):
    return L.assign_cells(cells(spark, d), clusters(spark, d)).withColumn("share", F.round("share", 6))


@query(f"SELECT c.doc_id, c.page_no, c.cell AS cluster FROM {_CELLS} c WHERE NOT EXISTS (SELECT 1 FROM {_ASSIGNED} a WHERE a.doc_id = c.doc_id AND a.page_no = c.page_no AND a.cell = c.cell)")
def orphan_cells(spark, d):
    c = cells(spark, d)
    return L.orphans(c, L.assign_cells(c, clusters(spark, d))).select("doc_id", "page_no", "cluster")


@query(f"SELECT doc_id, page_no, cluster FROM {_CLUSTERS} WHERE 0.3 + (cluster * 7 % 70) / 100 >= CASE WHEN starts_with(first, '|') THEN 0.5 WHEN regexp_matches(first, '^\\s*[-*•]') THEN 0.5 WHEN starts_with(first, '#') THEN 0.45 ELSE 0.5 END")
def confident_clusters(spark, d):
    return L.confident(clusters(spark, d)).select("doc_id", "page_no", "cluster")


@query(f"SELECT k.doc_id, k.page_no, k.cluster, CAST(min(CASE WHEN starts_with(k.first, '|') THEN least(k.l, c.l) ELSE c.l END) AS DOUBLE) AS l, CAST(max(CASE WHEN starts_with(k.first, '|') THEN greatest(k.b, c.b) ELSE c.b END) AS DOUBLE) AS b FROM {_CLUSTERS} k JOIN {_ASSIGNED} a ON a.doc_id = k.doc_id AND a.page_no = k.page_no AND a.cluster = k.cluster JOIN {_CELLS} c ON c.doc_id = a.doc_id AND c.page_no = a.page_no AND c.cell = a.cell GROUP BY k.doc_id, k.page_no, k.cluster")
def fitted_boxes(spark, d):
    c, k = cells(spark, d), clusters(spark, d)
    a = L.assign_cells(c, k)
    return L.fitted(k, c, a).join(a.select("doc_id", "page_no", "cluster").distinct(), ["doc_id", "page_no", "cluster"], "left_semi").select("doc_id", "page_no", "cluster", "box.l", "box.b")


@query(f"SELECT doc_id, page_no, cluster, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY t, l, cluster) AS position FROM {_CLUSTERS}")
def ordered_clusters(spark, d):
    c, k = cells(spark, d), clusters(spark, d)
    return L.in_order(k, L.assign_cells(c, k), "tblr").select("doc_id", "page_no", "cluster", F.col("position").cast("bigint").alias("position"))


@query()
def without_overlaps(spark, d):
    k = clusters(spark, d)
    wide = k.withColumns({"cluster": F.col("cluster") + 1000000, "confidence": F.col("confidence") / 2, "box": _box(F.col("box.l") - 1, F.col("box.t") - 1, F.col("box.r") + 1, F.col("box.b") + 1)})
    return L.without_overlaps(k.unionByName(wide)).select("doc_id", "page_no", "cluster")


@query(f"SELECT doc_id, page_no, arg_max(parent, share) AS parent, child FROM (SELECT p.doc_id, p.page_no, p.cluster AS parent, c.cluster AS child, greatest(least(c.r, p.r) - greatest(c.l, p.l), 0) * greatest(least(c.b, p.b) - greatest(c.t, p.t), 0) / nullif(greatest(c.r - c.l, 0) * greatest(c.b - c.t, 0), 0) AS share FROM {_CLUSTERS} p JOIN (SELECT doc_id, page_no, cluster, l, t, r, b FROM {_CLUSTERS} WHERE NOT starts_with(first, '|') UNION ALL SELECT doc_id, page_no, cluster + 1000000, l + 1, t + 1, r - 1, b - 1 FROM {_CLUSTERS} WHERE starts_with(first, '|')) c ON c.doc_id = p.doc_id AND c.page_no = p.page_no WHERE starts_with(p.first, '|')) WHERE share > 0.8 GROUP BY doc_id, page_no, child")
def nested_clusters(spark, d):
    k = clusters(spark, d)
    t = k.where("label = 'table'").withColumns({"cluster": F.col("cluster") + 1000000, "label": F.lit("text"), "box": _box(F.col("box.l") + 1, F.col("box.t") + 1, F.col("box.r") - 1, F.col("box.b") - 1)})
    return L.inside(k.unionByName(t))


@query()
def reading_order(spark, d):
    return L.reading_order(clusters(spark, d).select("doc_id", "page_no", F.col("cluster").alias("item"), "label", "box"))


@query("WITH i AS (SELECT doc_id, page_no, cell, CASE WHEN starts_with(text, '|') THEN 'table' WHEN regexp_matches(text, '^\\s*[-*•]') THEN 'list_item' WHEN regexp_matches(text, '^\\s*(?:Table|Figure|Abbildung|Tabelle)\\b') THEN 'caption' ELSE 'text' END AS label, text FROM " + _CELLS + "), n AS (SELECT *, lead(text) OVER w AS nt, lead(cell) OVER w AS ni, lead(label) OVER w AS nl FROM i WINDOW w AS (PARTITION BY doc_id ORDER BY page_no, cell)) SELECT doc_id, cell AS item, ni AS next_item FROM n WHERE label = 'text' AND nl = 'text' AND regexp_matches(text, '[\\p{Ll},-]\\s*$') AND regexp_matches(nt, '^\\s*\\p{Ll}')")
def continued_texts(spark, d):
    return L.continued(_items(spark, d))


@query(f"SELECT doc_id, item AS caption, CASE WHEN nl IN ('table', 'picture', 'code') THEN ni WHEN pl IN ('table', 'picture', 'code') THEN pi END AS target FROM (SELECT *, lead(label) OVER w AS nl, lead(item) OVER w AS ni, lag(label) OVER w AS pl, lag(item) OVER w AS pi FROM {_ITEMS} WINDOW w AS (PARTITION BY doc_id ORDER BY page_no, item)) WHERE label = 'caption' AND (nl IN ('table', 'picture', 'code') OR pl IN ('table', 'picture', 'code'))")
def captions(spark, d):
    return L.captions(_items(spark, d))


@query(f"WITH i AS (SELECT *, CASE WHEN regexp_matches(text, '^\\s*\\*') THEN 'footnote' ELSE label END AS k FROM {_ITEMS}), g AS (SELECT *, sum(CASE WHEN k <> 'footnote' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY page_no, item) AS run FROM i) SELECT f.doc_id, f.item AS footnote, h.item AS target FROM g f JOIN g h ON h.doc_id = f.doc_id AND h.run = f.run AND h.k IN ('table', 'picture') WHERE f.k = 'footnote'")
def footnotes(spark, d):
    i = _items(spark, d)
    return L.footnotes(i.withColumn("label", F.when(F.col("text").rlike(r"^\s*\*"), "footnote").otherwise(F.col("label"))))


@query()
def merged_cells(spark, d):
    c = cells(spark, d).select("doc_id", "page_no", "cell", F.posexplode(F.split("text", "(?<=,) ")).alias("k", "text"), "box")
    w = Window.partitionBy("doc_id", "page_no", "cell").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    left = F.coalesce(F.sum(F.length("text") + 1).over(w), F.lit(0)) * 6 + F.col("box.l")
    x = c.select("doc_id", "page_no", (F.col("cell") * 1000 + F.col("k")).alias("cell"), F.lit("text").alias("label"), "text", _box(left, F.col("box.t"), left + F.length("text") * 6, F.col("box.b")).alias("box"))
    return L.merge_cells(x)


@query()
def merged_paragraphs(spark, d):
    return L.merge_paragraphs(_items(spark, d))


def _page_number_sql() -> str:
    """Each wording on its own, in the words of the rule rather than as one pattern."""
    n, forms = "(0|[1-9][0-9]{0,3})", []
    for f in fixed.PAGE_FORMS:
        forms.append("\\s*".join(f.replace(".", "\\.").replace("#", n).split(" ")))
    for w, between in fixed.page_words().items():
        gap = "\\s*" if len(w) <= 2 or w.islower() else "\\s+"
        forms += [f"{w}{gap}{n}", f"{w}{gap}{n}\\s*/\\s*{n}", f"{w}{gap}{n}\\s*{n}[a-z/]{n}", f"{w}:\\s*{n}", f"{w}:\\s*{n}\\s*/\\s*{n}"] + [f"{w}{gap}{n}\\s+{b}\\s+{n}" for b in sorted(between)]
    return " OR ".join("regexp_full_match(x, '(?i)(" + "|".join(forms[i : i + 60]).replace("'", "''") + ")')" for i in range(0, len(forms), 60))


@query(f"SELECT doc_id, page_no, item FROM (SELECT *, trim(text, ' ' || chr(9) || chr(13)) AS x, min(item) FILTER (label <> 'table') OVER w AS a, max(item) FILTER (label <> 'table') OVER w AS z FROM {_ITEMS} WINDOW w AS (PARTITION BY doc_id, page_no)) WHERE item IN (a, z) AND label = 'text' AND ({_page_number_sql()})")
def page_number_items(spark, d):
    return L.tag_page_numbers(_items(spark, d)).where("is_page_number").select("doc_id", "page_no", "item")


_BULLET = "|".join(f"\\s*[{c}-](?:\\s+{c})*" for c in "‣⁃►▶▸➤➢›▪▫●○")


@query(f"SELECT doc_id, page_no, item, CASE WHEN label = 'list_item' THEN regexp_replace(t, '^([^\\s]*)\\s+', '\\1 ') ELSE t END AS text FROM (SELECT doc_id, page_no, item, label, regexp_replace(regexp_replace(regexp_replace(text, '^\\s*[✓✔✗✘]', '[x]'), '^\\s*[•·°◌∙◦●]', '*'), '^({_BULLET})', '-') AS t FROM {_ITEMS})")
def unify_list_marks(spark, d):
    return _items(spark, d).select("doc_id", "page_no", "item", TX.unify_list_marks(F.col("text"), F.col("label") == "list_item").alias("text"))


_MARK = "(?:[-*•·–]|\\(?(?:\\d{1,3}|[ivxlcIVXLC]{1,6}|[A-Za-z])[.)])"


@query(f"SELECT doc_id, page_no, item, marker, CASE WHEN lone THEN coalesce(nb, '') ELSE body END AS body FROM (SELECT *, marker IS NOT NULL AND body = '' AS lone, lead(body) OVER w AS nb, coalesce(lag(marker IS NOT NULL AND body = '') OVER w, false) AS after FROM (SELECT doc_id, page_no, item, nullif(regexp_extract(text, '^\\s*({_MARK})(?:\\s+|$)', 1), '') AS marker, regexp_replace(text, '^\\s*{_MARK}(?:\\s+|$)', '') AS body FROM {_ITEMS} WHERE label = 'list_item') WINDOW w AS (PARTITION BY doc_id ORDER BY page_no, item)) WHERE NOT after OR marker IS NOT NULL")
def list_markers(spark, d):
    return L.list_marker(_items(spark, d).where("label = 'list_item'")).select("doc_id", "page_no", "item", "marker", "body")


@query(f"SELECT doc_id, page_no, cell, list({{'table_cell': tc, 'share': round(share, 6)}} ORDER BY share DESC, tc) AS matches FROM (SELECT c.doc_id, c.page_no, c.cell, k.cluster AS tc, greatest(least(c.r, k.r) - greatest(c.l, k.l), 0) * greatest(least(c.b, k.b) - greatest(c.t, k.t), 0) / nullif((c.r - c.l) * (c.b - c.t), 0) AS share FROM {_CELLS} c JOIN {_CLUSTERS} k ON k.doc_id = c.doc_id AND k.page_no = c.page_no WHERE starts_with(k.first, '|')) WHERE share > 0 GROUP BY doc_id, page_no, cell")
def table_cell_matches(spark, d):
    k = clusters(spark, d).where("label = 'table'").select("doc_id", "page_no", F.col("cluster").alias("cell"), "box")
    return L.match_table_cells(k, cells(spark, d))


@query("SELECT doc_id, page_no, CAST(greatest(floor(w * z / 28), 1) * 28 AS INT) AS width FROM (SELECT doc_id, page_no, 600.0 + alpha_bytes % 300 AS w, 1280.0 / greatest(600.0 + alpha_bytes % 300, 800.0) AS z FROM page_lid WHERE alpha_bytes IS NOT NULL)")
def render_sizes(spark, d):
    p = table(spark, d, "page_lid").where("alpha_bytes IS NOT NULL")
    return p.select("doc_id", "page_no", R.render_size(F.lit(600.0) + F.col("alpha_bytes") % 300, F.lit(800.0))["width"].alias("width"))


@query("SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 AND b.label = a.label")
def neighbour_labels(spark, d):
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("a"), "label").join(e.select((F.col("vec_id") - 1).alias("a"), F.col("vec_id").alias("b"), "label"), ["a", "label"]).select("a", "b")


# trees: the documents read as Markdown


def _nodes(spark, d):
    return S.nodes(table(spark, d, "documents").select("doc_id", F.col("text").alias("content")), "markdown")


@query()
def markdown_nodes(spark, d):
    return _nodes(spark, d)


@query("SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^#{1,6}\\s+'))) AS BIGINT) AS headings FROM documents WHERE text IS NOT NULL AND len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^#{1,6}\\s+'))) > 0")
def heading_counts(spark, d):
    return _nodes(spark, d).where("kind IN ('title', 'heading')").groupBy("doc_id").agg(F.count("*").alias("headings"))


@query()
def html_nodes(spark, d):
    t = X.serialised(_nodes(spark, d), "html")
    return S.nodes(t.select("doc_id", F.concat(F.lit("<html><body>"), "text", F.lit("</body></html>")).alias("content")), "html")


@query()
def broken_trees(spark, d):
    return X.broken(_nodes(spark, d))


@query()
def trees_without_lists(spark, d):
    n = _nodes(spark, d)
    return X.without(n, n.where("kind = 'list'")).select("doc_id", "node_id", "seq", "kind")


@query()
def markdown_text(spark, d):
    return X.serialised(_nodes(spark, d), "markdown")


@query()
def plain_text(spark, d):
    return X.serialised(_nodes(spark, d), "plain")


@query()
def html_text(spark, d):
    return X.serialised(_nodes(spark, d), "html")


@query()
def doctags_text(spark, d):
    return X.serialised(_nodes(spark, d), "doctags")


@query()
def hier_chunks(spark, d):
    return X.hierarchical_chunks(_nodes(spark, d))


@query()
def hybrid_chunks(spark, d):
    return X.contextualised(X.hybrid_chunks(_nodes(spark, d)))


@query()
def table_triplets(spark, d):
    return _nodes(spark, d).where("kind = 'table'").select("doc_id", "node_id", X.triplets(F.col("rows")).alias("text"))


@query()
def table_structure_score(spark, d):
    t = _nodes(spark, d).where("kind = 'table' AND size(rows) >= 2").select("doc_id", "node_id", "rows", F.slice("rows", F.lit(1), F.size("rows") - 1).alias("guess"))
    u = F.udf(lambda a, b: round(E.teds(a, b), 6), "double", useArrow=True)
    return t.select("doc_id", "node_id", u("rows", "guess").alias("teds"))


@query()
def sniffed_formats(spark, d):
    return table(spark, d, "documents").select("doc_id", S.sniff(F.col("file_path"), F.coalesce(F.substring("text", 1, 400), F.lit(""))).alias("format"))


# measures


@query("WITH w AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(lower(coalesce(passage, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS a, list_distinct(list_filter(regexp_split_to_array(lower(coalesce(task_line, '') || ' the of'), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS b FROM eval_items), n AS (SELECT item_id, len(list_intersect(a, b)) AS n, len(a) AS na, len(b) AS nb FROM w) SELECT item_id, round(coalesce(n / nullif(nb, 0), 0), 6) AS \"precision\", round(coalesce(n / nullif(na, 0), 0), 6) AS recall, round(CASE WHEN n = 0 THEN 0 ELSE 2 * (n / nb) * (n / na) / (n / nb + n / na) END, 6) AS f1 FROM n")
def text_overlap(spark, d):
    x = table(spark, d, "eval_items").select("item_id", E.token_overlap(F.col("passage"), F.concat(F.coalesce("task_line", F.lit("")), F.lit(" the of"))).alias("x"))
    return x.select("item_id", F.round("x.precision", 6).alias("precision"), F.round("x.recall", 6).alias("recall"), F.round("x.f1", 6).alias("f1"))


@query()
def text_similarity(spark, d):
    i = table(spark, d, "eval_items").where("passage IS NOT NULL")
    other = F.regexp_replace("passage", r" (\w+) ", " x$1 ")
    return i.select("item_id", F.udf(E.edit_similarity, "double", useArrow=True)("passage", other).alias("edit"), F.udf(E.bleu, "double", useArrow=True)("passage", other).alias("bleu"))


_ORDER = "(SELECT doc_id, CAST(page_no AS BIGINT) AS item, page_no AS truth, coalesce(max(alpha_bytes), 0) AS guess FROM page_lid WHERE page_no IS NOT NULL GROUP BY doc_id, page_no)"


def _order(spark, d):
    p = table(spark, d, "page_lid").where("page_no IS NOT NULL").groupBy("doc_id", "page_no").agg(F.coalesce(F.max("alpha_bytes"), F.lit(0)).alias("guess"))
    return p.select("doc_id", F.col("page_no").cast("bigint").alias("item"), F.col("page_no").alias("truth"), "guess")


@query(f"SELECT doc_id, count(*) AS n, round(1 - sum(abs(t - g)) / (count(*) * count(*)), 6) AS score FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY truth, item) AS t, row_number() OVER (PARTITION BY doc_id ORDER BY guess, item) AS g FROM {_ORDER}) GROUP BY doc_id")
def reading_distance(spark, d):
    return E.reading_distance(_order(spark, d))


@query(f"SELECT doc_id, round(CASE WHEN count(*) > 1 THEN 1 - 6 * sum(d * d) / (count(*) * (count(*) * count(*) - 1)) ELSE 0 END, 6) AS rho FROM (SELECT doc_id, rank() OVER (PARTITION BY doc_id ORDER BY truth) + (count(*) OVER (PARTITION BY doc_id, truth) - 1) / 2 - rank() OVER (PARTITION BY doc_id ORDER BY guess) - (count(*) OVER (PARTITION BY doc_id, guess) - 1) / 2 AS d FROM {_ORDER}) GROUP BY doc_id")
def spearman_rho(spark, d):
    return E.spearman(_order(spark, d))


def _boxes(spark, d):
    t = clusters(spark, d).select("doc_id", "page_no", F.col("cluster").alias("id"), "label", "confidence", "box")
    g = t.withColumn("box", _box(F.col("box.l") + F.col("id") % 5 * 4, F.col("box.t"), F.col("box.r"), F.col("box.b") + F.col("id") % 3))
    return t, g


_T = f"(SELECT doc_id, page_no, cluster AS id, l, t, r, b FROM {_CLUSTERS})"
_G = f"(SELECT doc_id, page_no, cluster AS id, l + cluster % 5 * 4 AS l, t, r, b + cluster % 3 AS b FROM {_CLUSTERS})"
_CUT = "greatest(least(g.r, t.r) - greatest(g.l, t.l), 0) * greatest(least(g.b, t.b) - greatest(g.t, t.t), 0)"
_AREA = "greatest({0}.r - {0}.l, 0) * greatest({0}.b - {0}.t, 0)"


@query(f"WITH j AS (SELECT g.doc_id, g.page_no, g.id AS guess, t.id AS truth, {_CUT} / ({_AREA.format('g')} + {_AREA.format('t')} - {_CUT} + 1e-6) AS iou FROM {_G} g JOIN {_T} t ON t.doc_id = g.doc_id AND t.page_no = g.page_no), b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no, guess ORDER BY iou DESC, truth) AS rn FROM j WHERE iou > 0) SELECT g.doc_id, g.page_no, g.id AS guess, b.truth, round(coalesce(b.iou, 0), 6) AS iou FROM {_G} g LEFT JOIN b ON b.doc_id = g.doc_id AND b.page_no = g.page_no AND b.guess = g.id AND b.rn = 1")
def matched_boxes(spark, d):
    t, g = _boxes(spark, d)
    return E.match_boxes(t, g)


@query()
def layout_precision(spark, d):
    t, g = _boxes(spark, d)
    return E.average_precision(t, g)


@query()
def suppressed_boxes(spark, d):
    t, g = _boxes(spark, d)
    return E.suppress(t.unionByName(g.withColumn("id", F.col("id") + 1000000))).select("doc_id", "page_no", "id")


@query()
def weighted_box_match(spark, d):
    t, g = _boxes(spark, d)
    return E.weighted_match(t, g)


# extraction


@query()
def extracted_text(spark, d):
    return T.extract(table(spark, d, "documents").select("doc_id", F.col("text").alias("content")), "markdown")


@query()
def doctags_nodes(spark, d):
    t = X.serialised(_nodes(spark, d), "doctags")
    u = F.udf(lambda x: len(T.from_doctags(x)), "int", useArrow=True)
    return t.select("doc_id", u("text").alias("nodes"))


@query()
def repaired_encoding(spark, d):
    return table(spark, d, "documents").select("doc_id", F.udf(T.repair_encoding, "string", useArrow=True)("text").alias("text"))


@query("SELECT item_id, " + " OR ".join(f"contains(log, '{x}')" for x in fixed.CORRUPT_LOGS) + " AS corrupted FROM (SELECT item_id, CASE item_id % 9 WHEN 0 THEN '' " + " ".join(f"WHEN {i + 1} THEN 'MuPDF error: {x} (' || item_id || ')'" for i, x in enumerate(fixed.CORRUPT_LOGS)) + " ELSE 'MuPDF warning: syntax error in annotation' END AS log FROM eval_items)")
def corruption_logs(spark, d):
    k = F.col("item_id") % 9
    log = F.when(k == 0, "").otherwise("MuPDF warning: syntax error in annotation")
    for i, x in enumerate(fixed.CORRUPT_LOGS):
        log = F.when(k == i + 1, F.concat(F.lit(f"MuPDF error: {x} ("), "item_id", F.lit(")"))).otherwise(log)
    return table(spark, d, "eval_items").select("item_id", T.corrupted(log).alias("corrupted"))


@query(f"SELECT doc_id, page_no, count(*) AS boxes, CAST(sum(length(text)) AS BIGINT) AS chars, round(avg((r - l) * (b - t)), 6) AS mean_area FROM {_CELLS} GROUP BY doc_id, page_no")
def page_features(spark, d):
    s = cells(spark, d).withColumns({"font": F.lit("f"), "hidden": F.lit(False)})
    return T.page_features(s).select("doc_id", "page_no", "boxes", "chars", "mean_area")


@query()
def joined_lines(spark, d):
    return T.join_lines(cells(spark, d).withColumn("cluster", F.expr("cell div 3")))


@query()
def merged_strips(spark, d):
    c = cells(spark, d).select("doc_id", "page_no", _box(F.lit(0), F.col("box.t"), F.lit(595), F.col("box.b")).alias("box"))
    return T.merge_strips(c)


@query(f"SELECT l.doc_id, l.page_no, CAST(length(p.text) AS BIGINT) AS chars FROM page_lid l JOIN {PAGES} p ON p.doc_id = l.doc_id AND p.page_no = l.page_no WHERE l.best_lang = 'eng_Latn'")
def language_check_requests(spark, d):
    p = table(spark, d, "page_lid").join(C.page_rows(table(spark, d, "documents")), ["doc_id", "page_no"])
    x = T.check_requests(p, F.col("best_lang"), F.col("text"), "eng_Latn")
    return x.select("doc_id", "page_no", F.length("text").cast("bigint").alias("chars"))


@query("SELECT doc_id, num_pages, CAST(c AS BIGINT) AS copy FROM (SELECT doc_id, num_pages, unnest(range(1, CAST(greatest(coalesce(num_pages, 0) // 32, 1) AS BIGINT) + 1)) AS c FROM ocr_routing)")
def resampled_documents(spark, d):
    return T.resampled(table(spark, d, "ocr_routing").select("doc_id", "num_pages"))
