"""Queries over page texts: rules in Arrow batches, duplicates, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import fixed
from quire.functions.arrays import spread
from quire.operators import corpus as C
from quire.operators import models as M
from quire.operators import neardup as N
from quire.operators import pagetext as P
from quire.plans.corpus import PAGES
from quire.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _texts(spark, d):
    return spread(table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", "text"))


def _rule(name: str, fn, returns: str = "string", pages: bool = False) -> None:
    def query(spark, d):
        src = C.page_rows(table(spark, d, "documents")) if pages else _texts(spark, d)
        out = P.mapped(fn, returns, F.col("text"))
        return src.select(*[c for c in src.columns if c != "text"], (out if returns != "string" else out).alias("text" if returns == "string" else "result"))

    QUERIES[name] = query


_rule("clean_tables", P.clean_tables)
_rule("drop_faulty_tables", P.drop_faulty_tables, "struct<text:string,tables:int,faults:map<string,int>>")
_rule("drop_poor_annotations", P.drop_poor_annotations)
_rule("settle_page_numbers", P.settle_page_numbers, pages=True)
_rule("join_lone_signs", P.join_lone_signs, pages=True)
_rule("join_spaced_letters", P.join_spaced_letters, pages=True)
_rule("clean_pages", P.clean_page, pages=True)
_rule("repetition_flags", P.repetition, "struct<kind:string,at:int>")
_rule("top_chunks", P.top_chunk)


def remove_tables(spark, d):
    return _texts(spark, d).select("doc_id", F.regexp_replace("text", r"(?s)<docling_table>.*?</docling_table>", "").alias("text"))


def split_documents(spark, d):
    x = _texts(spark, d).select("doc_id", P.mapped(lambda t: P.split_document(t, 4000), "array<string>", F.col("text")).alias("parts")).select("doc_id", F.posexplode("parts").alias("part", "text"))
    return x.select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit("_chunk_"), F.col("part").cast("string")).alias("chunk_id"), "text")


def word_counts(spark, d):
    return _texts(spark, d).select("doc_id", F.size(F.regexp_extract_all("text", F.lit(r"(\S+)"))).alias("words"))


def minhash_clusters(spark, d):
    return N.deduplicate(table(spark, d, "documents"), "lang")


def ocr_classifier(spark, d):
    return M.ocr_probabilities(table(spark, d, "ocr_routing"), table(spark, d, "documents"))


def quality_regression(spark, d):
    return M.quality_scores(table(spark, d, "documents"), table(spark, d, "teacher_labels"))


def document_languages(spark, d):
    return M.document_languages(table(spark, d, "documents"), ("eng_Latn", "deu_Latn", "fra_Latn", "spa_Latn", "por_Latn", "ita_Latn", "nld_Latn", "rus_Cyrl"))


def multi_head_scores(spark, d):
    return M.multi_head(table(spark, d, "documents"), table(spark, d, "teacher_labels"), ("fw_edu_score", "ocr_quality_score"))


QUERIES |= {f.__name__: f for f in (remove_tables, split_documents, word_counts, minhash_clusters, ocr_classifier, quality_regression, document_languages, multi_head_scores)}
SQL |= {
    "remove_tables": "SELECT doc_id, regexp_replace(text, '(?s)<docling_table>.*?</docling_table>', '', 'g') AS text FROM documents WHERE text IS NOT NULL",
    "word_counts": "SELECT doc_id, CAST(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\x{0B}]+')) AS INT) AS words FROM documents WHERE text IS NOT NULL",
}

# SQL of the page rules


_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160) || chr(8195) || chr(8201) || chr(8239) || chr(12288)"


def _stitched(src: str, keys: str, pattern: str, fix: str) -> str:
    """The text with each match of pattern, whose first group is x, exchanged for fix; p and q are what stands around it."""
    return (
        f"WITH s AS (SELECT *, string_split(regexp_replace(text, '{pattern}', chr(1), 'g'), chr(1)) AS parts, regexp_extract_all(text, '{pattern}', 0) AS whole, regexp_extract_all(text, '{pattern}', 1) AS inner_ FROM {src} WHERE text IS NOT NULL), "
        f"m AS (SELECT {keys}, i, whole[i] AS w, inner_[i] AS x, parts[i] AS p, parts[i + 1] AS q FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM s)), "
        f"f AS (SELECT {keys}, list({fix} ORDER BY i) AS fixed FROM m GROUP BY {keys}) "
        f"SELECT {', '.join('s.' + k.strip() for k in keys.split(','))}, array_to_string(list_transform(s.parts, lambda v, n: v || coalesce(f.fixed[n], '')), '') AS text FROM s LEFT JOIN f ON {' AND '.join(f's.{k.strip()} = f.{k.strip()}' for k in keys.split(','))}"
    )


_ROWS = f"list_transform(list_filter(list_transform(string_split(trim(x, {_WS}), chr(10)), lambda l, i: {{'l': trim(l, {_WS}), 'i': i}}), lambda v: NOT (v.i = 2 AND contains(v.l, '---')) AND starts_with(v.l, '|') AND ends_with(v.l, '|')), lambda v: list_transform(string_split(substr(v.l, 2, greatest(length(v.l) - 2, 0)), '|'), lambda c: trim(c, {_WS})))"
_KEEP = "list_filter(range(1, CAST(list_max(list_transform(r, lambda a: len(a))) AS BIGINT) + 1), lambda k: len(list_filter(r, lambda a: coalesce(a[k], '') <> '')) > 0)"
_TABLE_FIX = f"(SELECT CASE WHEN len(string_split(trim(x, {_WS}), chr(10))) < 2 OR len(r) = 0 OR len(k) = 0 THEN '' ELSE '<docling_table>' || (SELECT lines[1] || chr(10) || '|' || array_to_string(list_transform(k, lambda j: '---'), '|') || '|' || array_to_string(list_transform(lines[2:], lambda l: chr(10) || l), '') FROM (SELECT list_transform(list_filter(r, lambda a: len(list_filter(a, lambda c: c <> '')) > 0), lambda a: '| ' || array_to_string(list_transform(k, lambda j: coalesce(a[j], '')), ' | ') || ' |') AS lines)) || '</docling_table>' END FROM (SELECT r, {_KEEP} AS k FROM (SELECT {_ROWS} AS r)))"
SQL |= {
    "clean_tables": _stitched('documents', 'doc_id', '(?s)<docling_table>(.*?)</docling_table>', _TABLE_FIX),
    "drop_poor_annotations": _stitched('documents', 'doc_id', '(?s)<docling_picture_annotation(?:_non_text)?>(.*?)</docling_picture_annotation(?:_non_text)?>', "CASE WHEN length(x) > 0 AND length(regexp_replace(x, '[^\\p{L}]', '', 'g')) / length(x) >= 0.8 THEN w ELSE '' END"),
    "settle_page_numbers": _stitched(PAGES, 'doc_id, page_no', '<docling_page_number>(.*?)</docling_page_number>', "CASE WHEN NOT regexp_full_match(x, '\\s*\\p{Nd}+\\s*') THEN w WHEN regexp_matches(p, '\\p{Nd}[\\s\\x{A0}]*$') OR regexp_matches(q, '^[\\s\\x{A0}]*\\p{Nd}') THEN x ELSE w END"),
    "join_lone_signs": f"WITH l AS (SELECT doc_id, page_no, i, x, trim(x, {_WS}) AS b FROM (SELECT doc_id, page_no, unnest(a) AS x, unnest(range(1, len(a) + 1)) AS i FROM (SELECT doc_id, page_no, string_split(regexp_replace(regexp_replace(text, '\\r\\n|[\\n\\r\\x{{0B}}\\x{{0C}}\\x{{1C}}-\\x{{1E}}\\x{{85}}\\x{{2028}}\\x{{2029}}]', chr(10), 'g'), '\\n$', ''), chr(10)) AS a FROM {PAGES}))), "
    "j AS (SELECT *, length(b) = 1 AND (contains('" + (fixed.LONE_SIGNS + fixed.TERMINAL_SIGNS).replace("'","''") + "', b) OR regexp_matches(b, '[\\x{01}-\\x{08}\\x{0E}-\\x{1F}\\x{7F}-\\x{9F}]')) AND coalesce(regexp_matches(last_value(CASE WHEN b <> '' THEN right(x, 1) END IGNORE NULLS) OVER (PARTITION BY doc_id, page_no ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '[\\p{L}\\p{N}\\s\\x{A0}]'), false) AS joined FROM l), "
    "k AS (SELECT *, b = '' AND coalesce(first_value(CASE WHEN b <> '' THEN joined END IGNORE NULLS) OVER (PARTITION BY doc_id, page_no ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), false) AS gone FROM j) "
    "SELECT doc_id, page_no, coalesce(substr(string_agg(CASE WHEN joined THEN x ELSE chr(10) || x END, '' ORDER BY i) FILTER (NOT gone), 2), '') AS text FROM k GROUP BY doc_id, page_no",
    "split_documents": f"WITH RECURSIVE c AS (SELECT doc_id, 0 AS part, text AS rest, NULL::VARCHAR AS out FROM documents WHERE text IS NOT NULL UNION ALL SELECT doc_id, part + 1, CASE WHEN length(rest) > 4000 THEN ltrim(substr(rest, cut + 1), {_WS}) END, CASE WHEN length(rest) > 4000 THEN rtrim(left(rest, cut), {_WS}) ELSE rest END FROM (SELECT doc_id, part, rest, CASE WHEN a > 0 THEN a + 2 WHEN b > 0 THEN b + 1 WHEN s > 0 THEN s + 2 WHEN e > 0 THEN e + 1 ELSE 4000 END AS cut FROM (SELECT *, length(regexp_extract(left(rest, 4000), '(?s)^(.*)\\n\\n', 1)) AS a, length(regexp_extract(left(rest, 4000), '(?s)^(.*)\\n', 1)) AS b, length(regexp_extract(left(rest, 4000), '(?s)^(.*)\\. ', 1)) AS s, length(regexp_extract(left(rest, 4000), '(?s)^(.*) ', 1)) AS e FROM c WHERE rest IS NOT NULL))) SELECT doc_id, doc_id || '_chunk_' || (part - 1) AS chunk_id, out AS text FROM c WHERE part > 0",
}
