"""Queries over records, whole documents put together, round trips through sinks and formats, and their SQL."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from quire.functions import fixed
from quire.operators import records as K
from quire.plans import structure as U
from quire.session import shared_dir, table
from quire.sources import formats as S
from quire.sources import sinks

QUERIES: dict = {}
SQL: dict[str, str] = {}
# a public rank file and the pattern of words that belongs to it
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


@query("SELECT url, dump, CASE WHEN fetch_status = 200 THEN 'fetched' ELSE 'failed' END AS route FROM crawl_index")
def fetch_routes(spark, d):
    x = table(spark, d, "crawl_index").withColumn("media_bytes", F.when(F.col("fetch_status") == 200, F.encode("url", "utf-8")))
    return K.fetched(x).select("url", "dump", "route")


@query("SELECT doc_id, url, n_chars FROM documents")
def dropped_field(spark, d):
    x = table(spark, d, "documents").select("doc_id", F.struct("url", "n_chars", F.col("text").alias("docling_doc_dict")).alias("metadata"))
    return K.without_field(x, "metadata", "docling_doc_dict").select("doc_id", "metadata.*")


@query("SELECT doc_id, source FROM documents WHERE CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '-7'), 1, 8) AS BIGINT) < 429496729")
def sampled_documents(spark, d):
    return K.sampled(table(spark, d, "documents").select("doc_id", "source"), 0.1, "doc_id", 7)


@query("SELECT doc_id, lang, CASE WHEN lang IN ('eng_Latn', 'deu_Latn', 'fra_Latn') THEN lang_score END AS quality FROM documents")
def modelled_languages(spark, d):
    return K.where_modelled(table(spark, d, "documents").select("doc_id", "lang", "lang_score"), "lang", ("eng_Latn", "deu_Latn", "fra_Latn"), F.col("lang_score"), "quality").drop("lang_score")


@query("SELECT source, keep_pct, CAST(unnest(range(1, 4)) AS INT) AS copy FROM keep_targets")
def repeated_rows(spark, d):
    return K.repeated(table(spark, d, "keep_targets"), 3)


@query("SELECT doc_id, max(fw_edu_score) AS target FROM teacher_labels WHERE fw_edu_score >= 0 GROUP BY doc_id")
def inferred_targets(spark, d):
    t = table(spark, d, "teacher_labels")
    name = K.target_column(t.columns)
    return t.where(F.col(name) >= 0).groupBy("doc_id").agg(F.max(name).alias("target"))


@query("SELECT fw_edu_score AS truth, CAST(least(greatest(round_even(coalesce(ocr_quality_score, 0) * 1.5, 0), 0), 5) AS INT) AS guess, count(*) AS n FROM teacher_labels WHERE fw_edu_score IS NOT NULL GROUP BY 1, 2")
def confusion_matrix(spark, d):
    t = table(spark, d, "teacher_labels").withColumn("guess", F.coalesce("ocr_quality_score", F.lit(0)) * 1.5)
    return K.confusion(t, "fw_edu_score", "guess")


@query(
    "WITH l AS (SELECT doc_id, i, trim(replace(x, chr(2), '-'), ' ') AS x FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE length(text) > 0) WHERE length(trim(x, ' ')) > 0), "
    "n AS (SELECT *, lead(x) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM l), "
    "p AS (SELECT doc_id, i, CASE WHEN nx IS NULL THEN x WHEN right(x, 1) <> '-' THEN x || ' ' WHEN regexp_matches(x, '[\\p{L}\\p{M}\\p{N}_][^\\p{L}\\p{M}\\p{N}_]*$') AND regexp_matches(nx, '[\\p{L}\\p{M}\\p{N}_]') AND NOT contains(regexp_extract(x, '([\\p{L}\\p{M}\\p{N}_]+)[^\\p{L}\\p{M}\\p{N}_]*$', 1), '_') AND NOT contains(regexp_extract(nx, '([\\p{L}\\p{M}\\p{N}_]+)', 1), '_') THEN left(x, length(x) - 1) ELSE x END AS p FROM n) "
    "SELECT doc_id, trim(translate(string_agg(p, '' ORDER BY i), '⁄’‘“”•', '/''''\"\"·'), ' ') AS text FROM p GROUP BY doc_id"
)
def joined_cells(spark, d):
    x = table(spark, d, "documents").where(F.length("text") > 0).select("doc_id", K.joined_cells(F.split("text", "\n")).alias("text"))
    return x.where(F.length("text") > 0)


@query("SELECT doc_id, length(CASE WHEN length(text) <= 1000000 THEN text ELSE left(text, 1000000) || CASE WHEN regexp_matches(substr(text, 1000001), '\\s') THEN regexp_extract(substr(text, 1000001), '^(\\S*)', 1) ELSE '' END END) AS n FROM documents WHERE text IS NOT NULL")
def capped_lengths(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.length(K.capped(F.col("text"))).cast("bigint").alias("n"))


@query()
def text_chunks(spark, d):
    """Top and bottom chunks in tokens of a public tokenizer, in words where its file is missing."""
    codec = (lambda: K.Ranked(RANKS, PATTERN)) if os.path.exists(RANKS) else K.Words
    return K.text_chunks(table(spark, d, "documents"), codec)


_MARKS = "CASE WHEN label = 'list_item' THEN regexp_replace(marked, '^([^\\s]*)\\s+', '\\1 ') ELSE marked END"
_TAGGED = f"(SELECT *, {_MARKS} AS m FROM (SELECT *, item IN (a, z) AND label = 'text' AND ({U._page_number_sql()}) AS is_number, regexp_replace(regexp_replace(regexp_replace(text, '^\\s*[{fixed.CHECK_MARKS}]', '[x]'), '^\\s*[{fixed.STAR_MARKS}]', '*'), '^({U._BULLET})', '-') AS marked FROM (SELECT *, trim(text, ' ' || chr(9) || chr(13)) AS x, min(item) FILTER (label <> 'table') OVER w AS a, max(item) FILTER (label <> 'table') OVER w AS z FROM {U._ITEMS} WINDOW w AS (PARTITION BY doc_id, page_no))))"


@query(f"WITH p AS (SELECT doc_id, page_no, string_agg(CASE WHEN is_number THEN '<docling_page_number>' || m || '</docling_page_number>' ELSE m END, chr(10) ORDER BY item) || chr(10) AS t FROM {_TAGGED} GROUP BY doc_id, page_no) SELECT doc_id, string_agg(t, '' ORDER BY page_no) AS text, list(e ORDER BY page_no) AS page_ends FROM (SELECT *, CAST(sum(length(t)) OVER (PARTITION BY doc_id ORDER BY page_no) AS BIGINT) AS e FROM p) GROUP BY doc_id")
def composed_texts(spark, d):
    return K.document_texts(U._items(spark, d))


@query()
def edited_trees(spark, d):
    n = U._nodes(spark, d)
    first = n.where("kind = 'heading'").groupBy("doc_id").agg(F.min("node_id").alias("sibling"))
    new = first.select("doc_id", "sibling", F.lit("text").alias("kind"), F.lit("new").alias("text"))
    return K.inserted(K.replaced(n, first.select("doc_id", F.col("sibling").alias("node_id"), F.lit(None).cast("string").alias("kind"), F.lit("changed").alias("text"))), new).select("doc_id", "node_id", "seq", "kind", "text")


# sinks and what reads them


def _path(spark, name: str) -> str:
    return f"{shared_dir(spark)}/quire-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@query("SELECT doc_id, text, source, page_ends FROM documents")
def jsonl_round_trip(spark, d):
    df, at = table(spark, d, "documents").select("doc_id", "text", "source", "page_ends"), _path(spark, "jsonl")
    sinks.write_jsonl(df, at, 10_000)
    return spark.read.schema(df.schema).json(at)


@query("SELECT doc_id, text, source FROM documents")
def container_round_trip(spark, d):
    df, at = table(spark, d, "documents").select("doc_id", "text", "source"), _path(spark, "container")
    sinks.write_container(df, at)
    return spark.read.parquet(at)


@query("SELECT url, coalesce(fetch_status, -1) AS route FROM crawl_index")
def routed_round_trip(spark, d):
    at = _path(spark, "routed")
    sinks.write_routed(table(spark, d, "crawl_index").select("url", F.coalesce("fetch_status", F.lit(-1)).alias("route")), at)
    return spark.read.parquet(at)


@query("SELECT doc_id, lang AS language_bucket FROM documents WHERE lang <> ''")
def language_round_trip(spark, d):
    at = _path(spark, "languages")
    sinks.write_languages(table(spark, d, "documents").where("lang <> ''").select("doc_id", F.col("lang").alias("language_bucket")), at, rows_per_file=1000)
    return spark.read.parquet(at)


@query("SELECT doc_id, CAST(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\x{0B}]+')) + 1 AS INT) AS n FROM documents WHERE text IS NOT NULL")
def shard_round_trip(spark, d):
    t = F.transform(F.regexp_extract_all("text", F.lit(r"(\S+)")), lambda w: F.length(w))
    at = _path(spark, "shards")
    sinks.token_shards(table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", t.alias("tokens")), at, 0, 100_000)
    return spark.read.parquet(at).select("doc_id", F.size("tokens").alias("n"))


# formats: files made of the tables, and what their parsers give


@query("SELECT n_regionkey AS doc_id, list([CAST(n_nationkey AS VARCHAR), n_name] ORDER BY n_nationkey) AS rows FROM nation GROUP BY n_regionkey")
def csv_tables(spark, d):
    """A CSV file for each region; the parser gives its table."""
    n = table(spark, d, "nation")
    g = n.groupBy(F.col("n_regionkey").alias("doc_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.concat(x["n_nationkey"].cast("string"), F.lit(","), x["n_name"])), "\n").alias("content"))
    return S.nodes(g, "csv").where("kind = 'table'").select("doc_id", "rows")


@query("SELECT n_regionkey AS doc_id, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS place, n_name AS text FROM nation")
def asciidoc_items(spark, d):
    """An AsciiDoc list for each region; its items in their order."""
    n = table(spark, d, "nation")
    g = n.groupBy(F.col("n_regionkey").alias("doc_id")).agg(F.concat(F.lit("= Nations\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.concat(F.lit("* "), x["n_name"])), "\n"), F.lit("\n")).alias("content"))
    w = U.Window.partitionBy("doc_id").orderBy("seq")
    return S.nodes(g, "asciidoc").where("kind = 'item'").select("doc_id", F.row_number().over(w).cast("bigint").alias("place"), "text")


@query("SELECT n_regionkey AS doc_id, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS place, n_name AS text FROM nation")
def html_items(spark, d):
    """An HTML list for each region; its items in their order."""
    n = table(spark, d, "nation")
    g = n.groupBy(F.col("n_regionkey").alias("doc_id")).agg(F.concat(F.lit("<html><body><h1>Nations</h1><ul>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.concat(F.lit("<li>"), x["n_name"], F.lit("</li>"))), ""), F.lit("</ul></body></html>")).alias("content"))
    w = U.Window.partitionBy("doc_id").orderBy("seq")
    return S.nodes(g, "html").where("kind = 'item'").select("doc_id", F.row_number().over(w).cast("bigint").alias("place"), "text")
