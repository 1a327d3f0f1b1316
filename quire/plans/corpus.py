"""Queries over the corpus tables and the SQL that each is compared with."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions import fixed
from quire.functions import records as R
from quire.functions import text as T
from quire.functions.arrays import spread
from quire.operators import corpus as C
from quire.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


PDF = "('application/pdf','application/x-pdf','application/acrobat','applications/vnd.pdf','text/pdf')"
MIME = f"(coalesce(content_mime_detected IN {PDF}, false) OR coalesce(content_mime_type IN {PDF}, false))"
PATH = "coalesce(regexp_extract(lower(url), '^[a-z][a-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1) LIKE '%.pdf', false)"
ROUTE = f"CASE WHEN NOT ({MIME} OR {PATH}) THEN 'not_pdf' WHEN content_truncated IS NOT NULL AND {MIME} THEN 'truncated' ELSE 'non_truncated' END"
PAGES = "(SELECT doc_id, CAST(i AS INT) - 1 AS page_no, substr(text, CAST(CASE WHEN i = 1 THEN 0 ELSE page_ends[i-1] END AS INT) + 1, CAST(page_ends[i] - CASE WHEN i = 1 THEN 0 ELSE page_ends[i-1] END AS INT)) AS text FROM (SELECT doc_id, text, page_ends, unnest(range(1, len(page_ends) + 1)) AS i FROM documents WHERE text IS NOT NULL AND len(page_ends) > 0))"
LANG_OK = "lang IS NOT NULL AND lang NOT IN ('', 'und', 'unknown')"


@query(f"SELECT url, warc_filename, warc_record_offset, {ROUTE} AS route FROM crawl_index")
def route_index(spark, d):
    return C.route_index(table(spark, d, "crawl_index")).select("url", "warc_filename", "warc_record_offset", "route")


@query(f"SELECT {ROUTE} AS route, dump, count(*) AS n, sum(warc_record_length) AS bytes FROM crawl_index GROUP BY 1, 2")
def route_counts(spark, d):
    return C.route_index(table(spark, d, "crawl_index")).groupBy("route", "dump").agg(F.count("*").alias("n"), F.sum("warc_record_length").alias("bytes"))


@query("SELECT md5(concat_ws('|', url, warc_filename, CAST(warc_record_offset AS VARCHAR))) AS id, dump, fetch_time AS date, coalesce(content_mime_detected, content_mime_type) AS mime, content_truncated IS NOT NULL AS is_truncated, url, warc_filename AS path, warc_record_offset AS \"offset\", warc_record_length AS length FROM crawl_index")
def index_records(spark, d):
    x = C.index_records(table(spark, d, "crawl_index"))
    m = F.col("media")[0]
    return x.select("id", "dump", "date", "mime", "is_truncated", m["url"].alias("url"), m["path"].alias("path"), m["offset"].alias("offset"), m["length"].alias("length"))


@query("SELECT warc_filename, warc_record_offset, url, ingest_time, fetch_status FROM (SELECT *, row_number() OVER (PARTITION BY warc_filename, warc_record_offset ORDER BY coalesce(ingest_time, TIMESTAMP '1900-01-01') DESC, url DESC) AS r FROM crawl_index) WHERE r = 1")
def latest_delivery(spark, d):
    return C.latest_delivery(table(spark, d, "crawl_index")).select("warc_filename", "warc_record_offset", "url", "ingest_time", "fetch_status")


@query(f"SELECT url, warc_filename, warc_record_offset FROM crawl_index WHERE fetch_status = 200 AND {MIME}")
def fetched_pdfs(spark, d):
    i = table(spark, d, "crawl_index")
    return i.where((F.col("fetch_status") == 200) & R.mime_pdf(F.col("content_mime_type"), F.col("content_mime_detected"))).select("url", "warc_filename", "warc_record_offset")


@query(f"SELECT url, content_mime_type, content_mime_detected FROM crawl_index WHERE {PATH} AND NOT {MIME}")
def pdf_path_only(spark, d):
    i = table(spark, d, "crawl_index")
    return i.where(R.path_pdf(F.col("url")) & ~R.mime_pdf(F.col("content_mime_type"), F.col("content_mime_detected"))).select("url", "content_mime_type", "content_mime_detected")


_OCR = "(SELECT doc_id, max(ocr_prob) AS ocr_prob, max(garbled_text_ratio) AS garbled FROM ocr_routing GROUP BY doc_id)"


@query(f"SELECT d.doc_id, d.extractor, CASE WHEN coalesce(f.ocr_prob, 0) >= 0.2 OR coalesce(f.garbled, 0) > 0 THEN 'ocr' ELSE 'non_ocr' END AS route FROM documents d LEFT JOIN {_OCR} f ON f.doc_id = d.doc_id")
def route_ocr(spark, d):
    return C.route_ocr(table(spark, d, "documents"), table(spark, d, "ocr_routing")).select("doc_id", "extractor", "route")


@query("SELECT r.doc_id, r.ocr_prob FROM ocr_routing r WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = r.doc_id)")
def routing_without_document(spark, d):
    return table(spark, d, "ocr_routing").join(table(spark, d, "documents").select("doc_id"), "doc_id", "left_anti").select("doc_id", "ocr_prob")


@query("SELECT doc_id, CASE WHEN coalesce(length(text), 0) = 0 THEN 'empty_text' WHEN coalesce(len(page_ends), 0) = 0 THEN 'no_pages' END AS reject_reason FROM documents")
def reject_reasons(spark, d):
    return C.drop_failed(table(spark, d, "documents")).select("doc_id", "reject_reason")


@query("SELECT doc_id, coalesce(dump, 'unknown-dump') AS dump, coalesce(is_truncated, false) AS is_truncated, 'corpus' AS origin FROM documents")
def add_constants(spark, d):
    return C.add_constants(table(spark, d, "documents").select("doc_id", "dump", "is_truncated"), dump="unknown-dump", is_truncated=False, origin="corpus")


@query(f"SELECT doc_id, page_no, octet_length(encode(regexp_replace(t, '[^\\p{{L}}]', '', 'g'))) AS alpha_bytes, octet_length(encode(regexp_replace(t, '[\\s\\x{{0B}}\\x{{1C}}-\\x{{1F}}\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+', '', 'g'))) AS dense_bytes FROM (SELECT doc_id, page_no, regexp_replace(regexp_replace(text, '(?m)^[ \\t]*\\|.*\\|[ \\t]*$', '', 'g'), '[|\\-*#]', '', 'g') AS t FROM {PAGES})")
def lid_features(spark, d):
    t = T.lid_text(F.col("text"))
    return C.page_rows(table(spark, d, "documents")).select("doc_id", "page_no", T.alpha_bytes(t).alias("alpha_bytes"), T.dense_bytes(t).alias("dense_bytes"))


_PAGE = "(SELECT doc_id, page_no, best_lang, best_score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY coalesce(best_score, -1) DESC, best_lang DESC) AS r FROM page_lid) WHERE r = 1)"
_AVG = f"avg_lang AS (SELECT p.doc_id, p.best_lang AS lang, sum(p.best_score) / any_value(n.pages) AS score FROM {_PAGE} p JOIN (SELECT doc_id, count(*) AS pages FROM {_PAGE} GROUP BY doc_id) n ON n.doc_id = p.doc_id WHERE p.best_lang <> 'unknown' AND p.best_score IS NOT NULL GROUP BY p.doc_id, p.best_lang HAVING sum(p.best_score) / any_value(n.pages) > 0.01)"


@query(f"WITH {_AVG} SELECT DISTINCT d.doc_id, coalesce(a.lang, 'unknown') AS best_lang, round(coalesce(a.score, 0), 9) AS best_score FROM (SELECT DISTINCT doc_id FROM page_lid) d LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang DESC) AS r FROM avg_lang) WHERE r = 1) a ON a.doc_id = d.doc_id")
def page_language_average(spark, d):
    return C.page_language_average(table(spark, d, "page_lid")).select("doc_id", "best_lang", F.round("best_score", 9).alias("best_score"))


_SWEEP = """g AS (SELECT lang, score, count(*) AS n, sum(CASE WHEN language_correct THEN 1 ELSE 0 END) AS c FROM lid_pairs WHERE language_correct IS NOT NULL AND score IS NOT NULL AND lang IS NOT NULL GROUP BY lang, score),
w AS (SELECT lang, score, sum(n) OVER d AS kept, sum(c) OVER d AS correct, sum(c) OVER (PARTITION BY lang) AS all_true FROM g WINDOW d AS (PARTITION BY lang ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
m AS (SELECT lang, score, CAST(kept AS BIGINT) AS kept, correct / kept AS "precision", correct / all_true AS recall FROM w WHERE all_true > 0),
f AS (SELECT *, coalesce(1.01 * "precision" * recall / nullif(0.01 * "precision" + recall, 0), 0) AS f FROM m WHERE recall >= 0.1 AND "precision" >= 0.9),
th AS (SELECT lang, score - 1e-12 AS threshold, kept, "precision", recall FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY f DESC, score DESC) AS r FROM f) WHERE r = 1)"""


@query(f'WITH {_SWEEP} SELECT lang, threshold, kept, "precision", recall FROM th')
def language_thresholds(spark, d):
    return C.language_thresholds(table(spark, d, "lid_pairs"))


@query(f'WITH {_SWEEP}, n AS (SELECT lang, count(*) AS n, CAST(sum(CASE WHEN language_correct THEN 1 ELSE 0 END) AS BIGINT) AS n_true FROM lid_pairs WHERE language_correct IS NOT NULL AND lang IS NOT NULL GROUP BY lang) SELECT n.lang, n, n_true, round(n_true / n, 6) AS trivial_accuracy, round(threshold, 6) AS threshold, kept, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(2 * "precision" * recall / nullif("precision" + recall, 0), 6) AS f1 FROM n LEFT JOIN th ON th.lang = n.lang')
def threshold_report(spark, d):
    return C.threshold_report(table(spark, d, "lid_pairs"))


_ALL_TH = "(SELECT lang, greatest(threshold, 0.05) AS threshold FROM th UNION ALL SELECT 'zxx_Latn', -1 UNION ALL SELECT 'zxx_Cyrl', -1 UNION ALL SELECT 'zxx_Arab', -1)"
_BUCKET = f"""o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS r FROM avg_lang),
won AS (SELECT doc_id, lang FROM (SELECT o.doc_id, o.lang, row_number() OVER (PARTITION BY o.doc_id ORDER BY o.r) AS k FROM o LEFT JOIN {_ALL_TH} t ON t.lang = o.lang WHERE o.score > coalesce(t.threshold, 10000) OR (o.r = 1 AND o.lang LIKE 'zxx\\_%' ESCAPE '\\')) WHERE k = 1),
b AS (SELECT d.doc_id, won.lang IS NOT NULL AS accepted, CASE WHEN won.lang IS NOT NULL THEN won.lang ELSE coalesce(o.lang, 'unknown') || CASE WHEN t.lang IS NOT NULL THEN '_removed' ELSE '' END END AS bucket FROM (SELECT DISTINCT doc_id FROM page_lid) d LEFT JOIN o ON o.doc_id = d.doc_id AND o.r = 1 LEFT JOIN won ON won.doc_id = d.doc_id LEFT JOIN {_ALL_TH} t ON t.lang = coalesce(o.lang, 'unknown'))"""


def _bucketed(spark, d):
    return C.with_language_bucket(C.page_language_average(table(spark, d, "page_lid")), C.language_thresholds(table(spark, d, "lid_pairs")))


@query(f"WITH {_AVG}, {_SWEEP}, {_BUCKET} SELECT doc_id, bucket, accepted FROM b")
def select_best_language(spark, d):
    return _bucketed(spark, d).select("doc_id", "bucket", "accepted")


@query(f"WITH {_AVG}, {_SWEEP}, {_BUCKET} SELECT bucket, count(*) AS documents FROM b WHERE bucket IN ('eng_Latn', 'deu_Latn', 'fra_Latn') GROUP BY bucket")
def language_keep_list(spark, d):
    return _bucketed(spark, d).where(F.col("bucket").isin("eng_Latn", "deu_Latn", "fra_Latn")).groupBy("bucket").agg(F.count("*").alias("documents"))


@query("SELECT doc_id, round(coalesce((length(text) - length(replace(text, chr(65533), ''))) / nullif(length(text), 0), 0), 9) AS garbled FROM documents WHERE text IS NOT NULL")
def garbled_ratio(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.round(T.garbled_ratio(F.col("text")), 9).alias("garbled"))


@query("SELECT producer, coalesce(" + " OR ".join(f"contains(lower(producer), '{x}')" for x in fixed.SCANNERS) + ", false) AS scanner, count(*) AS n FROM ocr_routing GROUP BY 1, 2")
def scanner_producers(spark, d):
    r = table(spark, d, "ocr_routing")
    return r.groupBy("producer", T.scanner_producer(F.col("producer")).alias("scanner")).agg(F.count("*").alias("n"))


WS = "[\\s\\x{0B}\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"
_KEY = f"md5(regexp_replace(text, '{WS}', '', 'g'))"


@query(f"SELECT doc_id, count(*) OVER (PARTITION BY k) AS copies, doc_id = min(doc_id) OVER (PARTITION BY k) AS kept FROM (SELECT doc_id, {_KEY} AS k FROM documents WHERE text IS NOT NULL)")
def exact_dedup(spark, d):
    docs = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", "text")
    return C.exact_duplicates(docs, T.exact_key(F.col("text"))).select("doc_id", "copies", "kept")


@query(f"SELECT doc_id, kept FROM (SELECT doc_id, doc_id = min(doc_id) OVER (PARTITION BY k, lang) AS kept FROM (SELECT doc_id, lang, {_KEY} AS k FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL))")
def exact_dedup_by_language(spark, d):
    docs = table(spark, d, "documents").where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "lang", "text")
    return C.exact_duplicates(docs, T.exact_key(F.col("text")), scope=["lang"]).select("doc_id", "kept")


@query("SELECT doc_id, kept FROM (SELECT doc_id, doc_id = min(doc_id) OVER (PARTITION BY is_truncated, k) AS kept FROM (SELECT doc_id, is_truncated, sha256(coalesce(text, '')) AS k FROM documents WHERE is_truncated IS NOT NULL))")
def byte_dedup(spark, d):
    docs = table(spark, d, "documents").where("is_truncated IS NOT NULL").select("doc_id", "is_truncated", "text")
    return C.exact_duplicates(docs, F.sha2(F.coalesce("text", F.lit("")), 256), scope=["is_truncated"]).select("doc_id", "kept")


@query(f"SELECT coalesce(lang, '') AS lang, count(*) AS documents, CAST(sum(CASE WHEN kept THEN 1 ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN kept THEN n_chars ELSE 0 END) AS BIGINT) AS chars, round(avg(alpha), 6) AS alpha_ratio FROM (SELECT lang, n_chars, alpha, doc_id = min(doc_id) OVER (PARTITION BY k) AS kept FROM (SELECT doc_id, lang, n_chars, length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')) / length(text) AS alpha, {_KEY} AS k FROM documents WHERE length(text) > 0)) GROUP BY 1")
def corpus_summary(spark, d):
    docs = table(spark, d, "documents").where(F.length("text") > 0).select("doc_id", "lang", "n_chars", T.exact_key(F.col("text")).alias("k"), (T.alpha_chars(F.col("text")) / F.length("text")).alias("alpha"))
    x = C.exact_duplicates(docs, F.col("k"))
    return x.groupBy(F.coalesce("lang", F.lit("")).alias("lang")).agg(F.count("*").alias("documents"), F.count_if("kept").alias("kept"), F.sum(F.when(F.col("kept"), F.col("n_chars")).otherwise(0)).alias("chars"), F.round(F.avg("alpha"), 6).alias("alpha_ratio"))


_LABEL = "(SELECT doc_id, max(fw_edu_score) AS y FROM teacher_labels WHERE fw_edu_score BETWEEN 0 AND 5 GROUP BY doc_id)"


@query("SELECT doc_id, coalesce(max(fw_edu_score), 0) AS best FROM teacher_labels GROUP BY doc_id HAVING coalesce(max(fw_edu_score), 0) >= 0.5")
def edu_filter(spark, d):
    x = table(spark, d, "teacher_labels").groupBy("doc_id").agg(F.collect_list(F.col("fw_edu_score").cast("double")).alias("s"))
    return x.select("doc_id", R.best_score(F.col("s")).cast("int").alias("best")).where("best >= 0.5")


@query(f"WITH c AS (SELECT fw_edu_score AS label, count(*) AS n FROM teacher_labels WHERE fw_edu_score BETWEEN 0 AND 5 GROUP BY 1), t AS (SELECT min(n) * 4 AS t FROM c) SELECT CAST(i AS INT) AS label, coalesce(n, 0) AS n, CAST(CASE WHEN n IS NULL THEN 0 ELSE greatest(least(n, t * 10), t) END AS BIGINT) AS samples FROM (SELECT unnest(range(0, 6)) AS i) LEFT JOIN c ON c.label = i CROSS JOIN t")
def samples_per_class(spark, d):
    return C.samples_per_class(table(spark, d, "teacher_labels"), "fw_edu_score", 0, 5)


@query(f"WITH c AS (SELECT y, count(*) AS n FROM {_LABEL} GROUP BY y), t AS (SELECT min(n) * 4 AS t FROM c), s AS (SELECT y, CAST(greatest(least(n, t * 10), t) AS BIGINT) AS samples FROM c CROSS JOIN t), r AS (SELECT l.y, l.doc_id, count(*) OVER (PARTITION BY l.y) AS m, row_number() OVER (PARTITION BY l.y ORDER BY md5('42' || CAST(l.doc_id AS VARCHAR)), l.doc_id) AS k FROM {_LABEL} l) SELECT r.y AS label, r.doc_id AS key, CAST(s.samples // m + CASE WHEN k <= s.samples % m THEN 1 ELSE 0 END AS BIGINT) AS copies FROM r JOIN s ON s.y = r.y WHERE s.samples // m + CASE WHEN k <= s.samples % m THEN 1 ELSE 0 END > 0")
def balanced_sample(spark, d):
    lab = table(spark, d, "teacher_labels").where(F.col("fw_edu_score").between(0, 5)).groupBy("doc_id").agg(F.max("fw_edu_score").alias("y"))
    return C.balanced_sample(lab, "y", "doc_id", C.samples_per_class(lab, "y", 0, 5))


@query(f"SELECT doc_id, y, CASE WHEN r <= least(ceil(m * 0.04), 20000 // (SELECT count(DISTINCT y) FROM {_LABEL})) THEN 'test' ELSE 'train' END AS split FROM (SELECT doc_id, y, count(*) OVER (PARTITION BY y) AS m, row_number() OVER (PARTITION BY y ORDER BY md5('42' || CAST(doc_id AS VARCHAR)), doc_id) AS r FROM {_LABEL})")
def stratified_split(spark, d):
    lab = table(spark, d, "teacher_labels").where(F.col("fw_edu_score").between(0, 5)).groupBy("doc_id").agg(F.max("fw_edu_score").alias("y"))
    return C.stratified_split(lab, "y", "doc_id")


@query("""WITH m AS (SELECT l.fw_edu_score AS y, CAST(greatest(least(round_even(d.score, 0), 5), 0) AS INT) AS p, count(*) AS n FROM teacher_labels l JOIN documents d ON d.doc_id = l.doc_id WHERE l.fw_edu_score BETWEEN 0 AND 5 AND d.score IS NOT NULL GROUP BY 1, 2),
t AS (SELECT y AS k, sum(n) AS tr, sum(CASE WHEN y = p THEN n ELSE 0 END) AS hit FROM m GROUP BY y), q AS (SELECT p AS k, sum(n) AS said FROM m GROUP BY p),
x AS (SELECT coalesce(t.k, q.k) AS k, coalesce(tr, 0) AS tr, coalesce(hit, 0) AS hit, coalesce(said, 0) AS said FROM t FULL JOIN q ON t.k = q.k),
y AS (SELECT *, coalesce(hit / nullif(said, 0), 0) AS p, coalesce(hit / nullif(tr, 0), 0) AS r FROM x)
SELECT round(sum(hit) / sum(tr), 6) AS accuracy, round(avg(p), 6) AS macro_precision, round(avg(r), 6) AS macro_recall, round(avg(coalesce(2 * p * r / nullif(p + r, 0), 0)), 6) AS macro_f1 FROM y""")
def class_metrics(spark, d):
    j = table(spark, d, "teacher_labels").where(F.col("fw_edu_score").between(0, 5)).join(table(spark, d, "documents").select("doc_id", "score"), "doc_id")
    return C.class_metrics(j, "fw_edu_score", "score")


@query("SELECT source, count(v) AS n, round(coalesce(avg(v), -1), 6) AS mean, round(coalesce(median(v), -1), 6) AS median, round(coalesce(stddev_samp(v), -1), 6) AS std, [" + ", ".join(f"CAST(sum(CASE WHEN v IS NOT NULL AND least(greatest(floor(v * 20), 0), 19) = {i} THEN 1 ELSE 0 END) AS BIGINT)" for i in range(20)) + "] AS histogram FROM (SELECT source, score / 5 AS v FROM documents) GROUP BY source")
def dataset_stats(spark, d):
    return C.dataset_stats(table(spark, d, "documents").select("source", (F.col("score") / 5).alias("v")), "v", ["source"])


@query(
    "WITH q AS (SELECT DISTINCT doc_id, page_no, best_lang, best_score FROM page_lid), p AS (SELECT doc_id, page_no, first(best_lang) AS l, first(best_score) AS s FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no ORDER BY coalesce(best_score, -1) DESC, best_lang DESC) AS k FROM q) WHERE k = 1 GROUP BY doc_id, page_no), "
    "n AS (SELECT doc_id, count(*) AS n, list(l ORDER BY page_no) AS pages FROM p GROUP BY doc_id), k AS (SELECT p.doc_id, l, sum(s) / any_value(n) AS a FROM p JOIN n ON n.doc_id = p.doc_id WHERE l <> 'unknown' AND s IS NOT NULL GROUP BY p.doc_id, l HAVING sum(s) / any_value(n) > 0.01), "
    "b AS (SELECT n.doc_id, pages, coalesce(k.l, 'unknown') AS l, coalesce(k.a, 0) AS a FROM n LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY a DESC, l DESC) AS r FROM k) k ON k.doc_id = n.doc_id AND k.r = 1) "
    "SELECT text, md5(concat_ws('|', url, file_path, CAST(record_offset AS VARCHAR))) AS id, coalesce(dump, nullif(regexp_extract(file_path, 'crawl=(.*?)/', 1), ''), nullif(regexp_extract(file_path, 'crawl-data/(.*?)/', 1), '')) AS dump, url, fetch_time AS date, file_path, record_offset AS \"offset\", token_count, coalesce(CASE WHEN lang NOT IN ('', 'und', 'unknown') THEN lang END, b.l) AS language, b.l AS page_average_lid, round(b.a, 6) AS page_average_lid_score, lang AS full_doc_lid, lang_score AS full_doc_lid_score, b.pages AS per_page_languages, is_truncated, extractor, page_ends FROM documents d LEFT JOIN b ON b.doc_id = d.doc_id"
)
def publish(spark, d):
    return C.publish(table(spark, d, "documents"), table(spark, d, "page_lid"))


@query("SELECT doc_id, regexp_replace(regexp_replace(text, '</?docling_(?:formula|image|picture_annotation(?:_non_text)?|page_number|table)>', '', 'g'), '\\n+', chr(10), 'g') AS text FROM documents WHERE text IS NOT NULL")
def strip_markup(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", T.strip_markup(F.col("text")).alias("text"))


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[\\x{E000}-\\x{F8FF}\\x{F0000}-\\x{FFFFD}\\x{100000}-\\x{10FFFD}\\x{FFFD}]', '', 'g'), '\\n{2,}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS text FROM documents WHERE text IS NOT NULL")
def clean_characters(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", T.squeeze_lines(T.drop_private(F.col("text"))).alias("text"))


@query("SELECT doc_id, translate(regexp_replace(text, '_{11,}', '__________', 'g'), chr(8260) || '’‘“”' || chr(2), '/''''\"\"-') AS text FROM documents WHERE text IS NOT NULL")
def plain_signs(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", T.plain_signs(T.short_rules(F.col("text"))).alias("text"))


@query("SELECT doc_id, array_to_string(list_transform(p, lambda x, i: CASE WHEN i % 2 = 0 THEN x ELSE replace(replace(replace(x, '\\_', chr(1)), '_', '\\_'), chr(1), '\\_') END), '') AS text FROM (SELECT doc_id, string_split(regexp_replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '(!\\[[^\\n]*?\\]\\([^\\n]*?\\))', chr(2) || '\\1' || chr(2), 'g'), chr(2)) AS p FROM documents WHERE text IS NOT NULL)")
def escape_markdown(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", T.escape_markdown(F.col("text")).alias("text"))


@query(f"SELECT doc_id, page_no, text FROM {PAGES}")
def page_rows(spark, d):
    return C.page_rows(table(spark, d, "documents"))


_BAD = "<--- (failed_to_process_page|stop_reason_[^>]*) --->|^The \\d+-\\d+ season|^The following is a list of the most common types of data breaches and how"
_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(f"SELECT doc_id, string_agg(CASE WHEN regexp_matches(text, '{_BAD}') THEN '<failed_page></failed_page>' || chr(10) ELSE trim(text, {_TRIM}) || chr(10) END, '' ORDER BY page_no) AS text, bool_or(NOT regexp_matches(text, '{_BAD}')) AS ok FROM {PAGES} GROUP BY doc_id")
def coalesce_failed_pages(spark, d):
    x = table(spark, d, "documents").where(F.col("text").isNotNull() & (F.size("page_ends") > 0)).select("doc_id", C.coalesce_failed(T.pages(F.col("text"), F.col("page_ends"))).alias("x"))
    return x.select("doc_id", F.array_join("x.pages", "").alias("text"), "x.ok")


@query(f"WITH p AS (SELECT doc_id, page_no, trim(text, {_TRIM}) AS t FROM {PAGES} WHERE length(trim(text, {_TRIM})) > 0), j AS (SELECT doc_id, page_no, t, lag(t) OVER w AS prev, lead(t) OVER w AS nxt FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY page_no)), k AS (SELECT doc_id, page_no, CASE WHEN prev IS NULL THEN '' WHEN regexp_matches(prev, '\\p{{L}}[-‐‒–—]$') THEN '' ELSE chr(10) || chr(10) END || CASE WHEN nxt IS NOT NULL AND regexp_matches(t, '\\p{{L}}[-‐‒–—]$') THEN substr(t, 1, length(t) - 1) ELSE t END AS piece, CASE WHEN nxt IS NOT NULL AND regexp_matches(t, '\\p{{L}}[-‐‒–—]$') THEN 1 ELSE 0 END AS dash FROM j), e AS (SELECT doc_id, page_no, piece, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY page_no) + dash AS page_end FROM k) SELECT doc_id, string_agg(piece, '' ORDER BY page_no) AS text, list(CAST(page_end AS BIGINT) ORDER BY page_no) AS page_ends, list(page_no ORDER BY page_no) AS page_indices FROM e GROUP BY doc_id")
def pages_to_text(spark, d):
    x = spread(table(spark, d, "documents").where(F.col("text").isNotNull() & (F.size("page_ends") > 0)).select("doc_id", "text", "page_ends")).select("doc_id", T.pages_to_text(T.pages(F.col("text"), F.col("page_ends"))).alias("x"))
    return x.select("doc_id", "x.text", "x.page_ends", "x.page_indices").where(F.size("page_indices") > 0)


def _edge(name: str, back: bool) -> str:
    """SQL of one edge's run of shared lines: the modal first line's pages, then the positions on which they all agree."""
    n = "list_reverse(n)" if back else "n"
    return f"""f_{name} AS (SELECT doc_id, page_no, {n} AS n, ({n})[1] AS first FROM norm),
c_{name} AS (SELECT doc_id, first, count(*) AS c, min(page_no) AS at_, min(len(n)) AS least_ FROM f_{name} GROUP BY doc_id, first),
m_{name} AS (SELECT * FROM (SELECT c.*, p.pages, row_number() OVER (PARTITION BY c.doc_id ORDER BY c.c DESC, c.at_) AS rn FROM c_{name} c JOIN (SELECT doc_id, count(*) AS pages FROM norm GROUP BY doc_id) p ON p.doc_id = c.doc_id) WHERE rn = 1 AND pages > 1 AND c >= greatest(5, pages * 0.25) AND NOT starts_with(first, chr(1))),
k_{name} AS (SELECT f.doc_id, f.page_no, f.n, m.least_ FROM f_{name} f JOIN m_{name} m ON m.doc_id = f.doc_id AND m.first = f.first),
e_{name} AS (SELECT doc_id, pos, min(line) <> max(line) AS differ FROM (SELECT doc_id, unnest(n[1:least_]) AS line, unnest(range(1, least_ + 1)) AS pos FROM k_{name}) GROUP BY doc_id, pos),
{name}_ AS (SELECT k.doc_id, k.page_no, coalesce(s.stop - 1, k.least_) AS {name} FROM k_{name} k LEFT JOIN (SELECT doc_id, min(pos) AS stop FROM e_{name} WHERE differ GROUP BY doc_id) s ON s.doc_id = k.doc_id)"""


@query(f"WITH norm AS (SELECT doc_id, page_no, list_transform(string_split(text, chr(10)), lambda x, i: CASE WHEN regexp_matches(x, '^\\s*\\|.*\\|\\s*$') THEN chr(1) || CAST(i - 1 AS VARCHAR) || '-' || CAST(page_no AS VARCHAR) ELSE replace(regexp_replace(x, '[0-9]', '0', 'g'), ' ', '') END) AS n FROM {PAGES}), {_edge('top', False)}, {_edge('bottom', True)} SELECT n.doc_id, n.page_no, CAST(coalesce(t.top, 0) AS INT) AS top, CAST(coalesce(b.bottom, 0) AS INT) AS bottom FROM norm n LEFT JOIN top_ t ON t.doc_id = n.doc_id AND t.page_no = n.page_no LEFT JOIN bottom_ b ON b.doc_id = n.doc_id AND b.page_no = n.page_no")
def boilerplate(spark, d):
    return C.boilerplate(C.page_rows(table(spark, d, "documents")))


@query("WITH s AS (SELECT item_id, string_split(task_line, '|') AS p FROM eval_items) SELECT item_id, p[1] AS suite, p[2] AS task, try_cast(p[3] AS INT) AS shots, try_cast(p[4] AS INT) AS truncate FROM s")
def parse_task_lines(spark, d):
    p = F.split("task_line", r"\|")
    i = table(spark, d, "eval_items")
    return i.select("item_id", F.get(p, F.lit(0)).alias("suite"), F.get(p, F.lit(1)).alias("task"), F.get(p, F.lit(2)).try_cast("int").alias("shots"), F.get(p, F.lit(3)).try_cast("int").alias("truncate"))


@query("SELECT item_id, task, list_filter([answer, split_name], lambda x: x IS NOT NULL AND length(x) > 0) AS answers FROM eval_items WHERE passage IS NOT NULL")
def eval_answers(spark, d):
    i = table(spark, d, "eval_items").where("passage IS NOT NULL")
    return i.select("item_id", "task", F.filter(F.array("answer", "split_name"), lambda x: x.isNotNull() & (F.length(x) > 0)).alias("answers"))


@query("SELECT task FROM (SELECT DISTINCT task FROM eval_items) WHERE task NOT IN (SELECT task FROM eval_items WHERE answer IS NULL)")
def unfinished_tasks(spark, d):
    i = table(spark, d, "eval_items")
    done = i.where("answer IS NULL").select("task", F.lit("2030-01-02").cast("timestamp").alias("finished_at"))
    return C.unfinished(i.select("task").distinct(), done, "2030-01-01")


@query("SELECT doc_id, [try_cast(x AS DOUBLE) for x in string_split(CAST(score AS VARCHAR) || ', ' || CAST(lang_score AS VARCHAR), ',')] AS scores FROM documents WHERE score IS NOT NULL AND lang_score IS NOT NULL")
def parse_scores(spark, d):
    x = table(spark, d, "documents").where("score IS NOT NULL AND lang_score IS NOT NULL")
    return x.select("doc_id", R.scores_of(F.concat_ws(", ", F.col("score").cast("string"), F.col("lang_score").cast("string"))).alias("scores"))


@query("SELECT doc_id, rater, try_cast(nullif(regexp_extract('Educational score: ' || CAST(fw_edu_score AS VARCHAR), 'Educational score:\\s*(\\d+)', 1), '') AS INT) AS rating FROM teacher_labels WHERE fw_edu_score IS NOT NULL")
def parse_ratings(spark, d):
    x = table(spark, d, "teacher_labels").where("fw_edu_score IS NOT NULL")
    return x.select("doc_id", "rater", R.rating_of(F.concat(F.lit("Educational score: "), F.col("fw_edu_score").cast("string"))).alias("rating"))


@query("SELECT pair_id, CASE WHEN r LIKE 'YES%' THEN true WHEN r LIKE 'NO%' THEN false END AS decision FROM (SELECT pair_id, upper(trim(coalesce(CASE WHEN language_correct THEN 'Yes, it is' WHEN NOT language_correct THEN ' no.' END, 'unsure'))) AS r FROM lid_pairs)")
def parse_decisions(spark, d):
    r = F.when(F.col("language_correct"), "Yes, it is").when(~F.col("language_correct"), " no.").otherwise("unsure")
    return table(spark, d, "lid_pairs").select("pair_id", R.yes_no(r).alias("decision"))


@query("SELECT doc_id, CASE lang WHEN 'sco_Latn' THEN 'eng_Latn' WHEN 'glg_Latn' THEN 'por_Latn' ELSE lang END AS lang FROM documents")
def language_alias(spark, d):
    return table(spark, d, "documents").select("doc_id", R.alias(F.col("lang"), {"sco_Latn": "eng_Latn", "glg_Latn": "por_Latn"}).alias("lang"))


@query("SELECT doc_id, fw_edu_score FROM teacher_labels WHERE fw_edu_score IS NOT NULL AND fw_edu_score <> -1 AND doc_id IN (SELECT doc_id FROM documents WHERE length(trim(text)) > 0)")
def usable_labels(spark, d):
    docs = table(spark, d, "documents").where(F.length(F.trim("text")) > 0).select("doc_id")
    return table(spark, d, "teacher_labels").where("fw_edu_score IS NOT NULL AND fw_edu_score <> -1").join(docs, "doc_id", "left_semi").select("doc_id", "fw_edu_score")


@query("SELECT split_name AS a, count(*) AS n FROM eval_items WHERE task IN (SELECT task FROM eval_items WHERE split_name = 'test' INTERSECT SELECT task FROM eval_items WHERE split_name = 'validation') GROUP BY split_name")
def label_intersection(spark, d):
    i = table(spark, d, "eval_items")
    both = i.where("split_name = 'test'").select("task").intersect(i.where("split_name = 'validation'").select("task"))
    return i.join(both, "task", "left_semi").groupBy(F.col("split_name").alias("a")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, page_no, k FROM (SELECT doc_id, page_no, row_number() OVER (PARTITION BY doc_id ORDER BY md5(CAST(doc_id AS VARCHAR) || '-' || CAST(page_no AS VARCHAR) || '-7'), page_no) AS k FROM (SELECT DISTINCT doc_id, page_no FROM page_lid)) WHERE k <= 8")
def page_sample(spark, d):
    w = Window.partitionBy("doc_id").orderBy(F.md5(F.concat_ws("-", F.col("doc_id").cast("string"), F.col("page_no").cast("string"), F.lit("7"))), "page_no")
    return table(spark, d, "page_lid").select("doc_id", "page_no").distinct().withColumn("k", F.row_number().over(w)).where("k <= 8")


@query("SELECT doc_id, " + ", ".join(f"CAST(a[{i} % len(a) + 1] AS DOUBLE) AS alpha_page{i}" for i in range(8)) + " FROM (SELECT doc_id, list(coalesce(alpha_bytes, 0) ORDER BY page_no, alpha_bytes) AS a FROM page_lid WHERE page_no IS NOT NULL GROUP BY doc_id)")
def flatten_features(spark, d):
    x = table(spark, d, "page_lid").where("page_no IS NOT NULL").groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("alpha_bytes", F.lit(0)).alias("a")))), lambda s: s["a"]).alias("a"))
    return x.select("doc_id", *[F.element_at("a", F.lit(i) % F.size("a") + 1).cast("double").alias(f"alpha_page{i}") for i in range(8)])


_T = [10 ** (-3 + 3 * i / 99) for i in range(100)]


@query("WITH t AS (SELECT unnest([" + ", ".join(repr(x) for x in _T) + "]::DOUBLE[]) AS threshold), r AS (SELECT doc_id, max(ocr_prob) AS p, max(num_pages) AS pages FROM ocr_routing GROUP BY doc_id), l AS (SELECT r.doc_id, p, pages, d.extractor = 'rolmOCR' AS y FROM r JOIN documents d ON d.doc_id = r.doc_id WHERE p IS NOT NULL AND pages IS NOT NULL) SELECT round(threshold, 9) AS threshold, CAST(count(*) FILTER (WHERE p >= threshold) AS BIGINT) AS selected, round(coalesce(sum(CASE WHEN y AND p >= threshold THEN pages END), 0) / nullif(sum(CASE WHEN y THEN pages END), 0), 6) AS recall, round(coalesce(sum(CASE WHEN p >= threshold THEN pages END), 0) / 5 / 86400, 9) AS gpu_days FROM l CROSS JOIN t GROUP BY threshold")
def recall_against_compute(spark, d):
    r = table(spark, d, "ocr_routing").groupBy("doc_id").agg(F.max("ocr_prob").alias("p"), F.max("num_pages").alias("pages")).where("p IS NOT NULL AND pages IS NOT NULL")
    x = r.join(table(spark, d, "documents").select("doc_id", (F.col("extractor") == "rolmOCR").alias("y")), "doc_id")
    # the hundred thresholds are conditional sums of one aggregation, not copies of the rows
    aggs = [F.struct(F.lit(t).alias("threshold"), F.count_if(F.col("p") >= t).alias("n"), F.sum(F.when(F.col("y") & (F.col("p") >= t), F.col("pages")).otherwise(0)).alias("hit"), F.sum(F.when(F.col("p") >= t, F.col("pages")).otherwise(0)).alias("work")) for t in _T]
    g = x.agg(F.sum(F.when(F.col("y"), F.col("pages"))).alias("all"), F.array(*aggs).alias("a")).select("all", F.explode("a").alias("a"))
    return g.select(F.round("a.threshold", 9).alias("threshold"), F.col("a.n").alias("selected"), F.round(F.try_divide(F.col("a.hit"), F.col("all")), 6).alias("recall"), F.round(F.col("a.work") / 5 / 86400, 9).alias("gpu_days"))
