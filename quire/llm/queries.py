"""The pN_ queries, over whole tables with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import abuse, cutoff, language, leak, mixing, neardup, packing, reading, scan, tokens
from quire.session import table

Query = Callable[[SparkSession, str], DataFrame]


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def p1_found(spark, d):
    docs = _docs(spark, d)
    return language.label_cases(docs, language.fit(docs))


def p1_documents(spark, d):
    docs = _docs(spark, d)
    return language.identify(docs, language.fit(docs)).select("doc_id", "language", F.round("score", 6).alias("score"), F.size("segments").alias("segments"))


def p1_segments(spark, d):
    docs = _docs(spark, d)
    return language.identify(docs, language.fit(docs)).select("doc_id", F.posexplode("segments").alias("segment_no", "s")).select("doc_id", "segment_no", "s.start", "s.stop", "s.language", F.round("s.score", 6).alias("score"), "s.words")


def p4_found(spark, d):
    return neardup.pairs(_docs(spark, d), 3, 0.7)


def p4_groups(spark, d):
    return neardup.groups(_docs(spark, d), 5, 0.8)


def p6_found(spark, d):
    return cutoff.kept(_docs(spark, d), table(spark, d, "keep_targets"))


def p6_cutoffs(spark, d):
    return cutoff.cutoffs(_docs(spark, d), table(spark, d, "keep_targets"))


def p6_report(spark, d):
    return cutoff.report(_docs(spark, d), table(spark, d, "keep_targets"))


def p7_found(spark, d):
    return leak.found(_docs(spark, d), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p7_report(spark, d):
    return leak.report(_docs(spark, d), table(spark, d, "eval_items"))


def p5_found(spark, d):
    return scan.found(_docs(spark, d))


def p5_repaired(spark, d):
    return scan.examine(_docs(spark, d), with_text=True)


def p10_found(spark, d):
    return abuse.found(_docs(spark, d), table(spark, d, "teacher_labels"))


def p10_documents(spark, d):
    docs = _docs(spark, d)
    return abuse.score(docs, abuse.fit(docs, table(spark, d, "teacher_labels"))).select("doc_id", F.round("score", 6).alias("score"), F.size("sentences").alias("offending_sentences"))


def p10_rates(spark, d):
    return abuse.rates(_docs(spark, d), table(spark, d, "teacher_labels"))


def p3_found(spark, d):
    return reading.found(_docs(spark, d))


def p3_profile(spark, d):
    return reading.profile(_docs(spark, d))


def p2_cube(spark, d):
    return tokens.cube(_docs(spark, d))


def p2_documents(spark, d):
    return tokens.counted(_docs(spark, d))


def p8_pack(spark, d):
    return packing.assign(_docs(spark, d), table(spark, d, "pack_targets"))


def p8_summary(spark, d):
    t = table(spark, d, "pack_targets")
    return packing.summary(packing.assign(_docs(spark, d), t), t)


def p9_mix(spark, d):
    return mixing.choose(_docs(spark, d), table(spark, d, "mix_targets"))[0]


def p9_shares(spark, d):
    return mixing.shares(_docs(spark, d), table(spark, d, "mix_targets"))


QUERIES: dict[str, Query] = {
    "p1_found": p1_found, "p1_documents": p1_documents, "p1_segments": p1_segments,
    "p2_documents": p2_documents, "p2_cube": p2_cube,
    "p3_found": p3_found, "p3_profile": p3_profile,
    "p4_found": p4_found, "p4_groups": p4_groups,
    "p6_found": p6_found, "p6_cutoffs": p6_cutoffs, "p6_report": p6_report,
    "p5_found": p5_found, "p5_repaired": p5_repaired, "p7_found": p7_found, "p7_report": p7_report,
    "p8_pack": p8_pack, "p8_summary": p8_summary, "p9_mix": p9_mix, "p9_shares": p9_shares,
    "p10_found": p10_found, "p10_documents": p10_documents, "p10_rates": p10_rates,
}

_P6 = """WITH scored AS (SELECT source, doc_id, lang, score FROM documents WHERE score IS NOT NULL),
want AS (SELECT source, max(keep_pct) AS keep_pct FROM keep_targets WHERE source IS NOT NULL AND keep_pct IS NOT NULL GROUP BY source),
sized AS (SELECT w.source, w.keep_pct, count(s.doc_id) AS records FROM want w LEFT JOIN scored s ON s.source = w.source GROUP BY w.source, w.keep_pct),
ranks AS (SELECT source, keep_pct, records, CAST((least(keep_pct, 100) * records + 99) // 100 AS BIGINT) AS "rank" FROM sized),
ordered AS (SELECT source, score, row_number() OVER (PARTITION BY source ORDER BY score DESC) AS rn FROM scored),
cut AS (SELECT r.source, r.keep_pct, r.records, o.score AS cutoff, r."rank" FROM ranks r LEFT JOIN ordered o ON o.source = r.source AND o.rn = r."rank")
"""



def _pairs_sql(k: int, least: float) -> str:
    """CTEs sets, reps and links: every pair of texts that share a k-word shingle, compared in full."""
    words = " || ' ' || ".join(f"w[i + {j}]" if j else "w[i]" for j in range(k))
    return f"""w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{Nd}}]+') AS w FROM documents WHERE length(text) > 0),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= {k} THEN list_transform(range(1, len(w) - {k - 2}), lambda i: hash({words})) ELSE [hash(array_to_string(w, ' '))] END) AS s FROM w WHERE len(w) > 0),
reps AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY list_sort(s)) AS rep FROM sets),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND a.n >= {least} * b.n AND b.n >= {least} * a.n GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= {least} * (a.n + b.n - count(*)) - 1e-9)"""


SQL: dict[str, str] = {
    "p4_found": f"WITH {_pairs_sql(3, 0.7)} SELECT a AS doc_id_a, b AS doc_id_b FROM links",
    "p4_groups": f"WITH RECURSIVE {_pairs_sql(5, 0.8)}, own AS (SELECT a, b FROM links WHERE a IN (SELECT rep FROM reps) AND b IN (SELECT rep FROM reps)), twoway AS (SELECT a, b FROM own UNION SELECT b, a FROM own), reach AS (SELECT DISTINCT rep AS a, rep AS b FROM reps UNION SELECT r.a, x.b FROM reach r JOIN twoway x ON x.a = r.b), class AS (SELECT a, min(b) AS class_id FROM reach GROUP BY a) SELECT r.doc_id, c.class_id, (SELECT count(*) FROM twoway x WHERE x.a = r.rep) AS links FROM reps r JOIN class c ON c.a = r.rep",
    "p6_found": _P6 + "SELECT s.source, s.doc_id FROM scored s JOIN cut c ON c.source = s.source WHERE s.score >= c.cutoff",
    "p6_cutoffs": _P6 + 'SELECT source, keep_pct, records, cutoff, "rank" FROM cut',
    "p6_report": _P6 + "SELECT c.source, s.lang, c.keep_pct, c.cutoff, count(s.doc_id) AS records, count(CASE WHEN s.score >= c.cutoff THEN 1 END) AS kept FROM cut c LEFT JOIN scored s ON s.source = c.source GROUP BY c.source, s.lang, c.keep_pct, c.cutoff",
}
