"""Steps of a corpus pipeline as DataFrame → DataFrame functions: routing, page work, duplicates, thresholds, sampling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import records as R
from quire.functions import text as T
from quire.functions.arrays import spread


def route_index(index: DataFrame) -> DataFrame:
    """Adds `route` to crawl-index rows; every row keeps one, so the counts of the routes add up to the input."""
    c = F.col
    return index.withColumn("route", R.crawl_route(c("url"), c("content_mime_type"), c("content_mime_detected"), c("content_truncated")))


def index_records(index: DataFrame) -> DataFrame:
    """Crawl-index rows as documents: an id from the record's place, one media struct, a fetch date."""
    key = F.md5(F.concat_ws("|", "url", "warc_filename", F.col("warc_record_offset").cast("string")))
    media = F.struct(key.alias("id"), F.col("url"), F.col("warc_filename").alias("path"), F.col("warc_record_offset").alias("offset"), F.col("warc_record_length").alias("length"))
    return index.select(key.alias("id"), F.array(media).alias("media"), "dump", F.col("fetch_time").alias("date"), F.coalesce("content_mime_detected", "content_mime_type").alias("mime"), "content_languages", (F.col("content_truncated").isNotNull()).alias("is_truncated"))


def latest_delivery(index: DataFrame) -> DataFrame:
    """One row for each (warc_filename, warc_record_offset), the one ingested last: partial maxima before the shuffle."""
    rest = [c for c in index.columns if c not in ("warc_filename", "warc_record_offset")]
    best = F.max_by(F.struct(*rest), F.struct(F.coalesce("ingest_time", F.lit("1900-01-01").cast("timestamp")), "url"))
    return index.groupBy("warc_filename", "warc_record_offset").agg(best.alias("x")).select("warc_filename", "warc_record_offset", *[F.col(f"x.{c}") for c in rest])


def route_ocr(docs: DataFrame, features: DataFrame) -> DataFrame:
    """Adds `route` ocr or non_ocr from each document's largest routing features; documents without features are non_ocr."""
    f = features.groupBy("doc_id").agg(F.max("ocr_prob").alias("ocr_prob"), F.max("garbled_text_ratio").alias("garbled_text_ratio"))
    return docs.join(f, "doc_id", "left").withColumn("route", F.when(R.needs_ocr(F.col("ocr_prob"), F.col("garbled_text_ratio")), "ocr").otherwise("non_ocr"))


def drop_failed(docs: DataFrame) -> DataFrame:
    """Adds `reject_reason`: empty_text, no_pages, or null for documents that go on."""
    return docs.withColumn("reject_reason", F.when(F.coalesce(F.length("text"), F.lit(0)) == 0, "empty_text").when(F.coalesce(F.size("page_ends"), F.lit(0)) <= 0, "no_pages"))


def add_constants(df: DataFrame, **values) -> DataFrame:
    """Constant columns; values that a row has already win."""
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) if k in df.columns else F.lit(v) for k, v in values.items()})


def exact_duplicates(docs: DataFrame, key: Column, order: str = "doc_id", scope: Iterable[str] = ()) -> DataFrame:
    """Adds `copies` and `kept`: the first row of each key, by order, inside the scope's columns, is kept.

    Keys are aggregated to (count, least id) before anything is joined, so a key that a third of the rows share costs
    one partial row for each task. Rows with a null key are their own.
    """
    s = list(scope)
    k = docs.withColumn("_key", key)
    g = k.where(F.col("_key").isNotNull()).groupBy("_key", *s).agg(F.min(order).alias("_first"), F.count("*").alias("copies"))
    j = k.join(g.select("_key", *s, "_first", "copies"), ["_key", *s], "left")
    return j.select(*docs.columns, F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce(F.col(order) == F.col("_first"), F.lit(True)).alias("kept"))


def page_language_average(page_lid: DataFrame, least: float = 0.01) -> DataFrame:
    """(doc_id, best_lang, best_score, scores): page scores summed over known languages, divided by all pages.

    Repeated rows of a page count once. A document without a known page is `unknown` with 0.
    """
    p = page_lid.dropDuplicates(["doc_id", "page_no", "best_lang", "best_score"]).groupBy("doc_id", "page_no").agg(F.max_by(F.struct("best_lang", "best_score"), F.struct(F.coalesce("best_score", F.lit(-1.0)), "best_lang")).alias("x"))
    n = p.groupBy("doc_id").agg(F.count("*").alias("pages"))
    known = p.where((F.col("x.best_lang") != "unknown") & F.col("x.best_score").isNotNull()).groupBy("doc_id", F.col("x.best_lang").alias("lang")).agg(F.sum("x.best_score").alias("s"))
    s = known.join(n, "doc_id").select("doc_id", "lang", (F.col("s") / F.col("pages")).alias("score")).where(F.col("score") > least)
    g = s.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("lang", "score"))).alias("scores"), F.max_by("lang", F.struct("score", "lang")).alias("best_lang"), F.max("score").alias("best_score"))
    return n.select("doc_id").join(g, "doc_id", "left").select("doc_id", F.coalesce("best_lang", F.lit("unknown")).alias("best_lang"), F.coalesce("best_score", F.lit(0.0)).alias("best_score"), "scores")


def threshold_sweep(pairs: DataFrame, min_recall: float = 0.1, min_precision: float = 0.9, beta: float = 0.1) -> DataFrame:
    """Every score of a language as a threshold: (lang, score, kept, correct, precision, recall, f, feasible).

    Equal scores are aggregated first, and no task sums more than one range of a language's scores. Undecided pairs are left out.
    """
    g = pairs.where(F.col("language_correct").isNotNull() & F.col("score").isNotNull() & F.col("lang").isNotNull()).groupBy("lang", "score").agg(F.count("*").alias("n"), F.sum(F.col("language_correct").cast("bigint")).alias("c"))
    # running sums in two levels: over ranges of scores, of which a language has at most 4,097, then inside each range
    g = g.withColumn("range", F.greatest(F.least(F.floor(F.col("score") * 4096), F.lit(4096)), F.lit(0)))
    above = Window.partitionBy("lang").orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    r = g.groupBy("lang", "range").agg(F.sum("n").alias("rn"), F.sum("c").alias("rc"))
    r = r.select("lang", "range", F.coalesce(F.sum("rn").over(above), F.lit(0)).alias("n0"), F.coalesce(F.sum("rc").over(above), F.lit(0)).alias("c0"), F.sum("rc").over(Window.partitionBy("lang")).alias("all_true"))
    down = Window.partitionBy("lang", "range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    x = g.join(r, ["lang", "range"]).withColumns({"kept": F.col("n0") + F.sum("n").over(down), "correct": F.col("c0") + F.sum("c").over(down)})
    p, r = F.col("correct") / F.col("kept"), F.col("correct") / F.col("all_true")
    x = x.where(F.col("all_true") > 0).withColumns({"precision": p, "recall": r})
    f = F.coalesce(F.try_divide((1 + beta**2) * F.col("precision") * F.col("recall"), beta**2 * F.col("precision") + F.col("recall")), F.lit(0.0))
    return x.select("lang", "score", "kept", "correct", "precision", "recall", f.alias("f"), ((F.col("recall") >= min_recall) & (F.col("precision") >= min_precision)).alias("feasible"))


def language_thresholds(pairs: DataFrame, **limits) -> DataFrame:
    """(lang, threshold, kept, precision, recall): the feasible threshold of the best F-beta, the highest score of equals."""
    best = F.max_by(F.struct("score", "kept", "precision", "recall"), F.struct("f", "score"))
    x = threshold_sweep(pairs, **limits).where("feasible").groupBy("lang").agg(best.alias("x"))
    return x.select("lang", (F.col("x.score") - F.lit(1e-12)).alias("threshold"), "x.kept", "x.precision", "x.recall")


def threshold_report(pairs: DataFrame, **limits) -> DataFrame:
    """(lang, n, n_true, trivial_accuracy, threshold, kept, precision, recall, f1), rounded to six places."""
    n = pairs.where(F.col("language_correct").isNotNull() & F.col("lang").isNotNull()).groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.col("language_correct").cast("bigint")).alias("n_true"))
    t = language_thresholds(pairs, **limits)
    r = lambda c: F.round(c, 6)
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return n.join(t, "lang", "left").select("lang", "n", "n_true", r(F.col("n_true") / F.col("n")).alias("trivial_accuracy"), r("threshold").alias("threshold"), "kept", r("precision").alias("precision"), r("recall").alias("recall"), r(f1).alias("f1"))


def with_language_bucket(scores: DataFrame, thresholds: DataFrame, floor: float = 0.05) -> DataFrame:
    """Adds bucket and accepted to rows with `scores`; thresholds (one row a language) are at least `floor`, zxx free.

    The thresholds are one map, bounded by the number of languages, that a scalar subquery gives to every row.
    """
    th = thresholds.agg(F.map_from_entries(F.collect_list(F.struct("lang", F.greatest("threshold", F.lit(floor))))).alias("th")).select(F.map_concat("th", F.create_map(*[x for z in ("zxx_Latn", "zxx_Cyrl", "zxx_Arab") for x in (F.lit(z), F.lit(-1.0))])).alias("th"))
    x = scores.withColumn("th", th.scalar())
    return x.withColumn("x", R.select_language(F.coalesce("scores", F.array().cast("array<struct<lang:string,score:double>>")), F.col("th"))).select(*scores.columns, "x.bucket", "x.accepted")


def samples_per_class(labels: DataFrame, label: str, low: int, high: int, most_repeats: float = 4.0, downscale: float = 10.0) -> DataFrame:
    """(label, n, samples) for each class from low to high: rare classes repeat, common ones are capped, empty ones give 0."""
    valid = labels.where(F.col(label).between(low, high)).groupBy(F.col(label).cast("int").alias("label")).agg(F.count("*").alias("n"))
    every = labels.sparkSession.range(low, high + 1).select(F.col("id").cast("int").alias("label"))
    x = every.join(valid, "label", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    t = x.where("n > 0").agg((F.min("n") * most_repeats).alias("t"))
    x = x.withColumn("t", t.scalar())
    cap = F.col("t") * downscale
    return x.select("label", "n", F.when(F.col("n") == 0, 0).otherwise(F.greatest(F.least(F.col("n").cast("double"), cap), F.col("t"))).cast("bigint").alias("samples"))


def hash_ranks(rows: DataFrame, label: str, key: str, seed: str) -> DataFrame:
    """Adds `rank` of a row in its class by a hash of the key, and `m`, the rows of the class.

    Classes are few and large, so ranks come in two levels: 4,096 hash ranges of each class are counted and summed up,
    and rows are ranked inside their range only. Rows of a null class are left out.
    """
    h = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    x = rows.where(F.col(label).isNotNull()).withColumns({"_h": h, "_b": F.substring(h, 1, 3)})
    n = x.groupBy(label, "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    n = n.select(label, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"), F.sum("_n").over(Window.partitionBy(label)).alias("m"))
    inside = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", key))
    return x.join(n, [label, "_b"]).withColumn("rank", F.col("_o") + inside).drop("_h", "_b", "_o")


def balanced_sample(rows: DataFrame, label: str, key: str, wanted: DataFrame, seed: str = "42") -> DataFrame:
    """(label, key, copies) drawn so that each class has the wanted number of samples: whole rounds, then the first by hash."""
    x = hash_ranks(rows.select(label, key), label, key, seed).join(F.broadcast(wanted.select(F.col("label").alias(label), "samples")), label)
    copies = F.expr("samples div m").cast("bigint") + (F.col("rank") <= F.col("samples") % F.col("m")).cast("bigint")
    return x.select(F.col(label).alias("label"), F.col(key).alias("key"), copies.alias("copies")).where("copies > 0")


def stratified_split(rows: DataFrame, label: str, key: str, test_share: float = 0.04, most: int = 20000, seed: str = "42") -> DataFrame:
    """Adds `split`: in each class the first rows by hash are test, test_share of them rounded up, `most` in all classes."""
    classes = rows.select(label).where(F.col(label).isNotNull()).distinct().count() or 1
    limit = F.least(F.ceil(F.col("m") * test_share), F.lit(most // classes))
    return hash_ranks(rows, label, key, seed).withColumn("split", F.when(F.col("rank") <= limit, "test").otherwise("train")).drop("rank", "m")


def class_metrics(pred: DataFrame, truth: str, guess: str, low: int = 0, high: int = 5) -> DataFrame:
    """One row: accuracy and macro precision, recall and F1 of scores rounded half to even and clipped into the classes."""
    g = F.greatest(F.least(F.bround(F.col(guess).cast("double")), F.lit(high)), F.lit(low)).cast("int")
    m = pred.where(F.col(truth).isNotNull() & F.col(guess).isNotNull()).select(F.col(truth).cast("int").alias("y"), g.alias("p")).groupBy("y", "p").agg(F.count("*").alias("n"))
    t = m.groupBy(F.col("y").alias("k")).agg(F.sum("n").alias("true"), F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)).alias("hit"))
    q = m.groupBy(F.col("p").alias("k")).agg(F.sum("n").alias("said"))
    x = t.join(q, "k", "full").fillna(0, ["true", "hit", "said"])
    p, r = F.coalesce(F.try_divide("hit", "said"), F.lit(0.0)), F.coalesce(F.try_divide("hit", "true"), F.lit(0.0))
    x = x.withColumns({"p": p, "r": r}).withColumn("f", F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0)))
    return x.agg(F.round(F.sum("hit") / F.sum("true"), 6).alias("accuracy"), F.round(F.avg("p"), 6).alias("macro_precision"), F.round(F.avg("r"), 6).alias("macro_recall"), F.round(F.avg("f"), 6).alias("macro_f1"))


def _group_keys(by: list[str]) -> dict[str, Column]:
    """Keys that join null groups, too; one constant where there are no groups."""
    return {f"_k{i}": F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for i, c in enumerate(by)} or {"_k0": F.lit("")}


def medians(df: DataFrame, value: str, by: list[str], slots: int = 4096) -> DataFrame:
    """(_k0 ..., median), keys as strings: exact medians without a group in one task. A histogram of each group names the slots of its two
    middle ranks; of these slots alone values are counted, equal ones together. NaN and null values are left out."""
    keys = _group_keys(by)
    names = list(keys)
    x = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*[k.alias(n) for n, k in keys.items()], F.col(value).cast("double").alias("_v"))
    g = x.groupBy(*names).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    x = x.join(g, names).withColumn("_s", F.coalesce(F.least(F.floor(F.try_divide(F.col("_v") - F.col("_lo"), F.col("_hi") - F.col("_lo")) * slots), F.lit(slots - 1)), F.lit(0)))
    h = x.groupBy(*names, "_s", "_n").agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*names).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    h = h.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0)))
    low, high = F.expr("(_n + 1) div 2"), F.expr("_n div 2 + 1")
    h = h.where(((low > F.col("_before")) & (low <= F.col("_before") + F.col("_c"))) | ((high > F.col("_before")) & (high <= F.col("_before") + F.col("_c")))).select(*names, "_s", "_before")
    v = x.join(h, [*names, "_s"]).groupBy(*names, "_s", "_before", "_n", "_v").agg(F.count("*").alias("_c"))
    inside = Window.partitionBy(*names, "_s").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    v = v.withColumn("_to", F.col("_before") + F.sum("_c").over(inside)).withColumn("_from", F.col("_to") - F.col("_c"))
    at = lambda r: F.max(F.when((r > F.col("_from")) & (r <= F.col("_to")), F.col("_v")))
    return v.groupBy(*names).agg(((at(low) + at(high)) / 2).alias("median"))


def dataset_stats(df: DataFrame, value: str, by: Iterable[str] = (), bins: int = 20) -> DataFrame:
    """Count, mean, median, sample deviation and a histogram over [0, 1] of a column; -1 where nothing is there."""
    by = list(by)
    v = F.col(value)
    slot = F.least(F.greatest(F.floor(v * bins), F.lit(0)), F.lit(bins - 1))
    hist = [F.count_if(v.isNotNull() & (slot == i)) for i in range(bins)]
    d = lambda x: F.round(F.coalesce(x, F.lit(-1.0)), 6)
    g = (df.groupBy(*by) if by else df.groupBy()).agg(F.count(v).alias("n"), d(F.avg(v)).alias("mean"), d(F.stddev_samp(v)).alias("std"), F.array(*hist).alias("histogram"))
    m = medians(df, value, by)
    keys = _group_keys(by)
    return g.withColumns(keys).join(m, list(keys), "left").select(*by, "n", "mean", d(F.col("median")).alias("median"), "std", "histogram")


def publish(docs: DataFrame, page_lid: DataFrame | None = None) -> DataFrame:
    """The seventeen published columns of a document; the page languages are null where page_lid is not given or has none."""
    if page_lid is not None:
        p = page_lid.groupBy("doc_id", "page_no").agg(F.max_by("best_lang", F.struct(F.coalesce("best_score", F.lit(-1.0)), "best_lang")).alias("l"))
        per_page = p.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "l"))), lambda x: x["l"]).alias("_pages"))
        average = page_language_average(page_lid).select("doc_id", F.col("best_lang").alias("_lang"), F.col("best_score").alias("_score"))
        docs = docs.join(per_page.join(average, "doc_id"), "doc_id", "left")
    else:
        docs = docs.withColumns({"_pages": F.lit(None).cast("array<string>"), "_lang": F.lit(None).cast("string"), "_score": F.lit(None).cast("double")})
    known = F.when(~F.col("lang").isin("", "und", "unknown"), F.col("lang"))
    return docs.select(
        "text", F.md5(F.concat_ws("|", "url", "file_path", F.col("record_offset").cast("string"))).alias("id"), F.coalesce("dump", R.dump_of(F.col("file_path"))).alias("dump"), "url", F.col("fetch_time").alias("date"), "file_path",
        F.col("record_offset").alias("offset"), "token_count", F.coalesce(known, "_lang").alias("language"), F.col("_lang").alias("page_average_lid"), F.round("_score", 6).alias("page_average_lid_score"),
        F.col("lang").alias("full_doc_lid"), F.col("lang_score").alias("full_doc_lid_score"), F.col("_pages").alias("per_page_languages"), "is_truncated", "extractor", "page_ends",
    )


def boilerplate(pages: DataFrame, least_share: float = 0.25, least_pages: int = 5) -> DataFrame:
    """(doc_id, page_no, top, bottom): lines at the edges of pages that many pages of a document share.

    pages (doc_id, page_no, text). Lines are compared with digits as 0 and without blanks; table lines never match. The
    most frequent first line, on equal counts that of the earliest page, makes its pages candidates if they are enough;
    the run goes on as long as all candidates agree. The end of a page is treated in the same way, backwards.
    """
    lines = F.split("text", "\n")
    norm = F.transform(lines, lambda x, i: F.when(x.rlike(r"^\s*\|.*\|\s*$"), F.concat(F.lit("\x00"), i.cast("string"), F.lit("-"), F.col("page_no").cast("string"))).otherwise(F.regexp_replace(F.regexp_replace(x, r"\d", "0"), " ", "")))
    p = pages.select("doc_id", "page_no", norm.alias("n"))
    n = p.groupBy("doc_id").agg(F.count("*").alias("pages"))

    def side(x: DataFrame, name: str) -> DataFrame:
        f = x.withColumn("first", F.get("n", F.lit(0)))
        c = f.groupBy("doc_id", "first").agg(F.count("*").alias("c"), F.min("page_no").alias("at"), F.min(F.size("n")).alias("least"))
        m = c.join(n, "doc_id").groupBy("doc_id", "pages").agg(F.max_by(F.struct("first", "c", "least"), F.struct("c", -F.col("at"))).alias("m"))
        m = m.where((F.col("pages") > 1) & (F.col("m.c") >= F.greatest(F.lit(least_pages).cast("double"), F.col("pages") * least_share)) & ~F.col("m.first").startswith("\x00")).select("doc_id", F.col("m.first").alias("first"), F.col("m.least").alias("least"))
        cand = f.join(m, ["doc_id", "first"])
        # lines on which all candidates agree: positions whose values are one, up to the first that are not
        e = cand.select("doc_id", F.posexplode(F.expr("slice(n, 1, least)")).alias("pos", "line")).groupBy("doc_id", "pos").agg((F.min("line") != F.max("line")).alias("differ"))
        stop = e.groupBy("doc_id").agg(F.min(F.when(F.col("differ"), F.col("pos"))).alias("stop"))
        return cand.join(stop, "doc_id").select("doc_id", "page_no", F.coalesce("stop", "least").alias(name))

    top = side(p, "top")
    bottom = side(p.select("doc_id", "page_no", F.reverse("n").alias("n")), "bottom")
    x = p.select("doc_id", "page_no").join(top, ["doc_id", "page_no"], "left").join(bottom, ["doc_id", "page_no"], "left")
    return x.select("doc_id", "page_no", F.coalesce("top", F.lit(0)).alias("top"), F.coalesce("bottom", F.lit(0)).alias("bottom"))


def page_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, page_no, text) of documents with text and page ends; small inputs are spread over the cores."""
    d = spread(docs.where(F.col("text").isNotNull() & (F.size("page_ends") > 0)).select("doc_id", "text", "page_ends"))
    # no array is empty here; the outer form has no filter inferred that would cut the pages a second time
    return d.select("doc_id", F.posexplode_outer(T.pages(F.col("text"), F.col("page_ends"))).alias("page_no", "text"))


def coalesce_failed(pages: Column) -> Column:
    """struct(pages, ok): pages that extraction gave up on, or invented, become a marker; ok if one page is left."""
    # Markers of failed pages and beginnings of invented ones
    bad = r"<--- (failed_to_process_page|stop_reason_[^>]*) --->|^The \d+-\d+ season|^The following is a list of the most common types of data breaches and how"
    fixed = F.transform(pages, lambda x: F.when(x.rlike(bad), F.lit("<failed_page></failed_page>\n")).otherwise(F.concat(F.btrim(x, F.lit(" \t\n\r\x0b\x0c")), F.lit("\n"))))
    return F.struct(fixed.alias("pages"), F.coalesce(F.exists(pages, lambda x: ~x.rlike(bad)), F.lit(False)).alias("ok"))


def fold_replies(replies: Column) -> Column:
    """One text of array<struct(ok, text, finish_reason, repeated)>: pages that failed or were cut become markers."""
    return F.array_join(F.transform(replies, lambda x: F.when(~F.coalesce(x["ok"], F.lit(False)), "<--- failed_to_process_page --->").when(F.coalesce(x["repeated"], F.lit(False)), "<--- stop_reason_repetition --->").when(x["finish_reason"] != "stop", F.concat(F.lit("<--- stop_reason_"), x["finish_reason"], F.lit(" --->"))).otherwise(x["text"])), "\n")


def unfinished(tasks: DataFrame, results: DataFrame, since: str, key: str = "task") -> DataFrame:
    """Tasks without a result newer than a date."""
    return tasks.join(results.where(F.col("finished_at") > F.lit(since).cast("timestamp")).select(key), key, "left_anti")
