"""Column builders for records: mime types, addresses, scores, languages, identifiers, geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Media types that name a PDF
PDF_MIMES = ("application/pdf", "application/x-pdf", "application/acrobat", "applications/vnd.pdf", "text/pdf")


def mime_pdf(declared: Column, detected: Column) -> Column:
    """Whether either media type names a PDF; nulls name none."""
    return F.coalesce(detected.isin(*PDF_MIMES), F.lit(False)) | F.coalesce(declared.isin(*PDF_MIMES), F.lit(False))


def path_pdf(url: Column) -> Column:
    """Whether the path of an address ends in .pdf."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://[^/?#]*([^?#]*)", 1).endswith(".pdf"), F.lit(False))


def crawl_route(url: Column, declared: Column, detected: Column, truncated: Column) -> Column:
    """not_pdf, truncated (to be fetched again) or non_truncated."""
    mime = mime_pdf(declared, detected)
    return F.when(~(mime | path_pdf(url)), "not_pdf").when(truncated.isNotNull() & mime, "truncated").otherwise("non_truncated")


def media_type(header: Column) -> Column:
    """The media type before its parameters, in lower case."""
    return F.lower(F.trim(F.split_part(header, F.lit(";"), F.lit(1))))


def needs_ocr(prob: Column, garbled: Column, least: float = 0.2, most_garbled: float = 0.0) -> Column:
    return (F.coalesce(prob, F.lit(0.0)) >= least) | (F.coalesce(garbled, F.lit(0.0)) > most_garbled)


def dump_of(path: Column) -> Column:
    """The crawl's name in an archive path; null where there is none."""
    a, b = F.regexp_extract(path, r"crawl=(.*?)/", 1), F.regexp_extract(path, r"crawl-data/(.*?)/", 1)
    return F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))


def scores_of(text: Column) -> Column:
    """Comma-joined numbers as an array; empty where one cannot be read."""
    a = F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast("double"))
    return F.when(F.coalesce(F.exists(a, lambda x: x.isNull()), F.lit(True)), F.array().cast("array<double>")).otherwise(a)


def best_score(scores: Column) -> Column:
    """The largest of an array's scores, 0 where there is none."""
    return F.coalesce(F.array_max(scores), F.lit(0.0))


def rating_of(reply: Column, label: str = "Educational score") -> Column:
    """The number that a teacher's reply gives after the label, or null."""
    return F.regexp_extract(reply, label + r":\s*(\d+)", 1).try_cast("int")


def yes_no(reply: Column) -> Column:
    """true, false, or null for a reply that begins with neither word."""
    r = F.upper(F.trim(reply))
    return F.when(r.startswith("YES"), True).when(r.startswith("NO"), False)


def alias(lang: Column, names: dict[str, str]) -> Column:
    """A language's other name where it has one."""
    if not names:
        return lang
    m = F.create_map(*[F.lit(x) for kv in sorted(names.items()) for x in kv])
    return F.coalesce(F.try_element_at(m, lang), lang)


def select_language(scores: Column, thresholds: dict[str, float] | Column, free: str = "zxx_") -> Column:
    """struct(bucket, accepted) from an array of struct(lang, score).

    Languages go by falling score, then name; the first above its threshold wins, a first-placed one without words
    (zxx) at once. Without a winner the first language, or `unknown`, is taken, as removed if it has a threshold.
    """
    th = thresholds if isinstance(thresholds, Column) else F.create_map(*[F.lit(x) for kv in sorted(thresholds.items()) for x in kv])
    order = F.array_sort(scores, lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).when(a["lang"] < b["lang"], -1).when(a["lang"] > b["lang"], 1).otherwise(0))
    first = F.get(order, F.lit(0))["lang"]
    ok = F.filter(order, lambda x, i: ((i == 0) & x["lang"].startswith(free)) | (x["score"] > F.coalesce(F.try_element_at(th, x["lang"]), F.lit(10000.0))))
    won = F.get(ok, F.lit(0))["lang"]
    lost = F.coalesce(first, F.lit("unknown"))
    removed = F.concat(lost, F.when(F.try_element_at(th, lost).isNotNull(), F.lit("_removed")).otherwise(F.lit("")))
    return F.struct(F.coalesce(won, removed).alias("bucket"), won.isNotNull().alias("accepted"))


def render_size(width: Column, height: Column, longest: int = 1280, align: int = 28, most_tokens: int = 2048) -> Column:
    """struct(width, height, zoom): sides of a page image on the grid, the longest side and the token area capped."""
    zoom = F.lit(float(longest)) / F.greatest(width, height)
    up = lambda x: F.greatest(F.floor(x * zoom / align), F.lit(1)) * align
    area = up(width) * up(height)
    cap = F.sqrt(F.least(F.lit(1.0), F.lit(float(most_tokens * align * align)) / area))
    w, h = F.greatest(F.floor(up(width) * cap / align), F.lit(1)) * align, F.greatest(F.floor(up(height) * cap / align), F.lit(1)) * align
    return F.struct(w.cast("int").alias("width"), h.cast("int").alias("height"), F.least(w / width, h / height).alias("zoom"))


# geometry of boxes with columns or fields l, t, r, b and the origin at the top left


def area(b: Column) -> Column:
    return F.greatest(b["r"] - b["l"], F.lit(0.0)) * F.greatest(b["b"] - b["t"], F.lit(0.0))


def shared_area(a: Column, b: Column) -> Column:
    w = F.least(a["r"], b["r"]) - F.greatest(a["l"], b["l"])
    h = F.least(a["b"], b["b"]) - F.greatest(a["t"], b["t"])
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    s = shared_area(a, b)
    return s / (area(a) + area(b) - s + 1e-6)


def share_inside(a: Column, b: Column) -> Column:
    """Part of a that lies in b."""
    return F.coalesce(F.try_divide(shared_area(a, b), area(a)), F.lit(0.0))


def enclosing(a: Column, b: Column) -> Column:
    return F.struct(F.least(a["l"], b["l"]).alias("l"), F.least(a["t"], b["t"]).alias("t"), F.greatest(a["r"], b["r"]).alias("r"), F.greatest(a["b"], b["b"]).alias("b"))


def flip(b: Column, height: Column) -> Column:
    """The box with the other vertical origin."""
    return F.struct(b["l"].alias("l"), (height - b["b"]).alias("t"), b["r"].alias("r"), (height - b["t"]).alias("b"))
