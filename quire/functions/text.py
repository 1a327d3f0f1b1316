"""Column builders for page text: counts, clean-up and markup. Nulls stay null; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import fixed

# The tag families that extraction puts around formulas, images, annotations, page numbers and tables
TAGS = r"</?docling_(?:formula|image|picture_annotation(?:_non_text)?|page_number|table)>"
FAILED = r"(?s)<(failed|corrupted)_page>.*?</\1_page>"
PRIVATE = r"[\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}\x{FFFD}]"
# Dashes after which the next page goes on without a break
DASHES = "-‐‒–—"


def alpha_bytes(c: Column) -> Column:
    """Bytes of the letters of a text."""
    return F.octet_length(F.regexp_replace(c, r"[^\p{L}]", ""))


def alpha_chars(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\p{L}]", ""))


def dense_bytes(c: Column) -> Column:
    """Bytes without white space, Unicode's included."""
    return F.octet_length(F.regexp_replace(c, r"(?U)\s+", ""))


def lid_text(c: Column, table_limit: int | None = None) -> Column:
    """Text as language identification reads it: no table lines, no |-*#, single blanks.

    table_limit gives the compatible behaviour that removes only the first so many table lines.
    """
    if table_limit is None:
        c = F.regexp_replace(c, r"(?m)^[ \t]*\|.*\|[ \t]*$", "")
    else:
        lines = F.split(c, "\n")
        hits = lambda upto: F.size(F.filter(F.slice(lines, 1, upto), lambda x: x.rlike(r"^\s*\|.*\|\s*$")))
        c = F.array_join(F.transform(lines, lambda x, i: F.when(x.rlike(r"^\s*\|.*\|\s*$") & (hits(i + 1) <= table_limit), "").otherwise(x)), "\n")
    return F.regexp_replace(F.regexp_replace(c, r"[|\-*#]", ""), r"(?U)\s+", " ")


def lid_eligible(c: Column, least_bytes: int = 50, least_ratio: float = 0.2) -> Column:
    """Whether enough of a page's bytes are letters."""
    return (alpha_bytes(c) >= least_bytes) & (alpha_bytes(c) / F.greatest(dense_bytes(c), F.lit(1)) >= least_ratio)


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, TAGS, "")


def strip_failed(c: Column) -> Column:
    return F.regexp_replace(c, FAILED, "")


def strip_markup(c: Column) -> Column:
    """No tags, and single line ends."""
    return F.regexp_replace(strip_tags(c), r"\n+", "\n")


def weird_spaces(c: Column, any_of: bool = False) -> Column:
    """The literal run of tab, return, blank, no-break space and further blanks becomes one blank; any_of takes each."""
    return F.regexp_replace(c, r"[\t\r\x{A0}]+" if any_of else r"\t\r \x{A0}[^\S\n]*", " ")


def drop_private(c: Column) -> Column:
    """No private-use and no replacement characters."""
    return F.regexp_replace(c, PRIVATE, "")


def squeeze_lines(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, r"\n{2,}", "\n\n"), F.lit(" \t\n\r\x0b\x0c"))


def plain_signs(c: Column) -> Column:
    """Typographic slashes, quotes and the stray control sign as plain characters."""
    return F.translate(c, "⁄’‘“”\x02", "/''\"\"-")


def spaced_header(c: Column) -> Column:
    """Letters pulled apart in a header: single blanks go, longer runs become one."""
    return F.regexp_replace(F.regexp_replace(c, r"(?<=\S) (?=\S)", ""), r" {2,}", " ")


def short_rules(c: Column) -> Column:
    """Runs of more than ten underscores become ten."""
    return F.regexp_replace(c, r"_{11,}", "_" * 10)


def escape_markdown(c: Column) -> Column:
    """HTML signs escaped, and underscores but those escaped already and those of an image."""
    c = F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    # by turns outside and inside of an image; the sign between them is in no text
    pieces = F.split(F.regexp_replace(c, r"(!\[[^\n]*?\]\([^\n]*?\))", "\x00$1\x00"), "\x00")
    return F.array_join(F.transform(pieces, lambda x, i: F.when(i % 2 == 1, x).otherwise(F.regexp_replace(x, r"(?<!\\)_", "\\\\_"))), "")


def unify_list_marks(c: Column, list_item: bool | Column = False) -> Column:
    """The mark at an item's start as -, * or [x]; in list items the first white space becomes one blank."""
    for pattern, mark in fixed.mark_patterns():
        c = F.regexp_replace(c, "(?U)" + pattern, mark)
    one = F.regexp_replace(c, r"(?Us)^(\S*)\s+", "$1 ")
    return F.when(list_item if isinstance(list_item, Column) else F.lit(list_item), one).otherwise(c)


def garbled_ratio(c: Column) -> Column:
    """Share of replacement characters; 0 for an empty text."""
    return F.coalesce(F.try_divide(F.length(c) - F.length(F.replace(c, F.lit("\uFFFD"), F.lit(""))), F.length(c)), F.lit(0.0))


def scanner_producer(c: Column) -> Column:
    """Whether a creator's or producer's name is that of scanning software or devices."""
    return F.coalesce(F.lower(c).rlike("|".join(fixed.SCANNERS)), F.lit(False))


def exact_key(c: Column) -> Column:
    """Key of texts that are equal but for white space."""
    return F.md5(F.regexp_replace(c, r"(?U)\s+", ""))


def pages(text: Column, ends: Column) -> Column:
    """Array of page texts from cumulative ends; the whole text as one page where ends are null or empty."""
    e = F.when(F.coalesce(F.size(ends), F.lit(0)) > 0, ends).otherwise(F.array(F.length(text).cast("bigint")))
    return F.transform(e, lambda x, i: F.substring(text, (F.coalesce(F.get(e, i - 1), F.lit(0)) + 1).cast("int"), F.greatest(x - F.coalesce(F.get(e, i - 1), F.lit(0)), F.lit(0)).cast("int")))


def page_ends(ps: Column) -> Column:
    """Cumulative ends of page texts laid side by side."""
    return F.transform(ps, lambda _, i: F.aggregate(F.slice(ps, F.lit(1), i + 1), F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)))


def pages_to_text(ps: Column) -> Column:
    """struct(text, page_ends, page_indices) of page texts.

    Blank pages go and the others keep their numbers; pages are parted by a blank line, except that one ending in a
    letter and a dash is joined to the next without the dash. Its recorded end still counts the dash.
    """
    trimmed = F.transform(ps, lambda x, i: F.struct(F.btrim(x, F.lit(" \t\n\r\x0b\x0c")).alias("t"), i.cast("int").alias("i")))
    live = F.filter(trimmed, lambda x: F.coalesce(F.length(x["t"]) > 0, F.lit(False)))
    start = F.struct(F.lit("").alias("tail"), F.lit(0).cast("bigint").alias("n"), F.array().cast("array<bigint>").alias("ends"), F.array().cast("array<boolean>").alias("joins"))

    # the fold carries the last two characters and the length, never the text
    def step(a, x):
        join = a["tail"].rlike(rf"\p{{L}}[{DASHES}]\z")
        gap = F.when((F.size(a["ends"]) == 0), 0).when(join, -1).otherwise(2)
        tail = F.when(join, F.concat(F.substring(a["tail"], 1, 1), x["t"])).otherwise(x["t"])
        n = a["n"] + gap + F.length(x["t"])
        return F.struct(F.right(tail, F.lit(2)).alias("tail"), n.alias("n"), F.concat(a["ends"], F.array(n)).alias("ends"), F.concat(a["joins"], F.array(join)).alias("joins"))

    def piece(x, i, s):
        cut = F.coalesce(F.get(s["joins"], i + 1), F.lit(False))
        gap = F.when((i == 0) | F.get(s["joins"], i), "").otherwise("\n\n")
        return F.concat(gap, F.when(cut, F.substring(x["t"], F.lit(1), F.length(x["t"]) - 1)).otherwise(x["t"]))

    both = F.array(F.struct(live.alias("l"), F.aggregate(live, start, step).alias("s")))
    return F.transform(both, lambda b: F.struct(F.array_join(F.transform(b["l"], lambda x, i: piece(x, i, b["s"])), "").alias("text"), b["s"]["ends"].alias("page_ends"), F.transform(b["l"], lambda x: x["i"]).alias("page_indices")))[0]
