"""Small steps on records: routing of failures, nested fields, samples, repeats, targets, caps, chunks in tokens, edits of trees."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.functions import text as T
from quire.functions.arrays import map_columns, spread
from quire.operators import layout as L

# Columns that hold a label, in the order in which they are looked for
LABELS = ("fw_edu_score", "dclm_score", "ocr_quality_score", "fw_edu_score_2", "label", "labels", "target", "y")


def fetched(df: DataFrame, media: str = "media_bytes") -> DataFrame:
    """Adds `route`: fetched where the media are there, failed where they are null; no row is lost."""
    return df.withColumn("route", F.when(F.col(media).isNotNull(), "fetched").otherwise("failed"))


def without_field(df: DataFrame, column: str, field: str) -> DataFrame:
    """df without a bulky field of a struct column; as it is where there is no such column or field."""
    kind = dict((f.name, f.dataType) for f in df.schema.fields).get(column)
    if not isinstance(kind, StructType) or field not in kind.names:
        return df
    return df.withColumn(column, F.col(column).dropFields(field)) if len(kind.names) > 1 else df.drop(column)


def sampled(df: DataFrame, rate: float, key: str, seed: int = 0) -> DataFrame:
    """About the share `rate` of the rows, by a hash of key: the same rows whatever the partitions, repeated keys together."""
    bound = min(max(int(rate * (1 << 32)), 0), 1 << 32)
    h = F.conv(F.substring(F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed)))), 1, 8), 16, 10).cast("bigint")
    return df.where(F.coalesce(h, F.lit(0)) < bound)


def where_modelled(df: DataFrame, language: str, models: Iterable[str], score: Column, name: str) -> DataFrame:
    """Adds `name`: the score where there is a model for the row's language; other rows pass with null."""
    known = sorted(set(models))
    return df.withColumn(name, F.when(F.col(language).isin(known), score) if known else F.lit(None).cast("double"))


def repeated(df: DataFrame, times: int) -> DataFrame:
    """Every row `times` times, with its `copy` from 1; none for 0."""
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times)))) if times > 0 else df.withColumn("copy", F.lit(1)).limit(0)


def target_column(columns: Iterable[str], preferred: str | None = None) -> str:
    """The column that holds the label: the preferred one if it is there, else the first known name."""
    there = set(columns)
    for name in (preferred, *LABELS):
        if name and name in there:
            return name
    raise ValueError(f"no target column among {sorted(there)}")


def confusion(pred: DataFrame, truth: str, guess: str, low: int = 0, high: int = 5) -> DataFrame:
    """(truth, guess, n): counts of scores rounded half to even and clipped into the classes; nulls are left out."""
    g = F.greatest(F.least(F.bround(F.col(guess).cast("double")), F.lit(high)), F.lit(low)).cast("int")
    return pred.where(F.col(truth).isNotNull() & F.col(guess).isNotNull()).groupBy(F.col(truth).cast("int").alias("truth"), g.alias("guess")).agg(F.count("*").alias("n"))


def joined_cells(lines: Column) -> Column:
    """One text of an array of cell texts: a dash between two words goes, other lines are parted by a blank."""
    live = F.filter(F.transform(lines, lambda x: F.trim(F.translate(x, "\x02", "-"))), lambda x: F.coalesce(F.length(x) > 0, F.lit(False)))

    def piece(x, i, all_):
        nxt = F.get(all_, i + 1)
        last, first = F.regexp_extract(x, r"(?U)(\w+)\W*$", 1), F.regexp_extract(nxt, r"(?U)(\w+)", 1)
        word = lambda w: (w != "") & ~F.contains(w, F.lit("_"))
        return F.when(nxt.isNull(), x).when(~x.endswith("-"), F.concat(x, F.lit(" "))).when(word(last) & word(first), F.substring(x, F.lit(1), F.length(x) - 1)).otherwise(x)

    both = F.transform(F.array(live), lambda a: F.array_join(F.transform(a, lambda x, i: piece(x, i, a)), ""))[0]
    return F.trim(F.translate(both, "⁄’‘“”•", "/''\"\"·"))


def capped(text: Column, most: int = 1_000_000) -> Column:
    """Texts over `most` characters up to the next white space behind them; exactly `most` where there is none."""
    rest = F.substring(text, F.lit(most + 1), F.length(text))
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.substring(text, 1, most), F.when(rest.rlike(r"(?U)\s"), F.regexp_extract(rest, r"(?U)^(\S*)", 1)).otherwise("")))


class Words:
    """Tokens as words with the white space before them, for where no tokenizer is at hand."""

    def encode(self, text: str) -> list:
        return re.findall(r"\s*\S+|\s+$", text)

    def decode(self, tokens: list) -> str:
        return "".join(tokens)


class Ranked:
    """A byte-pair tokenizer of a public rank file."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        self.own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list:
        return self.own.encode_ordinary(text)

    def decode(self, tokens: list) -> str:
        return self.own.decode(tokens)


def _trimmed(text: str, start: bool, end: bool) -> str:
    if start:
        m = re.search(r"\s", text)
        text = text[m.start() + 1 :] if m else text[10:]
    if end:
        m = re.search(r"\s", text[::-1])
        text = text[: len(text) - m.start() - 1] if m else text[:-10]
    return text


def chunks_of(text: str, codec, tokens: int = 2046, chars: int = 10_000) -> tuple[str, str | None]:
    """(top, bottom): the first tokens of the first characters, and for texts over twice as long the last of the last,
    both cut at white space, ten characters where there is none."""
    top = _trimmed(codec.decode(codec.encode(text[:chars])[:tokens]), False, True)
    if len(text) <= 2 * chars:
        return top, None
    return top, _trimmed(codec.decode(codec.encode(text[-chars:])[-tokens:]), True, False)


def text_chunks(docs: DataFrame, codec: Callable = Words, tokens: int = 2046, chars: int = 10_000) -> DataFrame:
    """(doc_id, top, bottom) of texts that are not null; bottom is null for shorter texts. codec() is made once a task."""

    def run(cols):
        own = codec()
        got = [chunks_of(t, own, tokens, chars) for t in cols["text"].to_pylist()]
        yield {"doc_id": cols["doc_id"], "top": [g[0] for g in got], "bottom": [g[1] for g in got]}

    return map_columns(spread(docs.where(F.col("text").isNotNull()).select("doc_id", "text")), run, "doc_id bigint, top string, bottom string")


def document_texts(items: DataFrame) -> DataFrame:
    """(doc_id, text, page_ends): items (doc_id, page_no, item, label, text, position) of pages put together.

    List marks are made Markdown's, page numbers at a page's edge are tagged, items stand one to a line, pages one after
    another with their cumulative ends. A page or document is one group, which its own size bounds.
    """
    x = L.tag_page_numbers(items).withColumn("text", T.unify_list_marks(F.col("text"), F.col("label") == "list_item"))
    tagged = F.when(F.col("is_page_number"), F.concat(F.lit("<docling_page_number>"), "text", F.lit("</docling_page_number>"))).otherwise(F.coalesce("text", F.lit("")))
    p = x.groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(F.struct("position", "item", tagged.alias("t")))).alias("s"))
    p = p.select("doc_id", "page_no", F.concat(F.array_join(F.transform("s", lambda v: v["t"]), "\n"), F.lit("\n")).alias("t"))
    g = p.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "t"))), lambda v: v["t"]).alias("p"))
    ends = F.aggregate("p", F.array().cast("array<bigint>"), lambda a, t: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + F.length(t))))
    return g.select("doc_id", F.array_join("p", "").alias("text"), ends.alias("page_ends"))


def inserted(nodes: DataFrame, new: DataFrame, before: bool = False) -> DataFrame:
    """Nodes with new ones as next (or previous) sibling of those named: new (doc_id, sibling, kind, text).

    New nodes get ids behind the document's last, in the order of their siblings; seq is counted anew. With a null
    sibling a node goes to the document's end. Siblings that do not exist insert nothing.
    """
    last = nodes.groupBy("doc_id").agg(F.max("node_id").alias("last"), F.max("seq").alias("end"))
    at = nodes.select("doc_id", F.col("node_id").alias("sibling"), F.col("parent_id").alias("up"), F.col("seq").alias("s")).dropDuplicates(["doc_id", "sibling"])
    x = new.join(last, "doc_id").join(at, ["doc_id", "sibling"], "left").where(F.col("sibling").isNull() | F.col("s").isNotNull())
    # behind a sibling is behind all that it holds: the next seq that is no descendant of it
    down = nodes.select("doc_id", "node_id", "parent_id", "seq")
    g = down.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seq", "node_id", "parent_id"))).alias("t"))
    x = x.join(g, "doc_id")
    inside = F.aggregate("t", F.struct(F.array(F.col("sibling").cast("int")).alias("in"), F.col("s").alias("to")), lambda a, n: F.when(F.array_contains(a["in"], n["parent_id"]), F.struct(F.concat(a["in"], F.array(n["node_id"])).alias("in"), n["seq"].alias("to"))).otherwise(a))
    place = F.when(F.col("sibling").isNull(), F.col("end") + 0.5).when(F.lit(before), F.col("s") - 0.5).otherwise(inside["to"] + 0.5)
    x = x.withColumn("place", place).withColumn("node_id", (F.col("last") + F.row_number().over(Window.partitionBy("doc_id").orderBy("place", "kind", "text"))).cast("int"))
    fresh = x.select("doc_id", "node_id", F.col("up").alias("parent_id"), F.col("place").alias("seq"), "kind", "text")
    out = nodes.withColumn("seq", F.col("seq").cast("double")).unionByName(fresh, allowMissingColumns=True)
    defaults = {k: v for k, v in {"layer": F.coalesce("layer", F.lit("body")), "depth": F.coalesce("depth", F.lit(0)), "in_picture": F.coalesce("in_picture", F.lit(False))}.items() if k in nodes.columns}
    return out.withColumns(defaults | {"seq": F.row_number().over(Window.partitionBy("doc_id").orderBy("seq", "node_id")) - 1}).select(nodes.columns)


def replaced(nodes: DataFrame, new: DataFrame) -> DataFrame:
    """Nodes with kind and text of those named exchanged: new (doc_id, node_id, kind, text); nulls keep what is there."""
    n = new.select("doc_id", "node_id", F.col("kind").alias("_k"), F.col("text").alias("_t")).dropDuplicates(["doc_id", "node_id"])
    return nodes.join(n, ["doc_id", "node_id"], "left").withColumns({"kind": F.coalesce("_k", "kind"), "text": F.coalesce("_t", "text")}).select(nodes.columns)
