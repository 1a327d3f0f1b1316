"""Problem 2: the tokens of each text under one existing tokenizer, and totals by source, language and domain.

Method: the byte-pair vocabulary is compiled into a matching automaton. Scanning a piece once, the last token of every
prefix's encoding is the one match that ends there and is compatible with the last token of the prefix before it (the
two encode to themselves side by side), so encodings are counted exactly in linear time and no token list is made.
Counts of stretches that return are kept. The totals are a cube over pre-aggregated rows.
"""

from __future__ import annotations

import base64
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.text import map_columns, spread

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the published splitting pattern of the vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLACEHOLDERS = ("", "und", "unknown")
_STRETCH = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
KEPT = 400_000


class Counter(dict):
    """Token counts of stretches (white space and what follows it); a dict whose misses are counted by the automaton."""

    def __init__(self, path: str = TOKENIZER):
        import ahocorasick
        import regex

        super().__init__()
        self.ranks: dict[str, int] = {}
        self.match = ahocorasick.Automaton()
        with open(path, "rb") as f:
            for line in f:
                token, rank = line.split()
                s = base64.b64decode(token).decode("latin-1")
                self.ranks[s] = int(rank)
                self.match.add_word(s, len(s))
        self.match.make_automaton()
        self.pieces = regex.compile(PATTERN).findall
        self.pairs: dict[tuple[str, str], bool] = {}

    def __missing__(self, stretch: str) -> int:
        n = sum(self.piece(p.encode().decode("latin-1")) for p in self.pieces(stretch))
        if len(stretch) <= 64:
            if len(self) > KEPT:
                self.clear()
            self[stretch] = n
        return n

    def text(self, text: str) -> int:
        """Tokens of a text."""
        return sum(map(self.__getitem__, _STRETCH.findall(text)))

    def piece(self, s: str) -> int:
        """Tokens of one piece, its bytes as characters."""
        if s in self.ranks:
            return 1
        last: list[str | None] = [None] * (len(s) + 1)
        count = [0] * (len(s) + 1)
        for end, size in self.match.iter(s):
            stop = end + 1
            if last[stop] is not None:
                continue
            start = stop - size
            token = s[start:stop]
            before = last[start]
            if not start or before is not None and self.compatible(before, token):
                last[stop], count[stop] = token, count[start] + 1
        return count[-1]

    def compatible(self, a: str, b: str) -> bool:
        """Whether a followed by b is encoded as these two tokens."""
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) > KEPT:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return got

    def merged(self, s: str) -> list[str]:
        """The encoding by its definition: the pair of the lowest rank merges first. Only for two tokens' length."""
        parts, ranks = list(s), self.ranks
        while len(parts) > 1:
            r, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if r == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts


_counters: dict[str, Counter] = {}


def counter(path: str = TOKENIZER) -> Counter:
    """The counter of a vocabulary file, built once for each process."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def counted(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), path: str = TOKENIZER) -> DataFrame:
    """The columns `keep` with n_tokens of text; null and empty texts have 0. Repeated rows stay."""
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep) + ", n_tokens bigint"

    def run(cols):
        c = counter(path)
        out = {k: cols[k] for k in keep}
        out["n_tokens"] = [c.text(t) if t else 0 for t in cols["text"].to_pylist()]
        yield out

    return map_columns(spread(docs.select(*keep, "text")), run, schema)


def host(column: str = "web_host"):
    """A domain in one spelling: lower case, no scheme, user, port, path, closing dot or leading www."""
    h = F.lower(F.trim(F.col(column)))
    h = F.regexp_replace(h, r"^[a-z][a-z0-9+.-]*://", "")
    h = F.regexp_replace(h, r"^[^/@]*@|[/?#:].*$|\.+$", "")
    h = F.regexp_replace(h, r"^www\d*\.", "")
    return F.when(h != "", h)


def cube(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(source, language, domain, documents, tokens, level) over the cube of the three; level is Spark's grouping_id.

    Absent labels are one null language, absent hosts one null domain; level tells these nulls from totals. Rows are
    summed by all three first, and the cube expands only the sums.
    """
    lang = F.when(~F.col("lang").isin(*PLACEHOLDERS), F.col("lang"))
    n = counted(docs.withColumns({"language": lang, "domain": host()}), ("source", "language", "domain"), path)
    small = n.groupBy("source", "language", "domain").agg(F.count("*").alias("d"), F.sum("n_tokens").alias("t"))
    return small.cube("source", "language", "domain").agg(F.sum("d").alias("documents"), F.sum("t").alias("tokens"), F.grouping_id().alias("level"))
