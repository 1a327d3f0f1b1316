"""Problem 7: passages of held-out items inside the corpus.

Method: SimHash fingerprints of every window of `span` words of an item and of every text. Four blocks of sixteen bits
index the items' fingerprints, which guarantees all within a Hamming radius of three. A text with windows enough of an
item is verified exactly: shared three-word shingles seed stretches in the passage's order, words match one by one along
them, and the share of matched words decides.

Windows are as short as the seeds of a stretch, and seeds of one stretch start at most six words apart: a text that
reproduces a share s of n words has at least s * n / 6 of the item's windows, so that no case fails for want of windows,
however its words are altered.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.text import MIX, broadcast_value, char_tables, codes, groups_by_size, has_text, map_columns, mix, shingle_hashes, spread, word_hashes, word_ranges

SPAN, RADIUS, BLOCKS = 3, 3, 4
GAP = 4  # altered words in a row that a stretch may hold, and one
BLOCK_ITEMS = 10_000  # items of one broadcast index; more are taken in blocks
DIVIDED = r"(?<=[\p{L}\p{N}])[-‐­¬]\s*\n\s*(?=[\p{L}\p{N}])"


def words_of(texts: list[str]) -> list[np.ndarray]:
    """Hashes of the words of each text, letters in lower case."""
    lower, kinds = char_tables()
    a = codes("\n".join(texts))
    low = lower[a]
    start, end = word_ranges(kinds[a])
    h = word_hashes(low, start, end)
    at = np.searchsorted(start, np.cumsum([0] + [len(t) + 1 for t in texts]))
    return [h[at[i] : at[i + 1]] for i in range(len(texts))]


def simhashes(words: np.ndarray, span: int) -> np.ndarray:
    """64-bit SimHash of each window of span words: majority of the bits of its words and word pairs."""
    n = len(words) - span + 1
    if n <= 0:
        return np.zeros(0, np.uint64)

    def sums(h: np.ndarray) -> np.ndarray:
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1)
        return np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])

    one = sums(words)
    total = one[span : span + n] - one[:n]
    if span > 1:
        with np.errstate(over="ignore"):
            two = sums(mix(words[:-1] * MIX + words[1:]))
        total = total + two[span - 1 : span - 1 + n] - two[:n]
    return np.packbits(total * 2 > 2 * span - 1, axis=1).view(np.uint64).ravel()


class Index:
    """Fingerprints of items by block value; items as word hashes."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        self.by_span: dict[int, tuple] = {}
        for span in sorted({min(SPAN, len(w)) for w in self.words if len(w)}):
            own = [k for k, w in enumerate(self.words) if len(w) and min(SPAN, len(w)) == span]
            f = [simhashes(self.words[k], span) for k in own]
            fp, item = np.concatenate(f), np.repeat(np.array(own), [len(x) for x in f])
            tables = []
            for b in range(BLOCKS):
                v = ((fp >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
                order = np.argsort(v, kind="stable")
                tables.append((order, np.concatenate([[0], np.cumsum(np.bincount(v, minlength=1 << 16))])))
            self.by_span[span] = (fp, item, tables)
        self.size = np.array([len(w) for w in self.words])

    def hits(self, words: np.ndarray, least: float = 0.5) -> list[int]:
        """Items of which the text may reproduce the share `least`: fingerprints of enough of their windows are within
        RADIUS of windows of the text."""
        out: list[int] = []
        for span, (fp, item, tables) in self.by_span.items():
            q = simhashes(words, span)
            met: list[np.ndarray] = []
            for b, (order, off) in enumerate(tables):
                v = ((q >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
                n = off[v + 1] - off[v]
                on = np.flatnonzero(n)
                if not len(on):
                    continue
                n = n[on]
                at = np.repeat(off[v[on]], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                c = order[at]
                near = np.bitwise_count(fp[c] ^ np.repeat(q[on], n)) <= RADIUS
                met.append(c[near])
            if met:
                windows = np.bincount(item[np.unique(np.concatenate(met))], minlength=len(self.size))
                out += np.flatnonzero((windows > 0) & (windows * (SPAN - 1 + GAP) >= least * self.size)).tolist()
        return sorted(out)


def share(item: np.ndarray, text: np.ndarray, least_words: int = 5, gap: int = GAP) -> float:
    """Share of the item's words that the text reproduces in stretches of the item's order.

    A stretch follows one offset between item and text; it may hold up to gap - 1 altered words in a row, and counts
    from least_words matching words on (from all, in an item that has fewer).
    """
    k = min(SPAN, len(item))
    if len(text) < k or not k:
        return 0.0
    a, b = shingle_hashes(item, k), shingle_hashes(text, k)
    order = np.argsort(b, kind="stable")
    s = b[order]
    lo, hi = np.searchsorted(s, a, "left"), np.searchsorted(s, a, "right")
    n = hi - lo
    if not n.sum():
        return 0.0
    i = np.repeat(np.arange(len(a)), n)
    j = order[np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
    d = j - i
    by = np.lexsort((i, d))
    i, d = i[by], d[by]
    cut = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (i[1:] - i[:-1] > k - 1 + gap)]))
    covered = np.zeros(len(item), dtype=bool)
    least = min(least_words, len(item))
    for x, y in zip(cut, np.append(cut[1:], len(i))):
        p = np.arange(i[x], i[y - 1] + k)
        same = item[p] == text[p + d[x]]
        if same.sum() >= least:
            covered[p[same]] = True
    return float(covered.mean())


def found(docs: DataFrame, items: DataFrame, least: float = 0.5) -> DataFrame:
    """(doc_id, item_id, share) for each text that reproduces at least `least` of an item's words.

    Null and empty texts and passages, and those without a word, are never found; empty tables give no rows. A doc_id
    or an item_id that stands twice gives its rows twice.
    """
    spark = docs.sparkSession
    items = items.where(F.col("passage").isNotNull() & (F.length("passage") > 0)).select("item_id", "passage")
    total = items.count()
    parts = -(-total // BLOCK_ITEMS)
    text = F.regexp_replace("text", DIVIDED, "")
    source = spread(docs.where(has_text()).select("doc_id", text.alias("text")))
    out = None
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).orderBy("item_id", "passage").collect()
        hashed = words_of([r[1] for r in rows])
        shared = broadcast_value(spark, {"items": [(r[0], w) for r, w in zip(rows, hashed)]})

        def run(cols, shared=shared):
            ids, texts = cols["doc_id"].to_pylist(), cols["text"]
            index = _index(shared)
            got: dict[str, list] = {"doc_id": [], "item_id": [], "share": []}
            for a in range(0, len(ids), 256):
                part_ids, part_texts = ids[a : a + 256], texts[a : a + 256].to_pylist()
                for lo, hi in groups_by_size(part_texts):
                    for doc, w in zip(part_ids[lo:hi], words_of(part_texts[lo:hi])):
                        for k in index.hits(w, least):
                            s = share(index.words[k], w)
                            if s >= least - 1e-12:
                                got["doc_id"].append(doc)
                                got["item_id"].append(index.ids[k])
                                got["share"].append(s)
            yield got

        one = map_columns(source, run, "doc_id bigint, item_id bigint, share double")
        out = one if out is None else out.unionByName(one)
    return spark.createDataFrame([], "doc_id bigint, item_id bigint, share double") if out is None else out


_indexes: dict[int, Index] = {}


def _index(shared) -> Index:
    """The index of a broadcast, built once for each worker process."""
    key = shared._jbroadcast.id() if getattr(shared, "_jbroadcast", None) is not None else id(shared.value["items"])
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = Index(shared.value["items"])
    return _indexes[key]


def report(docs: DataFrame, items: DataFrame, least: float = 0.5) -> DataFrame:
    """(task, split_name, items, leaked_items, documents): what leaked, by task and split of the items."""
    f = found(docs, items, least).groupBy("item_id").agg(F.count_distinct("doc_id").alias("n"))
    x = items.select("item_id", "task", "split_name").dropDuplicates(["item_id"]).join(f, "item_id", "left")
    return x.groupBy("task", "split_name").agg(F.count("*").alias("items"), F.count("n").alias("leaked_items"), F.coalesce(F.sum("n"), F.lit(0)).alias("document_hits"))
