"""Array views of text: characters as numpy codes, words and shingles as hashes; Arrow batches as plain columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xBF58476D1CE4E5B9)
_tables: dict[str, np.ndarray] = {}


def char_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point of the basic plane: its lower case, and its class (0 other, 1 letter, 2 digit)."""
    if not _tables:
        lower = np.arange(0x10000, dtype=np.uint32)
        kind = np.zeros(0x10000, dtype=np.uint8)
        for c in range(0x10000):
            s = chr(c)
            if s.isalpha():
                kind[c] = 1
            elif s.isdigit():
                kind[c] = 2
            low = s.lower()
            if len(low) == 1 and low != s:
                lower[c] = ord(low)
        _tables["lower"], _tables["kind"] = lower, kind
    return _tables["lower"], _tables["kind"]


def codes(text: str) -> np.ndarray:
    """The code points of a text; those beyond the basic plane become U+FFFF."""
    a = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.minimum(a, 0xFFFF) if len(a) and a.max() > 0xFFFF else a


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over an array of uint64."""
    x = (x ^ (x >> np.uint64(30))) * MIX2
    return x ^ (x >> np.uint64(31))


def word_ranges(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs where kind is not 0."""
    on = np.empty(len(kind) + 2, dtype=np.int8)
    on[0] = on[-1] = 0
    np.not_equal(kind, 0, out=on[1:-1].view(bool))
    d = np.diff(on)
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def word_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each code range low[start:end]."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    n = end - start
    first = np.repeat(start, n)
    total = int(n.sum())
    offset = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    c = low[first + offset].astype(np.uint64)
    with np.errstate(over="ignore"):
        v = mix(c * MIX + offset.astype(np.uint64) * MIX2 + np.uint64(1))
        at = np.cumsum(n) - n
        return mix(np.add.reduceat(v, at) + n.astype(np.uint64) * MIX)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive words; the whole text where it has fewer."""
    if not len(words):
        return words
    k = min(k, len(words))
    with np.errstate(over="ignore"):
        h = np.zeros(len(words) - k + 1, dtype=np.uint64)
        for i in range(k):
            h = mix(h * MIX + words[i : len(words) - k + 1 + i] + np.uint64(i + 1))
    return h


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the k-word shingles of each text."""
    lower, kinds = char_tables()
    out = []
    for lo, hi in groups_by_size(texts):
        part = texts[lo:hi]
        a = codes("\n".join(part))
        low, kind = lower[a], kinds[a]
        start, end = word_ranges(kind)
        h = word_hashes(low, start, end)
        first = np.cumsum([0] + [len(t) + 1 for t in part])
        at = np.searchsorted(start, first)
        for i in range(len(part)):
            out.append(np.unique(shingle_hashes(h[at[i] : at[i + 1]], k)))
    return out


def groups_by_size(texts: list[str | None], chars: int = 400_000) -> Iterator[tuple[int, int]]:
    """Ranges of a list whose texts have at most so many characters together; a longer text stands alone."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > at and size + n > chars:
            yield at, i
            at, size = i, 0
        size += n
    if at < len(texts):
        yield at, len(texts)


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the input is so small that its files make fewer tasks than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def map_columns(df: DataFrame, fn, schema: str) -> DataFrame:
    """mapInArrow over plain columns: fn gets a dict of Arrow arrays and yields dicts of lists with the schema's columns."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)
    names = arrow.names

    def run(batches):
        for b in batches:
            for out in fn(dict(zip(b.schema.names, b.columns))):
                yield pa.RecordBatch.from_arrays([pa.array(out[n], type=arrow.field(n).type) for n in names], schema=arrow)

    return df.mapInArrow(run, fields)
