"""Problem 8: whole items into containers of fixed capacity with little unused room.

Method: minimum bin slack. A container opens with the longest item left; a bitset subset-sum over the
remaining lengths then finds the multiset that fills it closest to capacity, and counts are backtracked from the layers.
Items are spread over chunks by hash, so that every task packs a bounded number of items, whatever the table's size.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import tokens

CHUNK_ITEMS = 40_000
SCHEMA = "pack_id bigint, container bigint, doc_id bigint, start bigint, n_tokens bigint"


def fill(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """Lengths, taken from sorted distinct `lengths` with `counts`, whose sum comes closest to room from below.

    All lengths and all their copies take part: copies are put together by powers of two, so that n of them are
    log2(n) layers. The search ends early only where room is filled exactly.
    """
    hi = bisect_right(lengths, room)
    if not hi:
        return []
    if lengths[hi - 1] == room:
        return [room]
    mask, goal = (1 << (room + 1)) - 1, 1 << room
    layers, reach = [], 1
    for v in reversed(lengths[:hi]):
        left, k = min(counts[v], room // v), 1
        while left and not reach & goal:
            n = min(k, left)
            new = (reach | reach << v * n) & mask
            if new != reach:
                layers.append((v, n, reach))
                reach = new
            left -= n
            k *= 2
        if reach & goal:
            break
    s = reach.bit_length() - 1
    out = []
    for v, n, before in reversed(layers):
        if not before >> s & 1:
            out += [v] * n
            s -= v * n
    return out


def pack(ids: list[int], sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """(container, id, start, size) of each piece. Items over the capacity fill containers alone, their rest is an item."""
    box: list[int] = []
    who: list[int] = []
    begin: list[int] = []
    size: list[int] = []
    n = 0
    left: dict[int, list[tuple[int, int]]] = {}
    for i, s in sorted(zip(ids, sizes)):
        at = 0
        while s - at > capacity or s - at == capacity:
            box.append(n)
            who.append(i)
            begin.append(at)
            size.append(capacity)
            n, at = n + 1, at + capacity
        if s > at:
            left.setdefault(s - at, []).append((i, at))
    lengths = sorted(left)
    counts = {v: len(x) for v, x in left.items()}

    def take(v: int) -> None:
        i, at = left[v].pop()
        box.append(n)
        who.append(i)
        begin.append(at)
        size.append(v)
        counts[v] -= 1
        if not counts[v]:
            del lengths[bisect_right(lengths, v) - 1]

    while lengths:
        room = capacity
        v = lengths[-1]
        take(v)
        room -= v
        while room and lengths and lengths[0] <= room:
            chosen = fill(lengths, counts, room)
            for v in chosen:
                take(v)
                room -= v
            if not chosen:
                break
        n += 1
    return box, who, begin, size


def assign(docs: DataFrame, targets: DataFrame, path: str = tokens.TOKENIZER) -> DataFrame:
    """(pack_id, container, doc_id, start, n_tokens): each text as a whole in one container, or its pieces in several.

    Texts without tokens take no room and have no row; targets with a null or non-positive capacity are left out.
    Repeated rows of a doc_id are packed each. Containers are numbered in their chunk; the chunk is the upper part.
    """
    import pandas as pd

    items = tokens.counted(docs, ("doc_id",), path).where(F.col("n_tokens") > 0)
    n = docs.where(F.length("text") > 0).count()
    chunks = max(1, -(-n // CHUNK_ITEMS))
    wanted = targets.where(F.col("capacity_tokens") > 0).select("pack_id", "capacity_tokens").dropDuplicates(["pack_id"])
    array = wanted.agg(F.collect_list(F.struct("pack_id", "capacity_tokens"))).first()[0]
    packs = F.array(*[F.struct(F.lit(p[0]).cast("bigint").alias("pack_id"), F.lit(p[1]).cast("bigint").alias("capacity")) for p in array]) if array else None
    if packs is None:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    rows = items.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks))).withColumn("p", F.explode(packs)).select("p.pack_id", "p.capacity", "chunk", "doc_id", "n_tokens")

    def one(pdf):
        pack_id, chunk = int(pdf["pack_id"].iloc[0]), int(pdf["chunk"].iloc[0])
        b, w, s, z = pack(pdf["doc_id"].tolist(), pdf["n_tokens"].tolist(), int(pdf["capacity"].iloc[0]))
        return pd.DataFrame({"pack_id": np.full(len(b), pack_id), "container": np.array(b, dtype=np.int64) + (chunk << 32), "doc_id": w, "start": s, "n_tokens": z})

    return rows.groupBy("pack_id", "chunk").applyInPandas(one, SCHEMA)


def summary(assigned: DataFrame, targets: DataFrame) -> DataFrame:
    """(pack_id, capacity_tokens, containers, tokens, unused_share)."""
    c = assigned.groupBy("pack_id", "container").agg(F.sum("n_tokens").alias("t")).groupBy("pack_id").agg(F.count("*").alias("containers"), F.sum("t").alias("tokens"))
    t = targets.select("pack_id", "capacity_tokens").dropDuplicates(["pack_id"])
    return c.join(t, "pack_id").select("pack_id", "capacity_tokens", "containers", "tokens", F.round(1 - F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("unused_share"))
