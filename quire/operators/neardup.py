"""MinHash signatures, banded buckets, clusters and the choice of one record for each cluster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.arrays import MIX, map_columns, mix, shingle_sets, spread
from quire.session import written

BUCKETS, HASHES, WORDS = 32, 10, 5


def signatures(docs: DataFrame, scope: str | None = None, buckets: int = BUCKETS, hashes: int = HASHES, words: int = WORDS) -> DataFrame:
    """(doc_id, scope, bands): for each bucket, 64 bits of its band of smallest shingle hashes.

    Shingles are runs of `words` lower-case words, or all words of a shorter text. Texts without words have no row.
    Signatures are made batch by batch in numpy; only one number for each bucket leaves the task.
    """
    rng = np.random.default_rng(1)
    mult = rng.integers(1, 1 << 63, buckets * hashes, dtype=np.uint64) | np.uint64(1)

    def run(cols):
        ids, scopes, texts = cols["doc_id"].to_pylist(), cols["scope"].to_pylist(), cols["text"]
        for at in range(0, len(ids), 128):
            sets = shingle_sets(texts[at : at + 128].to_pylist(), words)
            keep = [i for i, s in enumerate(sets) if len(s)]
            if not keep:
                continue
            h = np.concatenate([sets[i] for i in keep])
            first = np.cumsum([0] + [len(sets[i]) for i in keep])[:-1]
            bands = np.zeros((buckets, len(keep)), dtype=np.uint64)
            with np.errstate(over="ignore"):
                for b in range(buckets):
                    for m in mult[b * hashes : (b + 1) * hashes]:
                        x = h * m
                        bands[b] = mix(bands[b] * MIX + np.minimum.reduceat(x ^ (x >> np.uint64(29)), first))
            yield {"doc_id": [ids[at + i] for i in keep], "scope": [scopes[at + i] for i in keep], "bands": list(np.ascontiguousarray(bands.T).view(np.int64))}

    src = docs.where(F.length("text") > 0).select("doc_id", (F.col(scope) if scope else F.lit(None)).cast("string").alias("scope"), "text")
    return map_columns(spread(src), run, "doc_id bigint, scope string, bands array<bigint>")


def bucket_edges(sig: DataFrame) -> DataFrame:
    """(a, b): each text of a bucket linked to the bucket's least, so that a bucket of n texts gives n - 1 edges."""
    x = sig.select("doc_id", "scope", F.posexplode("bands").alias("bucket", "band"))
    low = x.groupBy("scope", "bucket", "band").agg(F.min("doc_id").alias("a"), F.count("*").alias("n")).where("n > 1")
    e = x.join(low, (x["bucket"] == low["bucket"]) & (x["band"] == low["band"]) & x["scope"].eqNullSafe(low["scope"]))
    return e.select(low["a"], x["doc_id"].alias("b")).where("a <> b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, cluster): the least node of each connected component, by min-label rounds with pointer jumping."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("cluster")))
    while True:
        near = both.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("cluster").alias("m"))
        step = label.join(near, "node").select("node", F.least("cluster", "m").alias("cluster"))
        jump = label.select(F.col("node").alias("cluster"), F.col("cluster").alias("over"))
        new = written(step.join(jump, "cluster", "left").select("node", F.least("cluster", F.coalesce("over", "cluster")).alias("cluster")))
        if new.join(label, ["node", "cluster"], "left_anti").limit(1).count() == 0:
            return new
        label = new


def deduplicate(docs: DataFrame, scope: str | None = None, **parameters) -> DataFrame:
    """(doc_id, cluster_id, cluster_size, kept) of texts with words: the least of each cluster is kept, others go aside."""
    sig = written(signatures(docs, scope, **parameters))
    c = connected(bucket_edges(sig))
    x = sig.select("doc_id").join(c.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", F.coalesce("cluster", "doc_id").alias("cluster_id"))
    n = x.groupBy("cluster_id").agg(F.count("*").alias("cluster_size"))
    return x.join(n, "cluster_id").select("doc_id", "cluster_id", "cluster_size", (F.col("doc_id") == F.col("cluster_id")).alias("kept"))
