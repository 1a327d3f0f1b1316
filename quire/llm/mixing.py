"""Problem 9: records of several sources combined so that each gives its share of all tokens.

Method: cube-method balanced sampling. A source's whole repeats come first; the fractional rest is an inclusion
probability of each of its records, and a flight moves three probabilities at a time along the null space of two
constraints, the number of documents and the number of tokens, until one reaches 0 or 1. Chunks fly on their own, what
they leave undecided flies again together, and the last records land with the document constraint given up.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import tokens
from quire.session import written

CHUNK = 20_000
EPS = 1e-9
RESERVE = 256


def flight(p: list[float], size: list[float], rng: np.random.Generator, land: bool = False) -> list[float]:
    """Moves probabilities p until at most two are left between 0 and 1, keeping sum(p) and sum(p * size); none with land.

    Sizes come from the largest down. With land, the largest quarter moves along the tokens alone first, as a large record
    would linger in the flight; the smallest records stay out of it, settle what it leaves, the document count given up,
    and a toss decides the last record, a small one.
    """
    p = list(p)
    live = [i for i, v in enumerate(p) if EPS < v < 1 - EPS]
    coin = rng.random(4 * len(live) + 64).tolist()  # more than there are moves
    k = 0

    def move(ids: list[int], u: list[float], out: bool = False) -> None:
        nonlocal k
        up = down = float("inf")
        for i, d in zip(ids, u):
            if d > 0:
                up, down = min(up, (1 - p[i]) / d), min(down, p[i] / d)
            elif d < 0:
                up, down = min(up, -p[i] / d), min(down, (p[i] - 1) / d)
        step = up if not out and coin[k % len(coin)] * (up + down) < down else -down
        k += 1
        for i, d in zip(ids, u):
            v = p[i] + step * d
            p[i] = 0.0 if v < EPS else 1.0 if v > 1 - EPS else v

    def along_tokens(ids: list[int]) -> list[int]:
        """Pairs move along the tokens alone; at most one record is left."""
        act: list[int] = []
        for i in ids:
            act.append(i)
            if len(act) == 2:
                sa, sb = max(size[act[0]], 1), max(size[act[1]], 1)
                move(act, [1.0, -sa / sb] if sa <= sb else [sb / sa, -1.0])
                act = [j for j in act if 0.0 < p[j] < 1.0]
        return act

    total, wanted = sum(size[i] for i in live), sum(p[i] * size[i] for i in live)
    for i in [i for i in live if land and size[i] > 0.02 * total]:  # at most fifty: each moves against all others together
        rest = [j for j in live if j != i and 0.0 < p[j] < 1.0]
        if 0.0 < p[i] < 1.0 and rest and (s := sum(size[j] for j in rest)) > 0:
            # a record larger than all that is wanted can only overshoot; its probability goes to the others
            move([i, *rest], [1.0] + [-size[i] / s] * len(rest), size[i] > wanted)
    live = [i for i in live if 0.0 < p[i] < 1.0]
    n = len(live)
    large, held = (n // 4, min(n // 2, RESERVE)) if land else (0, 0)
    act = along_tokens(live[:large])
    for i in act + live[large : n - held]:
        if i not in act:
            act.append(i)
        if len(act) == 3:
            a, b, c = act
            u = [size[b] - size[c], size[c] - size[a], size[a] - size[b]]
            big = max(map(abs, u))
            move(act, [x / big for x in u] if big > 0 else [1.0, -1.0, 0.0])
            act = [j for j in act if 0.0 < p[j] < 1.0]
    if land:
        for j in along_tokens(act + live[n - held :]):
            p[j] = 1.0 if coin[(k + j) % len(coin)] < p[j] else 0.0
    return p


def plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_id, source, share_permille, max_repeats, available, target_tokens, rate): how often a source is used.

    The total of a mix is the largest that lets every source give its share within its repeats. Sources without tokens,
    and shares or repeats that are null or not positive, give nothing, and the others keep their proportions.
    """
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("available"))
    t = targets.where(F.col("source").isNotNull() & F.col("mix_id").isNotNull()).groupBy("mix_id", "source").agg(F.sum("share_permille").alias("share_permille"), F.min("max_repeats").alias("max_repeats"))
    t = t.join(have, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    able = (F.col("available") > 0) & (F.col("share_permille") > 0) & (F.col("max_repeats") > 0)
    most = F.min(F.when(able, F.col("max_repeats") * F.col("available") / F.col("share_permille")))
    total = t.groupBy("mix_id").agg(most.alias("unit"))
    return t.join(total, "mix_id").select("mix_id", "source", "share_permille", "max_repeats", "available", F.when(able, F.col("unit") * F.col("share_permille")).otherwise(0.0).alias("target_tokens")).withColumn("rate", F.when(F.col("available") > 0, F.least(F.col("target_tokens") / F.col("available"), F.col("max_repeats").cast("double"))).otherwise(0.0))


def choose(docs: DataFrame, targets: DataFrame, seed: int = 7, path: str = tokens.TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """(chosen, plan): chosen (mix_id, source, doc_id, n_tokens, repeats) with repeats of at least 1.

    Texts without tokens are never chosen. Repeated rows of a doc_id count each.
    """
    import pandas as pd

    sizes = written(tokens.counted(docs.where(F.col("source").isNotNull()), ("doc_id", "source"), path).where(F.col("n_tokens") > 0))
    p = written(plan(sizes, targets).coalesce(1))
    n = sizes.groupBy("source").agg(F.count("*").alias("records"))
    base = sizes.join(p.join(n, "source").where(F.col("rate") > 0).select("mix_id", "source", "rate", "records"), "source")
    whole = F.floor(F.col("rate") + EPS)
    base = base.select("mix_id", "source", "doc_id", "n_tokens", whole.cast("bigint").alias("whole"), F.greatest(F.col("rate") - whole, F.lit(0.0)).alias("p"), F.pmod(F.xxhash64("doc_id", "mix_id"), F.ceil(F.col("records") / CHUNK)).alias("chunk"))
    schema = "mix_id bigint, source string, doc_id bigint, n_tokens bigint, whole bigint, p double, chunk bigint"

    def flown(last: bool):
        def one(pdf):
            pdf = pdf.sort_values(["doc_id", "n_tokens"])
            key = [seed, int(pdf["mix_id"].iloc[0]), int(pdf["chunk"].iloc[0]) & 0x7FFFFFFF, *str(pdf["source"].iloc[0]).encode()]
            rng = np.random.default_rng(key)
            pdf = pdf.iloc[rng.permutation(len(pdf))].sort_values("n_tokens", ascending=False, kind="stable")
            got = flight(pdf["p"].tolist(), pdf["n_tokens"].tolist(), rng, last)
            return pd.DataFrame({"mix_id": pdf["mix_id"], "source": pdf["source"], "doc_id": pdf["doc_id"], "n_tokens": pdf["n_tokens"], "whole": pdf["whole"], "p": got, "chunk": pdf["chunk"] // CHUNK})

        return one

    many = (n.agg(F.max("records")).first()[0] or 0) // CHUNK + 1
    done: list[DataFrame] = []
    todo = base
    while many > 1:
        out = written(todo.groupBy("mix_id", "source", "chunk").applyInPandas(flown(False), schema))
        done.append(out.where((F.col("p") <= 0) | (F.col("p") >= 1)))
        todo = out.where((F.col("p") > 0) & (F.col("p") < 1))
        many = -(-many // CHUNK)
        if many == 1:
            todo = todo.withColumn("chunk", F.lit(0).cast("bigint"))
    done.append(todo.groupBy("mix_id", "source", "chunk").applyInPandas(flown(True), schema))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    r = F.col("whole") + F.round("p").cast("bigint")
    return out.select("mix_id", "source", "doc_id", "n_tokens", r.alias("repeats")).where(F.col("repeats") > 0), p


def shares(docs: DataFrame, targets: DataFrame, seed: int = 7, path: str = tokens.TOKENIZER) -> DataFrame:
    """(mix_id, source, share_permille, documents, records, tokens, most_repeats, reached_permille) of each target."""
    chosen, p = choose(docs, targets, seed, path)
    got = chosen.groupBy("mix_id", "source").agg(F.count("*").alias("documents"), F.sum("repeats").alias("records"), F.sum(F.col("repeats") * F.col("n_tokens")).alias("tokens"), F.max("repeats").alias("most_repeats"))
    got = written(got)
    total = got.groupBy("mix_id").agg(F.sum("tokens").alias("all"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return p.join(got, ["mix_id", "source"], "left").join(total, "mix_id", "left").select("mix_id", "source", "share_permille", zero("documents"), zero("records"), zero("tokens"), zero("most_repeats"), F.round(1000.0 * F.coalesce("tokens", F.lit(0)) / F.col("all"), 3).alias("reached_permille"))
