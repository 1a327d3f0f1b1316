"""Problem 6: a score cutoff per source that keeps a target fraction of its records.

Method: distributed quickselect. Each round, every partition gives the median of its still active scores per source
with their number; the weighted median of these is the source's pivot; exact counts above and at the pivot discard one
side. Rounds repeat until each source's target rank is isolated. Only bounds and counts per source move.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.text import map_columns
from quire.session import written


def cutoffs(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, keep_pct, records, cutoff, rank) for each target row with a non-null source and percentage.

    Records are the documents with a non-null score of that source; rank is how many must be kept at least, the
    percentage of the records rounded up. NaN scores count as the highest, as in Spark's order. A source without records has a null cutoff.
    A percentage of 0 or less keeps nothing (null cutoff), one over 100 counts as 100. A source given twice has its
    largest percentage.
    """
    spark = docs.sparkSession
    want = targets.where(F.col("source").isNotNull() & F.col("keep_pct").isNotNull()).groupBy("source").agg(F.max("keep_pct").alias("keep_pct"))
    scored = docs.where(F.col("score").isNotNull()).select("source", F.col("score").cast("double").alias("score"))
    # equal scores of one partition are one weighted value; what is read again and again holds nothing else
    held = written(scored.join(want.select("source"), "source", "left_semi").groupBy("source", "score", F.spark_partition_id().alias("part")).agg(F.count("*").alias("w")).drop("part"))
    totals = held.groupBy("source").agg(F.sum("w").alias("records"))
    state = want.join(totals, "source", "left").select("source", "keep_pct", F.coalesce("records", F.lit(0)).alias("records"))
    exact = F.expr("(least(keep_pct, 100) * records + 99) div 100")
    state = written(state.select("source", "keep_pct", "records", F.greatest(exact, F.lit(0)).cast("bigint").alias("rank")).withColumns({"need": F.col("rank"), "low": F.lit(float("-inf")), "high": F.lit(None).cast("double"), "cutoff": F.lit(None).cast("double"), "done": (F.col("rank") <= 0)}).coalesce(1))
    while state.where(~F.col("done")).limit(1).count():
        live = state.where(~F.col("done")).select("source", "need", "low", "high")
        # active: above low (or at -inf), below high; null high is no bound
        active = held.join(live, "source").where(((F.col("score") > F.col("low")) | (F.col("low") == float("-inf"))) & (F.col("high").isNull() | (F.col("score") < F.col("high"))))

        def medians(batches):
            import pyarrow as pa

            got: dict[str, list[np.ndarray]] = {}
            for b in batches:
                s, v, w = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
                s = np.array(s, dtype=object)
                for name in set(s.tolist()):
                    at = s == name
                    got.setdefault(name, []).append(np.stack([v[at], w[at]]))
            names, meds, ws = [], [], []
            for name, parts in got.items():
                x = np.concatenate(parts, axis=1)
                x = x[:, np.argsort(x[0], kind="stable")]
                c = np.cumsum(x[1])
                names.append(name)
                meds.append(float(x[0][np.searchsorted(c, c[-1] / 2)]))
                ws.append(int(c[-1]))
            if names:
                yield pa.RecordBatch.from_pydict({"source": pa.array(names, pa.string()), "median": pa.array(meds, pa.float64()), "weight": pa.array(ws, pa.int64())})

        local = active.select("source", "score", "w").mapInArrow(medians, "source string, median double, weight bigint")
        # weighted median of the partitions' medians: at most one row for each partition and source
        pivot = local.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("median", "weight"))).alias("m"), F.sum("weight").alias("all"))
        walk = F.aggregate("m", F.struct(F.lit(0).cast("bigint").alias("c"), F.lit(None).cast("double").alias("p")), lambda a, x: F.struct((a["c"] + x["weight"]).alias("c"), F.when(a["p"].isNull() & ((a["c"] + x["weight"]) * 2 >= F.col("all")), x["median"]).otherwise(a["p"]).alias("p")))
        pivot = pivot.select("source", walk["p"].alias("pivot"))
        counts = active.join(pivot, "source").groupBy("source", "pivot").agg(F.sum(F.when(F.col("score") > F.col("pivot"), F.col("w")).otherwise(0)).alias("above"), F.sum(F.when(F.col("score") == F.col("pivot"), F.col("w")).otherwise(0)).alias("at"))
        j = state.join(counts, "source", "left")
        found = ~F.col("done") & (F.col("above") < F.col("need")) & (F.col("above") + F.col("at") >= F.col("need"))
        up = ~F.col("done") & (F.col("above") >= F.col("need"))
        down = ~F.col("done") & (F.col("above") + F.col("at") < F.col("need"))
        state = written(j.select(
            "source", "keep_pct", "records", "rank",
            F.when(down, F.col("need") - F.col("above") - F.col("at")).otherwise(F.col("need")).alias("need"),
            F.when(up, F.col("pivot")).otherwise(F.col("low")).alias("low"),
            F.when(down, F.col("pivot")).otherwise(F.col("high")).alias("high"),
            F.when(found, F.col("pivot")).otherwise(F.col("cutoff")).alias("cutoff"),
            (F.col("done") | F.coalesce(found, F.lit(True))).alias("done"),
        ).coalesce(1))
    return state.select("source", "keep_pct", "records", "cutoff", "rank")


def kept(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """The kept records (source, doc_id): those at or above their source's cutoff."""
    c = cutoffs(docs, targets).where(F.col("cutoff").isNotNull()).select("source", "cutoff")
    return docs.where(F.col("score").isNotNull()).select("source", "doc_id", "score").join(c, "source").where(F.col("score") >= F.col("cutoff")).select("source", "doc_id")


def report(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """Cutoff and kept sizes by source and lang: (source, lang, keep_pct, cutoff, records, kept); lang null as it is.

    Sources of the targets without scored records have one row with null lang and cutoff, and zeros.
    """
    c = cutoffs(docs, targets).select("source", "keep_pct", "cutoff")
    n = docs.where(F.col("score").isNotNull()).groupBy("source", "lang", "score").agg(F.count("*").alias("w"))
    x = c.join(n, "source", "left")
    return x.groupBy("source", "lang", "keep_pct", "cutoff").agg(F.coalesce(F.sum("w"), F.lit(0)).alias("records"), F.coalesce(F.sum(F.when(F.col("score") >= F.col("cutoff"), F.col("w"))), F.lit(0)).alias("kept"))
