"""Event streams: windows, sessions, batched scoring and keyed state, for tables and for streams alike."""

from __future__ import annotations

import os
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import shared_dir, table


def tumbling(events: DataFrame, width: str) -> DataFrame:
    """(event_type, window_start, n, total) in windows of a fixed width."""
    g = events.groupBy("event_type", F.window("ts", width).alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return g.select("event_type", F.col("w.start").alias("window_start"), "n", "total")


def sliding(events: DataFrame, width: str, step: str) -> DataFrame:
    """The same in windows that overlap."""
    g = events.groupBy("event_type", F.window("ts", width, step).alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return g.select("event_type", F.col("w.start").alias("window_start"), "n", "total")


def sessions(events: DataFrame, gap: str) -> DataFrame:
    """(user_id, session_start, n, total): a user's events without a pause of `gap` or more."""
    g = events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return g.select("user_id", F.col("w.start").alias("session_start"), "n", "total")


def source(spark: SparkSession, sf_dir: str, files_per_batch: int = 4) -> DataFrame:
    """The event table as a stream of files."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "events*").parquet(sf_dir)


def _out(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), f"stream-{uuid.uuid4().hex}")


def run_stream(spark: SparkSession, sf_dir: str, plan, mode: str = "append") -> DataFrame:
    """Runs a plan over the stream until its files are read; the last result is written to the shared folder."""
    at = _out(spark)

    def keep(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{at}/data")

    q = plan(source(spark, sf_dir)).writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(keep).start()
    q.awaitTermination()
    return spark.read.parquet(f"{at}/data")


def scored_batches(spark: SparkSession, sf_dir: str, size: int = 256) -> DataFrame:
    """(event_id, result): a stand-in for a model server that takes requests in batches of at most `size`.

    Arrow batches are the requests' batches; a model would be loaded once for each worker, before the loop.
    """

    def score(batches):
        for pdf in batches:
            for a in range(0, len(pdf), size):
                x = pdf.iloc[a : a + size]
                yield pd.DataFrame({"event_id": x["event_id"], "result": x["event_type"] + "/" + x["user_id"].astype(str)})

    return run_stream(spark, sf_dir, lambda s: s.where("value IS NOT NULL").mapInPandas(score, "event_id bigint, result string"))


def stateful_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, n, most): running count and maximum held in state by user; the last update of each user counts."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key, pdfs, state: GroupState):
        n, most = state.get if state.exists else (0, None)
        for pdf in pdfs:
            n += len(pdf)
            top = pdf["value"].max()
            most = top if most is None or (top == top and top > most) else most
        most = float(most) if most is not None else None
        state.update((n, most))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "most": [most]})

    out = "user_id bigint, n bigint, most double"
    plan = lambda s: s.groupBy("user_id").applyInPandasWithState(step, out, "n bigint, most double", "update", GroupStateTimeout.NoTimeout)
    x = run_stream(spark, sf_dir, plan, "update")
    return x.groupBy("user_id").agg(F.max("n").alias("n"), F.round(F.max("most"), 2).alias("most"))
