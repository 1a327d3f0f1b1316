"""Writers: routed side outputs, partitions by language, shards of a bounded size, token shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_routed(df: DataFrame, path: str, route: str = "route", fmt: str = "parquet") -> None:
    """All routes in one pass, one folder for each: what is rejected is kept beside what goes on."""
    df.write.mode("overwrite").partitionBy(route).format(fmt).save(path)


def write_languages(df: DataFrame, path: str, bucket: str = "language_bucket", rows_per_file: int = 1_000_000) -> None:
    """One folder for each language; a file holds a bounded number of rows, and large languages get many tasks (AQE)."""
    df.hint("rebalance", bucket).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(bucket).parquet(path)


def write_container(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Payloads as zstd Parquet."""
    df.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_jsonl(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    df.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", rows_per_file).json(path)


def write_published(df: DataFrame, path: str, best: str = "edu_score", least: float = 0.5) -> None:
    """Two targets: all rows, and those of a score."""
    df.drop(best).write.mode("overwrite").parquet(f"{path}/all")
    df.where(F.coalesce(best, F.lit(0.0)) >= least).drop(best).write.mode("overwrite").parquet(f"{path}/best")


def token_shards(tokens: DataFrame, path: str, eos: int, tokens_per_shard: int = 100_000_000, seed: int = 42) -> None:
    """Documents (doc_id, tokens) shuffled by a hash, each with an end sign, in shards of about so many tokens."""
    x = tokens.select("doc_id", F.concat("tokens", F.array(F.lit(eos))).alias("tokens"))
    total = x.agg(F.sum(F.size("tokens"))).first()[0] or 0
    shards = max(1, -(-total // tokens_per_shard))
    x.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(shards))).repartition(F.col("shard")).sortWithinPartitions("shard", F.xxhash64("doc_id", F.lit(seed + 1))).write.mode("overwrite").partitionBy("shard").parquet(path)


def page_export(items: DataFrame) -> DataFrame:
    """(doc_id, page_no, text, cells) from items (doc_id, page_no, position, text, box): one row for each page."""
    g = items.groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(F.struct("position", "text", "box"))).alias("cells"))
    return g.select("doc_id", "page_no", F.array_join(F.transform("cells", lambda c: c["text"]), "\n").alias("text"), "cells")
