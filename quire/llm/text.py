"""What the operators share besides the array views of text: samples, sizes, broadcasts behind a check."""

from __future__ import annotations

import sys
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.arrays import MIX, char_tables, codes, groups_by_size, map_columns, mix, shingle_hashes, shingle_sets, spread, word_hashes, word_ranges  # noqa: F401



def as_int64(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64) if a.dtype == np.uint64 else a.astype(np.int64)


def has_text(column: str = "text"):
    """Texts that are null or empty are never a case."""
    return F.col(column).isNotNull() & (F.length(column) > 0)


def sampled_by_label(df: DataFrame, label: str, key: str, per_label: int, labels: Iterable[str]) -> DataFrame:
    """About per_label rows for each label, chosen by a hash of key: a bounded, repeatable sample to fit a model on.

    One aggregation counts the labels, and the sample is a plain filter then: no sort and no shuffle of the rows.
    """
    labels = list(labels)
    counts = dict(df.where(F.col(label).isin(labels)).groupBy(label).count().collect())
    h = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30))
    rule = F.lit(False)
    for name, n in sorted(counts.items()):
        rule = rule | ((F.col(label) == name) & (h < int(min(1.0, per_label / n) * (1 << 30))))
    return df.where(rule)


def broadcast_value(spark: SparkSession, value, most_mb: int = 200):
    """A broadcast variable behind a check of its size."""
    def size(x) -> int:
        if isinstance(x, np.ndarray):
            return x.nbytes
        if isinstance(x, dict):
            return sum(size(k) + size(v) for k, v in x.items()) if len(x) < 1000 else sum(map(sys.getsizeof, x)) + 32 * len(x)
        if isinstance(x, (list, tuple)):
            return sum(map(size, x)) if len(x) < 1000 else len(x) * 64
        return sys.getsizeof(x)

    if (n := size(value)) > most_mb << 20:
        raise ValueError(f"{n >> 20} MB are too much to broadcast; the bound is {most_mb} MB")
    return spark.sparkContext.broadcast(value)
