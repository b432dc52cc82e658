"""Joins: keep rows of the most frequent keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` most frequent non-null keys (ties by key), with counts."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("_n"))
            .orderBy(F.desc("_n"), F.asc(key)).limit(k))


def keep_top_keys(df: DataFrame, key: str, k: int = 23, keep_nulls: bool = True) -> DataFrame:
    """Keep the rows whose key is among the ``k`` most frequent keys.

    The key table has at most ``k`` rows, so it is broadcast and the big side
    is never shuffled. Rows with a NULL key are kept by default: a delete by
    value never matches them.
    """
    top = F.broadcast(top_keys(df, key, k).select(key, F.lit(True).alias("_top")))
    out = df.join(top, key, "left")
    cond = F.col("_top") | (F.col(key).isNull() if keep_nulls else F.lit(False))
    return out.where(cond).drop("_top").select(df.columns)

