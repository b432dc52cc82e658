"""Grouped aggregates: frequency tables, per-key rollups, conditional counts.

Every aggregate is one ``groupBy().agg()``: Spark combines partial results on
the map side, so a hot key costs one partial row per partition, not a skewed
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.functions.text import parse_count, short_name


def value_counts(df: DataFrame, col: str, count_col: str = "count") -> DataFrame:
    """Frequency of each non-null value, most frequent first (ties by value)."""
    return (df.where(F.col(col).isNotNull())
            .groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.desc(count_col), F.asc(col)))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column (NULL included once, as a value)."""
    return df.select(col).distinct()


def genre_rollup(df: DataFrame, key: str = "Genres", installs: str = "Installs",
                 rating: str = "Rating", top: int | None = 20, ordered: bool = True) -> DataFrame:
    """Per genre: number of apps, total installs, mean rating.

    One aggregate replaces the count table and the two inner joins with the
    install sum and the mean rating: the joins only ever kept the non-null
    keys, which the filter does here. Installs may be text ('10,000+'); it is
    summed as a number. Ordered by count descending, then genre; ``top`` keeps
    the first rows of that order (None keeps all). ``ordered=False`` skips the
    sort (for tables that only feed further aggregates).
    """
    inst = F.col(installs)
    inst = parse_count(inst) if dict(df.dtypes)[installs] == "string" else inst.cast("bigint")
    out = (df.where(F.col(key).isNotNull())
           .groupBy(key)
           .agg(F.count(F.lit(1)).alias("Count"),
                F.sum(inst).alias("Installs"),
                F.avg(rating).alias("Rating")))
    if top is None and not ordered:
        return out
    out = out.orderBy(F.desc("Count"), F.asc(key))
    return out.limit(top) if top is not None else out


def mean_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean per key, NULLs skipped, highest first (NULL means last)."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.avg(value).alias(value))
            .orderBy(F.desc_nulls_last(value), F.asc(key)))


def polarity_by_app(df: DataFrame, app: str = "App", polarity: str = "Polarity") -> DataFrame:
    """Per app: reviews with polarity >= 0 (zero counts here) and < 0.

    Both counts come from one grouped pass; ``short`` is the display name made
    of the last two dot segments.
    """
    p = F.col(polarity)
    return (df.where(F.col(app).isNotNull()).groupBy(app)
            .agg(F.count_if(p >= 0).alias("non_negative"),
                 F.count_if(p < 0).alias("negative"))
            .select(app, short_name(app).alias("short"), "non_negative", "negative"))


def class_share(df: DataFrame, col: str) -> DataFrame:
    """Count and percentage (2 decimals) of each non-null class.

    The total is a scalar subquery summing the per-class counts (Spark reuses
    the same aggregate for it), so the data is read once and no window over
    a single partition is needed; every class keeps its own label.
    """
    counts = (df.where(F.col(col).isNotNull())
              .groupBy(col).agg(F.count(F.lit(1)).alias("count")))
    total = counts.select(F.sum("count")).scalar()
    return counts.select(col, "count", F.round(F.col("count") * 100.0 / total, 2).alias("share"))
