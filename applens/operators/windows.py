"""Ordered operators: per-group top rows, global sort, ordered preview.

Every order carries an explicit tie-break column, so results do not depend
on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from applens.functions.names import unused
from applens.session import ensure_checkpoint_dir


def top_n_per_group(df: DataFrame, group: str, by: str, n: int = 5,
                    tie: str | None = None) -> DataFrame:
    """The ``n`` rows with the largest ``by`` in each group (NULL groups skipped).

    ``row_number() <= n`` lets Spark insert a per-partition group limit before
    the shuffle, so a hot group sends at most ``n`` rows per map task.
    """
    order = [F.desc_nulls_last(by)] + ([F.asc(tie)] if tie else [])
    w = Window.partitionBy(group).orderBy(*order)
    return (df.where(F.col(group).isNotNull())
            .withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= n).drop("_rn"))


def sort_desc(df: DataFrame, by: str, tie: str | None = None) -> DataFrame:
    """Global sort, largest first, NULLs last, ties by ``tie``."""
    return df.orderBy(F.desc_nulls_last(by), *([F.asc(tie)] if tie else []))


def with_positions(df: DataFrame, *order, out: str = "position") -> DataFrame:
    """Add each row's place (from 0) in a global order, without a single-task window.

    The rows are sorted across the cluster and checkpointed, which fixes
    their partitions; a row's place is its place in its partition plus the
    sizes of the partitions before it (one row per partition). Without an
    order the rows are numbered as they lie.
    """
    ensure_checkpoint_dir(df.sparkSession)
    part, row, size, before = unused(["part", "row", "size", "before"], df)
    ranked = (df.orderBy(*order) if order else df).checkpoint(eager=True)
    in_part = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    placed = ranked.withColumns({part: F.spark_partition_id(), row: in_part})
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias(size))
    offsets = sizes.select(part, (F.sum(size).over(Window.orderBy(part)) - F.col(size)).alias(before))
    # One row per partition: bounded by the number of partitions.
    return (placed.join(F.broadcast(offsets), part).withColumn(out, F.col(before) + F.col(row))
            .drop(part, row, before))


def preview(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """First ``n`` rows in ``keys`` order (a top-k, not a whole sort)."""
    return df.orderBy(*keys).limit(n)
