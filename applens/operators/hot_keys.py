"""Hot values of key columns: found by a frequent-items sketch, spread by salts of their own.

A value is hot if its rows exceed a task's fair share (rows / tasks). One aggregate pass
keeps a mergeable frequent-items sketch per column, which holds every value of more than
about 4 in TRACKED of the rows, NULL among them; so at most MOST_TASKS values a column reach the driver. A hot
value gets as many salts as fair shares, every other value one. The sketch decides only
which task a row goes to: results never depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applens.functions.names import quoted, unused

TRACKED = 16_384
MOST_TASKS = 1_000


def task_count(df: DataFrame) -> int:
    """Shuffle tasks of the session that hot values are spread over."""
    return max(1, min(MOST_TASKS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def hot_values(df: DataFrame, cols: list[str], tasks: int | None = None) -> dict[str, dict[str | None, int]]:
    """For every column its hot values (as text; None for NULL) with their number of salts."""
    tasks = tasks or task_count(df)
    sketches = [F.expr(f"approx_top_k(CAST({quoted(c)} AS STRING), {tasks}, {TRACKED})").alias(f"t{i}")
                for i, c in enumerate(cols)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *sketches).first()
    fair = row.n / tasks
    return {c: {item["item"]: -int(-item["count"] // fair) for item in row[f"t{i}"] or [] if item["count"] > fair}
            for i, c in enumerate(cols)}


def salt_table(df: DataFrame, hot: dict[str | None, int], value: str, salts: str) -> DataFrame:
    """The hot values of one column as a table of at most MOST_TASKS rows (literals, so that nothing is read for it)."""
    rows = [F.struct(F.lit(v).cast("string").alias(value), F.lit(n).alias(salts)) for v, n in hot.items()]
    return df.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def salted_rows(df: DataFrame, col: str, hot: dict[str | None, int], salt: str) -> DataFrame:
    """Add ``salt``: rows of a hot value take its salts in turn, other rows have 0."""
    if not hot:
        return df.withColumn(salt, F.lit(0))
    value, salts = unused(["hot", "salts"], df)
    few = F.broadcast(salt_table(df, hot, value, salts))
    turn = F.monotonically_increasing_id() % F.coalesce(F.col(salts), F.lit(1))
    return (df.join(few, F.col(quoted(col)).cast("string").eqNullSafe(F.col(value)), "left")
            .withColumn(salt, turn.cast("int")).drop(value, salts))


def salted_keys(keys: DataFrame, col: str, hot: dict[str | None, int], salt: str) -> DataFrame:
    """Every row of a key table once for each salt of its value (rows of values that are not hot: once)."""
    if not hot:
        return keys.withColumn(salt, F.lit(0))
    value, salts = unused(["hot", "salts"], keys)
    few = F.broadcast(salt_table(keys, hot, value, salts))
    all_salts: Column = F.sequence(F.lit(0), F.coalesce(F.col(salts), F.lit(1)) - 1)
    return (keys.join(few, F.col(quoted(col)).cast("string").eqNullSafe(F.col(value)), "left")
            .withColumn(salt, F.explode(all_salts)).drop(value, salts))
