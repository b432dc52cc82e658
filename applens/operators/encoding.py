"""Encoders: dummy columns, frequency indexes, reproducible split and folds."""

from __future__ import annotations

import math

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applens.functions.names import quoted, unused
from applens.operators.hot_keys import hot_values, salted_keys, salted_rows
from applens.operators.windows import with_positions

MOST_LEVELS = 10_000


def dummy_levels(df: DataFrame, col: str, most: int = MOST_LEVELS) -> list:
    """Sorted distinct non-null values of a column: the names of its dummy columns.

    A wide table needs them on the driver, so more than ``most`` levels are an error; the
    vector (``dummy_vectors``) and the long form (``dummies_long``) take any number.
    """
    rows = (df.where(F.col(quoted(col)).isNotNull()).select(F.col(quoted(col)).alias("v"))
            .distinct().limit(most + 1).collect())
    if len(rows) > most:
        raise ValueError(f"{col} has more than {most} levels: use dummy_vectors or dummies_long")
    return sorted(r.v for r in rows)


def with_dummies(df: DataFrame, col: str, prefix: str = "cat",
                 levels: list | None = None) -> DataFrame:
    """Add one 0/1 column ``<prefix>_<value>`` per level, all levels kept.

    A NULL value gives 0 in every column. Levels are read from the data
    (see ``dummy_levels``) unless given.
    """
    levels = dummy_levels(df, col) if levels is None else levels
    c = F.col(f"`{col}`")
    return df.select("*", *[F.coalesce((c == F.lit(v)).cast("int"), F.lit(0)).alias(f"{prefix}_{v}")
                            for v in levels])


def dummies_long(df: DataFrame, keys: list[str], col: str, prefix: str = "cat") -> DataFrame:
    """The dummy columns that are 1, one row each: ``keys..., dummy``. Any number of levels."""
    c = F.col(f"`{col}`")
    return df.where(c.isNotNull()).select(
        *[F.col(f"`{k}`") for k in keys], F.concat(F.lit(f"{prefix}_"), c.cast("string")).alias("dummy"))


def dummy_vectors(df: DataFrame, index: DataFrame, col: str, out: str) -> DataFrame:
    """Add all dummy columns of a column as one sparse vector ``out``: slot ``index`` of the row's value is 1.

    ``index`` is a fitted, stored index table ``(col, index)`` (see ``frequency_index``), which names the slots. A NULL or a
    value it does not hold has no slot set. No level reaches the driver, only their number.
    """
    place, = unused(["place"], df)
    n = index.count()
    indexed = apply_index(df, index.select(col, F.col("index").alias(place)), col, place, F.lit(float(n)))
    # One more category than levels, the last of which is dropped: the vector of rows without a level is empty.
    last = df.sparkSession.range(0, 1, 1, 1).select(F.lit(float(n)).alias(place))
    encoder = OneHotEncoder(inputCols=[place], outputCols=[out], dropLast=True).fit(last)
    return encoder.transform(indexed).drop(place)


def frequency_indexes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Index the distinct non-null values of several columns by descending frequency, ties by value.

    Rows ``column, value, count, index`` with ``index`` = 0, 1, 2, ... within each column,
    as StringIndexer's frequencyDesc order gives, but without collecting labels: one
    aggregate over all columns, one sort across the cluster, and places from
    ``with_positions``. Values of several columns are text.
    """
    kind = df.schema[cols[0]].dataType if len(cols) == 1 else "string"
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast(kind).alias("value")) for c in cols])
    counts = (df.select(F.inline(cells)).where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")))
    placed = with_positions(counts, "column", F.desc("count"), F.asc("value"), out="_at")
    # One row per column.
    first = placed.groupBy("column").agg(F.min("_at").alias("_first"))
    return (placed.join(F.broadcast(first), "column")
            .select("column", "value", "count", (F.col("_at") - F.col("_first")).alias("index")))


def frequency_index(df: DataFrame, col: str, out: str = "index",
                    count: str | None = None) -> DataFrame:
    """``(col, out)`` of one column's values (see ``frequency_indexes``); ``count``
    names an extra output column with each value's frequency."""
    extra = [F.col("count").alias(count)] if count else []
    return frequency_indexes(df, [col]).select(F.col("value").alias(col), F.col("index").alias(out), *extra)


def apply_index(df: DataFrame, index: DataFrame, col: str, out: str,
                unseen: Column | None = None, hot: dict[str | None, int] | None = None) -> DataFrame:
    """Attach an index table to rows by value; unseen or NULL values get
    ``unseen`` (default: the number of labels, as ``handleInvalid='keep'``).

    One left join on (value, salt). ``hot`` are the values of ``df`` with more rows than a task's
    fair share, seen or not, NULL among them (``hot_keys.hot_values``; found by a pass over ``df`` unless
    given): their rows are spread over salts by their count, and only their index rows are sent once a salt.
    """
    if unseen is None:
        unseen = F.lit(float(index.count()))
    if hot is None:
        hot = hot_values(df, [col])[col]
    salt, key, number, salt2 = unused(["salt", "key", "index", "salt2"], df)
    idx = salted_keys(index.select(F.col(quoted(col)).alias(key), F.col(quoted(out)).cast("double").alias(number)), key, hot, salt2)
    rows = salted_rows(df, col, hot, salt)
    same = F.col(quoted(col)) == F.col(key)
    if hot:
        same = same & (F.col(salt) == F.col(salt2))
    return rows.join(idx, same, "left").withColumn(out, F.coalesce(number, unseen)).drop(salt, key, number, salt2)


def _hash8(key: Column, seed: int) -> Column:
    return F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 8)


def split_threshold(fraction: float) -> str:
    """Hex prefix below which a key falls in the held-out part."""
    return format(int(fraction * 2 ** 32), "08x")


def is_held_out(key: Column, fraction: float = 0.2, seed: int = 42) -> Column:
    """True for about ``fraction`` of keys, decided by the key alone."""
    return _hash8(key, seed) < F.lit(split_threshold(fraction))


DIGITS, MD5_DIGITS = 4, 32


def _threshold(df: DataFrame, digest: Column, need: int) -> tuple[str, int, bool]:
    """The prefix of the hex digests that the row of rank ``need`` (from 1) has, how many rows with that prefix belong
    to the first ``need``, and whether these are all of them. A pass adds DIGITS digits."""
    prefix, rows = "", 0
    while len(prefix) < MD5_DIGITS:
        digits = F.substring(digest, len(prefix) + 1, DIGITS).alias("digits")
        counts = df.where(digest.startswith(prefix)).groupBy(digits).agg(F.count(F.lit(1)).alias("n")).collect()
        for digit, rows in sorted(map(tuple, counts)):
            if need <= rows:
                prefix += digit
                break
            need -= rows
        if need == rows:
            return prefix, need, True
    return prefix, need, False


def exact_split(df: DataFrame, key: Column, fraction: float = 0.2, seed: int = 42, out: str = "held_out") -> DataFrame:
    """Every row with ``out``: true for exactly ceil(fraction * rows) of them, those with the smallest hashes.

    The same rows whatever the partitions: the order is that of the key's md5 (with the seed, as
    ``is_held_out``), then of the whole row's; of rows alike in all columns any are taken. The threshold is selected,
    not sorted for: a pass counts rows by the next hex digits (at most 65,536 counts reach the driver) and
    goes on in the group that holds the wanted rank, until a group is taken whole.
    """
    digest, whole_row, place = unused(["digest", "row", "place"], df)
    need = math.ceil(fraction * df.count())
    if need <= 0:
        return df.withColumn(out, F.lit(False))

    def md5(text: Column) -> Column:
        return F.md5(F.concat(F.coalesce(text, F.lit("\0")), F.lit(f":{seed}")))

    row = F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns]), {"ignoreNullFields": "false"})
    hashed = df.withColumns({digest: md5(key.cast("string")), whole_row: md5(row)})
    first, need, whole = _threshold(hashed, F.col(digest), need)
    start = F.substring(digest, 1, len(first))
    held, alike = start < F.lit(first), start == F.lit(first)
    if whole:
        return hashed.withColumn(out, held | alike).drop(digest, whole_row)
    second, need, whole = _threshold(hashed.where(alike), F.col(whole_row), need)
    start = F.substring(whole_row, 1, len(second))
    held, same = held | (alike & (start < F.lit(second))), alike & (start == F.lit(second))
    if whole:
        return hashed.withColumn(out, held | same).drop(digest, whole_row)
    copies = with_positions(hashed.where(same), out=place).withColumn(out, F.col(place) < need).drop(place)
    return hashed.where(~same).withColumn(out, held).unionByName(copies).drop(digest, whole_row)


def fold_of(key: Column, folds: int = 10, seed: int = 155) -> Column:
    """Fold number 0..folds-1 from a hash of the key."""
    return (F.conv(_hash8(key, seed), 16, 10).cast("bigint") % folds).cast("int")
