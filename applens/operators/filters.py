"""Row filters and column drops of the cleaning job.

Each is a predicate that Catalyst pushes towards the scan where it can. Rows
are matched by value; nothing depends on row position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_outliers(df: DataFrame, col: str, max_value: float) -> DataFrame:
    """Drop rows whose value exceeds ``max_value``; missing values are kept."""
    c = _col(col)
    return df.where(c.isNull() | (c <= max_value))


def drop_value(df: DataFrame, col: str, value) -> DataFrame:
    """Drop rows equal to ``value``; NULLs are kept (null-safe comparison)."""
    return df.where(~_col(col).eqNullSafe(F.lit(value)))


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose text is the empty string; NULLs are kept."""
    return drop_value(df, col, "")


def complete_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Keep rows without any NULL (or NaN) in ``subset`` (default: all columns)."""
    return df.na.drop(how="any", subset=subset)


def keep_field_count(df: DataFrame, fields: str, n: int) -> DataFrame:
    """Keep rows whose array column ``fields`` has exactly ``n`` elements."""
    return df.where(F.size(_col(fields)) == n)


def keep_present(df: DataFrame, col: str) -> DataFrame:
    return df.where(_col(col).isNotNull())


def xy(df: DataFrame, label: str, drop: tuple[str, ...] = ()) -> tuple[list[str], str]:
    """Feature column names and the label name, chosen by name, not position.

    Label and features stay on the same row, so no positional re-attachment
    is ever needed.
    """
    features = [c for c in df.columns if c != label and c not in drop]
    return features, label
