"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Sentiment labels.
NEGATIVE, NEUTRAL, POSITIVE = "Negative", "Neutral", "Positive"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: ColumnOrName) -> Column:
    """NaN -> NULL, so that comparisons, medians and counts skip it."""
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def ceil1(c: ColumnOrName) -> Column:
    """Round up to one decimal, as a double."""
    return F.ceil(_col(c) * 10) / 10.0


def sign_label(c: ColumnOrName) -> Column:
    """Negative / Neutral / Positive by sign; NULL stays NULL."""
    c = _col(c)
    return (F.when(c < 0, NEGATIVE).when(c > 0, POSITIVE)
            .when(c == 0, NEUTRAL))


def safe_corr(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Pearson correlation on pairwise-complete rows; NULL for a constant side.

    ``corr`` divides by zero (an error under ANSI) for constant input; this
    form gives NULL instead and equals ``corr`` otherwise.
    """
    x, y = _col(x), _col(y)
    sx = F.stddev_pop(F.when(y.isNotNull(), x))
    sy = F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), sx * sy)
