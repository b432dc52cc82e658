"""Column names that an input cannot clash with."""

from __future__ import annotations

from pyspark.sql import DataFrame


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unused(names: list[str], *tables: DataFrame) -> list[str]:
    """The names, each with as many underscores in front as it takes to be in none of the tables (in any case)."""
    taken = {c.lower() for t in tables for c in t.columns}
    prefix = "_"
    while any((prefix + n).lower() in taken for n in names):
        prefix += "_"
    return [prefix + n for n in names]
