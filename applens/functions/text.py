"""Text-to-value column expressions used by the cleaning and review jobs.

All are plain Catalyst expressions, so they stay inside whole-stage codegen
and work on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The character class kept by the name cleaner, and the
# whitespace set removed by ``strip`` (Python's str.strip set: ASCII
# whitespace, the separators \x1c-\x1f, NEL and every Unicode separator).
NOT_ALNUM = "[^a-zA-Z0-9]"
WHITESPACE_CLASS = "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\p{Z}]"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: ColumnOrName) -> Column:
    """Text or number to double; unparseable text becomes NULL (never raises)."""
    return _col(c).try_cast("double")


def to_long(c: ColumnOrName) -> Column:
    """Text or number to bigint; unparseable text (including '1.0') becomes NULL."""
    return _col(c).try_cast("bigint")


def alnum(c: ColumnOrName, fill: str = "") -> Column:
    """Keep ASCII letters and digits; every other character becomes ``fill``."""
    return F.regexp_replace(_col(c), NOT_ALNUM, fill)


def category_label(c: ColumnOrName) -> Column:
    """Display form of a cleaned category: each '0' shown as '-'.

    Not an inverse of ``alnum(c, '0')``: genuine zeros are rewritten too.
    """
    return F.replace(_col(c), F.lit("0"), F.lit("-"))


def parse_size_mb(c: ColumnOrName) -> Column:
    """'19M' -> 19.0, '201k' -> 0.2 (k/1024, half-even to 1 decimal),
    'Varies with device' -> NULL, anything else unparseable -> NULL."""
    no_m = F.rtrim(_col(c), F.lit("M"))
    kilo = no_m.endswith("k")
    kb = to_double(F.rtrim(no_m, F.lit("k")))
    return (
        F.when(kilo, F.bround(kb / 1024.0, 1))
        .when(no_m.startswith("Varies"), F.lit(None).cast("double"))
        .otherwise(to_double(no_m))
    )


def parse_count(c: ColumnOrName) -> Column:
    """'10,000+' -> 10000 as bigint: trailing '+' and all commas removed."""
    return to_long(F.replace(F.rtrim(_col(c), F.lit("+")), F.lit(","), F.lit("")))


def parse_price(c: ColumnOrName) -> Column:
    """'$4.99 ' -> 4.99: leading '$' and trailing whitespace removed."""
    return to_double(F.regexp_replace(_col(c), "^\\$+|" + WHITESPACE_CLASS + "+$", ""))


def strip(c: ColumnOrName) -> Column:
    """Remove leading and trailing whitespace, Unicode separators included."""
    ws = WHITESPACE_CLASS
    return F.regexp_replace(_col(c), f"^{ws}+|{ws}+$", "")


def remove_newlines(c: ColumnOrName, replacement: str = " ") -> Column:
    """Replace each '\\n'; ``replacement=''`` joins the words across lines."""
    return F.replace(_col(c), F.lit("\n"), F.lit(replacement))


def literal_split(c: ColumnOrName, delimiter: str) -> Column:
    """Split on a literal delimiter, keeping empty and trailing fields."""
    return F.split(_col(c), "\\Q" + delimiter + "\\E", -1)


def short_name(c: ColumnOrName) -> Column:
    """Last two dot-separated segments joined by '-' ('com.a.b' -> 'a-b').

    A value without a dot is returned unchanged.
    """
    return F.replace(F.substring_index(_col(c), ".", -2), F.lit("."), F.lit("-"))


def prefix(c: ColumnOrName, text: str) -> Column:
    return F.concat(F.lit(text), _col(c))
