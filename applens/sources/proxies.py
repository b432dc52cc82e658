"""Stand-in inputs built from the driver tables.

The catalogue and review sources of the application are not shipped, so the
queries derive tables of the same shape from ``part`` and ``conversations``.
They are lazy projections of the given tables, so they grow with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from applens.schemas import LEXICON
from applens.session import spread


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def apps_raw(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Catalogue rows as a CSV reader with inference would type them.

    App, Category, Size, Installs, Type, Price, Content Rating and Genres are
    text; Rating is a double with gaps and outliers; Reviews is a bigint.
    Bad values are planted by key so every cleaning rule has rows to act on.
    ``stream=True`` reads the same rows as a file stream.
    """
    p = _table(spark, sf_dir, "part")
    if stream:
        # A file stream watches a folder or glob; this glob matches the one file.
        p = spark.readStream.schema(p.schema).parquet(f"{sf_dir}/[p]art.parquet")
    else:
        p = spread(p, "part")
    k = F.col("p_partkey")
    size = F.col("p_size")
    return p.select(
        F.when(k % 101 == 0, F.lit("#$%"))
        .otherwise(F.concat(F.col("p_name"), F.lit(" #"), k.cast("string"))).alias("App"),
        F.when(k % 997 == 0, F.lit("1.9"))
        .otherwise(F.concat(F.col("p_type"), F.lit("_AND_"), F.col("p_brand"))).alias("Category"),
        F.when(k % 11 == 0, F.lit(None).cast("double"))
        .when(k % 97 == 0, F.lit(19.0))
        .otherwise((k % 41 + 10).cast("double") / 10.0).alias("Rating"),
        (k * 7).cast("bigint").alias("Reviews"),
        F.when(size % 5 == 0, F.lit("Varies with device"))
        .when(size % 5 == 1, F.concat((size * 16).cast("string"), F.lit("k")))
        .otherwise(F.concat(size.cast("string"), F.lit("M"))).alias("Size"),
        F.when(k % 4 == 0, F.lit("0")).when(k % 4 == 1, F.lit("500+"))
        .when(k % 4 == 2, F.lit("10,000+")).otherwise(F.lit("1,000,000+")).alias("Installs"),
        F.when(k % 53 == 0, F.lit(None).cast("string"))
        .when(k % 10 == 0, F.lit("Paid")).otherwise(F.lit("Free")).alias("Type"),
        F.when(k % 10 == 0, F.lit("$4.99 ")).otherwise(F.lit("0")).alias("Price"),
        F.when(k % 50 == 0, F.lit("Unrated")).when(k % 3 == 0, F.lit("Teen"))
        .otherwise(F.lit("Everyone")).alias("Content Rating"),
        F.concat(F.col("p_type"), F.lit(" & "), F.col("p_brand"), F.lit(";Other")).alias("Genres"),
        F.lit("January 7, 2018").alias("Last Updated"),
        F.lit("1.0.0").alias("Current Ver"),
        F.lit("4.0.3 and up").alias("Android Ver"),
    )


def review_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited review text, one chunk per conversation turn: ``rid, record``.

    ``record`` is ``app @ review``; turns with ``rid % 50 == 7`` carry a second
    '@' and turns with ``rid % 50 == 13`` carry none, so the field-count rule
    has records to reject. Turns with ``conv_id % 9`` 4 or 7 hold several records
    joined by '#', with empty and malformed ones, a trailing '#' and Unicode blanks.
    The text keeps its newlines.
    """
    c = _table(spark, sf_dir, "conversations")
    rid = (F.col("conv_id") * 1000 + F.col("turn")).cast("bigint")
    app = F.concat(F.lit("com."), F.col("role"), F.lit(".app"), (F.col("conv_id") % 40).cast("string"))
    record = (
        F.when(rid % 50 == 7, F.concat(app, F.lit(" @ "), F.col("text"), F.lit(" @ spam")))
        .when(rid % 50 == 13, F.concat(app, F.lit(" "), F.col("text")))
        .when(F.col("conv_id") % 9 == 4, F.concat(app, F.lit(" @ "), F.col("text"), F.lit("#\u00a0"), app,
                                       F.lit(" @ the second\nof two\u2003#")))
        .when(F.col("conv_id") % 9 == 7, F.concat(app, F.lit(" @ "), F.col("text"), F.lit("## "), app,
                                       F.lit("\u3000@ and and of#no fields#a @ b @ c#"), app, F.lit("@the")))
        .otherwise(F.concat(app, F.lit(" @ "), F.col("text")))
    )
    return c.select(rid.alias("rid"), record.alias("record"))


# The stand-in sentiment lexicon (word, polarity, subjectivity).
LEXICON_ROWS = [
    ("the", 0.5, 0.4),
    ("and", -0.25, 0.8),
    ("of", -0.6, 0.1),
    ("la", 0.3, 0.9),
    ("le", -0.3, 0.2),
    ("der", 0.7, 0.5),
    ("und", -0.45, 0.6),
]


# Words of the stand-in lexicon that modify the next one.
MODIFIER_ROWS = [("not", -0.5), ("very", 1.3)]


def modified_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns as reviews, ``rid, Review``, with a modifier planted before every 'the' and 'la': 'not' where
    ``conv_id % 3`` is 0, 'very' where it is 1, 'not very' or 'very odd' (a word between) where it is 2."""
    c = _table(spark, sf_dir, "conversations")
    third = F.col("conv_id") % 3
    planted = lambda word: (F.when(third == 0, f" not {word} ").when(third == 1, f" very {word} ")
                            .otherwise(f" not very {word} " if word == "the" else f" very odd {word} "))
    text = F.replace(F.replace(F.lower("text"), F.lit(" the "), planted("the")), F.lit(" la "), planted("la"))
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).cast("bigint").alias("rid"), text.alias("Review"))


def modifier_lexicon(spark: SparkSession) -> DataFrame:
    """The stand-in lexicon with modifiers: ``(word, polarity, subjectivity, modifier)``."""
    rows = [(w, p, s, None) for w, p, s in LEXICON_ROWS] + [(w, None, None, m) for w, m in MODIFIER_ROWS]
    return spark.createDataFrame(rows, "word string, polarity double, subjectivity double, modifier double")


def lexicon(spark: SparkSession) -> DataFrame:
    """The stand-in lexicon as a table ``(word, polarity, subjectivity)``."""
    return spark.createDataFrame(LEXICON_ROWS, LEXICON)
