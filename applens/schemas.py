"""Explicit schemas of the catalogue, cleaned and feature tables."""

from pyspark.sql import types as T

# Raw catalogue: read as text, typed by the cleaning step.
RAW_COLUMNS = [
    "App", "Category", "Rating", "Reviews", "Size", "Installs", "Type", "Price",
    "Content Rating", "Genres", "Last Updated", "Current Ver", "Android Ver",
]
RAW_TEXT = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Cleaned catalogue, headerless on disk, column order fixed.
CLEAN = T.StructType([
    T.StructField("App", T.StringType(), True),
    T.StructField("Category", T.StringType(), True),
    T.StructField("Rating", T.DoubleType(), True),
    T.StructField("Reviews", T.LongType(), True),
    T.StructField("Size", T.DoubleType(), True),
    T.StructField("Installs", T.LongType(), True),
    T.StructField("Type", T.StringType(), True),
    T.StructField("Price", T.DoubleType(), True),
    T.StructField("Content Rating", T.StringType(), True),
    T.StructField("Genres", T.StringType(), True),
])

CATEGORICAL = ["App", "Category", "Type", "Content Rating", "Genres"]
CONTINUOUS = ["Reviews", "Size", "Installs", "Price"]
INDEX_SUFFIX = "Index"
FEATURE_SLOTS = [c + INDEX_SUFFIX for c in CATEGORICAL] + CONTINUOUS

# Exported feature lines: label, nine feature slots, three labels.
FEATURES13 = T.StructType(
    [T.StructField("Rating", T.DoubleType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in CATEGORICAL + CONTINUOUS]
    + [T.StructField(c, T.StringType(), True)
       for c in ["App_Label", "Category_Label", "Genres_Label"]]
)

LEXICON = T.StructType([
    T.StructField("word", T.StringType(), False),
    T.StructField("polarity", T.DoubleType(), False),
    T.StructField("subjectivity", T.DoubleType(), False),
])
