"""Catalogue, cleaned-table and feature-table readers and writers.

Paths are plain Hadoop URIs (local, HDFS, object stores): no client upload
step. Every reader states its schema; nothing is inferred.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from applens.functions.numeric import nan_to_null
from applens.functions.text import to_double, to_long
from applens.schemas import CLEAN, FEATURE_SLOTS, FEATURES13, RAW_TEXT


def type_raw(raw: DataFrame) -> DataFrame:
    """Give the text catalogue the types a CSV reader would infer for the
    numeric columns: Rating double (NaN as NULL), Reviews bigint."""
    return raw.withColumns({
        "Rating": nan_to_null(to_double("Rating")),
        "Reviews": to_long("Reviews"),
    })


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue CSV with a header row; RFC-4180 quoting; numbers typed.

    Every field is read as text (no inference pass) and the catalogue
    columns are taken by header name, so the file's column order does not
    matter and a missing column is NULL. Rating and Reviews are then typed as
    a CSV reader with inference would (bad text -> NULL, 'NaN' -> NULL).
    """
    raw = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
           .option("inferSchema", False).csv(path))
    present = set(raw.columns)
    cols = [F.col(f"`{c}`").alias(c) if c in present else F.lit(None).cast("string").alias(c)
            for c in RAW_TEXT.names]
    return type_raw(raw.select(cols))


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """Headerless cleaned table, 10 typed columns; malformed fields -> NULL."""
    return spark.read.schema(CLEAN).option("mode", "PERMISSIVE").csv(path, header=False)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Headerless feature table (label, nine slots, three labels): every part file."""
    return spark.read.schema(FEATURES13).option("mode", "PERMISSIVE").csv(path, header=False)


def write_clean(df: DataFrame, path: str) -> None:
    """Write the cleaned table headerless, in schema order, replacing old output."""
    df.select([f.name for f in CLEAN.fields]).write.mode("overwrite").csv(path, header=False)


def feature_columns(df: DataFrame, features: str = "features") -> DataFrame:
    """Features-vector table -> the 13 flat columns of the exported lines."""
    arr = vector_to_array(F.col(features))
    slots = [arr[i].alias(name) for i, name in enumerate(FEATURES13.names[1:1 + len(FEATURE_SLOTS)])]
    return df.select(F.col("Rating").cast("double").alias("Rating"), *slots,
                     F.col("App").alias("App_Label"), F.col("Category").alias("Category_Label"),
                     F.col("Genres").alias("Genres_Label"))


def write_features(df: DataFrame, path: str, features: str = "features") -> None:
    """Write ``Rating, f1..f9, App, Category, Genres`` lines (quoted as needed).

    ``df`` is either a table with a features vector or the flat 13-column
    table ``build_features`` returns.
    """
    flat = feature_columns(df, features) if features in df.columns else df.select(FEATURES13.names)
    flat.write.mode("overwrite").csv(path, header=False)


def with_run_keys(df: DataFrame, ts: str, dataset: str) -> DataFrame:
    """Add the output keys ``run_month`` ('yyyy-MM' of ``ts``) and ``dataset``."""
    return df.withColumns({"run_month": F.date_format(F.col(ts), "yyyy-MM"),
                           "dataset": F.lit(dataset)})


def write_run(df: DataFrame, base: str, fmt: str = "parquet") -> None:
    """Write partitioned by ``run_month``/``dataset``; a rerun replaces only its
    own partitions (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_month", "dataset").format(fmt).save(base))
