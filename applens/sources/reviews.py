"""Delimited review records: ``app @ review`` joined by ``#``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from applens.functions.text import literal_split, remove_newlines, strip
from applens.operators.filters import keep_field_count
from applens.session import kept_table

RECORD_SEP = "#"
FIELD_SEP = "@"


def _fields(record: Column) -> list[Column]:
    """App and Review of a record's fields, stripped, and the number of fields."""
    return [strip(F.get(record, 0)).alias("App"), strip(F.get(record, 1)).alias("Review"), F.size(record).alias("n_fields")]


def split_records(df: DataFrame, text: str, keys: list[str] | None = None,
                  newline: str = " ", with_rejected: bool = False) -> DataFrame:
    """Text chunks -> one row per record ``keys..., seq, App, Review``.

    Newlines are replaced by ``newline`` ('' joins words across lines), each
    chunk is split on '#', each record on '@'; only records with exactly two
    fields are kept, both fields stripped. ``seq`` is the record's position
    in its chunk. ``with_rejected`` keeps every record and adds ``n_fields``
    instead, so rejected records can be counted.
    """
    keys = keys or []
    recs = df.select(*keys, F.posexplode(literal_split(remove_newlines(text, newline), RECORD_SEP))
                     .alias("seq", "_rec"))
    recs = recs.withColumn("_f", literal_split("_rec", FIELD_SEP))
    if not with_rejected:
        recs = keep_field_count(recs, "_f", 2)
    out = recs.select(*keys, "seq", *_fields(F.col("_f")))
    return out if with_rejected else out.drop("n_fields")


def read_reviews(spark: SparkSession, path: str, newline: str = " ",
                 wholetext: bool = False, with_rejected: bool = False) -> DataFrame:
    """Review text files -> records ``file, seq, App, Review`` (rules as ``split_records``).

    A file is one text, whatever its lines: '#' is the scan's own record separator, so that Spark
    reads a file in blocks, many tasks at once, and a record may run over lines and blocks. ``seq`` (a
    bigint) is the record's position in its file: its place in its block plus the records of the
    blocks before. The records are written once to the checkpoint folder, as places are
    counted and then attached. ``with_rejected`` keeps all records and adds ``n_fields``; with
    it the empty record after a last '#' is there too, as splitting the whole text gives it (found
    by the file's size, as the scan does not report it). A file without text has no records.
    ``wholetext=True`` gives the same from one row a file, for small files: nothing is written.
    """
    if wholetext:
        whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
        found = split_records(whole.where(F.octet_length("value") > 0), "value", ["file"], newline, with_rejected)
        return found.withColumn("seq", F.col("seq").cast("bigint"))
    raw = spark.read.option("lineSep", RECORD_SEP).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"), F.monotonically_increasing_id().alias("row"), "value")
    fields = literal_split(remove_newlines("value", newline), FIELD_SEP)
    recs = kept_table(raw.withColumn("bytes", F.octet_length("value")).withColumn("f", fields).select(
        "file", "block", "row", "file_size", "bytes", *_fields(F.col("f"))), "review-records")
    # One row per block, then per file: rows of a block are read in order by one task.
    blocks = recs.groupBy("file", "block").agg(
        F.min("row").alias("first"), F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.first("file_size").alias("file_size"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
    placed = blocks.select("file", "block", (before - F.col("first")).alias("shift"))
    out = recs.join(placed, ["file", "block"]).withColumn("seq", F.col("row") + F.col("shift"))
    if not with_rejected:
        return out.where(F.col("n_fields") == 2).select("file", "seq", "App", "Review")
    files = blocks.groupBy("file").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.first("file_size").alias("file_size"))
    # Every record but the last is followed by a separator; one more byte is a separator at the end.
    last = files.where(F.col("bytes") + F.col("n") == F.col("file_size")).select(
        "file", F.col("n").alias("seq"), F.lit("").alias("App"), F.lit(None).cast("string").alias("Review"), F.lit(1).alias("n_fields"))
    return out.select("file", "seq", "App", "Review", "n_fields").unionByName(last)
