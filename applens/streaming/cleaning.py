"""Catalogue cleaning on a streaming DataFrame.

Every cleaning step except the median fill is a stateless expression or
predicate, so the same plan runs on a stream. A median over an unbounded
stream is not defined; the fill value is given instead (for example the
median of a batch snapshot, from ``rating_median``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from applens.operators.filters import drop_outliers, drop_value
from applens.operators.quantiles import exact_quantiles
from applens.plans.catalog_jobs import BAD_CATEGORY, MAX_RATING, clean_rows
from applens.session import ensure_checkpoint_dir
from applens.sources.catalog import type_raw


def rating_median(batch: DataFrame) -> float | None:
    """Median rating of a batch snapshot after the range and category filters."""
    df = drop_value(drop_outliers(batch, "Rating", MAX_RATING), "Category", BAD_CATEGORY)
    row = exact_quantiles(df, ["Rating"], [0.5]).first()
    return None if row is None else row.value


def clean_catalog_stream(raw: DataFrame, rating_fill: float | Column | None) -> DataFrame:
    """Streaming clean: range filter, then the row-level steps of the batch job."""
    if dict(raw.dtypes).get("Rating") == "string":
        raw = type_raw(raw)
    fill = None if rating_fill is None else (
        rating_fill if isinstance(rating_fill, Column) else F.lit(float(rating_fill)))
    return clean_rows(drop_outliers(raw, "Rating", MAX_RATING), fill)


def start_clean_stream(raw: DataFrame, rating_fill, path: str, checkpoint: str,
                       trigger_once: bool = False) -> StreamingQuery:
    """Append the cleaned rows of a stream to a Parquet folder.

    ``checkpoint`` must be a shared, durable folder: it holds the source
    offsets and the sink's commit log, which make restarts exactly-once.
    """
    w = (clean_catalog_stream(raw, rating_fill).writeStream.format("parquet")
         .option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()


def run_to_table(stream: DataFrame, name: str, checkpoint_root: str | None = None) -> DataFrame:
    """Run a streaming DataFrame over everything available now into a Parquet
    folder and return that table.

    Table and stream checkpoint go under the session's checkpoint folder; no
    row passes through the driver.
    """
    spark = stream.sparkSession
    base = f"{checkpoint_root or ensure_checkpoint_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"
    q = (stream.writeStream.format("parquet").option("path", f"{base}/table").outputMode("append")
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/table")
