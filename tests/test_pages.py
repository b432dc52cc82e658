"""The two pages end to end on small inputs, including a same-month rerun."""

import datetime as dt
import os

from pyspark.sql import functions as F

from applens.plans.pages import catalogue_page, review_page
from applens.schemas import RAW_COLUMNS
from applens.sources import proxies

from conftest import SF_SMALL


def test_catalogue_page(spark, tmp_dir):
    raw = proxies.apps_raw(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "catalogue")
    raw.select([F.col(f"`{c}`").cast("string").alias(c) for c in RAW_COLUMNS]) \
        .write.option("header", True).option("escape", '"').csv(src)
    out = os.path.join(tmp_dir, "out")
    paths = catalogue_page(spark, src, out, run_date=dt.date(2024, 5, 1), tune=False)
    rec = spark.read.parquet(paths["recommendations"])
    assert rec.count() > 0 and set(rec.select("run_month").distinct().toPandas().run_month) == {"2024-05"}
    first = spark.read.parquet(paths["genre_rollup"]).count()
    assert spark.read.parquet(paths["corr"]).count() == 64
    assert spark.read.parquet(paths["feature_preview"]).count() == 12
    assert {r["column"] for r in spark.read.parquet(paths["profile"]).collect()} >= {"Last Updated", "Rating"}
    catalogue_page(spark, src, out, run_date=dt.date(2024, 5, 20), tune=False)  # same month
    catalogue_page(spark, src, out, run_date=dt.date(2024, 6, 2), tune=False)
    g = spark.read.parquet(paths["genre_rollup"])
    assert g.where(F.col("run_month") == "2024-05").count() == first
    assert g.where(F.col("run_month") == "2024-06").count() == first


def test_review_page(spark, tmp_dir):
    src = os.path.join(tmp_dir, "reviews.txt")
    texts = [r.record for r in proxies.review_records(spark, SF_SMALL).orderBy("rid").limit(60).collect()]
    with open(src, "w") as f:
        f.write("#".join(texts))
    out = os.path.join(tmp_dir, "out")
    paths = review_page(spark, src, proxies.lexicon(spark), out, run_date=dt.date(2024, 5, 1), wholetext=True)
    reviews = spark.read.parquet(paths["reviews"])
    assert reviews.count() > 0
    shares = spark.read.parquet(paths["shares"])
    assert abs(shares.agg(F.sum("share")).first()[0] - 100.0) < 0.05
    assert spark.read.parquet(paths["n_apps"]).first().apps == reviews.select("App").distinct().count()
    assert spark.read.parquet(paths["profile"]).where("`column` = 'Polarity'").count() == 1
