"""File sources/sinks and the streaming clean."""

import os

from pyspark.sql import functions as F

from applens.plans import catalog_jobs as cj
from applens.schemas import CLEAN, RAW_COLUMNS
from applens.sources import catalog as cat
from applens.sources import proxies
from applens.streaming import clean_catalog_stream, rating_median

from conftest import SF_SMALL


def rows(df):
    return sorted((tuple((v is None, v) for v in r) for r in df.collect()))


def test_catalog_csv_round_trip(spark, tmp_dir):
    raw = proxies.apps_raw(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "raw")
    text = raw.select([F.col(f"`{c}`").cast("string").alias(c) for c in RAW_COLUMNS])
    text.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    back = cat.read_catalog(spark, path)
    assert rows(back.select("App", "Rating", "Reviews", "Size")) == rows(raw.select("App", "Rating", "Reviews", "Size"))
    c1, _ = cj.clean_catalog(raw)
    c2, _ = cj.clean_catalog(back)
    assert rows(c1) == rows(c2)


def test_clean_and_feature_files(spark, tmp_dir):
    clean, _ = cj.clean_catalog(proxies.apps_raw(spark, SF_SMALL))
    p = os.path.join(tmp_dir, "clean")
    cat.write_clean(clean, p)
    back = cat.read_clean(spark, p)
    assert back.schema == CLEAN and rows(back) == rows(clean)
    feats, model = cj.build_features(clean)
    assert len(feats.columns) == 13
    fp = os.path.join(tmp_dir, "features")
    cat.write_features(model.transform(clean), fp)
    got = cat.read_features(spark, fp)
    assert got.count() == clean.count()
    assert got.where(F.col("App_Label").isNull()).count() == 0


def test_run_keys_dynamic_overwrite(spark, tmp_dir):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    keyed = cat.with_run_keys(orders, "o_orderdate", "orders")
    base = os.path.join(tmp_dir, "runs")
    cat.write_run(keyed, base)
    one_month = keyed.where(F.col("run_month") == keyed.first().run_month)
    cat.write_run(one_month, base)  # rerun of one month leaves the others alone
    assert spark.read.parquet(base).count() == orders.count()


def test_stream_clean_equals_batch(spark, tmp_dir):
    raw = proxies.apps_raw(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "in")
    raw.write.parquet(src)
    med = rating_median(raw)
    stream = spark.readStream.schema(raw.schema).parquet(src)
    q = (clean_catalog_stream(stream, med).writeStream.format("memory")
         .queryName("clean_stream_test").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    batch, _ = cj.clean_catalog(raw)
    assert rows(spark.table("clean_stream_test")) == rows(batch)


def test_stream_to_parquet_restarts_exactly_once(spark, tmp_dir):
    from applens.streaming import start_clean_stream

    raw = proxies.apps_raw(spark, SF_SMALL)
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    raw.where(F.col("Reviews") % 2 == 0).write.parquet(src)
    med = rating_median(raw)
    q = start_clean_stream(spark.readStream.schema(raw.schema).parquet(src), med, out, ck, trigger_once=True)
    q.awaitTermination()
    raw.where(F.col("Reviews") % 2 == 1).write.mode("append").parquet(src)
    q = start_clean_stream(spark.readStream.schema(raw.schema).parquet(src), med, out, ck, trigger_once=True)
    q.awaitTermination()
    batch, _ = cj.clean_catalog(raw)
    assert rows(spark.read.parquet(out)) == rows(batch)


def test_read_catalog_by_header_name(spark, tmp_dir):
    p = os.path.join(tmp_dir, "cat.csv")
    with open(p, "w") as f:
        f.write('Genres,App,Rating,Reviews,Size,Installs,Type,Price,Content Rating,Category\n')
        f.write('"Art;Design","My, App",4.1,10,19M,"10,000+",Free,0,Everyone,ART_AND_DESIGN\n')
        f.write('Tools,Other,NaN,x,8.5k,500+,Paid,$1.99,Teen,TOOLS\n')
    df = cat.read_catalog(spark, p)
    assert df.columns == RAW_COLUMNS
    got = {r.App: r for r in df.collect()}
    assert got["My, App"].Genres == "Art;Design" and got["My, App"].Rating == 4.1
    assert got["My, App"].Installs == "10,000+" and got["My, App"]["Last Updated"] is None
    assert got["Other"].Rating is None and got["Other"].Reviews is None
