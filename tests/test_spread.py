from pyspark.sql import functions as F

from applens import session
from applens.plans import catalog_jobs as cj
from applens.sources import proxies


def one_task(spark, path, rows=400):
    """A part table in one file and row group, copies and NULLs among its rows."""
    k = F.col("id")
    df = spark.range(rows).select(
        F.when(k % 50 != 0, k).alias("p_partkey"), F.lit("red ring").alias("p_name"), F.concat(F.lit("Brand#"), k % 5).alias("p_brand"),
        F.lit("LARGE").alias("p_type"), (k % 40).cast("int").alias("p_size"), F.lit(900.0).alias("p_retailprice"))
    df.unionByName(df.limit(20)).coalesce(1).write.parquet(f"{path}/part.parquet")


def sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_rows_of_one_file_are_dealt_over_tasks(spark, tmp_dir, monkeypatch):
    one_task(spark, tmp_dir)
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a file a task
    try:
        before = sorted(map(str, proxies.apps_raw(spark, tmp_dir).collect()))
        monkeypatch.setattr(session, "ROWS_A_TASK", 100)
        raw = proxies.apps_raw(spark, tmp_dir)
        assert sorted(map(str, raw.collect())) == before and len(before) == 420
        assert len(sizes(raw)) >= 4 and max(sizes(raw)) <= 110
        assert session.spread(raw.limit(50)).count() == 50
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_model_input_grows_in_partitions(spark, tmp_dir, monkeypatch):
    """Tasks of the boosted trees hold a bounded number of rows, however few files the features came from."""
    one_task(spark, tmp_dir)
    clean, _ = cj.clean_catalog(proxies.apps_raw(spark, tmp_dir))
    feats, _ = cj.build_features(clean)
    monkeypatch.setattr(session, "ROWS_A_TASK", 40)
    assembled, label = cj._model_input(feats.coalesce(1), 0.2, 42)
    rows = assembled.count()
    assert label == "Rating" and rows > 200 and max(sizes(assembled)) <= 45


def test_features_are_computed_once_for_the_lasso(spark, tmp_dir, monkeypatch):
    one_task(spark, tmp_dir)
    seen = []
    real = cj.kept_table
    monkeypatch.setattr(cj, "kept_table", lambda df, name, by=None: seen.append(name) or real(df, name, by))
    clean, _ = cj.clean_catalog(proxies.apps_raw(spark, tmp_dir))
    feats, _ = cj.build_features(clean)
    cj.tune_lasso(feats, alphas=[0.1])
    assert seen == ["clean", "feature-index", "features"]
