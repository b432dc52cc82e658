"""Models: planted signal recovered, partition-independent predictions."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from applens.operators import models as M
from applens.operators.encoding import fold_of
from applens.plans import catalog_jobs as cj
from applens.sources import proxies

from conftest import SF_SMALL


def planted(spark, n=600):
    df = spark.range(n).select(
        F.col("id"), (F.col("id") % 7).cast("double").alias("a"),
        (F.col("id") % 11).cast("double").alias("b"), (F.col("id") % 5).cast("double").alias("noise"))
    df = df.withColumn("Rating", 1.0 + 0.3 * F.col("a") - 0.1 * F.col("b"))
    return VectorAssembler(inputCols=["a", "b", "noise"], outputCol="features").transform(df)


def test_lasso_grid_recovers_signal(spark):
    df = planted(spark).withColumn("fold", fold_of(F.col("id"), 5, 1))
    est = M.lasso()
    cvm = M.grid_search(df, est, [1e-4, 1e-2, 1.0], est.regParam, "fold", folds=5, parallelism=2)
    assert cvm.bestModel.getOrDefault("regParam") == 1e-4
    pred = M.fit_l1(df, 1e-4).transform(df)
    assert M.r2(pred, "Rating", "prediction").first().r2 > 0.999


def test_gbt_beats_mean_and_ignores_partitioning(spark):
    df = planted(spark)
    model = M.rating_model(max_iter=10).fit(df)
    a = model.transform(df)
    assert a.select(F.min("prediction")).first()[0] is not None
    assert M.r2(a, "Rating", "prediction").first().r2 > 0.5
    b = model.transform(df.repartition(7))
    sa = a.agg(F.sum("prediction")).first()[0]
    sb = b.agg(F.sum("prediction")).first()[0]
    assert abs(sa - sb) < 1e-9


def test_rate_and_recommend_shapes(spark):
    clean, _ = cj.clean_catalog(proxies.apps_raw(spark, SF_SMALL))
    feats, _ = cj.build_features(clean)
    out = cj.rate_and_recommend(feats, tune=False, gbt_iter=5)
    rec = out["recommendations"]
    assert rec.columns == ["App_Label", "Category_Label", "Genres_Label", "Type", "Reviews", "Size",
                           "Installs", "Price", "Y-pred"]
    per_cat = rec.groupBy("Category_Label").count().agg(F.max("count")).first()[0]
    assert per_cat <= 5
    assert rec.where(F.col("Category_Label").contains("0")).count() == 0
    assert out["r2"].count() == 1


def test_r2_formula(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5)], "y double, p double")
    assert abs(M.r2(df, "y", "p").first().r2 - (1 - 0.5 / 2.0)) < 1e-12


def test_feature_model_alone_transforms_raw_rows(spark, tmp_dir):
    clean, _ = cj.clean_catalog(proxies.apps_raw(spark, SF_SMALL))
    feats, model = cj.build_features(clean)
    path = tmp_dir + "/features"
    model.save(path)
    again = cj.FeatureModel.load(spark, path)
    a = sorted(tuple(r.features) for r in model.transform(clean).select("features").collect())
    b = sorted(tuple(r.features) for r in again.transform(clean).select("features").collect())
    assert a == b and len(a) == feats.count()
    # A row of labels never seen gets the extra index of every column.
    new = clean.limit(1).withColumns({c: F.lit("never seen") for c in cj.INDEXED})
    labels = {r.column: r["count"] for r in again.index.groupBy("column").count().collect()}
    row = again.transform(new).first()
    assert all(row[c + "Index"] == labels[c] for c in cj.INDEXED)


def test_transform_scans_the_source_once(spark):
    clean, _ = cj.clean_catalog(proxies.apps_raw(spark, SF_SMALL))
    _, model = cj.build_features(clean)
    plan = model.transform(clean)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [p_partkey") == 1  # the others are the written index, a column's rows each


def test_shown_predictions_are_sorted_and_recommendations_are_not_presorted(spark):
    rows = [("a", "x", "g", 0.0, 1, 1.0, 1, 0.0, 3.01), ("b", "x", "g", 0.0, 1, 1.0, 1, 0.0, 4.0)]
    df = spark.createDataFrame(rows, "App_Label string, Category_Label string, Genres_Label string, Type double, "
                                     "Reviews int, Size double, Installs int, Price double, prediction double")
    table = M.prediction_table(df)
    assert [r["Y-pred"] for r in M.shown_predictions(table).collect()] == [4.0, 3.1]
    assert "Sort" not in table._jdf.queryExecution().optimizedPlan().toString()


def test_tuned_booster_settings():
    g = M.rating_model(max_iter=1000, max_depth=1, rows=0.8, columns=0.7)
    assert (g.getSubsamplingRate(), g.getFeatureSubsetStrategy(), g.getMaxIter(), g.getMaxDepth()) == (0.8, "0.7", 1000, 1)
