"""

Every query reads the driver tables (or tables Spark derives from them) in
full. Floating results are rounded to 6 decimals in both engines; counts are
bigint in both.
"""

from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# The package lives next to this file; make it importable from any cwd.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from applens import functions as fn
from applens.operators import aggregates as agg
from applens.operators import boosting
from applens.operators import encoding as enc
from applens.operators import filters as flt
from applens.operators import joins as jn
from applens.operators import models
from applens.operators import profiling as prof
from applens.operators.quantiles import exact_quantiles
from applens.operators.sentiment import score_sentiment
from applens.operators import windows as win
from applens.plans import catalog_jobs as cj
from applens.plans import review_jobs as rj
from applens.sources import catalog as cat_src
from applens.sources import proxies
from applens.session import fresh_folder, kept_table
from applens.sources.reviews import read_reviews, split_records

# The training-data operators are an optional part of the installation: without them, or without
# what they import, the other queries still work.
try:
    from applens.llm import registry as llm_registry
except ImportError as missing:
    warnings.warn(f"no training-data queries: {missing}", stacklevel=1)
    llm_registry = None

SMOKE_DIR = "/root/testdata/sf0.001"


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


# ---------------------------------------------------------------- queries

def _clean(spark, sf):
    return cj.clean_catalog(proxies.apps_raw(spark, sf))


def _ranged(spark, sf):
    return cj.ranged_catalog(proxies.apps_raw(spark, sf))


def _scored(spark, sf):
    return rj.review_sentiment(proxies.review_records(spark, sf), proxies.lexicon(spark),
                               keys=["rid"])


def q_clean_catalog(spark: SparkSession, sf: str) -> DataFrame:
    clean, _ = _clean(spark, sf)
    return _r6(clean, "Rating", "Size", "Price")


def q_clean_catalog_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The row-level cleaning run as a stream (median from the batch table)."""
    from applens.streaming import clean_catalog_stream, rating_median, run_to_table

    med = rating_median(proxies.apps_raw(spark, sf))
    stream = clean_catalog_stream(proxies.apps_raw(spark, sf, stream=True), med)
    return _r6(run_to_table(stream, "clean_catalog_stream"), "Rating", "Size", "Price")


def q_genre_rollup(spark: SparkSession, sf: str) -> DataFrame:
    ranged = _ranged(spark, sf)
    return _r6(agg.genre_rollup(ranged, top=20), "Rating")


def q_genre_rollup_all(spark, sf):
    ranged = _ranged(spark, sf)
    return _r6(agg.genre_rollup(ranged, top=None), "Rating")


def q_genre_mean_rating(spark, sf):
    ranged = _ranged(spark, sf)
    return _r6(agg.mean_by_key(ranged, "Genres", "Rating"), "Rating")


def q_median_rating(spark, sf):
    ranged = _ranged(spark, sf)
    df = flt.drop_value(ranged, "Category", cj.BAD_CATEGORY)
    med = exact_quantiles(df, ["Rating"], [0.5]).select(F.col("value").alias("median_rating"))
    return _r6(med, "median_rating")


def q_rating_value_counts(spark, sf):
    return agg.value_counts(_ranged(spark, sf), "Rating")


def q_distinct_ratings(spark, sf):
    return agg.distinct_values(_ranged(spark, sf), "Rating")


def q_category_counts(spark, sf):
    clean, _ = _clean(spark, sf)
    return agg.value_counts(clean, "Category")


def q_part_type_counts(spark, sf):
    return agg.value_counts(spark.read.parquet(f"{sf}/part.parquet"), "p_type")


def q_content_ratings(spark, sf):
    clean, _ = _clean(spark, sf)
    return agg.distinct_values(clean, "Content Rating")


def q_category_labels(spark, sf):
    clean, _ = _clean(spark, sf)
    return agg.distinct_values(clean, "Category").select(
        "Category", fn.category_label("Category").alias("Category_Label"),
        fn.prefix("Category", "cat_").alias("dummy_name"))


def q_describe_part(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    return _r6(prof.describe_exact(part, ["p_partkey", "p_size", "p_retailprice"]),
               "mean", "std", "min", "p25", "p50", "p75", "max")


def q_describe_clean(spark, sf):
    clean, _ = _clean(spark, sf)
    return _r6(prof.describe_exact(clean), "mean", "std", "min", "p25", "p50", "p75", "max")


def q_describe_reviews(spark, sf):
    return _r6(prof.describe_exact(_scored(spark, sf), ["Polarity", "Subjectivity"]),
               "mean", "std", "min", "p25", "p50", "p75", "max")


def q_profile_reviews(spark, sf):
    return prof.profile(_scored(spark, sf))


def q_profile_apps_raw(spark, sf):
    return prof.profile(proxies.apps_raw(spark, sf))


def q_corr_clean(spark, sf):
    clean, _ = _clean(spark, sf)
    return _r6(prof.corr_matrix(clean, ["Rating", "Reviews", "Size", "Installs", "Price"]), "r")


def q_category_dummies(spark, sf):
    clean, _ = _clean(spark, sf)
    wide = enc.with_dummies(clean.select("App", "Reviews", "Category"), "Category", "cat")
    dummies = [c for c in wide.columns if c.startswith("cat_")]
    # Long form of the wide table: how many of a row's dummies are set, and which.
    ones = F.filter(F.array(*[F.when(F.col(f"`{c}`") == 1, F.lit(c)) for c in dummies]), lambda x: x.isNotNull())
    return wide.select("App", "Reviews", F.size(ones).cast("bigint").alias("n_set"),
                       F.array_join(ones, ",").alias("dummy"))


def q_category_dummies_long(spark, sf):
    clean, _ = _clean(spark, sf)
    return enc.dummies_long(clean, ["App", "Reviews"], "Category")


def q_size_histogram(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    return _r6(prof.histogram(part, "p_size", 10), "lo", "hi")


def q_size_density(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    return _r6(prof.kde(part, "p_size", 200), "x", "density")


def q_rating_density_by_type(spark, sf):
    clean, _ = _clean(spark, sf)
    return _r6(prof.kde(clean, "Rating", 200, by="Type"), "x", "density")


def q_catalog_pair_grid(spark, sf):
    clean, _ = _clean(spark, sf)
    return prof.pair_grid(clean, PAIR_COLS, hue="Type", bins=20)


PAIR_COLS = ["Rating", "Size", "Installs", "Reviews", "Price"]


def q_part_pair_bins(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    return prof.pair_bins(part, "p_size", "p_retailprice", hue="p_type", bins=20)


def q_top_rated_per_category(spark, sf):
    clean, _ = _clean(spark, sf)
    return _r6(win.top_n_per_group(clean.select("Category", "App", "Rating"),
                                   "Category", "Rating", 5, "App"), "Rating")


def q_sorted_by_rating(spark, sf):
    clean, _ = _clean(spark, sf)
    placed = win.with_positions(clean.select("App", "Rating"), F.desc_nulls_last("Rating"), "App")
    return _r6(placed, "Rating")


def q_first_by_rating(spark, sf):
    """The head of the table sorted by rating, ties by name."""
    clean, _ = _clean(spark, sf)
    return _r6(win.sort_desc(clean.select("App", "Rating"), "Rating", "App").limit(25), "Rating")


def q_catalog_preview(spark, sf):
    clean, _ = _clean(spark, sf)
    return _r6(win.preview(clean, 12, "App"), "Rating", "Size", "Price")


def q_raw_preview(spark, sf):
    # Names repeat in the raw table ('#$%'): Reviews breaks the ties.
    return win.preview(_ranged(spark, sf), 12, "App", "Reviews").drop(
        "Last Updated", "Current Ver", "Android Ver")


def q_review_records(spark, sf):
    return split_records(proxies.review_records(spark, sf), "record", keys=["rid"])


def q_review_file_records(spark, sf):
    """The chunks written as text files, '#' after each, and read back by the record scan."""
    path = f"{fresh_folder(spark, 'review-text')}"
    proxies.review_records(spark, sf).select("record").write.option("lineSep", "#").text(path)
    return read_reviews(spark, path).select("App", "Review", (F.col("seq") >= 0).alias("placed"))


def q_catalog_csv(spark, sf):
    """The raw catalogue written as CSV with a header and read back (S1), then cleaned."""
    path = fresh_folder(spark, "catalogue-csv")
    raw = proxies.apps_raw(spark, sf)
    (raw.select([F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns])
     .write.option("header", True).option("escape", '"').csv(path))
    clean, _ = cj.clean_catalog(cat_src.read_catalog(spark, path))
    return _r6(clean, "Rating", "Size", "Price")


def q_clean_csv(spark, sf):
    """The cleaned table written headerless (S4) and read back (S2)."""
    path = fresh_folder(spark, "clean-csv")
    cat_src.write_clean(_clean(spark, sf)[0], path)
    return _r6(cat_src.read_clean(spark, path), "Rating", "Size", "Price")


def q_feature_csv(spark, sf):
    """The feature lines written (S5) and every part file read back (S3)."""
    path = fresh_folder(spark, "feature-csv")
    cat_src.write_features(cj.build_features(_clean(spark, sf)[0])[0], path)
    return _r6(cat_src.read_features(spark, path), "Rating", "Size", "Price")


def q_review_field_counts(spark, sf):
    recs = split_records(proxies.review_records(spark, sf), "record", keys=["rid"],
                         with_rejected=True)
    return recs.groupBy("n_fields").agg(F.count(F.lit(1)).alias("records"))


def q_top_app_reviews(spark, sf):
    recs = split_records(proxies.review_records(spark, sf), "record", keys=["rid"])
    return jn.keep_top_keys(recs, "App", 23)


def q_review_sentiment(spark, sf):
    return _r6(_scored(spark, sf), "Polarity", "Subjectivity")


def q_modified_sentiment(spark, sf):
    """Every turn scored with negations and intensifiers in front of the scored words."""
    scored = score_sentiment(proxies.modified_reviews(spark, sf), "Review", proxies.modifier_lexicon(spark), keys=["rid"])
    return _r6(scored.select("rid", "Polarity", "Subjectivity"), "Polarity", "Subjectivity")


def q_reviews_preview(spark, sf):
    return _r6(win.preview(_scored(spark, sf), 10, "rid", "seq"), "Polarity", "Subjectivity")


def q_polarity_by_app(spark, sf):
    return rj.sentiment_report(_scored(spark, sf))["by_app"]


def q_sentiment_shares(spark, sf):
    return rj.sentiment_report(_scored(spark, sf))["shares"]


def q_subjectivity_histogram(spark, sf):
    return _r6(rj.sentiment_report(_scored(spark, sf))["subjectivity_hist"], "lo", "hi")


def q_sentiment_scatter(spark, sf):
    return rj.sentiment_report(_scored(spark, sf))["abs_scatter"]


def q_split_and_folds(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    k = F.col("p_partkey")
    return part.select("p_partkey", enc.is_held_out(k, 0.2, 42).alias("is_test"),
                       enc.fold_of(k, 10, 155).alias("fold"))


def q_exact_split(spark, sf):
    """Exactly a fifth of the line items, many to an order, held out by order key."""
    items = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    return enc.exact_split(items, F.col("l_orderkey"), 0.2, 42).groupBy("l_orderkey", "held_out").agg(F.count(F.lit(1)).alias("items"))


def q_exact_split_size(spark, sf):
    items = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    return enc.exact_split(items, F.col("l_orderkey"), 0.2, 42).groupBy("held_out").agg(F.count(F.lit(1)).alias("items"))


def q_category_vectors(spark, sf):
    """The dummies as one sparse vector a row, added up slot by slot; every row has one slot set."""
    clean, _ = _clean(spark, sf)
    index = kept_table(enc.frequency_index(clean, "Category"), "category-index")
    wide = enc.dummy_vectors(clean.select("App", "Reviews", "Category"), index, "Category", "dummies")
    totals = wide.select(Summarizer.metrics("sum", "count").summary(F.col("dummies")).alias("s")).select(
        F.col("s.count").alias("rows"), F.posexplode(vector_to_array("s.sum")).alias("index", "set"))
    return totals.join(index, "index").select(F.concat(F.lit("cat_"), F.col("Category")).alias("dummy"),
                                              F.col("set").cast("bigint").alias("set"), "rows")


def q_scatter_points(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    return _r6(prof.scatter_sample(part, "p_size", "p_retailprice", "p_partkey", hue="p_type", k=3), "x", "y")


def q_frequency_index(spark, sf):
    clean, _ = _clean(spark, sf)
    return enc.frequency_indexes(clean, cj.INDEXED).select("column", "value", "index")


def q_build_features(spark, sf):
    clean, _ = _clean(spark, sf)
    feats, _ = cj.build_features(clean)
    return _r6(feats, "Rating", "Size", "Price")


HEATMAP_COLS = ["Rating", "Size", "Installs", "Reviews", "Price", "Type", "Category", "Genres"]


def q_corr_features(spark, sf):
    clean, _ = _clean(spark, sf)
    feats, _ = cj.build_features(clean)
    return _r6(prof.corr_matrix(feats, HEATMAP_COLS), "r")


#: Dummies of the wide matrix: every index of the column and one that no row has.
CORR_DUMMIES = {"Type": [0.0, 1.0, 2.0], "Content Rating": [0.0, 1.0, 2.0]}


def q_corr_all(spark, sf):
    clean, _ = _clean(spark, sf)
    feats, _ = cj.build_features(clean)
    return _r6(prof.corr_all(feats, dummies=CORR_DUMMIES), "r")


def q_corr_categories(spark, sf):
    """The whole matrix: every number and a dummy for every Category of the data."""
    clean, _ = _clean(spark, sf)
    feats, _ = cj.build_features(clean)
    return _r6(prof.corr_all(feats, dummies={"Category": None}), "r")


def _fixed_predictions(spark, sf):
    """The prediction table with a formula for a model, so that it can be checked."""
    clean, _ = _clean(spark, sf)
    feats, _ = cj.build_features(clean)
    return models.prediction_table(feats.withColumn("prediction", 1 + (F.col("Reviews") % 37) / 8.0))


def q_fixed_predictions(spark, sf):
    shown = win.with_positions(_fixed_predictions(spark, sf), F.desc_nulls_last("Y-pred"), "App_Label")
    return _r6(shown, "Y-pred", "Size", "Price")


def q_fixed_recommendations(spark, sf):
    return _r6(models.recommend(_fixed_predictions(spark, sf)), "Y-pred", "Size", "Price")


def q_label_feature_split(spark, sf):
    clean, _ = _clean(spark, sf)
    names, label = flt.xy(clean, "Rating", drop=("App", "Category", "Type", "Content Rating", "Genres"))
    return _r6(clean.select(F.col(label).alias("label"), *names), "label", "Size", "Price")


def q_feature_preview(spark, sf):
    clean, _ = _clean(spark, sf)
    feats, _ = cj.build_features(clean)
    return _r6(win.preview(feats, 12, "App_Label"), "Rating", "Size", "Price")


def q_genre_rating_counts(spark, sf):
    return _r6(cj.genre_report(_ranged(spark, sf))["rating_counts"], "Rating")


def q_describe_ranged(spark, sf):
    return _r6(prof.describe_exact(_ranged(spark, sf)), "mean", "std", "min", "p25", "p50", "p75", "max")


def q_review_apps(spark, sf):
    return rj.sentiment_report(_scored(spark, sf))["n_apps"]


def q_genre_rating_density(spark, sf):
    return _r6(cj.genre_report(_ranged(spark, sf))["rating_density"], "x", "density")


def q_genre_rating_describe(spark, sf):
    return _r6(cj.genre_report(_ranged(spark, sf))["rating_describe"],
               "mean", "std", "min", "p25", "p50", "p75", "max")


def q_baseline_r2(spark, sf):
    clean, _ = _clean(spark, sf)
    means = clean.groupBy("Category").agg(F.avg("Rating").alias("baseline"))
    return _r6(models.r2(clean.join(means, "Category"), "Rating", "baseline"), "r2")


def q_orders_by_month(spark, sf):
    orders = cat_src.with_run_keys(spark.read.parquet(f"{sf}/orders.parquet"), "o_orderdate", "orders")
    return orders.groupBy("run_month", "dataset").agg(F.count(F.lit(1)).alias("rows"))


def q_recommendations(spark, sf):
    """Top 5 apps per category by the boosted model (model output: rows-only).

    The lasso grid search does not feed the recommendations, so it is its own
    query (``lasso_cv``)."""
    clean, _ = _clean(spark, sf)
    feats, _ = cj.build_features(clean)
    return cj.rate_and_recommend(feats, tune=False)["recommendations"]


def q_lasso_cv(spark, sf):
    """Tuned L1 penalty and its held-out R^2 (model output: rows-only)."""
    clean, _ = _clean(spark, sf)
    feats, _ = cj.build_features(clean)
    out = cj.tune_lasso(feats)
    return out["tuned_r2"].select(F.lit(out["best_alpha"]).alias("best_alpha"), "r2")


def q_lasso_grid(spark, sf):
    """Held-out R^2 of every penalty and fold (model output: rows-only, tested against brute force)."""
    clean, _ = _clean(spark, sf)
    feats, _ = cj.build_features(clean)
    return _r6(cj.tune_lasso(feats)["grid"], "r2")


def q_regularised_recommendations(spark, sf):
    """Top 5 apps per category by the regularised booster, ten trees (model output: rows-only)."""
    clean, _ = _clean(spark, sf)
    feats, _ = cj.build_features(clean)
    return cj.rate_and_recommend(feats, tune=False, regularised=boosting.Settings(trees=10, rate=0.3))["recommendations"]


STUMP_NUMBERS = ["Type", "Installs", "Price", "Size"]
STUMP = boosting.Settings(trees=1, depth=1, rate=1.0, l1=1.0, base=3.0)


def q_boosted_split(spark, sf):
    """The best regularised split of the whole feature table: each side's prediction and rows."""
    clean, _ = _clean(spark, sf)
    feats, _ = cj.build_features(clean)
    feats = kept_table(feats, "features")
    model = boosting.fit(feats, STUMP_NUMBERS, "Category", "Rating", "App_Label", STUMP)
    return _r6(model.predict(feats).groupBy("prediction").agg(F.count(F.lit(1)).alias("rows")), "prediction")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top 20 genres by app count, with installs and mean rating."""
    return q_genre_rollup(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "clean_catalog": q_clean_catalog,
        "clean_catalog_stream": q_clean_catalog_stream,
        "genre_rollup": q_genre_rollup,
        "genre_rollup_all": q_genre_rollup_all,
        "genre_mean_rating": q_genre_mean_rating,
        "median_rating": q_median_rating,
        "rating_value_counts": q_rating_value_counts,
        "distinct_ratings": q_distinct_ratings,
        "category_counts": q_category_counts,
        "part_type_counts": q_part_type_counts,
        "content_ratings": q_content_ratings,
        "category_labels": q_category_labels,
        "describe_part": q_describe_part,
        "profile_apps_raw": q_profile_apps_raw,
        "describe_clean": q_describe_clean,
        "describe_reviews": q_describe_reviews,
        "profile_reviews": q_profile_reviews,
        "corr_clean": q_corr_clean,
        "category_dummies": q_category_dummies,
        "category_dummies_long": q_category_dummies_long,
        "corr_all": q_corr_all,
        "corr_categories": q_corr_categories,
        "fixed_predictions": q_fixed_predictions,
        "fixed_recommendations": q_fixed_recommendations,
        "label_feature_split": q_label_feature_split,
        "feature_preview": q_feature_preview,
        "genre_rating_counts": q_genre_rating_counts,
        "describe_ranged": q_describe_ranged,
        "review_apps": q_review_apps,
        "size_histogram": q_size_histogram,
        "size_density": q_size_density,
        "part_pair_bins": q_part_pair_bins,
        "rating_density_by_type": q_rating_density_by_type,
        "catalog_pair_grid": q_catalog_pair_grid,
        "top_rated_per_category": q_top_rated_per_category,
        "sorted_by_rating": q_sorted_by_rating,
        "first_by_rating": q_first_by_rating,
        "catalog_preview": q_catalog_preview,
        "raw_preview": q_raw_preview,
        "review_records": q_review_records,
        "review_file_records": q_review_file_records,
        "catalog_csv": q_catalog_csv,
        "clean_csv": q_clean_csv,
        "feature_csv": q_feature_csv,
        "review_field_counts": q_review_field_counts,
        "top_app_reviews": q_top_app_reviews,
        "review_sentiment": q_review_sentiment,
        "modified_sentiment": q_modified_sentiment,
        "reviews_preview": q_reviews_preview,
        "polarity_by_app": q_polarity_by_app,
        "sentiment_shares": q_sentiment_shares,
        "subjectivity_histogram": q_subjectivity_histogram,
        "sentiment_scatter": q_sentiment_scatter,
        "split_and_folds": q_split_and_folds,
        "exact_split": q_exact_split,
        "exact_split_size": q_exact_split_size,
        "category_vectors": q_category_vectors,
        "scatter_points": q_scatter_points,
        "frequency_index": q_frequency_index,
        "build_features": q_build_features,
        "baseline_r2": q_baseline_r2,
        "corr_features": q_corr_features,
        "genre_rating_density": q_genre_rating_density,
        "genre_rating_describe": q_genre_rating_describe,
        "orders_by_month": q_orders_by_month,
        "recommendations": q_recommendations,
        "lasso_cv": q_lasso_cv,
        "lasso_grid": q_lasso_grid,
        "regularised_recommendations": q_regularised_recommendations,
        "boosted_split": q_boosted_split,
    } | (llm_registry.queries() if llm_registry else {})


# ---------------------------------------------------------------- oracles

APPS_RAW = """
apps_raw AS (
  SELECT
    CASE WHEN p_partkey % 101 = 0 THEN '#$%'
         ELSE p_name || ' #' || CAST(p_partkey AS VARCHAR) END AS "App",
    CASE WHEN p_partkey % 997 = 0 THEN '1.9'
         ELSE p_type || '_AND_' || p_brand END AS "Category",
    CASE WHEN p_partkey % 11 = 0 THEN NULL
         WHEN p_partkey % 97 = 0 THEN 19.0::DOUBLE
         ELSE CAST(p_partkey % 41 + 10 AS DOUBLE) / 10.0 END AS "Rating",
    CAST(p_partkey * 7 AS BIGINT) AS "Reviews",
    CASE WHEN p_size % 5 = 0 THEN 'Varies with device'
         WHEN p_size % 5 = 1 THEN CAST(p_size * 16 AS VARCHAR) || 'k'
         ELSE CAST(p_size AS VARCHAR) || 'M' END AS "Size",
    CASE p_partkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '500+'
         WHEN 2 THEN '10,000+' ELSE '1,000,000+' END AS "Installs",
    CASE WHEN p_partkey % 53 = 0 THEN NULL
         WHEN p_partkey % 10 = 0 THEN 'Paid' ELSE 'Free' END AS "Type",
    CASE WHEN p_partkey % 10 = 0 THEN '$4.99 ' ELSE '0' END AS "Price",
    CASE WHEN p_partkey % 50 = 0 THEN 'Unrated'
         WHEN p_partkey % 3 = 0 THEN 'Teen' ELSE 'Everyone' END AS "Content Rating",
    p_type || ' & ' || p_brand || ';Other' AS "Genres"
  FROM part
)"""

RANGED = """
ranged AS (SELECT * FROM apps_raw WHERE "Rating" IS NULL OR "Rating" <= 10)"""

CLEAN = """
c_cat AS (SELECT * FROM ranged WHERE "Category" IS DISTINCT FROM '1.9'),
c_med AS (SELECT median("Rating") AS m FROM c_cat),
c_fill AS (SELECT * REPLACE (coalesce("Rating", (SELECT m FROM c_med)) AS "Rating") FROM c_cat),
c_app AS (SELECT * REPLACE (regexp_replace("App", '[^a-zA-Z0-9]', '', 'g') AS "App") FROM c_fill),
c_named AS (SELECT * FROM c_app WHERE "App" IS DISTINCT FROM ''),
c_parsed AS (
  SELECT "App",
    regexp_replace("Category", '[^a-zA-Z0-9]', '0', 'g') AS "Category",
    "Rating", "Reviews",
    CASE WHEN rtrim("Size", 'M') LIKE '%k'
           THEN round_even(TRY_CAST(rtrim(rtrim("Size", 'M'), 'k') AS DOUBLE) / 1024.0, 1)
         WHEN rtrim("Size", 'M') LIKE 'Varies%' THEN NULL
         ELSE TRY_CAST(rtrim("Size", 'M') AS DOUBLE) END AS "Size",
    TRY_CAST(replace(rtrim("Installs", '+'), ',', '') AS BIGINT) AS "Installs",
    "Type",
    TRY_CAST(regexp_replace("Price", '^\\$+|\\s+$', '', 'g') AS DOUBLE) AS "Price",
    "Content Rating",
    regexp_replace("Genres", '[^a-zA-Z0-9]', '', 'g') AS "Genres"
  FROM c_named
),
apps_clean AS (
  SELECT * FROM c_parsed
  WHERE "Content Rating" IS DISTINCT FROM 'Unrated'
    AND "App" IS NOT NULL AND "Category" IS NOT NULL AND "Rating" IS NOT NULL
    AND "Reviews" IS NOT NULL AND "Size" IS NOT NULL AND "Installs" IS NOT NULL
    AND "Type" IS NOT NULL AND "Price" IS NOT NULL AND "Content Rating" IS NOT NULL
    AND "Genres" IS NOT NULL
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


CATALOG = _with(APPS_RAW, RANGED, CLEAN)


WS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\p{Z}]"

REVIEWS = f"""
r_src AS (
  SELECT CAST(conv_id * 1000 + turn AS BIGINT) AS rid,
         'com.' || role || '.app' || CAST(conv_id % 40 AS VARCHAR) AS app, text
  FROM conversations
),
r_raw AS (
  SELECT rid,
    CASE WHEN rid % 50 = 7 THEN app || ' @ ' || text || ' @ spam'
         WHEN rid % 50 = 13 THEN app || ' ' || text
         WHEN rid // 1000 % 9 = 4 THEN app || ' @ ' || text || '#' || chr(160) || app || ' @ the second' || chr(10) || 'of two' || chr(8195) || '#'
         WHEN rid // 1000 % 9 = 7 THEN app || ' @ ' || text || '## ' || app || chr(12288) || '@ and and of#no fields#a @ b @ c#' || app || '@the'
         ELSE app || ' @ ' || text END AS record
  FROM r_src
),
r_chunks AS (SELECT rid, string_split(replace(record, chr(10), ' '), '#') AS parts FROM r_raw),
r_pos AS (SELECT rid, parts, unnest(generate_series(1, len(parts))) AS i FROM r_chunks),
r_all AS (SELECT rid, CAST(i - 1 AS INTEGER) AS seq, string_split(parts[i], '@') AS f FROM r_pos),
reviews AS (
  SELECT rid, seq,
         regexp_replace(f[1], '^{WS}+|{WS}+$', '', 'g') AS "App",
         regexp_replace(f[2], '^{WS}+|{WS}+$', '', 'g') AS "Review"
  FROM r_all WHERE len(f) = 2
)"""

SCORED = """
top_apps AS (
  SELECT "App" FROM reviews WHERE "App" IS NOT NULL
  GROUP BY "App" ORDER BY count(*) DESC, "App" LIMIT 23
),
kept AS (SELECT * FROM reviews WHERE "App" IN (SELECT "App" FROM top_apps) OR "App" IS NULL),
lex(word, polarity, subjectivity) AS (VALUES
  ('the', 0.5::DECIMAL(20,10), 0.4::DECIMAL(20,10)), ('and', -0.25::DECIMAL(20,10), 0.8::DECIMAL(20,10)),
  ('of', -0.6::DECIMAL(20,10), 0.1::DECIMAL(20,10)), ('la', 0.3::DECIMAL(20,10), 0.9::DECIMAL(20,10)),
  ('le', -0.3::DECIMAL(20,10), 0.2::DECIMAL(20,10)), ('der', 0.7::DECIMAL(20,10), 0.5::DECIMAL(20,10)),
  ('und', -0.45::DECIMAL(20,10), 0.6::DECIMAL(20,10))),
toks AS (SELECT rid, seq, string_split_regex(lower("Review"), '[^a-z]+') AS t FROM kept),
tok AS (SELECT rid, seq, unnest(t) AS word FROM toks),
sc2 AS (
  SELECT rid, seq, CAST(sum(polarity) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS p,
         CAST(sum(subjectivity) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS s
  FROM tok JOIN lex USING (word) GROUP BY rid, seq
),
scored AS (
  SELECT kept.rid, kept.seq, "App", "Review",
         coalesce(p, 0.0) AS "Polarity", coalesce(s, 0.0) AS "Subjectivity",
         CASE WHEN coalesce(p, 0.0) < 0 THEN 'Negative'
              WHEN coalesce(p, 0.0) > 0 THEN 'Positive'
              WHEN coalesce(p, 0.0) = 0 THEN 'Neutral' END AS "Sentiment"
  FROM kept LEFT JOIN sc2 ON kept.rid = sc2.rid AND kept.seq = sc2.seq
)"""

SCORED_ALL = _with(REVIEWS, SCORED)


# The tokens walked one by one, with the modifiers in force and how many more words they hold over.
MODIFIED = """
WITH RECURSIVE lex(word, polarity, subjectivity, modifier) AS (VALUES
  ('the', 0.5::DECIMAL(20,10), 0.4::DECIMAL(20,10), NULL::DECIMAL(20,10)), ('and', -0.25, 0.8, NULL), ('of', -0.6, 0.1, NULL),
  ('la', 0.3, 0.9, NULL), ('le', -0.3, 0.2, NULL), ('der', 0.7, 0.5, NULL), ('und', -0.45, 0.6, NULL),
  ('not', NULL, NULL, -0.5), ('very', NULL, NULL, 1.3)),
src AS (
  SELECT CAST(conv_id * 1000 + turn AS BIGINT) AS rid, lower(text) AS t, conv_id % 3 AS m FROM conversations),
planted AS (
  SELECT rid, replace(replace(t, ' the ', CASE m WHEN 0 THEN ' not the ' WHEN 1 THEN ' very the ' ELSE ' not very the ' END),
                      ' la ', CASE m WHEN 0 THEN ' not la ' WHEN 1 THEN ' very la ' ELSE ' very odd la ' END) AS t FROM src),
toks AS (SELECT rid, list_filter(string_split_regex(t, '[^a-z]+'), lambda w: w <> '') AS w FROM planted),
walk AS (
  SELECT rid, 0 AS i, 0::DECIMAL(20,10) AS p, 0::DECIMAL(20,10) AS s, 0 AS n,
         1::DECIMAL(20,10) AS turn, 1::DECIMAL(20,10) AS strength, 0 AS room FROM toks
  UNION ALL
  SELECT k.rid, k.i + 1,
    CAST(k.p + CASE WHEN lex.polarity IS NOT NULL THEN greatest(-1::DECIMAL(20,10), least(1::DECIMAL(20,10),
           CAST(CAST(lex.polarity AS DECIMAL(18,8)) * CAST(k.turn AS DECIMAL(18,8)) AS DECIMAL(20,10)))) ELSE 0 END AS DECIMAL(20,10)),
    CAST(k.s + CASE WHEN lex.polarity IS NOT NULL THEN greatest(0::DECIMAL(20,10), least(1::DECIMAL(20,10),
           CAST(CAST(lex.subjectivity AS DECIMAL(18,8)) * CAST(k.strength AS DECIMAL(18,8)) AS DECIMAL(20,10)))) ELSE 0 END AS DECIMAL(20,10)),
    k.n + CASE WHEN lex.polarity IS NOT NULL THEN 1 ELSE 0 END,
    CASE WHEN lex.modifier IS NOT NULL THEN CAST(CAST(k.turn AS DECIMAL(18,8)) * CAST(lex.modifier AS DECIMAL(18,8)) AS DECIMAL(20,10))
         WHEN lex.polarity IS NULL AND k.room > 0 THEN k.turn ELSE 1::DECIMAL(20,10) END,
    CASE WHEN lex.modifier > 0 THEN CAST(CAST(k.strength AS DECIMAL(18,8)) * CAST(lex.modifier AS DECIMAL(18,8)) AS DECIMAL(20,10))
         WHEN lex.modifier IS NOT NULL OR (lex.polarity IS NULL AND k.room > 0) THEN k.strength ELSE 1::DECIMAL(20,10) END,
    CASE WHEN lex.modifier IS NOT NULL THEN 1 WHEN lex.polarity IS NULL AND k.room > 0 THEN k.room - 1 ELSE 0 END
  FROM walk k JOIN toks ON toks.rid = k.rid AND k.i < len(toks.w) LEFT JOIN lex ON lex.word = toks.w[k.i + 1])
SELECT rid, round(coalesce(CAST(p AS DOUBLE) / nullif(n, 0), 0.0), 6) + 0.0 AS "Polarity",
       round(coalesce(CAST(s AS DOUBLE) / nullif(n, 0), 0.0), 6) + 0.0 AS "Subjectivity"
FROM walk JOIN toks USING (rid) WHERE i = len(w)"""


# Only how many items of an order are held out is settled by the key: an order's items share its hash.
EXACT_SPLIT = """
SELECT l_orderkey, row_number() OVER (ORDER BY md5(CAST(l_orderkey AS VARCHAR) || ':42'), l_linenumber)
                   <= (SELECT ceil(0.2 * count(*)) FROM lineitem) AS held_out FROM lineitem"""


def _hist_sql(source: str, x: str, bins: int) -> str:
    return f"""
v AS (SELECT CAST({x} AS DOUBLE) AS x FROM {source} WHERE {x} IS NOT NULL AND NOT isnan(CAST({x} AS DOUBLE))),
st AS (
  SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
         CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v
),
b AS (SELECT least(CAST(floor({bins} * (x - lo) / (hi - lo)) AS BIGINT) + 1, {bins}) AS bin FROM v, st),
c AS (SELECT bin, count(*) AS cnt FROM b GROUP BY bin),
e AS (SELECT CAST(i AS INTEGER) AS bin FROM range(1, {bins + 1}) t(i))
SELECT e.bin, round(lo + (e.bin - 1) * ((hi - lo) / {bins}), 6) AS lo,
       round(lo + e.bin * ((hi - lo) / {bins}), 6) AS hi, coalesce(cnt, 0) AS count
FROM e CROSS JOIN st LEFT JOIN c ON e.bin = c.bin"""


def _range_sql(name: str, col: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT CASE WHEN min({col}) = max({col}) THEN min({col}) - 0.5 ELSE min({col}) END AS lo,
         CASE WHEN min({col}) = max({col}) THEN max({col}) + 0.5 ELSE max({col}) END AS hi
  FROM {source}
)"""


def _pair_bins_sql(bins: int, hue: str | None) -> str:
    h = f"{hue}, " if hue else ""
    return f"""
SELECT {h}least(CAST(floor({bins} * (x - sx.lo) / (sx.hi - sx.lo)) AS BIGINT) + 1, {bins}) AS bx,
       least(CAST(floor({bins} * (y - sy.lo) / (sy.hi - sy.lo)) AS BIGINT) + 1, {bins}) AS "by",
       count(*) AS count
FROM v, sx, sy GROUP BY ALL"""


def _describe_sql(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        c = c.strip('"')
        parts.append(f"""
SELECT '{c}' AS "column", count({x}) AS count, round(avg({x}), 6) AS mean,
       round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min,
       round(quantile_cont({x}, 0.25), 6) AS p25, round(quantile_cont({x}, 0.5), 6) AS p50,
       round(quantile_cont({x}, 0.75), 6) AS p75, round(max({x}), 6) AS max
FROM {table}""")
    return " UNION ALL ".join(parts)


RAW_TYPES = [("App", "string"), ("Category", "string"), ("Rating", "double"),
             ("Reviews", "bigint"), ("Size", "string"), ("Installs", "string"),
             ("Type", "string"), ("Price", "string"), ("Content Rating", "string"),
             ("Genres", "string"), ("Last Updated", "string"), ("Current Ver", "string"),
             ("Android Ver", "string")]

APPS_RAW_FULL = APPS_RAW.replace(
    """p_type || ' & ' || p_brand || ';Other' AS "Genres"
  FROM part""",
    """p_type || ' & ' || p_brand || ';Other' AS "Genres",
    'January 7, 2018' AS "Last Updated", '1.0.0' AS "Current Ver",
    '4.0.3 and up' AS "Android Ver"
  FROM part""")

CLEAN_NUM = ["Rating", "Reviews", "Size", "Installs", "Price"]
SCORED_TYPES = [("rid", "bigint"), ("seq", "int"), ("App", "string"), ("Review", "string"),
                ("Polarity", "double"), ("Subjectivity", "double"), ("Sentiment", "string")]
INDEXED = ["App", "Category", "Type", "Content Rating", "Genres"]


def _index_sql(src: str, c: str, alias: str) -> str:
    return (f"""SELECT "{c}" AS v, row_number() OVER (ORDER BY count(*) DESC, "{c}") - 1 AS ix
FROM {src} WHERE "{c}" IS NOT NULL GROUP BY "{c}" """)


def _features_sql() -> str:
    idx = ",\n".join(f"i{i} AS ({_index_sql('tr', c, f'i{i}')})" for i, c in enumerate(INDEXED))
    flag = """
flag AS (SELECT *, substr(md5("App" || ':42'), 1, 8) < '33333333' AS is_test FROM apps_clean),
tr AS (SELECT * FROM flag WHERE NOT is_test),
""" + idx
    joins = " ".join(f'LEFT JOIN i{i} ON f."{c}" = i{i}.v' for i, c in enumerate(INDEXED))
    slots = ",\n  ".join(
        f'CAST(coalesce(i{i}.ix, (SELECT count(*) FROM i{i})) AS DOUBLE) AS "{c}"'
        for i, c in enumerate(INDEXED))
    return CATALOG + "," + flag + f""",
feats AS (
SELECT f."Rating" AS "Rating",
  {slots},
  CAST(f."Reviews" AS DOUBLE) AS "Reviews", f."Size" AS "Size",
  CAST(f."Installs" AS DOUBLE) AS "Installs", f."Price" AS "Price",
  f."App" AS "App_Label", f."Category" AS "Category_Label", f."Genres" AS "Genres_Label"
FROM flag f {joins})
"""


FIXED_PREDICTIONS = """
shown AS (
  SELECT "App_Label", replace("Category_Label", '0', '-') AS "Category_Label", "Genres_Label",
         "Type", "Reviews", round("Size", 6) AS "Size", "Installs", round("Price", 6) AS "Price",
         round(ceil((1 + ("Reviews" % 37) / 8.0) * 10) / 10, 6) AS "Y-pred"
  FROM feats)"""


def _corr_all_sql() -> str:
    values = {c: f'"{c}"' for c in ["Rating", *FEATURE_NAMES]}
    values |= {f"{c}_{v}": f'CASE WHEN "{c}" = {v} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END'
               for c, levels in CORR_DUMMIES.items() for v in levels}
    pairs = [(a, b) for a in values for b in values]
    first = ", ".join(f"'{a}'" for a, _ in pairs)
    second = ", ".join(f"'{b}'" for _, b in pairs)
    r = ", ".join(f"CASE WHEN isnan(corr({values[a]}, {values[b]})) THEN NULL ELSE corr({values[a]}, {values[b]}) END"
                  for a, b in pairs)
    return f"""
SELECT unnest([{first}]) AS a, unnest([{second}]) AS b,
       unnest(list_transform(rs, lambda x: round(x, 6) + 0.0)) AS r
FROM (SELECT [{r}] AS rs FROM feats)"""


def _corr_long_sql(numbers: list[str], column: str) -> str:
    """Every pair of numbers and dummies, each dummy spelled out for every row."""
    cells = " UNION ALL ".join(f"SELECT rid, '{c}' AS name, CAST(\"{c}\" AS DOUBLE) AS x FROM rowed" for c in numbers)
    return f"""
rowed AS (SELECT *, row_number() OVER () AS rid FROM feats),
cells AS (
  {cells}
  UNION ALL
  SELECT rid, '{column}_' || CAST(v AS VARCHAR), CASE WHEN "{column}" = v THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
  FROM rowed, (SELECT DISTINCT "{column}" AS v FROM feats))
SELECT p.name AS a, q.name AS b,
       round(CASE WHEN isnan(corr(p.x, q.x)) THEN NULL ELSE corr(p.x, q.x) END, 6) + 0.0 AS r
FROM cells p JOIN cells q USING (rid) GROUP BY 1, 2"""


FEATURE_NAMES = [*INDEXED, "Reviews", "Size", "Installs", "Price"]


def _pair_grid_sql(cols: list[str], hue: str, bins: int) -> str:
    v = ", ".join(f'CAST("{c}" AS DOUBLE) AS c{i}' for i, c in enumerate(cols))
    rng = ", ".join(
        f"CASE WHEN min(c{i}) = max(c{i}) THEN min(c{i}) - 0.5 ELSE min(c{i}) END AS lo{i}, "
        f"CASE WHEN min(c{i}) = max(c{i}) THEN max(c{i}) + 0.5 ELSE max(c{i}) END AS hi{i}"
        for i in range(len(cols)))

    def b(i):
        return (f"CASE WHEN c{i} IS NOT NULL THEN "
                f"least(CAST(floor({bins} * (c{i} - lo{i}) / (hi{i} - lo{i})) AS BIGINT) + 1, {bins}) END")

    cells = " UNION ALL ".join(
        f"""SELECT "{hue}", '{cols[i]}' AS x_col, '{cols[j]}' AS y_col, {b(i)} AS bx, {b(j)} AS "by" FROM v, r"""
        for i in range(len(cols)) for j in range(i + 1, len(cols)))
    return f""",
v AS (SELECT "{hue}", {v} FROM apps_clean),
r AS (SELECT {rng} FROM v),
cells AS ({cells})
SELECT "{hue}", x_col, y_col, bx, "by", count(*) AS count FROM cells
WHERE bx IS NOT NULL AND "by" IS NOT NULL GROUP BY ALL"""


def _boosted_split_sql() -> str:
    """Every split of every feature with l1 = l2 = 1, base 3 and 1.0 as missing; the best one's two sides."""
    numbers = " UNION ALL ".join(
        f"""SELECT {i} AS f, CASE WHEN "{c}" <> 1 THEN "{c}" END AS v, 3.0 - "Rating" AS g FROM feats"""
        for i, c in enumerate(STUMP_NUMBERS))
    soft = "(sign({0}) * greatest(abs({0}) - 1.0, 0.0))"
    score = lambda g, h: f"(pow({soft.format(g)}, 2) / ({h} + 1.0))"
    return f""",
cells AS (SELECT f, v, sum(g) AS g, count(*) AS h FROM ({numbers}) GROUP BY f, v),
gone AS (SELECT f, g, h FROM cells WHERE v IS NULL),
sums AS (SELECT f, v, sum(g) OVER w AS g, sum(h) OVER w AS h FROM cells WHERE v IS NOT NULL WINDOW w AS (PARTITION BY f ORDER BY v)),
sides AS (
  SELECT f, v, 0 AS side, g, h FROM sums
  UNION ALL SELECT f, v, 1, sums.g + gone.g, sums.h + gone.h FROM sums JOIN gone USING (f)
  UNION ALL SELECT f, -1e300, 1, g, h FROM gone
  UNION ALL SELECT {len(STUMP_NUMBERS)}, "Category", 0, t.g - sum(3.0 - "Rating"), t.h - count(*) FROM feats, (SELECT sum(3.0 - "Rating") AS g, count(*) AS h FROM feats) t
            GROUP BY "Category", t.g, t.h),
total AS (SELECT sum(3.0 - "Rating") AS tg, count(*) AS th FROM feats),
best AS (
  SELECT g, h, tg - g AS rg, th - h AS rh FROM sides, total WHERE h >= 1 AND th - h >= 1
  ORDER BY {score("g", "h")} + {score("(tg - g)", "(th - h)")} DESC LIMIT 1)
SELECT round(3.0 - {soft.format("g")} / (h + 1.0), 6) AS prediction, CAST(h AS BIGINT) AS rows FROM best
UNION ALL SELECT round(3.0 - {soft.format("rg")} / (rh + 1.0), 6), CAST(rh AS BIGINT) FROM best"""


def oracle_sql() -> dict[str, str]:
    corr = " UNION ALL ".join(
        f"""SELECT '{a}' AS a, '{b}' AS b,
  round(CASE WHEN isnan(corr("{a}", "{b}")) THEN NULL ELSE corr("{a}", "{b}") END, 6) + 0.0 AS r
FROM apps_clean""" for a in CLEAN_NUM for b in CLEAN_NUM)
    clean_sql = CATALOG + """
SELECT "App", "Category", round("Rating", 6) AS "Rating", "Reviews",
       round("Size", 6) AS "Size", "Installs", "Type", round("Price", 6) AS "Price",
       "Content Rating", "Genres"
FROM apps_clean"""
    features_sql = """
SELECT * REPLACE (round("Rating", 6) AS "Rating", round("Size", 6) AS "Size",
                  round("Price", 6) AS "Price") FROM feats"""
    profile = " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS dtype,
  count("{c}") AS non_null, count(*) - count("{c}") AS nulls FROM apps_raw"""
        for i, (c, t) in enumerate(RAW_TYPES))
    freq = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", v AS value, ix AS index FROM ({_index_sql('apps_clean', c, 'x')})"""
        for c in INDEXED)
    return {
        "clean_catalog": clean_sql,
        "clean_catalog_stream": clean_sql,
        "genre_rollup": _with(APPS_RAW, RANGED) + """
SELECT "Genres", count(*) AS "Count",
       CAST(sum(TRY_CAST(replace(rtrim("Installs", '+'), ',', '') AS BIGINT)) AS BIGINT) AS "Installs",
       round(avg("Rating"), 6) AS "Rating"
FROM ranged WHERE "Genres" IS NOT NULL
GROUP BY "Genres" ORDER BY "Count" DESC, "Genres" LIMIT 20""",
        "genre_rollup_all": _with(APPS_RAW, RANGED) + """
SELECT "Genres", count(*) AS "Count",
       CAST(sum(TRY_CAST(replace(rtrim("Installs", '+'), ',', '') AS BIGINT)) AS BIGINT) AS "Installs",
       round(avg("Rating"), 6) AS "Rating"
FROM ranged WHERE "Genres" IS NOT NULL GROUP BY "Genres" """,
        "genre_mean_rating": _with(APPS_RAW, RANGED) + """
SELECT "Genres", round(avg("Rating"), 6) AS "Rating"
FROM ranged WHERE "Genres" IS NOT NULL GROUP BY "Genres" """,
        "median_rating": _with(APPS_RAW, RANGED) + """
SELECT round(median("Rating"), 6) AS median_rating
FROM ranged WHERE "Category" IS DISTINCT FROM '1.9'""",
        "rating_value_counts": _with(APPS_RAW, RANGED) + """
SELECT "Rating", count(*) AS count FROM ranged WHERE "Rating" IS NOT NULL GROUP BY "Rating" """,
        "distinct_ratings": _with(APPS_RAW, RANGED) + """
SELECT DISTINCT "Rating" FROM ranged""",
        "category_counts": CATALOG + """
SELECT "Category", count(*) AS count FROM apps_clean
WHERE "Category" IS NOT NULL GROUP BY "Category" """,
        "part_type_counts": """
SELECT p_type, count(*) AS count FROM part WHERE p_type IS NOT NULL GROUP BY p_type""",
        "content_ratings": CATALOG + """
SELECT DISTINCT "Content Rating" FROM apps_clean""",
        "category_labels": CATALOG + """
SELECT DISTINCT "Category", replace("Category", '0', '-') AS "Category_Label",
       'cat_' || "Category" AS dummy_name FROM apps_clean""",
        "describe_part": _describe_sql("part", ["p_partkey", "p_size", "p_retailprice"]),
        "profile_apps_raw": _with(APPS_RAW_FULL) + profile,
        "describe_clean": CATALOG + _describe_sql("apps_clean", [f'"{c}"' for c in CLEAN_NUM]),
        "describe_reviews": SCORED_ALL + _describe_sql("scored", ['"Polarity"', '"Subjectivity"']),
        "profile_reviews": SCORED_ALL + " UNION ALL ".join(
            f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS dtype,
  count("{c}") AS non_null, count(*) - count("{c}") AS nulls FROM scored"""
            for i, (c, t) in enumerate(SCORED_TYPES)),
        "corr_clean": CATALOG + corr,
        "category_dummies": CATALOG + """
SELECT "App", "Reviews", CAST(1 AS BIGINT) AS n_set, 'cat_' || "Category" AS dummy FROM apps_clean""",
        "category_dummies_long": CATALOG + """
SELECT "App", "Reviews", 'cat_' || "Category" AS dummy FROM apps_clean""",
        "corr_all": _features_sql() + _corr_all_sql(),
        "corr_categories": _features_sql() + "," + _corr_long_sql(["Rating", *FEATURE_NAMES], "Category"),
        "boosted_split": _features_sql() + _boosted_split_sql(),
        "fixed_predictions": _features_sql() + "," + FIXED_PREDICTIONS + """
SELECT *, row_number() OVER (ORDER BY "Y-pred" DESC, "App_Label") - 1 AS position FROM shown""",
        "fixed_recommendations": _features_sql() + "," + FIXED_PREDICTIONS + """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY "Category_Label" ORDER BY "Y-pred" DESC, "App_Label") AS rn FROM shown) WHERE rn <= 5""",
        "label_feature_split": CATALOG + """
SELECT round("Rating", 6) AS label, "Reviews", round("Size", 6) AS "Size", "Installs", round("Price", 6) AS "Price"
FROM apps_clean""",
        "feature_preview": _features_sql() + """
SELECT * REPLACE (round("Rating", 6) AS "Rating", round("Size", 6) AS "Size", round("Price", 6) AS "Price")
FROM feats ORDER BY "App_Label" LIMIT 12""",
        "genre_rating_counts": _with(APPS_RAW, RANGED) + """
SELECT round("Rating", 6) AS "Rating", count(*) AS count FROM (
  SELECT avg("Rating") AS "Rating" FROM ranged WHERE "Genres" IS NOT NULL GROUP BY "Genres")
WHERE "Rating" IS NOT NULL GROUP BY "Rating" """,
        "describe_ranged": _with(APPS_RAW, RANGED) + _describe_sql("ranged", ['"Rating"', '"Reviews"']),
        "review_apps": SCORED_ALL + """
SELECT count(DISTINCT "App") AS apps FROM scored""",
        "size_histogram": "WITH " + _hist_sql("part", "p_size", 10),
        "size_density": """
WITH v AS (SELECT CAST(p_size AS DOUBLE) AS x FROM part WHERE p_size IS NOT NULL),
st0 AS (SELECT count(x) AS n, stddev_samp(x) * pow(count(x), -0.2) AS bw,
               min(x) AS mn, max(x) AS mx FROM v),
st AS (SELECT n, bw, mn - 3.0 * bw AS lo, mx + 3.0 * bw AS hi FROM st0),
vc AS (SELECT x, count(*) AS c FROM v GROUP BY x),
g AS (SELECT CAST(j AS INTEGER) AS point, lo + j * ((hi - lo) / 199) AS gx
      FROM st, range(200) t(j))
SELECT point, round(gx, 6) AS x,
       round(sum(c * exp(-0.5 * pow((gx - x) / bw, 2))) / (n * bw * sqrt(2 * pi())), 6) AS density
FROM g, vc, st GROUP BY point, gx, n, bw""",
        "rating_density_by_type": CATALOG + """,
v AS (SELECT "Type" AS g, "Rating" AS x FROM apps_clean WHERE "Rating" IS NOT NULL AND "Type" IS NOT NULL),
st0 AS (SELECT g, count(x) AS n, stddev_samp(x) * pow(count(x), -0.2) AS bw,
               min(x) AS mn, max(x) AS mx FROM v GROUP BY g),
st AS (SELECT g, n, bw, mn - 3.0 * bw AS lo, mx + 3.0 * bw AS hi FROM st0),
vc AS (SELECT g, x, count(*) AS c FROM v GROUP BY g, x),
gr AS (SELECT g, CAST(j AS INTEGER) AS point, lo + j * ((hi - lo) / 199) AS gx
       FROM st, range(200) t(j))
SELECT gr.g AS "Type", point, round(gx, 6) AS x,
       round(sum(c * exp(-0.5 * pow((gx - vc.x) / bw, 2))) / (n * bw * sqrt(2 * pi())), 6) AS density
FROM gr JOIN vc ON gr.g = vc.g JOIN st ON gr.g = st.g
GROUP BY gr.g, point, gx, n, bw""",
        "catalog_pair_grid": CATALOG + _pair_grid_sql(PAIR_COLS, "Type", 20),
        "part_pair_bins": """
WITH v AS (SELECT p_type, CAST(p_size AS DOUBLE) AS x, CAST(p_retailprice AS DOUBLE) AS y
           FROM part WHERE p_size IS NOT NULL AND p_retailprice IS NOT NULL),""" +
        _range_sql("sx", "x", "v") + "," + _range_sql("sy", "y", "v") + _pair_bins_sql(20, "p_type"),
        "top_rated_per_category": CATALOG + """
SELECT "Category", "App", round("Rating", 6) AS "Rating" FROM (
  SELECT *, row_number() OVER (PARTITION BY "Category" ORDER BY "Rating" DESC NULLS LAST, "App") AS rn
  FROM apps_clean WHERE "Category" IS NOT NULL) WHERE rn <= 5""",
        "sorted_by_rating": CATALOG + """
SELECT "App", round("Rating", 6) AS "Rating",
       row_number() OVER (ORDER BY "Rating" DESC NULLS LAST, "App") - 1 AS position FROM apps_clean""",
        "first_by_rating": CATALOG + """
SELECT "App", round("Rating", 6) AS "Rating" FROM apps_clean ORDER BY "Rating" DESC NULLS LAST, "App" LIMIT 25""",
        "catalog_preview": CATALOG + """
SELECT "App", "Category", round("Rating", 6) AS "Rating", "Reviews",
       round("Size", 6) AS "Size", "Installs", "Type", round("Price", 6) AS "Price",
       "Content Rating", "Genres"
FROM apps_clean ORDER BY "App" LIMIT 12""",
        "raw_preview": _with(APPS_RAW, RANGED) + """
SELECT * FROM ranged ORDER BY "App", "Reviews" LIMIT 12""",
        "review_records": _with(REVIEWS) + """
SELECT rid, seq, "App", "Review" FROM reviews""",
        "review_file_records": _with(REVIEWS) + """
SELECT "App", "Review", true AS placed FROM reviews""",
        "catalog_csv": clean_sql,
        "clean_csv": clean_sql,
        "feature_csv": _features_sql() + features_sql,
        "review_field_counts": _with(REVIEWS) + """
SELECT CAST(len(f) AS INTEGER) AS n_fields, count(*) AS records FROM r_all GROUP BY 1""",
        "top_app_reviews": _with(REVIEWS, SCORED) + """
SELECT rid, seq, "App", "Review" FROM kept""",
        "review_sentiment": SCORED_ALL + """
SELECT rid, seq, "App", "Review", round("Polarity", 6) + 0.0 AS "Polarity",
       round("Subjectivity", 6) + 0.0 AS "Subjectivity", "Sentiment" FROM scored""",
        "modified_sentiment": MODIFIED,
        "reviews_preview": SCORED_ALL + """
SELECT rid, seq, "App", "Review", round("Polarity", 6) + 0.0 AS "Polarity",
       round("Subjectivity", 6) + 0.0 AS "Subjectivity", "Sentiment"
FROM scored ORDER BY rid, seq LIMIT 10""",
        "polarity_by_app": SCORED_ALL + """
SELECT "App", array_to_string(string_split("App", '.')[-2:], '-') AS short,
       count(*) FILTER (WHERE "Polarity" >= 0) AS non_negative,
       count(*) FILTER (WHERE "Polarity" < 0) AS negative
FROM scored WHERE "App" IS NOT NULL GROUP BY "App" """,
        "sentiment_shares": SCORED_ALL + """
SELECT "Sentiment", count(*) AS count,
       round(CAST(count(*) AS DOUBLE) * 100.0 /
             (SELECT count(*) FROM scored WHERE "Sentiment" IS NOT NULL), 2) AS share
FROM scored WHERE "Sentiment" IS NOT NULL GROUP BY "Sentiment" """,
        "subjectivity_histogram": SCORED_ALL + "," + _hist_sql("scored", '"Subjectivity"', 10),
        "sentiment_scatter": SCORED_ALL + """,
v AS (SELECT abs("Subjectivity") AS x, abs("Polarity") AS y FROM scored
      WHERE "Subjectivity" IS NOT NULL AND "Polarity" IS NOT NULL),""" +
        _range_sql("sx", "x", "v") + "," + _range_sql("sy", "y", "v") + _pair_bins_sql(20, None),
        "split_and_folds": """
SELECT p_partkey,
       substr(md5(CAST(p_partkey AS VARCHAR) || ':42'), 1, 8) < '33333333' AS is_test,
       CAST(('0x' || substr(md5(CAST(p_partkey AS VARCHAR) || ':155'), 1, 8))::BIGINT % 10 AS INTEGER) AS fold
FROM part""",
        "exact_split": "SELECT l_orderkey, held_out, count(*) AS items FROM (" + EXACT_SPLIT + ") GROUP BY ALL",
        "exact_split_size": "SELECT held_out, count(*) AS items FROM (" + EXACT_SPLIT + ") GROUP BY ALL",
        "category_vectors": CATALOG + """
SELECT 'cat_' || "Category" AS dummy, count(*) AS "set", (SELECT count(*) FROM apps_clean) AS rows
FROM apps_clean GROUP BY "Category" """,
        "scatter_points": """
WITH v AS (SELECT p_type, p_partkey, CAST(p_size AS DOUBLE) AS x, CAST(p_retailprice AS DOUBLE) AS y
           FROM part WHERE p_size IS NOT NULL AND p_retailprice IS NOT NULL),""" +
        _range_sql("sx", "x", "v") + "," + _range_sql("sy", "y", "v") + """,
c AS (SELECT p_type, p_partkey, x, y, least(CAST(floor(20 * (x - sx.lo) / (sx.hi - sx.lo)) AS BIGINT) + 1, 20) AS bx,
             least(CAST(floor(20 * (y - sy.lo) / (sy.hi - sy.lo)) AS BIGINT) + 1, 20) AS "by" FROM v, sx, sy)
SELECT p_type, bx, "by", p_partkey, round(x, 6) AS x, round(y, 6) AS y FROM c
QUALIFY row_number() OVER (PARTITION BY p_type, bx, "by" ORDER BY md5(CAST(p_partkey AS VARCHAR) || ':0'), x, y) <= 3""",
        "frequency_index": CATALOG + freq,
        "build_features": _features_sql() + features_sql,
        "corr_features": _features_sql() + " UNION ALL ".join(
            f"""SELECT '{a}' AS a, '{b}' AS b,
  round(CASE WHEN isnan(corr("{a}", "{b}")) THEN NULL ELSE corr("{a}", "{b}") END, 6) + 0.0 AS r
FROM feats""" for a in HEATMAP_COLS for b in HEATMAP_COLS),
        "genre_rating_density": _with(APPS_RAW, RANGED) + """,
v AS (SELECT avg("Rating") AS x FROM ranged WHERE "Genres" IS NOT NULL GROUP BY "Genres"),
v2 AS (SELECT x FROM v WHERE x IS NOT NULL AND NOT isnan(x)),
st0 AS (SELECT count(x) AS n, stddev_samp(x) * pow(count(x), -0.2) AS bw,
               min(x) AS mn, max(x) AS mx FROM v2),
st AS (SELECT n, bw, mn - 3.0 * bw AS lo, mx + 3.0 * bw AS hi FROM st0),
vc AS (SELECT x, count(*) AS c FROM v2 GROUP BY x),
g AS (SELECT CAST(j AS INTEGER) AS point, lo + j * ((hi - lo) / 199) AS gx
      FROM st, range(200) t(j))
SELECT point, round(gx, 6) AS x,
       round(sum(c * exp(-0.5 * pow((gx - x) / bw, 2))) / (n * bw * sqrt(2 * pi())), 6) AS density
FROM g, vc, st GROUP BY point, gx, n, bw""",
        "genre_rating_describe": _with(APPS_RAW, RANGED) + """,
rollup AS (SELECT avg("Rating") AS "Rating" FROM ranged WHERE "Genres" IS NOT NULL GROUP BY "Genres")
""" + _describe_sql("rollup", ['"Rating"']),
        "baseline_r2": CATALOG + """,
m AS (SELECT "Category", avg("Rating") AS baseline FROM apps_clean GROUP BY "Category"),
j AS (SELECT "Rating", baseline FROM apps_clean JOIN m USING ("Category"))
SELECT round(1 - sum(pow("Rating" - baseline, 2)) /
             sum(pow("Rating" - (SELECT avg("Rating") FROM j), 2)), 6) AS r2 FROM j""",
        "orders_by_month": """
SELECT strftime(o_orderdate, '%Y-%m') AS run_month, 'orders' AS dataset, count(*) AS rows
FROM orders GROUP BY 1""",
    } | (llm_registry.oracle_sql() if llm_registry else {})
