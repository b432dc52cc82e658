"""The application's two pages as end-to-end jobs.

``catalogue_page``: catalogue CSV -> clean table, feature lines, genre and
profile reports, model scores and recommendations. ``review_page``: review
text -> scored reviews and the report tables. Every table is written as
Parquet under ``<out>/<table>/run_month=YYYY-MM/dataset=<name>/`` with
dynamic partition overwrite, so a rerun in the same month replaces its own
output and leaves other months and datasets alone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from applens.operators.models import recommend, shown_predictions
from applens.operators.profiling import describe_exact, profile
from applens.operators.windows import preview
from applens.plans.catalog_jobs import (
    build_features, clean_ranged, genre_report, profile_report, ranged_catalog, rate_and_recommend,
)
from applens.plans.review_jobs import score_reviews, sentiment_report
from applens.sources.catalog import read_catalog, write_clean, write_features, write_run
from applens.sources.reviews import read_reviews


def _write_tables(tables: dict[str, DataFrame], out: str, dataset: str, month: str) -> dict[str, str]:
    paths = {}
    for name, df in tables.items():
        path = f"{out}/{name}"
        keyed = df.withColumns({"run_month": F.lit(month), "dataset": F.lit(dataset)})
        # Parquet column names may not contain spaces etc.; keep a safe form.
        keyed = keyed.toDF(*[c.replace(" ", "_").replace("-", "_") for c in keyed.columns])
        write_run(keyed, path)
        paths[name] = path
    return paths


def _month(run_date: dt.date | None) -> str:
    return (run_date or dt.datetime.now(dt.timezone.utc).date()).strftime("%Y-%m")


def _kept(df: DataFrame, out: str, table: str, month: str, dataset: str) -> DataFrame:
    """Write a table under its run's folder and read it back: later steps start from a plain scan."""
    path = f"{out}/{table}/run_month={month}/dataset={dataset}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


CORR_COLS = ["Rating", "Size", "Installs", "Reviews", "Price", "Type", "Category", "Genres"]
PAIR_COLS = ["Rating", "Size", "Installs", "Reviews", "Price"]


def catalogue_page(spark: SparkSession, catalog_path: str, out: str, dataset: str = "default",
                   run_date: dt.date | None = None, tune: bool = True) -> dict[str, str]:
    """Run the catalogue page; returns the written table paths.

    The catalogue is read once, into the range-filtered table; that, the clean table and the
    feature table are written as Parquet, and every report reads what it needs from them.
    """
    month = _month(run_date)
    ranged = _kept(ranged_catalog(read_catalog(spark, catalog_path)), out, "ranged", month, dataset)
    clean = _kept(clean_ranged(ranged), out, "clean", month, dataset)
    write_clean(clean, f"{out}/clean_csv/run_month={month}/dataset={dataset}")
    features, model = build_features(clean)
    features = _kept(features, out, "features", month, dataset)
    write_features(features, f"{out}/features_csv/run_month={month}/dataset={dataset}")
    model.save(f"{out}/feature_model/run_month={month}/dataset={dataset}")
    genres = genre_report(ranged)
    profiles = profile_report(features, CORR_COLS, pair_cols=PAIR_COLS, hue="Type")
    models = rate_and_recommend(features, tune=tune)
    predictions = _kept(models["predictions"], out, "scored", month, dataset)
    tables = {
        "genre_rollup": genres["rollup"], "genre_top": genres["top"],
        "genre_rating_describe": genres["rating_describe"],
        "genre_rating_counts": genres["rating_counts"],
        "genre_rating_density": genres["rating_density"],
        "raw_preview": preview(ranged, 12, "App", "Reviews"),
        "feature_preview": preview(features, 12, "App_Label"),
        "describe": describe_exact(ranged), "profile": profile(ranged),
        "corr": profiles["corr"], "pairs": profiles["pairs"], "diagonal": profiles["diagonal"],
        "predictions": shown_predictions(predictions), "recommendations": recommend(predictions),
        "r2": models["r2"],
    }
    if tune:
        tables["tuned_predictions"] = shown_predictions(models["tuned_predictions"])
        tables["tuned_r2"] = models["tuned_r2"]
    return _write_tables(tables, out, dataset, month)


def review_page(spark: SparkSession, text_path: str, lexicon: DataFrame, out: str,
                dataset: str = "default", run_date: dt.date | None = None,
                wholetext: bool = False, newline: str = " ") -> dict[str, str]:
    """Run the review page on extracted review text; returns the table paths.

    A file is one text of records (see ``read_reviews``), read in blocks; ``wholetext=True`` reads each file
    as one row, for small files. The reviews are scored once and read back for the report.
    """
    month = _month(run_date)
    records = read_reviews(spark, text_path, newline=newline, wholetext=wholetext)
    scored = _kept(score_reviews(records, lexicon), out, "scored_reviews", month, dataset)
    tables = {"reviews": scored, **sentiment_report(scored, written=True)}
    return _write_tables(tables, out, dataset, month)
