"""Composite review jobs: scoring and the report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.functions.numeric import sign_label
from applens.operators.aggregates import class_share, polarity_by_app
from applens.operators.filters import keep_present
from applens.operators.joins import keep_top_keys
from applens.operators.profiling import describe_exact, histogram, pair_bins, profile
from applens.operators.sentiment import score_sentiment
from applens.session import ensure_checkpoint_dir, kept_table
from applens.sources.reviews import split_records

TOP_APPS = 23


def score_reviews(reviews: DataFrame, lexicon: DataFrame,
                  top_apps: int | None = TOP_APPS) -> DataFrame:
    """Split review records -> scored reviews of the busiest apps.

    Adds ``Polarity, Subjectivity, Sentiment``. The top-apps filter runs
    before scoring (it depends on App only), so the scorer never sees rows
    that would be dropped. The rows that are left are written once: scoring reads
    them twice, and so the records are split only for the counts of the apps and here.
    """
    if top_apps is not None:
        reviews = keep_top_keys(reviews, "App", top_apps)
    reviews = kept_table(reviews, "reviews")
    keys = [c for c in reviews.columns if c not in ("App", "Review")]
    scored = score_sentiment(reviews, "Review", lexicon, keys=keys)
    return scored.withColumn("Sentiment", sign_label("Polarity"))


def review_sentiment(records: DataFrame, lexicon: DataFrame, text: str = "record",
                     keys: list[str] | None = None, top_apps: int | None = TOP_APPS,
                     newline: str = " ") -> DataFrame:
    """Delimited text -> scored reviews of the busiest apps.

    Output: ``keys..., seq, App, Review, Polarity, Subjectivity, Sentiment``.
    """
    reviews = split_records(records, text, keys=keys, newline=newline)
    return score_reviews(reviews, lexicon, top_apps)


def sentiment_report(scored: DataFrame, bins: int = 10, scatter_bins: int = 20,
                     written: bool = False) -> dict[str, DataFrame]:
    """The report tables of a scored review table.

    * ``by_app``: per app, non-negative and negative review counts + short name
    * ``n_apps``: the number of apps in it
    * ``describe``, ``profile``: quartiles of the scores, structure of the table
    * ``subjectivity_hist``: equal-width histogram of Subjectivity
    * ``abs_scatter``: 2-D bins of |Subjectivity| against |Polarity|
    * ``shares``: count and percentage of each Sentiment class
    """
    # Every table reads the same scored rows: score once and write them to the
    # checkpoint folder, unless the caller has them written already.
    if not written:
        ensure_checkpoint_dir(scored.sparkSession)
        scored = scored.checkpoint(eager=True)
    absolute = scored.select(F.abs("Subjectivity").alias("Subjectivity"),
                             F.abs("Polarity").alias("Polarity"))
    return {
        "by_app": polarity_by_app(scored),
        "n_apps": scored.agg(F.count_distinct("App").alias("apps")),
        "describe": describe_exact(scored, ["Polarity", "Subjectivity"]),
        "profile": profile(scored),
        "subjectivity_hist": histogram(keep_present(scored, "Subjectivity"), "Subjectivity", bins),
        "abs_scatter": pair_bins(absolute, "Subjectivity", "Polarity", bins=scatter_bins),
        "shares": class_share(scored, "Sentiment"),
    }
