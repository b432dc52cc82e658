"""Composite catalogue jobs: clean (P1), features (P2), genre report (P3),
profile report (P4), rating models and recommendations (P5)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from applens.functions.text import alnum, parse_count, parse_price, parse_size_mb
from applens.operators.aggregates import genre_rollup, value_counts
from applens.operators.encoding import apply_index, fold_of, frequency_indexes, is_held_out
from applens.operators.filters import (
    complete_rows, drop_blank, drop_outliers, drop_value, xy,
)
from applens.operators.hot_keys import hot_values
from applens.operators import boosting, lasso
from applens.operators.models import (
    ALPHAS, FOLD_SEED, FOLDS, model_features, prediction_table, r2, rating_model, recommend,
)
from applens.operators.profiling import (
    corr_matrix, describe_exact, kde, numeric_columns, pair_grid, profile,
)
from applens.operators.quantiles import exact_quantiles
from applens.schemas import CLEAN, FEATURE_SLOTS
from applens.session import ensure_checkpoint_dir, kept_table, spread
from applens.sources.catalog import feature_columns, type_raw

DROPPED = ["Last Updated", "Current Ver", "Android Ver"]
MAX_RATING = 10.0
BAD_CATEGORY = "1.9"
UNRATED = "Unrated"


def fill_median(df: DataFrame, col: str) -> DataFrame:
    """Fill NULLs with the exact, interpolated median of the column.

    The median is computed once, when the plan is built (one number reaches
    the driver), and embedded as a literal, so every later pass over the
    cleaned table re-runs only row-level steps. No task ever holds all
    distinct values (see ``operators.quantiles``).
    """
    row = exact_quantiles(df, [col], [0.5]).first()
    if row is None:  # no values at all: nothing to fill with
        return df
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(float(row.value))))


def cast_clean(df: DataFrame) -> DataFrame:
    """Type every column to the cleaned schema; bad text becomes NULL."""
    return df.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in CLEAN.fields])


def clean_rows(raw: DataFrame, rating_fill: Column | None) -> DataFrame:
    """The row-level cleaning steps after the range filter, in order.

    Drop Category '1.9', fill missing ratings with ``rating_fill`` (None
    keeps them missing), keep letters/digits in App and drop empty names,
    replace other characters of Category with '0', keep letters/digits in
    Genres, parse Size/Installs/Price, drop 'Unrated', drop the three unused
    columns, type the columns, drop rows with any NULL. Every step is a
    stateless expression or predicate, so this also runs on streams.
    """
    df = drop_value(raw, "Category", BAD_CATEGORY)
    if rating_fill is not None:
        df = df.withColumn("Rating", F.coalesce(F.col("Rating"), rating_fill))
    return _clean_after_fill(df)


def _clean_after_fill(df: DataFrame) -> DataFrame:
    df = df.withColumn("App", alnum("App"))
    df = drop_blank(df, "App")
    df = df.withColumns({
        "Category": alnum("Category", "0"),
        "Genres": alnum("Genres"),
        "Size": parse_size_mb("Size"),
        "Installs": parse_count("Installs"),
        "Price": parse_price("Price"),
    })
    df = drop_value(df, "Content Rating", UNRATED)
    df = df.drop(*[c for c in DROPPED if c in df.columns])
    df = cast_clean(df)
    return complete_rows(df)


def ranged_catalog(raw: DataFrame) -> DataFrame:
    """The raw catalogue typed and range-filtered (ratings > 10 dropped,
    missing kept): the table the genre summaries read."""
    if dict(raw.dtypes).get("Rating") == "string":
        raw = type_raw(raw)
    return drop_outliers(raw, "Rating", MAX_RATING)


def clean_catalog(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean a raw catalogue. Returns ``(clean, ranged)``.

    ``ranged`` is the input after the rating range filter only (the table the
    genre summaries use). ``clean`` then follows the application's order of
    steps (see ``clean_rows``); the median used for missing ratings is taken
    after the range and category filters, before names are cleaned.
    """
    ranged = ranged_catalog(raw)
    return clean_ranged(ranged), ranged


def clean_ranged(ranged: DataFrame) -> DataFrame:
    """The cleaned table of a range-filtered catalogue."""
    return _clean_after_fill(fill_median(drop_value(ranged, "Category", BAD_CATEGORY), "Rating"))


# ------------------------------------------------------------------ P2

INDEXED = ["App", "Category", "Type", "Content Rating", "Genres"]


class FeatureModel:
    """The fitted features: an index of every categorical column (``column, value, index``)
    and the assembler of the slots. It transforms raw cleaned rows by itself, whatever
    the number of labels, and can be saved and loaded."""

    def __init__(self, index: DataFrame, slots: list[str] = FEATURE_SLOTS):
        self.index = index
        self.assembler = VectorAssembler(inputCols=slots, outputCol="features", handleInvalid="error")
        # Labels of every column: the index of values that it does not hold. One row a column.
        self.labels = {r.column: r["count"] for r in index.groupBy("column").count().collect()}

    @classmethod
    def fit(cls, train: DataFrame, cols: list[str] = INDEXED) -> FeatureModel:
        index = frequency_indexes(train, cols).select("column", "value", "index")
        return cls(kept_table(index, "feature-index", by="column"))

    def transform(self, clean: DataFrame) -> DataFrame:
        """Add ``<column>Index`` for every indexed column and the ``features`` vector.

        One sketch pass over the rows finds the hot values of all columns, then a join a column.
        """
        hot = hot_values(clean, INDEXED)
        for c in INDEXED:
            own = self.index.where(F.col("column") == c).select(F.col("value").alias(c), F.col("index").alias(c + "Index"))
            clean = apply_index(clean, own, c, c + "Index", F.lit(float(self.labels.get(c, 0))), hot[c])
        return self.assembler.transform(clean)

    def save(self, path: str) -> None:
        self.index.write.mode("overwrite").parquet(f"{path}/index")
        self.assembler.write().overwrite().save(f"{path}/assembler")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureModel:
        model = cls(spark.read.parquet(f"{path}/index"))
        model.assembler = VectorAssembler.load(f"{path}/assembler")
        return model


def build_features(clean: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, FeatureModel]:
    """Index and assemble the features of every cleaned row.

    The held-out part is chosen by a hash of App; indexes are learnt on the
    training part only and unseen labels get the extra index (as
    ``handleInvalid='keep'``). Returns ``(features13, model)``; ``features13``
    holds all rows (train and held-out) in the exported 13-column layout.
    """
    clean = kept_table(clean, "clean")  # cleaned once: counts, sketches and joins read it
    model = FeatureModel.fit(clean.where(~is_held_out(F.col("App"), test_fraction, seed)))
    return feature_columns(model.transform(clean)), model


# ------------------------------------------------------------------ P3 / P4

def genre_report(ranged: DataFrame, top: int = 20) -> dict[str, DataFrame]:
    """Genre summaries of the range-filtered catalogue.

    ``rollup`` (every genre), ``top`` (first ``top`` by count), and the
    describe, value counts and density of the per-genre mean ratings.
    """
    # One row per genre, read by five tables: computed once and written.
    ensure_checkpoint_dir(ranged.sparkSession)
    rollup = genre_rollup(ranged, top=None, ordered=False).checkpoint(eager=True)
    ordered = rollup.orderBy(F.desc("Count"), F.asc("Genres"))
    return {
        "rollup": ordered,
        "top": ordered.limit(top),
        "rating_describe": describe_exact(rollup, ["Rating"]),
        "rating_counts": value_counts(rollup, "Rating"),
        "rating_density": kde(rollup, "Rating"),
    }


def profile_report(df: DataFrame, corr_cols: list[str] | None = None, hue: str | None = None,
                   pair_cols: list[str] | None = None) -> dict[str, DataFrame]:
    """Describe, structure profile and correlation matrix of a table; with
    ``hue``, also the scatter-matrix data of ``pair_cols`` (pair grid plus
    per-hue densities of every column, the grid's diagonal)."""
    cols = corr_cols or numeric_columns(df)
    pairs = pair_cols or cols
    out = {"describe": describe_exact(df), "profile": profile(df),
           "corr": corr_matrix(df, cols)}
    if hue:
        out["pairs"] = pair_grid(df, pairs, hue)
        out["diagonal"] = reduce(lambda a, b: a.unionByName(b), [
            kde(df, c, by=hue).select(F.lit(c).alias("column"), "*") for c in pairs])
    return out


# ------------------------------------------------------------------ P5

# Columns the model never sees: names, labels and the dropped categoricals.
NOT_MODEL_INPUT = ("App", "Content Rating", "Category", "App_Label", "Category_Label",
                   "Genres_Label")


def _model_input(features13: DataFrame, test_fraction: float, seed: int):
    """Assembled, written model input and its label: every feature column except
    names and labels (Type, Genres, Reviews, Size, Installs, Price), plus a
    one-hot block of Category; held-out rows by the same hash of the app as
    ``build_features`` used, CV folds by another hash of it."""
    numeric, label = xy(features13, "Rating", drop=NOT_MODEL_INPUT)
    df = spread(kept_table(features13, "features")).withColumns({
        "_test": is_held_out(F.col("App_Label"), test_fraction, seed),
        "fold": fold_of(F.col("App_Label"), FOLDS, FOLD_SEED),
    })
    pipe = model_features(numeric, "Category")
    assembled = pipe.fit(df.where(~F.col("_test"))).transform(df)
    # Written once: every fit reads it, and nothing stays in memory afterwards.
    ensure_checkpoint_dir(features13.sparkSession)
    return assembled.checkpoint(eager=True), label


def tune_lasso(features13: DataFrame, test_fraction: float = 0.2, seed: int = 42,
               alphas: list[float] = ALPHAS) -> dict:
    """Cross-validated L1 penalty (10 hash folds, R^2), refit, held-out scores.

    Two passes over the training rows serve the whole grid (see ``operators.lasso``). Returns
    ``best_alpha``, ``grid`` (alpha, fold, r2), ``tuned_predictions`` and ``tuned_r2``.
    """
    features13 = kept_table(features13, "features")
    numeric, label = xy(features13, "Rating", drop=NOT_MODEL_INPUT)
    held = is_held_out(F.col("App_Label"), test_fraction, seed)
    train = features13.where(~held).withColumn("fold", fold_of(F.col("App_Label"), FOLDS, FOLD_SEED))
    grid = lasso.LassoGrid(train, numeric, "Category", label, "fold")
    scores = grid.scores(alphas)
    alpha = lasso.best(scores)
    tuned = grid.predict(features13.where(held), grid.fit(alpha))
    return {"best_alpha": alpha, "grid": features13.sparkSession.createDataFrame(scores, "alpha double, fold int, r2 double"),
            "tuned_predictions": prediction_table(tuned), "tuned_r2": r2(tuned, label, "prediction")}


def rate_and_recommend(features13: DataFrame, test_fraction: float = 0.2, seed: int = 42,
                       tune: bool = True, gbt_iter: int = 100, n: int = 5,
                       regularised: boosting.Settings | None = None) -> dict:
    """Train the rating models on the feature table and recommend per category.

    The boosted model (the one whose scores are shown and recommended) is
    trained on the same rows as the tuned lasso (``tune=True``,
    see ``tune_lasso``); the lasso's results are returned alongside, as in
    the application they never feed the recommendations. Returns
    predictions, recommendations and the held-out R^2 (plus the lasso's
    ``best_alpha``, ``grid``, ``tuned_predictions`` and ``tuned_r2``).

    With ``regularised`` settings the shown model is ``operators.boosting``: leaf penalties, base
    score, column sampling and sides for missing values as the application's library has them, at the
    cost of a Spark job for every level of a tree.
    """
    out: dict = {}
    if tune:
        out.update(tune_lasso(features13, test_fraction, seed))
    if regularised:
        features13 = kept_table(features13, "features")
        numeric, label = xy(features13, "Rating", drop=NOT_MODEL_INPUT)
        held = is_held_out(F.col("App_Label"), test_fraction, seed)
        model = boosting.fit(features13.where(~held), numeric, "Category", label, "App_Label", regularised)
        shown = model.predict(features13.where(held))
    else:
        assembled, label = _model_input(features13, test_fraction, seed)
        model = rating_model(label=label, max_iter=gbt_iter).fit(assembled.where(~F.col("_test")))
        shown = model.transform(assembled.where(F.col("_test")))
    out["r2"] = r2(shown, label, "prediction")
    out["predictions"] = prediction_table(shown)
    out["recommendations"] = recommend(out["predictions"], n)
    return out
