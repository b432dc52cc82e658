"""Feature assembly, model fitting, scoring and evaluation on pyspark.ml.

Substitutions, by design: the application's boosted trees come from another library. The default
counterpart here is ``GBTRegressor`` (no leaf penalty, base score or side for missing values); ``operators.boosting``
has those. Its L1-penalty grid search becomes a lasso tuned by k-fold cross-validation on R^2
(``operators.lasso``); ``grid_search`` tunes any estimator of pyspark.ml that way.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.functions.numeric import ceil1
from applens.functions.text import category_label
from applens.operators.windows import sort_desc, top_n_per_group

# The L1 penalties searched (10^-5 .. 10^4) and the folds.
ALPHAS = [10.0 ** i for i in range(-5, 5)]
FOLDS = 10
FOLD_SEED = 155


def model_features(numeric: list[str], onehot: str | None, out: str = "features") -> Pipeline:
    """Unfitted pipeline: numeric columns plus a one-hot block (all levels
    kept) of an already indexed column, assembled into ``out``."""
    stages, cols = [], list(numeric)
    if onehot:
        stages.append(OneHotEncoder(inputCols=[onehot], outputCols=[onehot + "_vec"],
                                    dropLast=False, handleInvalid="keep"))
        cols.append(onehot + "_vec")
    stages.append(VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error"))
    return Pipeline(stages=stages)


def lasso(reg: float = 0.0, label: str = "Rating", features: str = "features") -> LinearRegression:
    return LinearRegression(featuresCol=features, labelCol=label, regParam=reg,
                            elasticNetParam=1.0, maxIter=100, standardization=True)


def grid_search(df: DataFrame, estimator, grid: list, param, fold_col: str,
                folds: int = 10, label: str = "Rating", parallelism: int = 4):
    """k-fold cross-validated grid search scored by R^2 (higher is better).

    The folds come from a column (a hash of a key), so they are the same
    whatever the partitioning. Returns the fitted ``CrossValidatorModel``.
    """
    params = ParamGridBuilder().addGrid(param, grid).build()
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=params,
                        evaluator=RegressionEvaluator(labelCol=label, metricName="r2"),
                        foldCol=fold_col, numFolds=folds, parallelism=parallelism, seed=0)
    return cv.fit(df)


def fit_l1(df: DataFrame, reg: float, label: str = "Rating", features: str = "features"):
    """Refit the lasso with the chosen penalty."""
    return lasso(reg, label, features).fit(df)


def rating_model(label: str = "Rating", features: str = "features", max_iter: int = 100,
                 max_depth: int = 3, step: float = 0.1, seed: int = 0,
                 rows: float = 1.0, columns: float = 1.0) -> GBTRegressor:
    """Boosted regression trees: 100 trees, depth 3, rate 0.1, squared loss.

    ``rows`` and ``columns`` are the shares that each tree sees (the tuned
    variant of the application: 1,000 trees of depth 1, 0.8 and 0.7).
    """
    return GBTRegressor(featuresCol=features, labelCol=label, maxIter=max_iter,
                        maxDepth=max_depth, stepSize=step, subsamplingRate=rows,
                        featureSubsetStrategy="all" if columns >= 1 else str(columns),
                        lossType="squared", cacheNodeIds=True, checkpointInterval=10, seed=seed)


def prediction_table(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Shown columns + ``Y-pred`` (rounded up to 1 decimal), in no order.

    Category is shown in its display form (each '0' as '-').
    """
    return scored.select(
        "App_Label", category_label("Category_Label").alias("Category_Label"), "Genres_Label",
        "Type", "Reviews", "Size", "Installs", "Price", ceil1(prediction).alias("Y-pred"))


def shown_predictions(predictions: DataFrame) -> DataFrame:
    """The prediction table as it is shown: best first."""
    return sort_desc(predictions, "Y-pred", "App_Label")


def recommend(predictions: DataFrame, n: int = 5, group: str = "Category_Label",
              by: str = "Y-pred", tie: str = "App_Label") -> DataFrame:
    """The ``n`` best-predicted apps of every category."""
    return top_n_per_group(predictions, group, by, n, tie)


def r2(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Coefficient of determination 1 - SSE/SST in one pass, one row ``r2``.

    SST is ``n * var_pop(y)``; Spark merges variance partials with a stable
    update, so no second pass over the data is needed for the mean.
    """
    both = F.col(y).isNotNull() & F.col(yhat).isNotNull()
    yy = F.when(both, F.col(y))
    sse = F.sum(F.when(both, F.pow(F.col(y) - F.col(yhat), 2)))
    sst = F.count(yy) * F.var_pop(yy)
    return df.agg((1 - F.try_divide(sse, sst)).alias("r2"))
