"""Plan invariants of every registered query: JVM-only expressions, no
cartesian products, pruned scans, partial group limits."""

import importlib
import re

import pytest

from conftest import SF_SMALL

entry = importlib.import_module("__spark_entry__")
SKIP = {"recommendations", "lasso_cv", "clean_catalog_stream"}  # models / a run stream, not a plan


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Queries of the optional subpackage have plan tests of their own.
OWN = [n for n in entry.queries() if not re.fullmatch(r"op\d+_.*|pipeline", n)]


@pytest.mark.parametrize("name", [n for n in OWN if n not in SKIP])
def test_no_python_or_cartesian(spark, name):
    plan = physical(entry.queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct"):
        assert bad not in plan, (name, bad)


def test_top_n_limits_before_shuffle(spark):
    df = entry.queries()["top_rated_per_category"](spark, SF_SMALL)
    df.collect()
    plan = physical(df)
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) + final


def test_clean_scan_prunes_columns(spark):
    plan = physical(entry.queries()["clean_catalog"](spark, SF_SMALL))
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert schemas and all("p_retailprice" not in s for s in schemas)


def test_genre_rollup_single_aggregate(spark):
    # A rollup kept by an earlier test would be reused (already sorted);
    # start from the uncached plan.
    spark.catalog.clearCache()
    plan = physical(entry.queries()["genre_rollup"](spark, SF_SMALL))
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    assert "TakeOrderedAndProject" in plan


def test_quantiles_have_no_single_partition_funnel(spark):
    from applens.operators.quantiles import exact_quantiles

    plan = physical(exact_quantiles(spark.range(1000).selectExpr("cast(id % 37 as double) as a"), ["a"], [0.5]))
    assert "SinglePartition" not in plan and "percentile" not in plan


def test_sentiment_joins_and_never_collects(spark):
    plan = physical(entry.queries()["review_sentiment"](spark, SF_SMALL))
    assert "map_from_entries" not in plan and "Join" in plan
