"""Catalogue cleaning: filters, the median fill and the whole job."""

import math

from pyspark.sql import functions as F

from applens.operators import filters as flt
from applens.plans import catalog_jobs as cj
from applens.schemas import CLEAN, RAW_COLUMNS
from applens.sources import proxies

from conftest import SF_CHECK


def raw_rows(spark, rows):
    return spark.createDataFrame(rows, [c for c in RAW_COLUMNS])


def row(app="A b", cat="ART_AND_DESIGN", rating="4.1", reviews="10", size="19M",
        installs="10,000+", typ="Free", price="0", cr="Everyone", genres="Art & Design"):
    return (app, cat, rating, reviews, size, installs, typ, price, cr, genres, "x", "y", "z")


def test_filters_keep_nulls(spark):
    df = spark.createDataFrame([(1, 11.0), (2, None), (3, 10.0), (4, 5.0)], "k int, r double")
    assert sorted(r.k for r in flt.drop_outliers(df, "r", 10.0).collect()) == [2, 3, 4]
    s = spark.createDataFrame([(1, "1.9"), (2, None), (3, "x")], "k int, c string")
    assert sorted(r.k for r in flt.drop_value(s, "c", "1.9").collect()) == [2, 3]
    b = spark.createDataFrame([(1, ""), (2, None), (3, "x")], "k int, c string")
    assert sorted(r.k for r in flt.drop_blank(b, "c").collect()) == [2, 3]


def test_complete_rows_drops_nan(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "k int, v double")
    assert [r.k for r in flt.complete_rows(df).collect()] == [3]


def test_clean_catalog_small(spark):
    raw = raw_rows(spark, [
        row(app="Good App!", rating="4.5"),
        row(app="No rating", rating=None),           # filled with the median, 4.1
        row(app="Outlier", rating="19"),            # dropped (> 10)
        row(app="Bad cat", cat="1.9", rating="1.0"),  # dropped; not in the median
        row(app="!!!", rating="3.5"),               # blank name, dropped after the median
        row(app="Unrated", cr="Unrated"),           # dropped
        row(app="Paid", price="$4.99 ", size="256k", installs="500+"),
        row(app="NoType", typ=None),                # dropped by complete_rows
        row(app="Varies", size="Varies with device"),  # Size NULL -> dropped
    ])
    clean, ranged = cj.clean_catalog(raw)
    got = {r.App: r for r in clean.collect()}
    assert set(got) == {"GoodApp", "Norating", "Paid"}
    assert got["Norating"].Rating == 4.1  # median of 4.5, 3.5 and five 4.1
    assert got["Paid"].Price == 4.99 and got["Paid"].Size == 0.2 and got["Paid"].Installs == 500
    assert got["GoodApp"].Category == "ART0AND0DESIGN" and got["GoodApp"].Genres == "ArtDesign"
    # Names and types are the cleaned schema's; nullability is what Spark can
    # prove (Rating is never NULL after the fill).
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in CLEAN]
    assert ranged.count() == 8


def test_clean_catalog_proxy_counts(spark):
    clean, ranged = cj.clean_catalog(proxies.apps_raw(spark, SF_CHECK))
    assert clean.count() == 1504
    assert ranged.where(F.col("Rating") > 10).count() == 0
