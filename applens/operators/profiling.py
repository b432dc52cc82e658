"""Table profiles: describe, structure, correlation, histogram, density, 2-D bins.

Each profile is a fixed number of aggregate passes whose results have a size
set by the parameters (columns, bins, grid points), never by the row count.
Global statistics reach the row-level expressions as scalar subqueries, which
Spark evaluates once and ships with the tasks.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations
from operator import add

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applens.functions.names import quoted
from applens.functions.numeric import nan_to_null, safe_corr
from applens.operators.hot_keys import hot_values, salted_keys, salted_rows
from applens.operators.quantiles import exact_quantiles
from applens.session import kept_table

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)
QUARTILES = (0.25, 0.5, 0.75)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def _value(df: DataFrame, c: str) -> Column:
    """Column as double with NaN turned into NULL."""
    x = F.col(f"`{c}`").cast("double")
    return nan_to_null(x)


def describe_exact(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 %, max per numeric column.

    One aggregate pass gives the moments for all columns; the quartiles come
    from ``exact_quantiles`` (distributed, exact). One output row per column:
    ``column, count, mean, std, min, p25, p50, p75, max``.
    """
    cols = cols or numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = _value(df, c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                     F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                     F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
            for i, c in enumerate(cols)]
    moments = df.agg(*aggs).select(F.inline(F.array(*rows)))
    qs = (exact_quantiles(df, cols, list(QUARTILES)).groupBy("column")
          .agg(*[F.max(F.when(F.col("q") == i, F.col("value"))).alias(name)
                 for i, name in enumerate(["p25", "p50", "p75"])]))
    return moments.join(qs, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def profile(df: DataFrame) -> DataFrame:
    """Structure: per column its position, type, non-null and null counts.

    NaN counts as missing in floating columns. One aggregate pass.
    """
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = nan_to_null(c)
        aggs.append(F.count(c).alias(f"c{i}"))
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                     F.lit(f.dataType.simpleString()).alias("dtype"),
                     F.col(f"c{i}").alias("non_null"),
                     (F.col("_rows") - F.col(f"c{i}")).alias("nulls"))
            for i, f in enumerate(fields)]
    return wide.select(F.inline(F.array(*rows)))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every ordered column pair, long form ``(a, b, r)``.

    Pairwise-complete rows; NULL where a side is constant. The upper triangle
    is computed in one aggregate pass and mirrored.
    """
    vals = {c: _value(df, c) for c in cols}
    aggs, pairs = [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            aggs.append(safe_corr(vals[a], vals[b]).alias(f"r{i}_{j}"))
    wide = df.agg(*aggs)
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            src = f"r{min(i, j)}_{max(i, j)}"
            pairs.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(src).alias("r")))
    return wide.select(F.inline(F.array(*pairs)))


def corr_all(df: DataFrame, cols: list[str] | None = None,
             dummies: dict[str, list | None] | None = None) -> DataFrame:
    """Pearson correlation of all columns and dummies, long form ``(a, b, r)``, a row for every ordered pair.

    ``cols`` are numeric (by default all numeric columns). ``dummies`` maps a column of any type to
    its levels, or to None for all its values; each level is a 0/1 column ``<column>_<level>`` of
    the matrix, 0 for NULL. Rows with a missing number are left out; a constant column has NULL.

    No dummy column is ever made. A level's count and its sums of the (centred) numbers give its
    correlations with numbers; counts of levels, and of pairs of levels of different columns, those
    among dummies. Numbers among each other take one pass over vectors. Levels stay on Spark, whatever
    their number; only moments of ``cols`` reach the driver. The values used are written once.
    """
    cols = numeric_columns(df) if cols is None else cols
    dummies = dummies or {}
    xs, ds = [f"x{i}" for i in range(len(cols))], [f"d{i}" for i in range(len(dummies))]
    plain = df.select(*[_value(df, c).alias(x) for c, x in zip(cols, xs)],
                      *[F.col(quoted(c)).cast("string").alias(d) for c, d in zip(dummies, ds)]).dropna(subset=xs)
    plain = kept_table(plain, "corr-values")
    n, means, spreads, numbers = _number_matrix(plain, cols, xs)
    if not dummies:
        return numbers
    cells = F.array(*[F.struct(F.lit(i).alias("at"), F.col(d).alias("level")) for i, d in enumerate(ds)])
    centred = [F.sum(F.col(x) - F.lit(m)).alias(x) for x, m in zip(xs, means)]
    found = (plain.select(*xs, F.inline(cells)).where(F.col("level").isNotNull())
             .groupBy("at", "level").agg(F.count(F.lit(1)).alias("n"), *centred))
    asked = [F.struct(F.lit(i).alias("at"), F.lit(v).cast("string").alias("level"))
             for i, levels in enumerate(dummies.values()) if levels is not None for v in levels]
    if asked:
        given = df.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*asked)))
        free = [i for i, levels in enumerate(dummies.values()) if levels is None]
        found = given.join(found, ["at", "level"], "left").unionByName(found.where(F.col("at").isin(free)))
        found = found.na.fill(0)
    label = F.concat(F.element_at(F.array(*[F.lit(c) for c in dummies]), F.col("at") + 1), F.lit("_"), F.col("level"))
    levels = kept_table(found.withColumn("name", label), "corr-levels")
    # A dummy's variance is p (1 - p): nothing for a level that no row or every row has.
    var = F.col("n").cast("double") * (F.lit(float(n)) - F.col("n"))
    per_level = levels.select("name", F.inline(F.array(*[F.struct(
        F.lit(c).alias("number"), F.try_divide(F.col(x), F.lit(s) * F.sqrt(var)).alias("r"))
        for c, x, s in zip(cols, xs, spreads)]))) if cols else None
    rest = _dummy_pairs(plain, levels, ds, n)
    if per_level is not None:
        rest = (rest.unionByName(per_level.select(F.col("name").alias("a"), F.col("number").alias("b"), "r"))
                .unionByName(per_level.select(F.col("number").alias("a"), F.col("name").alias("b"), "r")))
    return numbers.unionByName(rest)


def _number_matrix(plain: DataFrame, cols: list[str], xs: list[str]) -> tuple[int, list[float], list[float | None], DataFrame]:
    """Rows, means, standard deviations (None where constant) and correlations of the number columns."""
    moments = plain.agg(F.count(F.lit(1)).alias("n"), *[F.avg(x).alias(f"m_{x}") for x in xs],
                        *[F.when(F.min(x) < F.max(x), F.stddev_pop(x)).alias(f"s_{x}") for x in xs]).first()
    spreads = [moments[f"s_{x}"] for x in xs]
    if moments.n and xs:
        vectors = VectorAssembler(inputCols=xs, outputCol="_v").transform(plain.select(*xs)).select("_v")
        matrix = Correlation.corr(vectors, "_v").first()[0].toArray()
    rows = [(a, b, float(matrix[i][j]) if spreads[i] is not None and spreads[j] is not None else None)
            for i, a in enumerate(cols) for j, b in enumerate(cols)]
    numbers = plain.sparkSession.createDataFrame(rows, "a string, b string, r double")
    return moments.n, [moments[f"m_{x}"] or 0.0 for x in xs], spreads, numbers


def _dummy_pairs(plain: DataFrame, levels: DataFrame, ds: list[str], n: int) -> DataFrame:
    """Correlations among dummies, from their counts: ``a, b, r`` for every ordered pair of levels."""
    pairs = [F.struct(F.lit(i).alias("at"), F.col(p).alias("level"), F.lit(j).alias("at2"), F.col(q).alias("level2"))
             for i, p in enumerate(ds) for j, q in enumerate(ds) if i != j]
    one, two = levels.select("at", "level", "name", "n"), levels.select(
        F.col("at").alias("at2"), F.col("level").alias("level2"), F.col("name").alias("name2"), F.col("n").alias("n2"))
    # The result itself has a row for every pair of levels.
    both = one.crossJoin(two)
    same = F.when((F.col("at") == F.col("at2")) & (F.col("level") == F.col("level2")), F.col("n")).otherwise(0)
    if pairs:
        joint = (plain.select(F.inline(F.array(*pairs))).where("level IS NOT NULL AND level2 IS NOT NULL")
                 .groupBy("at", "level", "at2", "level2").agg(F.count(F.lit(1)).alias("both")))
        both = both.join(joint, ["at", "level", "at2", "level2"], "left")
        same = F.when(F.col("at") == F.col("at2"), same).otherwise(F.coalesce("both", F.lit(0)))
    rows = F.lit(float(n))
    p, q = F.col("n").cast("double"), F.col("n2").cast("double")
    r = F.try_divide(same * rows - p * q, F.sqrt(p * (rows - p)) * F.sqrt(q * (rows - q)))
    return both.select(F.col("name").alias("a"), F.col("name2").alias("b"), r.alias("r"))


def _widen(lo: Column, hi: Column) -> tuple[Column, Column]:
    """Widen an empty range [v, v] to [v - 0.5, v + 0.5]."""
    same = lo == hi
    return (F.when(same, lo - 0.5).otherwise(lo).alias("lo"),
            F.when(same, hi + 0.5).otherwise(hi).alias("hi"))


def _range_stats(vals: DataFrame, *cols: str) -> Column:
    """One scalar subquery: a struct with the (widened) range of every column,
    fields ``<col>_lo`` / ``<col>_hi``. Bind it to a column once and read the
    fields from that column: every separate reference to a subquery is
    planned (and run) as a separate subquery."""
    st = vals.agg(*[e for c in cols for e in (F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi"))])
    fields = []
    for c in cols:
        lo, hi = _widen(F.col(f"{c}_lo"), F.col(f"{c}_hi"))
        fields += [lo.alias(f"{c}_lo"), hi.alias(f"{c}_hi")]
    return st.select(F.struct(*fields)).scalar()


def _range_of(bound: str, c: str) -> tuple[Column, Column]:
    r = F.col(bound)
    return r.getField(f"{c}_lo"), r.getField(f"{c}_hi")


def _bucket(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """1..bins equal-width bucket; the top edge belongs to the last bucket.

    NULL stays NULL (``least`` alone would skip it and answer ``bins``).
    """
    return F.when(x.isNotNull(), F.least(F.width_bucket(x, lo, hi, F.lit(bins)), F.lit(bins)))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram over [min, max]: ``bin, lo, hi, count``.

    Every bin is returned, empty ones with count 0. When all values are equal
    the range is widened by 0.5 each way, as the usual plotting default does.
    Two passes over the data: the range (a scalar subquery), then the counts.
    """
    vals = df.select(_value(df, col).alias("x")).where(F.col("x").isNotNull())
    rng = _range_stats(vals, "x")
    lo, hi = _range_of("_r", "x")
    counts = (vals.withColumn("_r", rng)
              .groupBy(_bucket(F.col("x"), lo, hi, bins).cast("int").alias("bin"))
              .agg(F.count(F.lit(1)).alias("count")))
    width = (hi - lo) / bins
    numbers = (df.sparkSession.range(1, bins + 1, numPartitions=1)
               .select(F.col("id").cast("int").alias("bin")).withColumn("_r", rng))
    edges = numbers.select("bin", (lo + (F.col("bin") - 1) * width).alias("lo"),
                           (lo + F.col("bin") * width).alias("hi"))
    return (edges.join(counts, "bin", "left")
            .select("bin", "lo", "hi", F.coalesce("count", F.lit(0).cast("bigint")).alias("count")))


# Fixed values of the density: terms of the kernel's series, bins a bandwidth, and its reach in bandwidths.
KDE_TERMS, KDE_BINS, KDE_REACH = 10, 4, 12.0


def _hermite(u: Column, order: int) -> Column:
    """The probabilists' Hermite polynomial of that order at u, by Horner's rule from its coefficients."""
    below, own = [1], [0, 1]
    for k in range(1, order):
        below, own = own, [a - k * b for a, b in zip([0, *own], [*below, 0, 0])]
    own = own if order else [1]
    out = F.lit(float(own[-1]))
    for c in reversed(own[:-1]):
        out = out * u + F.lit(float(c))
    return out


def kde(df: DataFrame, col: str, grid: int = 200, cut: float = 3.0,
        bw: float | None = None, by: str | None = None) -> DataFrame:
    """Gaussian kernel density on ``grid`` points: ``[by,] point, x, density``.

    Bandwidth by Scott's rule (sample sd * n^(-1/5)) unless given; the grid
    spans [min - cut*bw, max + cut*bw], per group when ``by`` is given (NULL
    groups skipped). A group with zero variance has no bandwidth: its
    densities are NULL (plotting libraries skip such a curve).

    Values are never spread over the grid. One pass adds each to the moments of its bin (KDE_BINS a
    bandwidth wide, first KDE_TERMS powers of the distance t from the bin's middle, in bandwidths), which are
    combined before the shuffle; a bin then gives its kernel sum at the grid points within
    KDE_REACH bandwidths by the series exp(-(u - t)^2 / 2) = sum of t^k / k! He_k(u) exp(-u^2 / 2).
    The number of bins is at most KDE_BINS * range / bandwidth and never above that of distinct values. With
    |t| <= 1/8 and ten terms a value's kernel is off by less than 1.1 * (1/8)^10 / sqrt(10!) < 1e-12 of its peak,
    and by less than exp(-72) where it is left out, so a density is within 1e-12 / bandwidth.

    Hot groups are salted by their count (``hot_keys``) where rows meet their group's range.
    """
    keys = [by] if by else []
    vals = df.select(*[F.col(quoted(k)).alias(k) for k in keys], _value(df, col).alias("x"))
    vals = vals.where(F.col("x").isNotNull() & (F.col(quoted(by)).isNotNull() if by else F.lit(True)))
    st = vals.groupBy(*[quoted(k) for k in keys]).agg(F.count("x").alias("n"), F.stddev_samp("x").alias("sd"),
                                                      F.min("x").alias("mn"), F.max("x").alias("mx"))
    bw_col = F.lit(float(bw)) if bw is not None else F.col("sd") * F.pow(F.col("n"), -0.2)
    st = st.select(*[F.col(quoted(k)).alias(f"_{i}") for i, k in enumerate(keys)], "n", bw_col.alias("_h"), "mn", "mx")
    st = st.withColumns({"_lo": F.col("mn") - cut * F.col("_h"),
                         "_step": ((F.col("mx") + cut * F.col("_h")) - (F.col("mn") - cut * F.col("_h"))) / (grid - 1)})
    stats = ("n", "_h", "_lo", "_step", "mn")
    if by:
        # One row per group, met by the rows of the group.
        hot = hot_values(vals, [by])[by]
        rows = salted_rows(vals.withColumnRenamed(by, "_by"), "_by", hot, "_salt")
        groups = salted_keys(st, "_0", hot, "_salt2")
        met = rows.join(groups, (F.col("_by") == F.col("_0")) & (F.col("_salt") == F.col("_salt2")))
        own = [F.col("_by")]
    else:
        # One row of statistics, sent to every task.
        met = vals.crossJoin(F.broadcast(st))
        own = []
    width = F.col("_h") / KDE_BINS
    binned = met.withColumn("_bin", F.floor(F.try_divide(F.col("x") - F.col("mn"), width)))
    t = F.try_divide(F.col("x") - (F.col("mn") + (F.col("_bin") + 0.5) * width), F.col("_h"))
    moments = binned.where("_bin IS NOT NULL").withColumn("_t", t).groupBy(*own, *stats, "_bin").agg(
        *[F.sum(F.pow("_t", F.lit(float(k)))).alias(f"_m{k}") for k in range(KDE_TERMS)])
    # Grid points in reach of the bin, if there are any.
    middle = F.col("mn") + (F.col("_bin") + 0.5) * width
    reach = F.lit(KDE_REACH) * F.col("_h")
    first = F.greatest(F.lit(0), F.ceil((middle - reach - F.col("_lo")) / F.col("_step")).cast("int"))
    last = F.least(F.lit(grid - 1), F.floor((middle + reach - F.col("_lo")) / F.col("_step")).cast("int"))
    some = F.when(first <= last, F.sequence(first, last))
    spread = moments.withColumn("_middle", middle).withColumn("point", F.explode(some))
    spread = spread.withColumn("_u", F.try_divide(F.col("_lo") + F.col("point") * F.col("_step") - F.col("_middle"), F.col("_h")))
    series = [F.col(f"_m{k}") / math.factorial(k) * _hermite(F.col("_u"), k) for k in range(KDE_TERMS)]
    kernel = reduce(add, series) * F.exp(-0.5 * F.col("_u") * F.col("_u"))
    sums = spread.groupBy(*own, "point", *stats).agg(F.sum(kernel).alias("k"))
    # Every point of every group: 0 where no bin reaches.
    points = st.select(*[F.col("_0").alias("_by") for _ in keys], *stats, F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"))
    same = ["_by", "point"] if by else ["point"]
    full = points.join(sums.select(*same, "k"), same, "left")
    norm = F.col("n") * F.col("_h") * math.sqrt(2 * math.pi)
    density = F.when(F.col("_h") > 0, F.try_divide(F.greatest(F.coalesce("k", F.lit(0.0)), F.lit(0.0)), norm))
    return full.select(*[c.alias(by) for c in own], "point",
                       (F.col("_lo") + F.col("point") * F.col("_step")).alias("x"), density.alias("density"))


def pair_bins(df: DataFrame, x: str, y: str, hue: str | None = None,
              bins: int = 20) -> DataFrame:
    """Scatter data as 2-D binned counts: ``[hue,] bx, by, count``.

    Bins are equal-width over each column's range (1..bins); rows with a
    missing coordinate are skipped. Output size is at most hue x bins^2.
    """
    keep = [F.col(f"`{hue}`").alias(hue)] if hue else []
    vals = df.select(*keep, _value(df, x).alias("x"), _value(df, y).alias("y")).where(
        F.col("x").isNotNull() & F.col("y").isNotNull())
    bound = vals.withColumn("_r", _range_stats(vals, "x", "y"))
    bx = _bucket(F.col("x"), *_range_of("_r", "x"), bins).alias("bx")
    by = _bucket(F.col("y"), *_range_of("_r", "y"), bins).alias("by")
    keys = ([hue] if hue else []) + [bx, by]
    return bound.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def scatter_sample(df: DataFrame, x: str, y: str, key: str, hue: str | None = None,
                   bins: int = 20, k: int = 5, seed: int = 0) -> DataFrame:
    """Real points beside the bin counts of ``pair_bins``: at most ``k`` rows of every cell.

    ``[hue,] bx, by, key, x, y`` of the rows whose key has the smallest md5 (with the seed) in their cell; equal
    hashes by x, then y. Such a sample is the same for any partitioning and merges by keeping the smallest:
    every task sends at most ``k`` rows a cell, however many rows the cell has.
    """
    keep = [F.col(quoted(hue)).alias(hue)] if hue else []
    vals = df.select(*keep, F.col(quoted(key)).alias(key), _value(df, x).alias("x"), _value(df, y).alias("y")).where(
        F.col("x").isNotNull() & F.col("y").isNotNull())
    bound = vals.withColumn("_r", _range_stats(vals, "x", "y"))
    cells = bound.select(*([hue] if hue else []), _bucket(F.col("x"), *_range_of("_r", "x"), bins).alias("bx"),
                         _bucket(F.col("y"), *_range_of("_r", "y"), bins).alias("by"), key, "x", "y")
    digest = F.md5(F.concat(F.coalesce(F.col(quoted(key)).cast("string"), F.lit("")), F.lit(f":{seed}")))
    place = F.row_number().over(Window.partitionBy(*([quoted(hue)] if hue else []), "bx", "by").orderBy(digest, "x", "y"))
    return cells.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def pair_grid(df: DataFrame, cols: list[str], hue: str | None = None, bins: int = 20) -> DataFrame:
    """2-D binned counts of every column pair: ``[hue,] x_col, y_col, bx, by, count``.

    Scatter-matrix data in two passes whatever the number of pairs: one for
    all column ranges, one that emits each row's bucket for every pair and
    counts them (partial counts are combined before the shuffle). Each axis
    uses its column's own range; rows missing either coordinate are skipped
    for that pair only.
    """
    keep = [F.col(f"`{hue}`").alias(hue)] if hue else []
    vals = df.select(*keep, *[_value(df, c).alias(c) for c in cols])
    bound = vals.withColumn("_r", _range_stats(vals, *cols))
    # Bucket every column once, then pair the buckets.
    bucketed = bound.select(*([hue] if hue else []),
                            *[_bucket(F.col(c), *_range_of("_r", c), bins).alias(f"_b{i}")
                              for i, c in enumerate(cols)])
    idx = {c: i for i, c in enumerate(cols)}
    pairs = [F.struct(F.lit(x).alias("x_col"), F.lit(y).alias("y_col"),
                      F.col(f"_b{idx[x]}").alias("bx"), F.col(f"_b{idx[y]}").alias("by"))
             for x, y in combinations(cols, 2)]
    cells = bucketed.select(*([hue] if hue else []), F.inline(F.array(*pairs)))
    cells = cells.where(F.col("bx").isNotNull() & F.col("by").isNotNull())
    return cells.groupBy(*([hue] if hue else []), "x_col", "y_col", "bx", "by").agg(
        F.count(F.lit(1)).alias("count"))
