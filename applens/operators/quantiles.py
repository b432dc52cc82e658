"""Exact quantiles by brackets: sketch, count, narrow; no sort of a column.

Spark's exact ``percentile`` merges a value -> count map of every distinct
value in one final task, which does not scale to wide continuous columns.
Here a mergeable quantile sketch brackets each wanted rank; one pass over the data then counts the
values below the bracket, so that the rank inside it is known exactly, and sketches only what
lies inside. Each round leaves about one value in a hundred; when few distinct values
are left in a bracket, they are counted one by one and the wanted ones picked by
running counts. A bracket that turns out to miss its rank is dropped for the one before with twice the margin,
so sketches decide the work, never the result. Values are interpolated linearly, as
``percentile`` and the usual dataframe libraries do.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from applens.functions.names import quoted
from applens.functions.numeric import nan_to_null

SKETCH = 4_096      # size parameter of a sketch
MARGIN = 0.005      # ranks kept on either side, about four times the sketch's error
FEW = 100_000       # distinct values of a bracket that are counted one by one


@dataclass(frozen=True)
class Bracket:
    """The values from lo to hi (None: no bound) of a column."""

    column: str
    lo: float | None = None
    hi: float | None = None

    def holds(self, x: Column) -> Column:
        out = x.isNotNull()
        if self.lo is not None:
            out = out & (x >= F.lit(self.lo)) & (x <= F.lit(self.hi))
        return out


@dataclass
class _Wanted:
    """A quantile on its way: its ranks (from 0), the bracket they lie in, and the values below that."""

    column: str
    q: int
    p: float
    rows: int
    bracket: Bracket
    before: Bracket | None = None
    below: int = 0
    margin: float = MARGIN

    def ranks(self) -> tuple[int, int, float]:
        place = self.p * (self.rows - 1)
        return math.floor(place), math.ceil(place), place


def _value(c: str) -> Column:
    return nan_to_null(F.col(quoted(c)).cast("double"))


def _look(df: DataFrame, asked: dict[Bracket, list[tuple[int, float]]]) -> dict[Bracket, tuple]:
    """One aggregate: for every bracket the values below and inside, about how many are distinct, and the
    sketch's values at the asked ranks (of the whole column), moved by a margin. A sketch is of fixed size."""
    aggs = []
    for i, b in enumerate(asked):
        x = F.when(b.holds(_value(b.column)), _value(b.column))
        below = F.count_if(_value(b.column) < F.lit(b.lo)) if b.lo is not None else F.count_if(F.lit(False))
        aggs += [below.alias(f"b{i}"), F.count(x).alias(f"n{i}"), F.approx_count_distinct(x, 0.02).alias(f"d{i}"),
                 F.call_function("kll_sketch_agg_double", x, F.lit(SKETCH)).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    values = []
    for i, ranks in enumerate(asked.values()):
        if row[f"n{i}"]:
            shares = [min(1.0, max(0.0, (rank - row[f"b{i}"]) / max(1, row[f"n{i}"] - 1) + move)) for rank, move in ranks]
            values.append(F.call_function("kll_sketch_get_quantile_double", F.lit(row[f"s{i}"]), F.array(*map(F.lit, shares))).alias(f"v{i}"))
    at = df.sparkSession.range(0, 1, 1, 1).select(*values).first().asDict() if values else {}
    return {b: (row[f"b{i}"], row[f"n{i}"], row[f"d{i}"], at.get(f"v{i}")) for i, b in enumerate(asked)}


def _narrow(df: DataFrame, wanted: list[_Wanted]) -> None:
    """Narrow the brackets, a pass a round, until few distinct values are left in each."""
    open_ = [w for w in wanted if w.rows > FEW]
    while open_:
        asked: dict[Bracket, list[tuple[int, float]]] = {}
        spots = []
        for w in open_:
            low, high, _ = w.ranks()
            spots.append(len(asked.setdefault(w.bracket, [])))
            asked[w.bracket] += [(low, -w.margin), (high, w.margin)]
        seen = _look(df, asked)
        still = []
        for w, spot in zip(open_, spots):
            below, inside, distinct, values = seen[w.bracket]
            low, high, _ = w.ranks()
            if not below <= low <= high < below + inside:  # missed: back, with twice the margin
                w.bracket, w.margin = w.before, 2 * w.margin
                still.append(w)
                continue
            w.below = below
            new = Bracket(w.column, values[spot], values[spot + 1])
            if inside > FEW and distinct > FEW and new != w.bracket:
                w.before, w.bracket = w.bracket, new
                still.append(w)
        open_ = still


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Exact quantiles of several columns: rows ``column, q, p, value``.

    ``q`` is the position of ``p`` in ``probs``; a column without values
    gives no rows. Runs a pass for the counts and, for columns of more than FEW values, one or two a round of
    narrowing; the result itself is one aggregate over what is left in the brackets.
    """
    cols = list(dict.fromkeys(cols))
    sizes = df.agg(*[F.count(_value(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    wanted = [_Wanted(c, q, float(p), sizes[f"n{i}"], Bracket(c)) for i, c in enumerate(cols)
              for q, p in enumerate(probs) if sizes[f"n{i}"]]
    _narrow(df, wanted)
    schema = "column string, q int, p double, value double"
    if not wanted:
        return df.sparkSession.createDataFrame([], schema)
    brackets = list(dict.fromkeys(w.bracket for w in wanted))
    cells = F.array(*[F.when(b.holds(_value(b.column)), F.struct(F.lit(i).alias("b"), _value(b.column).alias("x")))
                      for i, b in enumerate(brackets)])
    counts = (df.select(F.inline(F.filter(cells, lambda c: c.isNotNull()))).groupBy("b", "x").agg(F.count(F.lit(1)).alias("c")))
    upto = F.sum("c").over(Window.partitionBy("b").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counts.withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("c"))
    asks = []
    for w in wanted:
        low, high, place = w.ranks()
        b = brackets.index(w.bracket)
        asks.append(F.struct(F.lit(b).alias("b2"), F.lit(w.column).alias("column"), F.lit(w.q).alias("q"), F.lit(w.p).alias("p"),
                             F.lit(low - w.below).alias("low"), F.lit(high - w.below).alias("high"),
                             F.lit(place - low).alias("part")))
    # As many rows as quantiles are asked for.
    probes = df.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*asks)))
    at = lambda rank: (F.col("from") <= F.col(rank)) & (F.col(rank) < F.col("upto"))
    hits = placed.join(F.broadcast(probes), (F.col("b") == F.col("b2")) & (at("low") | at("high")))
    found = hits.groupBy("column", "q", "p", "part").agg(
        F.max(F.when(at("low"), F.col("x"))).alias("x_lo"), F.max(F.when(at("high"), F.col("x"))).alias("x_hi"))
    value = F.when((F.col("part") == 0) | (F.col("x_lo") == F.col("x_hi")), F.col("x_lo")).otherwise(
        (1 - F.col("part")) * F.col("x_lo") + F.col("part") * F.col("x_hi"))
    return found.select("column", "q", "p", value.alias("value"))
