"""Lexicon sentiment scoring as a table job.

A review's polarity and subjectivity are the means over its tokens found in
the lexicon (each occurrence counts); a review without any hit scores 0.0 on
both. Tokens are the runs of ASCII letters of the lower-cased text.

There is one path for every lexicon: the distinct tokens of a row are joined
with the lexicon by hash (Spark broadcasts it if its bytes allow), so the cost
of a token does not depend on the number of words. Scores are taken as decimals of 10
places (more are rounded): sums are exact, whatever order they are taken in, and opposite scores cancel to zero.

A lexicon with a column ``modifier`` has words that score nothing themselves but change the next scored
word: negations (below 0, such as -0.5: flips and damps) and intensifiers (above 0, such as 1.3). A row's tokens
are then scanned in order, with the product of the modifiers since the last scored word as state. It holds over at most
REACH other words. A polarity is multiplied by it and kept within -1 and 1; a subjectivity by the
product of its size's intensifiers alone, and kept within 0 and 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applens.functions.names import quoted, unused
from applens.session import ensure_checkpoint_dir

TOKEN_SPLIT = "[^a-z]+"
EXACT = "decimal(20,10)"
REACH = 1


def _lexicon_unique(lexicon: DataFrame) -> DataFrame:
    return lexicon.groupBy("word").agg(F.avg("polarity").cast(EXACT).alias("polarity"),
                                       F.avg("subjectivity").cast(EXACT).alias("subjectivity"))


def _tokens(text: str):
    return F.split(F.lower(F.col(quoted(text))), TOKEN_SPLIT, -1)


def _number(value) -> Column:
    return F.lit(value).cast(EXACT)


def _scan(tokens: Column, found: Column, reach: int) -> Column:
    """Sums over a row's tokens in order: struct (p, s, n). `found` maps the row's words of the lexicon
    to their polarity, subjectivity and modifier."""
    one = _number("1")
    start = F.struct(_number("0").alias("p"), _number("0").alias("s"), F.lit(0).cast("long").alias("n"),
                     one.alias("turn"), one.alias("strength"), F.lit(0).alias("left"))

    def times(a: Column, b: Column) -> Column:
        return (a * b).cast(EXACT)

    def next_state(a: Column, w: Column) -> Column:
        keep = {c: a[c] for c in ("p", "s", "n", "turn", "strength", "left")}

        def state(**new):
            return F.struct(*[new.get(c, v).alias(c) for c, v in keep.items()])

        fresh = {"turn": one, "strength": one, "left": F.lit(0)}
        up = F.when(w["modifier"] > 0, times(a["strength"], w["modifier"])).otherwise(a["strength"])
        p = F.greatest(_number("-1"), F.least(one, times(w["polarity"], a["turn"])))
        s = F.greatest(_number("0"), F.least(one, times(w["subjectivity"], a["strength"])))
        return (F.when(w["modifier"].isNotNull(), state(turn=times(a["turn"], w["modifier"]), strength=up, left=F.lit(reach)))
                .when(w["polarity"].isNotNull() | w["subjectivity"].isNotNull(), state(
                    p=(a["p"] + F.coalesce(p, _number("0"))).cast(EXACT), s=(a["s"] + F.coalesce(s, _number("0"))).cast(EXACT),
                    n=a["n"] + 1, **fresh))
                .when(a["left"] > 0, state(left=a["left"] - 1)).otherwise(state(**fresh)))

    def step(a, token):
        return F.transform(F.array(F.try_element_at(found, token)), lambda w: next_state(a, w))[0]

    return F.aggregate(F.filter(tokens, lambda t: t != ""), start, step)


def _scored_in_order(df: DataFrame, text: str, lexicon: DataFrame, keys: list[str], reach: int) -> DataFrame:
    names = unused([f"k{i}" for i in range(len(keys))], df)
    found, sums = unused(["found", "sums"], df)
    words = df.select(*[F.col(quoted(k)).alias(n) for k, n in zip(keys, names)],
                      F.explode(F.array_distinct(_tokens(text))).alias("word")).where("word <> ''")
    entries = lexicon.groupBy("word").agg(*[F.avg(c).cast(EXACT).alias(c) for c in ("polarity", "subjectivity", "modifier")])
    # As many entries as a row has words of the lexicon.
    own = words.join(entries, "word").groupBy(*names).agg(F.map_from_entries(F.collect_list(
        F.struct("word", F.struct("polarity", "subjectivity", "modifier")))).alias(found))
    match = [F.col(quoted(k)).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    scored = df.join(own, match, "left").withColumn(sums, F.when(F.col(found).isNotNull(), _scan(_tokens(text), F.col(found), reach)))

    def mean(total: str):
        value = F.try_divide(F.col(sums)[total].cast("double"), F.col(sums)["n"].cast("double"))
        return F.coalesce(value, F.lit(0.0))

    return scored.withColumns({"Polarity": mean("p"), "Subjectivity": mean("s")}).drop(*names, found, sums)


def score_sentiment(df: DataFrame, text: str, lexicon: DataFrame,
                    keys: list[str] | None = None, reach: int = REACH) -> DataFrame:
    """Add ``Polarity`` and ``Subjectivity`` to every row of ``df``; with modifiers if the lexicon has that column.

    ``keys`` name a row (none may be NULL in two rows alike); without them
    the rows are checkpointed under an id, so that both uses see the same ids.
    """
    own_id = not keys
    if own_id:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.withColumn("_rowid", F.monotonically_increasing_id()).checkpoint(eager=True)
        keys = ["_rowid"]
    if "modifier" in lexicon.columns:
        out = _scored_in_order(df, text, lexicon, keys, reach)
        return out.drop("_rowid") if own_id else out
    names = [f"_k{i}" for i in range(len(keys))]
    words = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)],
                      F.explode(_tokens(text)).alias("word")).where(F.col("word") != "")
    # Reduced to one row per key and word before the join: a frequent word is
    # there once per review.
    uses = words.groupBy(*names, "word").agg(F.count(F.lit(1)).alias("_uses"))
    uses = uses.withColumn("_uses", F.col("_uses").cast("decimal(18,0)"))
    sums = (uses.join(_lexicon_unique(lexicon), "word").groupBy(*names)
            .agg(F.sum(F.col("polarity") * F.col("_uses")).alias("_p"),
                 F.sum(F.col("subjectivity") * F.col("_uses")).alias("_s"),
                 F.sum("_uses").alias("_n")))
    match = [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in zip(keys, names)]

    def mean(total: str):
        return F.coalesce(F.col(total).cast("double") / F.col("_n").cast("double"), F.lit(0.0))

    out = (df.join(sums, match, "left").withColumns({"Polarity": mean("_p"), "Subjectivity": mean("_s")})
           .drop(*names, "_p", "_s", "_n"))
    return out.drop("_rowid") if own_id else out
