"""Operator 13: how often each document is taken, so that sources reach their target shares.

A document's size is its number of words. Sources, in code point order with NULL last, get the weights of
WEIGHTS in turn and share the total size by weight; a target stops at MOST times its source's
size, and what is above goes to the others by weight until none is above. Every document of a
source should then be taken target / source_size times: a whole number of copies and a
fraction, which pivotal rounding makes whole.

Two documents with open fractions meet; words are moved from one to the other, in a direction that a keyed hash
draws so that expected copies stay as they were, until one of them has 0 or 1 copies more. Words are
neither lost nor won. Documents are dealt by hash into blocks of about BLOCK, larger ones first
in each; a block's last open document meets those of other blocks, BLOCK at a time, up a tree
of as many levels as the largest source needs. Only the source's last one is drawn by itself: a
source's words miss its target by less than that document's size.

DataFrame functions alone. Documents are numbers here (id, size, source); no task holds more than a
block, no source is grouped as a whole. Rows that are alike (id, source and size) are one unit whose
copies are dealt evenly over them. NULL or empty text: size 0, nothing taken. NULL ids and sources are values like
others. An empty table gives no rows. Draws depend on ids, sizes and the seed, not on partitions or order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applens.llm.common import attached, write_shared
from applens.operators.windows import with_positions

WEIGHTS, MOST = (5, 2, 1), 3
BLOCK = 256
WORD = r"[^\x20\x09-\x0D]+"
ROWS_AT_ONCE = 10_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The columns of `sources` (key, source_size, ...; one row a source) and ``target``, written to the shared folder.

    Each turn is one aggregate over the sources; only the level (target a unit of weight) comes to the driver.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    placed = with_positions(sources, F.asc_nulls_last("key"), out="_place")
    placed = write_shared(placed.withColumn("_weight", weight).drop("_place"), "mix-sources")
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    level, most_of = 0.0, most * F.col("source_size")
    while total:
        above = most_of < level * F.col("_weight")
        row = placed.agg(F.sum(F.when(above, most_of)).alias("kept"), F.sum(F.when(~above, F.col("_weight"))).alias("weight")).first()
        new = (total - (row.kept or 0)) / row.weight if row.weight else level
        if new <= level:
            break
        level = new
    target = F.least(most_of.cast("double"), level * F.col("_weight"))
    return write_shared(placed.withColumn("target", target).drop("_weight"), "mix-targets")


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) drawn from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0 ** -53)


def _meet(y: Column, x: Column, key: Column) -> Column:
    """Two open documents: which one is finished, with how many copies more, and the other with its new mass.

    `mass` is the open words of a document: its fraction times its size.
    """
    x_room, y_room = x["size"] - x["mass"], y["size"] - y["mass"]
    rise, fall = F.least(x_room, y["mass"]), F.least(x["mass"], y_room)
    # x rises with probability fall / (rise + fall): expected copies stay.
    drawn = F.struct((_uniform(key, y["draw"], x["draw"]) * (rise + fall) < fall).alias("up"))

    def move(d):
        x_done = F.when(d["up"], x_room <= y["mass"]).otherwise(x["mass"] <= y_room)
        x_ends = F.struct(_finished(x, d["up"]).alias("done"), y.withField(
            "mass", F.when(d["up"], y["mass"] - x_room).otherwise(y["mass"] + x["mass"])).alias("held"))
        y_ends = F.struct(_finished(y, ~d["up"]).alias("done"), x.withField(
            "mass", F.when(d["up"], x["mass"] + y["mass"]).otherwise(x["mass"] - y_room)).alias("held"))
        return F.when(x_done, x_ends).otherwise(y_ends)

    return F.transform(F.array(drawn), move)[0]


UNIT = ("doc_id", "size", "rows", "copies")


def _finished(unit: Column, up: Column) -> Column:
    return F.struct(*[unit[c].alias(c) for c in UNIT[:3]], (unit["copies"] + up.cast("long")).alias("copies"))


def _round_block(units: Column, key: Column) -> Column:
    """A block's units, one after the other: the finished ones, and the last open one."""
    first = F.get(units, 0)
    nothing = F.array().cast("array<struct<doc_id:bigint,size:bigint,rows:bigint,copies:bigint>>")

    def step(state, x):
        met = F.transform(F.array(_meet(state["held"], x, key)), lambda m: F.struct(
            m["held"].alias("held"), F.array_append(state["done"], m["done"]).alias("done")))
        return met[0]

    return F.aggregate(F.slice(units, 2, F.size(units)), F.struct(first.alias("held"), nothing.alias("done")), step)


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 13) -> DataFrame:
    """doc_id, source, size, source_size, target (of its source) and copies, one row per document."""
    units = (docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"))
             .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")))
    units = write_shared(units, "mix-units")
    sources = units.groupBy(F.col("source").alias("key")).agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count(F.lit(1)).alias("n"))
    targets = source_targets(sources, weights, most)
    most_units = targets.agg(F.max("n")).first()[0] or 0
    blocks = F.ceil(F.col("units") / BLOCK)
    expected = F.col("rows") * F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    each = (attached(units, "source", targets.withColumn("units", F.col("n")))
            .withColumn("copies", F.floor(expected))
            .withColumn("mass", F.when(F.col("size") > 0, (expected - F.col("copies")) * F.col("size")).otherwise(0.0))
            .withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "size")))
    whole = each.filter("mass <= 0").select("source", "source_size", "target", *UNIT)
    # Larger ones first, so that a small one is left open.
    unit = F.struct((-F.col("size")).alias("order"), *[F.col(c) for c in ("draw", "doc_id", "size", "rows", "copies", "mass")])
    level, left = 0, -(-most_units // BLOCK)
    open_units = each.filter("mass > 0").select("source", "source_size", "target", F.pmod("draw", blocks).alias("block"), unit.alias("unit"))
    finished = [whole]
    while True:
        rounded = _round_block(F.sort_array(F.collect_list("unit")), F.lit(seed * 64 + level))
        table = write_shared(open_units.groupBy("source", "block").agg(
            F.any_value("source_size").alias("source_size"), F.any_value("target").alias("target"), rounded.alias("r")),
            f"mix-level-{level}")
        constant = ("source", "source_size", "target")
        finished.append(table.select(*constant, F.inline("r.done")))
        if left <= 1:
            break
        level, left = level + 1, -(-left // BLOCK)
        open_units = table.select(*constant, F.floor(F.col("block") / BLOCK).alias("block"), F.col("r.held").alias("unit"))
    held = F.col("r.held")
    last = _uniform(F.lit(seed * 64 + 63), held["draw"]) * held["size"] < held["mass"]
    finished.append(table.select(*constant, F.inline(F.array(_finished(held, last)))))
    out = finished[0]
    for part in finished[1:]:
        out = out.unionByName(part)
    return _each_row(out)


def _each_row(units: DataFrame) -> DataFrame:
    """A row for each of a unit's rows: its copies dealt evenly, the first rows one more."""
    def spread(df):
        row = F.explode(F.sequence(F.col("first"), F.least(F.col("rows"), F.col("first") + ROWS_AT_ONCE) - 1)).alias("row")
        df = df.select("*", row)
        n = F.floor(F.col("copies") / F.col("rows")) + (F.col("row") < F.col("copies") % F.col("rows")).cast("long")
        return df.select("doc_id", "source", "size", "source_size", "target", n.alias("copies"))

    few = units.filter(F.col("rows") <= ROWS_AT_ONCE).withColumn("first", F.lit(0).cast("long"))
    # A unit of very many rows is cut up and dealt out before it is spread.
    starts = F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(ROWS_AT_ONCE).cast("long"))
    many = units.filter(F.col("rows") > ROWS_AT_ONCE).withColumn("first", F.explode(starts))
    many = many.repartition("doc_id", "source", "size", "first")
    return spread(few).unionByName(spread(many))


def mix(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    return copies(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
