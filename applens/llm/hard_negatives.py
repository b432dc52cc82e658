"""Operator 11: hard negatives of anchors, by Strassen products of exact integer tiles.

Components become floor(SCALE * x) and a score is the inner product of two vectors. Candidates are
dealt into shards of a bounded size, anchors into blocks of about BLOCK_ROWS; every block meets
every shard. A task multiplies a block with tiles of TILE_ROWS candidates by Strassen's
recursion on int64 matrices, with zero rows and columns where a side is odd; additions
of integers are exact. From each tile it takes a block's best entries and merges them with those
of the tiles before; what the shards found is merged by rank.

1. Positive heaps: an anchor's first `positives` other rows of its label, higher scores first,
   ties by the smaller id.
2. Window heaps: for each anchor and positive the first `negatives` rows of other labels whose score s
   satisfies low * p <= 100 * s <= high * p (p the positive's score). A positive below zero has none.

Components so large that a score might not fit int64 go through the same steps as Python integers; a score
beyond a long counts as the greatest one. Rows take no part if the id, the label or the vector is NULL, or if the vector
holds a NULL or non-finite component. Shorter vectors end in zeros. Rows that repeat an id are candidates of their own,
except for an anchor of that id; an anchor is asked once (the row with the least label, then vector). Without
anchors, or without rows of other labels, there are no rows. Other columns are left alone and not returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from applens.llm.common import quoted, write_shared
from applens.llm.exact import LARGEST, as_long, integers, is_finite, matrix, parted

SCALE = 256
SHARD_BYTES = 32 << 20
BLOCK_ROWS, TILE_ROWS, LEAF = 512, 2048, 32
NOTHING = -(LARGEST + 1)  # less than every score


def _even(x: np.ndarray) -> np.ndarray:
    """x with a zero row or column more where their number is odd."""
    m, n = x.shape
    if m % 2 == 0 and n % 2 == 0:
        return x
    out = np.zeros((m + m % 2, n + n % 2), x.dtype)
    out[:m, :n] = x
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b of integer matrices (int64 modulo 2^64, or Python integers) by seven products a step."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    a, b = _even(a), _even(b)
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * h), p1.dtype)
    out[:i, :h] = p1 + p4 - p5 + p7
    out[:i, h:] = p3 + p5
    out[i:, :h] = p2 + p4
    out[i:, h:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of every row of a with every row of b, as longs (saturating)."""
    # Products of integers up to this size add up to less than 2^62.
    bound = 2 ** ((61 - max(1, a.shape[1]).bit_length()) // 2)
    out = np.zeros((len(a), len(b)), np.int64)
    for rows, x in parted(a, bound):
        for at, y in parted(b, bound):
            if x.dtype != y.dtype:
                x, y = x.astype(object), y.astype(object)
            out[np.ix_(rows, at)] = as_long(strassen(x, np.ascontiguousarray(y.T)))
    return out


def _best(score: np.ndarray, which: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The first `most` along the last axis, higher scores first; equal ones stay in order."""
    order = np.argsort(-score, axis=-1, kind="stable")[..., :most]
    return np.take_along_axis(score, order, -1), np.take_along_axis(which, order, -1)


class Shard:
    """The candidates of one shard, in the order of their ids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]

    def tiles(self, block: Block):
        """Tile by tile: scores with the block's anchors, the ids, and which rows have the anchor's label.

        NOTHING stands for the anchor's own rows.
        """
        for at in range(0, len(self.ids), TILE_ROWS):
            ids = self.ids[at:at + TILE_ROWS]
            s = scores(block.x, self.x[at:at + TILE_ROWS])
            s[ids[None] == block.ids[:, None]] = NOTHING
            yield s, ids, self.labels[None, at:at + TILE_ROWS] == block.labels[:, None]

    def positives(self, block: Block, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of each anchor's first rows of its label (NOTHING where there is none)."""
        top = np.full((len(block.ids), most), NOTHING), np.zeros((len(block.ids), most), np.int64)
        for s, ids, same in self.tiles(block):
            s[~same] = NOTHING
            # Few reach the last of the best so far; ids ascend, so that ties keep the earlier.
            found = _best(s, np.broadcast_to(ids, s.shape), most)
            top = _best(np.concatenate([top[0], found[0]], 1), np.concatenate([top[1], found[1]], 1), most)
        return top

    def windows(self, block: Block, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the first rows of other labels in each anchor's windows (block.low, block.high)."""
        m, n = block.low.shape
        top = np.full((m, n, most), NOTHING), np.zeros((m, n, most), np.int64)
        for s, ids, same in self.tiles(block):
            s[same] = NOTHING
            s, which = _best(s, np.broadcast_to(ids, s.shape), s.shape[1])
            # Scores descend: a window is a run of them, from the first that is not above it.
            first = np.stack([(s > block.high[:, j:j + 1]).sum(1) for j in range(n)], axis=1)
            at = np.minimum(first[:, :, None] + np.arange(most), s.shape[1])
            s = np.concatenate([s, np.full((m, 1), NOTHING)], 1)
            which = np.concatenate([which, np.zeros((m, 1), np.int64)], 1)
            row = np.arange(m)[:, None, None]
            found = np.where(s[row, at] >= block.low[:, :, None], s[row, at], NOTHING), which[row, at]
            top = _best(np.concatenate([top[0], found[0]], 2), np.concatenate([top[1], found[1]], 2), most)
        return top


class Block:
    """Some anchors, and the windows of their positives."""

    def __init__(self, packed: pa.Array, width: int):
        rows = packed.flatten()
        self.ids = rows.field("id").to_numpy().astype(np.int64)
        self.labels = rows.field("label").to_numpy().astype(np.int64)
        self.x = integers(matrix(rows.field("v"), width), SCALE)
        heaps = [h or [] for h in rows.field("heap").to_pylist()]
        n = max((len(h) for h in heaps), default=0)
        self.positive = np.zeros((len(heaps), n), np.int64)
        self.score = np.zeros((len(heaps), n), np.int64)
        self.low, self.high = np.zeros((len(heaps), n), np.int64), np.full((len(heaps), n), NOTHING)
        for i, heap in enumerate(heaps):
            for j, p in enumerate(heap):
                self.positive[i, j], self.score[i, j] = p["id"], p["score"]
                self.low[i, j], self.high[i, j] = p["low"], p["high"]


def _met(candidates: DataFrame, anchors: DataFrame, shards: int, blocks: int, width: int, work, schema: str) -> DataFrame:
    """What `work(shard, block)` yields for every shard of candidates (id, label, v) and every block of anchors
    (those columns and heap). A task holds one shard and one block, which is sent as one row a shard."""
    packed = (anchors.groupBy(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
              .agg(F.collect_list(F.struct("id", "label", "v", "heap")).alias("packed")))
    none = F.lit(None)
    # By row, not by id: rows that repeat an id are dealt out as well.
    own = candidates.select(F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(shards)).alias("shard"), none.cast("bigint").alias("block"),
                            "id", "label", "v", none.cast(packed.schema["packed"].dataType).alias("packed"))
    asked = packed.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), "block",
                          none.cast("bigint").alias("id"), none.cast("bigint").alias("label"),
                          none.cast("array<double>").alias("v"), "packed")
    sent = own.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", F.asc_nulls_first("block"))

    def run(batches):
        number, parts, shard = None, [], None
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(numbers)) + 1, len(numbers)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if start == end:
                    continue
                if numbers[start] != number:
                    number, parts, shard = numbers[start], [], None
                rows = batch.slice(start, end - start)
                asking = np.flatnonzero(rows.column("block").is_valid().to_numpy(zero_copy_only=False))
                here = rows.slice(0, asking[0] if len(asking) else rows.num_rows)
                if here.num_rows:
                    parts.append((here.column("id").to_numpy(), here.column("label").to_numpy(),
                                  integers(matrix(here.column("v"), width), SCALE)))
                if len(asking) and parts and shard is None:
                    shard = Shard(*[np.concatenate([p[i] for p in parts]) for i in range(3)])
                    parts = parts[:1]
                for i in asking if shard is not None else ():
                    yield from work(shard, Block(rows.column("packed").slice(i, 1), width))

    return sent.mapInArrow(run, schema)


def _first(found: DataFrame, keys: list[str], score: str, tie: str, most: int) -> DataFrame:
    """The heaps of all shards merged: the first `most` of each key, with their rank from 1."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), tie))
    return found.withColumn("rank", rank).filter(F.col("rank") <= most)


def mine(table: DataFrame, is_anchor, id_column: str = "vec_id", vector: str = "embedding", label=None,
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score and positive_rank of the table's
    anchors (the rows for which the column `is_anchor` of `table` is true). `label` is a column expression."""
    label = F.col("label") if label is None else label
    v = F.col(quoted(vector))
    rows = table.filter(is_finite(v) & label.isNotNull() & F.col(quoted(id_column)).isNotNull()).select(
        F.col(quoted(id_column)).cast("long").alias("id"), label.cast("long").alias("label"),
        v.cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.sum(F.size("v").cast("long")).alias("all"),
                    F.count_if("asks").alias("asks")).first()
    width = size.width or 0
    # By size; a small table is still spread over the cores, a tile each at least.
    cores = table.sparkSession.sparkContext.defaultParallelism
    shards = max(1, -(-8 * (size["all"] or 0) // SHARD_BYTES), min(cores, size.n // TILE_ROWS))
    blocks = max(1, -(-size.asks // BLOCK_ROWS))
    candidates = rows.drop("asks")
    one = F.min(F.struct("label", "v")).alias("row")
    anchors = rows.filter("asks").groupBy("id").agg(one).select("id", "row.label", "row.v")

    def positive_heaps(shard, block):
        score, ids = shard.positives(block, positives)
        row, place = np.nonzero(score != NOTHING)
        yield pa.RecordBatch.from_pydict({"anchor_id": block.ids[row], "positive_id": ids[row, place], "score": score[row, place]})

    def window_heaps(shard, block):
        score, ids = shard.windows(block, negatives)
        row, j, place = np.nonzero(score != NOTHING)
        yield pa.RecordBatch.from_pydict({
            "anchor_id": block.ids[row], "positive_rank": (j + 1).astype(np.int32), "positive_id": block.positive[row, j],
            "negative_id": ids[row, j, place], "positive_score": block.score[row, j], "negative_score": score[row, j, place]})

    heap_of = "struct<rank:int,id:bigint,score:bigint,low:bigint,high:bigint>"
    no_heap = F.lit(None).cast(f"array<{heap_of}>").alias("heap")
    found = _met(candidates, anchors.withColumn("heap", no_heap), shards, blocks, width, positive_heaps,
                 "anchor_id bigint, positive_id bigint, score bigint")
    p = F.col("score").cast("decimal(38,0)")
    heap = F.struct("rank", F.col("positive_id").alias("id"), "score", F.ceil(p * low / 100).cast("long").alias("low"),
                    F.floor(p * high / 100).cast("long").alias("high"))
    heaps = (_first(found, ["anchor_id"], "score", "positive_id", positives).filter("score >= 0")
             .groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(heap)).alias("heap")))
    asking = write_shared(anchors.join(heaps, "id"), "positive-heaps")
    found = _met(candidates, asking, shards, blocks, width, window_heaps,
                 "anchor_id bigint, positive_rank int, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint")
    best = _first(found, ["anchor_id", "positive_rank"], "negative_score", "negative_id", negatives)
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank")


def negatives(table: DataFrame) -> DataFrame:
    """The query's columns: labels of ids divisible by 7 are shifted, ids divisible by 100 are anchors."""
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(table, F.col("vec_id") % 100 == 0, label=shifted).drop("positive_rank")


def oracle() -> str:
    """DuckDB SQL of the query's rows (distinct ids, vectors of one length, scores of ordinary size)."""
    return """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS place FROM s WHERE same),
n AS (SELECT p.anchor_id, p.other AS positive_id, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY s.score DESC, s.other) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
      WHERE p.place <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""
