"""Operator 5: exact top-k search with a three-phase uniform threshold.

Vectors are dealt into shards of a bounded size; a shard's scores with a query are
a local list. Every query meets every shard, block by block.

1. Each shard sends the LIST greatest lower bounds of its scores (few, as there are many
   shards). A query's cutoff is the k-th greatest of all that are gathered: k vectors score at
   least that much, so nothing below it can be among the first k.
2. The cutoffs go to all shards, the same for each; a shard collects every vector whose
   upper bound reaches its query's cutoff.
3. The scores of those are resolved exactly, in integers, and a shard sends its first k
   (a shard's own k-th is enough, however many are tied).

Bounds come from a double-precision product and its rounding error, exact scores from 64-bit
integers, or Python integers where a score might not fit. Components are floor(256 * x), of any
size; a score beyond a long counts as the greatest one. Shorter vectors end in zeros. A vector
that is NULL, holds a NULL or non-finite component, or has no id, takes no part. Rows that repeat an id are
candidates of their own; a query is asked once (the row whose vector has the least bytes).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from applens.llm.exact import as_long, integers, rows_above

SHARD_ROWS = 8192
QUERY_ROWS = 512
SCALE = 256

ROWS = "vec_id bigint, payload binary"


def integer_vectors(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and the vector (little-endian doubles, not yet made integers) of the rows that take part."""
    def run(batches):
        for batch in batches:
            ids, payloads = [], []
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if vec_id is None or not v.is_valid or v.values.null_count:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype("<f8")
                if np.isfinite(x).all():
                    ids.append(vec_id)
                    payloads.append(x.tobytes())
            yield pa.RecordBatch.from_pydict({"vec_id": pa.array(ids, pa.int64()), "payload": pa.array(payloads, pa.binary())})

    return table.select(F.col(id_column).cast("long"), F.col(vector)).mapInArrow(run, ROWS)


def _matrix(payloads: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(payloads), width))
    for i, p in enumerate(payloads):
        out[i, :len(p) // 8] = np.frombuffer(p, "<f8")
    return out


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the integers of row pairs, as longs (saturating)."""
    bound = 2 ** ((61 - max(1, a.shape[1]).bit_length()) // 2)
    x, y = integers(a, SCALE), integers(b, SCALE)
    big = rows_above(x, bound) | rows_above(y, bound)
    out = np.zeros(len(a), np.int64)
    out[~big] = np.einsum("ij,ij->i", x[~big].astype(np.int64), y[~big].astype(np.int64))
    if big.any():
        out[big] = as_long((x[big].astype(object) * y[big].astype(object)).sum(axis=1))
    return out


class Shard:
    """The vectors of one shard, and the two passes over them."""

    def __init__(self, ids: list[int], payloads: list[bytes]):
        order = np.argsort(np.array(ids, np.int64), kind="stable")
        self.ids = np.array(ids, np.int64)[order]
        self.payloads = [payloads[i] for i in order]
        self.width = max((len(p) // 8 for p in payloads), default=0)
        self.x = _matrix(self.payloads, self.width)
        with np.errstate(over="ignore"):
            self.floors = np.floor(self.x * SCALE)
            self.norms = np.sqrt((self.floors ** 2).sum(1))

    def _bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores in double precision and how far off each may be (where they overflow: 0, without end)."""
        q = q[:, :self.width] if q.shape[1] >= self.width else np.pad(q, ((0, 0), (0, self.width - q.shape[1])))
        with np.errstate(over="ignore", invalid="ignore"):
            f = np.floor(q * SCALE)
            s = f @ self.floors.T
            # A saturated score is off by what it is cut.
            off = (self.width + 3) * 2.0 ** -52 * np.sqrt((f ** 2).sum(1))[:, None] * self.norms[None] + np.abs(s) * 2.0 ** -50
        lost = ~np.isfinite(s) | ~np.isfinite(off)
        s[lost], off[lost] = 0.0, np.inf
        return np.clip(s, -2.0 ** 63, 2.0 ** 63), off

    def lists(self, ids: np.ndarray, q: np.ndarray, most: int):
        """(query, lower bound): the greatest of this shard."""
        s, off = self._bounds(q)
        low = np.where(self.ids[None] == ids[:, None], -np.inf, s - off)
        m = min(most, low.shape[1])
        top = -np.partition(-low, m - 1, axis=1)[:, :m]
        keep = np.isfinite(top)
        return np.repeat(ids, m)[keep.ravel()], top[keep]

    def entries(self, ids: np.ndarray, q: np.ndarray, cutoff: np.ndarray, k: int):
        """(query, vector, score) of the first k vectors that can reach the cutoff."""
        s, off = self._bounds(q)
        can = s + off >= cutoff[:, None]
        can &= self.ids[None] != ids[:, None]
        row, at = np.nonzero(can)
        score = np.empty(len(row), np.int64)
        n = min(self.width, q.shape[1])
        for i in range(0, len(row), 1 << 14):
            a, b = row[i:i + (1 << 14)], at[i:i + (1 << 14)]
            score[i:i + len(a)] = _dots(q[a, :n], self.x[b, :n])
        order = np.lexsort((self.ids[at], -score, row))  # ties to the smaller id
        row, at, score = row[order], at[order], score[order]
        first = np.searchsorted(row, row)
        keep = np.arange(len(row)) - first < k
        return ids[row[keep]], self.ids[at[keep]], score[keep]


def _against_shards(vectors: DataFrame, queries: DataFrame, shards: int, work, schema: str) -> DataFrame:
    """Every query (query_id, payload, cutoff) with every shard; `work` takes a shard and a block of queries.

    A shard's vectors come first, then the queries in blocks: a task holds one shard and one block.
    """
    sent = (vectors.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), F.lit(0).alias("kind"),
                           F.col("vec_id").alias("id"), "payload", F.lit(None).cast("double").alias("cutoff"))
            .unionByName(queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
                                        F.lit(1).alias("kind"), F.col("query_id").alias("id"), "payload", "cutoff"))
            .repartition(shards, "shard").sortWithinPartitions("shard", "kind", "id"))

    def run(batches):
        number, shard, vectors_here, block = None, None, ([], []), ([], [], [])

        def asked():
            nonlocal shard, block
            if block[0] and (vectors_here[0] or shard):
                shard = shard or Shard(*vectors_here)
                q = _matrix(block[1], max(len(p) // 8 for p in block[1]))
                yield work(shard, np.array(block[0], np.int64), q, np.array(block[2], np.float64))
            block = ([], [], [])

        for batch in batches:
            for s, kind, i, payload, cutoff in zip(*[batch.column(c).to_pylist() for c in range(5)], strict=True):
                if s != number:
                    yield from asked()
                    number, shard, vectors_here = s, None, ([], [])
                if kind == 0:
                    vectors_here[0].append(i)
                    vectors_here[1].append(payload)
                else:
                    block[0].append(i)
                    block[1].append(payload)
                    block[2].append(-np.inf if cutoff is None else cutoff)
                    if len(block[0]) == QUERY_ROWS:
                        yield from asked()
        yield from asked()

    return sent.mapInArrow(run, schema)


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k greatest inner products.

    Both are tables of `integer_vectors`; a query's own id is no candidate; ties go to the smaller vec_id.
    """
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    most = min(k, max(1, -(-4 * k // shards)))
    asked = queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("payload").alias("payload"))

    def lists(shard, ids, q, _):
        query, bound = shard.lists(ids, q, most)
        return pa.RecordBatch.from_pydict({"query_id": pa.array(query), "bound": pa.array(bound)})

    def entries(shard, ids, q, cutoff):
        query, vec, score = shard.entries(ids, q, cutoff, k)
        return pa.RecordBatch.from_pydict({"query_id": pa.array(query), "vec_id": pa.array(vec), "score": pa.array(score)})

    gathered = _against_shards(vectors, asked.withColumn("cutoff", F.lit(None).cast("double")), shards, lists,
                               "query_id bigint, bound double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound")))
    cutoffs = gathered.withColumn("n", place).filter(F.col("n") == k).select("query_id", F.col("bound").alias("cutoff"))
    found = _against_shards(vectors, asked.join(cutoffs, "query_id", "left"), shards, entries,
                            "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle(k: int = 5) -> str:
    """DuckDB SQL of the query's rows (vectors of one length)."""
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {k}"""
