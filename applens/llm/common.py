"""Helpers shared by the operators of this subpackage.

Text operators work on UTF-8 bytes in numpy inside Spark tasks. Words are
maximal runs of bytes other than space and 0x09-0x0D; lower-casing touches
A-Z only.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager, nullcontext
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at BATCH_BYTES (Spark's own bound is 64 MB, held twice on either side of a worker)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


@lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # not the GNU C library
        return lambda _: 0


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker lives on after its task, beside the next stage's."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a local-mode session without that setting gets a fresh folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="llm-shared-")
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Spark removes the shuffle files of each job inside when it has ended."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def write_shared(df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it back: cuts lineage durably.

    `drop_shuffles` lets Spark remove the shuffle files of this job when the table stands.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    with shuffles_dropped(spark) if drop_shuffles else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> tuple[DataFrame, Callable[[], None]]:
    """Like `write_shared`, bucketed by `key`: joins on it need not deal the table again.

    Also returns what takes the table off the session's catalog (its files stay).
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", os.path.join(shared_dir(spark), table)).saveAsTable(table))
    return spark.table(table), lambda: spark.sql(f"DROP TABLE IF EXISTS {table}")


HEAVY = 1000


def attached(rows: DataFrame, key: str, totals: DataFrame) -> DataFrame:
    """The columns of `totals` for every row of `rows` (both stored tables), by key; NULLs are one key.

    `totals` has one row per ``key``, with its number of rows ``n``. Keys with more than a share of
    1/HEAVY of all rows, fewer than HEAVY by count, are broadcast; the others, whose groups are small, are joined.
    """
    bound = (totals.agg(F.sum("n")).first()[0] or 0) // HEAVY
    own = F.col(quoted(key))
    names = [c for c in totals.columns if c not in ("key", "n")]

    def side(part):
        return part.select(F.col("key").alias("_attached_key"), *names)

    heavy = side(totals.filter(F.col("n") > bound))
    light = side(totals.filter(F.col("n") <= bound))
    same = own.eqNullSafe(F.col("_attached_key"))
    first = rows.join(F.broadcast(heavy), same).drop("_attached_key")
    rest = rows.join(F.broadcast(heavy.select("_attached_key")), same, "left_anti").join(light, same).drop("_attached_key")
    return first.unionByName(rest)


def text_bytes(docs: DataFrame) -> int:
    """Total UTF-8 bytes of ``text``; sizes the number of blocks and buckets."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def doc_crc_mod(m: int):
    """crc32 of the decimal doc_id, modulo m (NULL for a NULL id)."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % F.lit(m)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift-multiply): a bijection that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_NEAR = mix(np.arange(1, 64 * 256 + 1, dtype=np.uint64))


def place_values(place: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A random 64-bit value for each (place in the word, byte)."""
    out = _NEAR[np.minimum(place, 63) << 8 | b]
    far = np.flatnonzero(place >= 64)
    if len(far):
        out[far] = mix((place[far].astype(np.uint64) << np.uint64(8)) + b[far] + np.uint64(1))
    return out


def word_hashes(b: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word: the sum over its bytes of a random value of (place, byte)."""
    white = WHITE[b]
    starts = np.flatnonzero(~white & np.concatenate([[True], white[:-1]]))
    if not len(starts):
        return np.zeros(0, np.uint64)
    at = np.arange(len(b))
    first = np.zeros(len(b), np.int64)
    first[starts] = starts
    values = place_values(at - np.maximum.accumulate(first), b)
    values[white] = 0
    return mix(np.add.reduceat(values, starts) + np.uint64(1))


def shingle_hashes(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles.

    With fewer words than `width` the whole sequence is the one shingle;
    without words (or text) there is none.
    """
    if not text:
        return np.zeros(0, np.uint64)
    w = word_hashes(LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)])
    if not len(w):
        return w
    k = min(width, len(w))
    n = len(w) - k + 1
    h = np.full(n, k, np.uint64)
    for j in range(k):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w[j:j + n])
    return np.unique(h)
