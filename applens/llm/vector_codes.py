"""Operator 12: vectors as short codes, by one exact integer codebook per part.

Components become floor(SCALE * x); a vector is cut into PARTS equal consecutive parts. Each
part's codebook starts as that part of the ENTRIES rows with the smallest ids. Each of ROUNDS
rounds gives every part to its codebook's nearest entry (squared distance, ties to the lower
index) and replaces each entry by the floored mean of its parts; entries without any stay.

Distances are |x|^2 - 2 x.c + |c|^2. The products x.c come from float64 matrix multiplications
that are exact: integers are split into limbs so small that no sum of limb products
reaches 2^53, and the limb products are put together in int64; the first least distance wins.
Where a distance might not fit int64 (integers of about 2^25 and more), it is computed in Python integers.

A round is one pass over the table. A task adds up its parts per entry and sends the
sums, cut in 32-bit limbs, so that no sum over tasks overflows; what reaches the driver and is sent
out again is one codebook (PARTS * ENTRIES entries), whatever the number of rows. The table
is read ROUNDS + 3 times: give a stored one.

Rows take no part if the vector is NULL or holds a NULL or non-finite component. Shorter vectors end in
zeros; so does each part if PARTS does not divide the length. Repeated ids are rows of their own, in
the order of their vectors; NULL ids come last. With fewer than ENTRIES rows there are as many
entries; an empty table gives no rows. A sum that does not fit a long is shown as the greatest one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applens.llm.common import attached, quoted, write_shared
from applens.llm.exact import LARGEST, as_long, integers, is_finite, largest, matrix, parted

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
CHUNK = 8192
SUMS = "part int, entry int, place int, limb int, value bigint"


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """x as a sum of limb[i] << (bits * i), as float64: each limb is at most 2^bits in size."""
    out = []
    while largest(x) >= 1 << bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """x @ c.T of int64 rows, exact (modulo 2^64), by float64 products of limbs."""
    bits = (53 - max(1, x.shape[1]).bit_length()) // 2
    out = np.zeros((len(x), len(c)), np.int64)
    right = [b.T for b in limbs(c, bits)]
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            if bits * (i + j) < 64:
                out += (a @ b).astype(np.int64) << (bits * (i + j))
    return out


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distance of every row of x to every row of c: int64, or Python integers if one is an object array."""
    if x.dtype == object or c.dtype == object:
        x, c = x.astype(object), c.astype(object)
        cross = x @ c.T
    else:
        cross = products(x, c)
    return (x * x).sum(1)[:, None] - 2 * cross + (c * c).sum(1)[None]


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row of x the first nearest row of c, and the squared distance (saturating)."""
    # Two rows of integers up to this size are at most 2^58 apart in squared distance.
    bound = 2 ** ((56 - max(1, x.shape[1]).bit_length()) // 2)
    sides, own = parted(c, bound), parted(x, bound)
    ordinary = all(part.dtype == np.int64 for _, part in sides + own)
    at, least = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64 if ordinary else object)
    for rows, part in own:
        best = None
        for entries, side in sides:
            d = distances(part, side)
            first = d.argmin(axis=1)
            found = (d[np.arange(len(part)), first], entries[first])
            if best is None:
                best = found
            else:
                nearer = ((found[0] < best[0]) | ((found[0] == best[0]) & (found[1] < best[1]))).astype(bool)
                best = (np.where(nearer, found[0], best[0]), np.where(nearer, found[1], best[1]))
        at[rows] = best[1]
        least[rows] = best[0]
    return at, least


@dataclass
class Codebooks:
    """The entries of every part: integers of shape (parts, entries, width of a part)."""

    entries: np.ndarray
    scale: int

    @property
    def padded(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def parts_of(self, column: pa.Array) -> np.ndarray:
        x = integers(matrix(column, self.padded), self.scale)
        return x.reshape(len(x), self.entries.shape[0], self.entries.shape[2])

    def sha256(self) -> str:
        """Of all entries' decimal integers, by part, entry and place, comma-joined."""
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.ravel()).encode()).hexdigest()


def _chunks(batches, vector: int):
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            chunk = batch.slice(at, CHUNK)
            yield chunk, chunk.column(vector)


def _sums(books: Codebooks):
    """A task's sums of the parts of every entry, place by place (place -1: how many), in limbs of 32 bits."""
    parts, entries, width = books.entries.shape

    def run(batches):
        total = np.zeros((parts, entries, width + 1), np.int64)
        room = 0  # no sum is greater in size
        for _, column in _chunks(batches, 0):
            x = books.parts_of(column)
            room += len(x) * max(1, largest(x))
            if room >= 2 ** 62 or x.dtype == object:
                total = total.astype(object)
            for p in range(parts):
                at, _ = nearest(x[:, p], books.entries[p])
                order = np.argsort(at, kind="stable")
                names, first = np.unique(at[order], return_index=True)
                total[p, names, :width] += np.add.reduceat(x[order, p], first, axis=0)
                total[p, names, width] += np.diff(np.r_[first, len(at)])
        used = total[:, :, width] != 0
        part, entry = np.nonzero(used.astype(bool))
        values = total[part, entry]
        limb = 0
        while len(values):
            last = largest(values) < 2 ** 31
            low = values if last else values & 0xFFFFFFFF
            n = len(values)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(np.repeat(part, width + 1).astype(np.int32)),
                "entry": pa.array(np.repeat(entry, width + 1).astype(np.int32)),
                "place": pa.array(np.tile(np.r_[np.arange(width), -1], n).astype(np.int32)),
                "limb": pa.array(np.full(n * (width + 1), limb, np.int32)),
                "value": pa.array(low.ravel().astype(np.int64))})
            if last:
                break
            values, limb = values >> 32, limb + 1

    return run


def kept_rows(table: DataFrame, vector: str = "embedding") -> DataFrame:
    return table.filter(is_finite(F.col(quoted(vector))))


def fit(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", parts: int = PARTS,
        entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """The codebooks of the table's vectors."""
    v = F.col(quoted(vector))
    kept = kept_rows(table, vector).select(F.col(quoted(id_column)).alias("id"), v.cast("array<double>").alias("v"))
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // parts)
    first = [r.v for r in kept.orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()]
    start = integers(matrix(pa.array(first, pa.list_(pa.float64())), parts * width), scale)
    books = Codebooks(np.ascontiguousarray(start.reshape(len(first), parts, width).transpose(1, 0, 2)), scale)
    for _ in range(rounds if first else 0):
        found = (kept.select("v").mapInArrow(_sums(books), SUMS).groupBy("part", "entry", "place", "limb")
                 .agg(F.sum("value").alias("value")).collect())
        total: dict[tuple[int, int, int], int] = {}
        for r in found:
            key = (r.part, r.entry, r.place)
            total[key] = total.get(key, 0) + (r.value << (32 * r.limb))
        new = books.entries.astype(object)
        for (p, e, place), value in total.items():
            if place >= 0:
                new[p, e, place] = value // total[p, e, -1]
        books = Codebooks(new if largest(new) >= 2 ** 62 else new.astype(np.int64), scale)
    return books


def encode(table: DataFrame, books: Codebooks, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The rows that take part, every column but the vector, then ``codes`` (one index a part) and ``error``
    (sum of the squared distances). Columns of the table that are named so are replaced."""
    others = [c for c in table.columns if c not in (vector, "codes", "error")]
    fields = [T.StructField(f"c{i}", table.schema[c].dataType) for i, c in enumerate(others)]
    schema = T.StructType([*fields, T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])

    def run(batches):
        for chunk, column in _chunks(batches, len(others)):
            x = books.parts_of(column)
            found = [nearest(x[:, p], books.entries[p]) for p in range(x.shape[1])]
            codes = np.stack([at for at, _ in found], axis=1).astype(np.int32)
            error = as_long(sum((d for _, d in found), np.zeros(len(x), np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*chunk.columns[:-1], pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), codes.shape[1]).cast(pa.list_(pa.int32())),
                 pa.array(error)], names=[f.name for f in schema])

    if not books.entries.size and not books.entries.shape[1]:
        return table.sparkSession.createDataFrame([], T.StructType(
            [*[T.StructField(c, table.schema[c].dataType) for c in others], *schema.fields[-2:]]))
    rows = kept_rows(table, vector).select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(others)],
                                           F.col(quoted(vector)).cast("array<double>"))
    return rows.mapInArrow(run, schema).toDF(*others, "codes", "error")


def label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """A stored table of codes with ``label_error``: the errors of its label added up (NULLs are one label)."""
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    totals = coded.groupBy(F.col(quoted(label)).alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.least(exact, F.lit(LARGEST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return attached(coded, label, write_shared(totals, "label-errors"))


def codes(table: DataFrame) -> DataFrame:
    """The query's columns."""
    books = fit(table)
    coded = encode(table.select("vec_id", "embedding", "label"), books)
    two_digits = F.transform("codes", lambda i: F.lower(F.lpad(F.hex(i), 2, "0")))
    coded = write_shared(coded.select("vec_id", "label", F.array_join(two_digits, "").alias("code"), "error"), "vector-codes")
    return label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def oracle(rounds: int = ROUNDS) -> str:
    """DuckDB SQL of the query's rows (vectors of one length, components of ordinary size)."""
    assign = """
d{i} AS (SELECT vec_id, p, min(CAST(list_inner_product(e, e) - 2 * list_inner_product(e, c) + list_inner_product(c, c) AS HUGEINT) * 256 + entry) AS m
        FROM x JOIN b{i} USING (p) GROUP BY vec_id, p),
a{i} AS (SELECT vec_id, p, CAST(m % 256 AS INTEGER) AS entry, CAST(m // 256 AS BIGINT) AS d FROM d{i})"""
    update = """,
u{i} AS (SELECT p, entry, k, sum(CAST(e[k] AS BIGINT)) AS s, count(*) AS n
        FROM a{i} JOIN x USING (vec_id, p), range(1, (SELECT any_value(len(e)) FROM x) + 1) t(k) GROUP BY p, entry, k),
m{i} AS (SELECT p, entry, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY k) AS c FROM u{i} GROUP BY p, entry),
b{j} AS (SELECT p, entry, coalesce(m{i}.c, b{i}.c) AS c FROM b{i} LEFT JOIN m{i} USING (p, entry)),"""
    steps = "".join(assign.format(i=i) + update.format(i=i, j=i + 1) for i in range(rounds)) + assign.format(i=rounds)
    return f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS f FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT vec_id, p, f[p * (len(f) // 4) + 1:(p + 1) * (len(f) // 4)] AS e FROM v, range(4) t(p)),
o AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v),
b0 AS (SELECT p, CAST(entry AS INTEGER) AS entry, e AS c FROM o JOIN x USING (vec_id) WHERE entry < 256),{steps},
r AS (SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda z: CAST(CAST(z AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, entry)) AS h FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM r JOIN v USING (vec_id), h"""
