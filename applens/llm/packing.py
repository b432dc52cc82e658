"""Operator 2: best-fit packing by a configuration linear program.

Documents become token ids and an end id; a document longer than a sequence is
cut from its end, so that only its first piece may be shorter. How many pieces
there are of each length is all that the packing needs, so the program is solved on
a histogram of at most CAPACITY numbers, whatever the size of the table:

* A configuration is a multiset of lengths that fits a sequence. The covering
  program (fewest sequences, every length covered) is solved by multiplicative
  weights: each length has a price that falls as it is covered, and the next
  configuration is the dearest one, found by dynamic programming over a knapsack.
* Rounding uses each configuration as often as whole copies of it remain. What
  is left is filled by taking the longest piece and the subset of the rest that
  fills the sequence best, as often as that repeats; each such step uses up a
  length, so there are at most CAPACITY of them.

The plan (for each length, which of its pieces go to which sequences) is joined
with the pieces, which are numbered within their length: by counts per length and
salt first, then within each of these, so that no length is numbered in one task.

A NULL text is empty. Text that spells a special token is ordinary text.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from applens.llm.common import release_memory, write_shared

CAPACITY, END = 1024, 2
ITERATIONS = 800
STEP = 0.5               # of what a configuration can still cover, per iteration
RATE = 8.0               # by which prices fall with coverage
POWER = 2.0              # of the length, in its price at the start: long pieces are harder to place
PIECES_PER_SALT = 100_000
SLICE = 256

# ------------------------------------------------------------- token ids


def _byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + n)] = b
    return out


@lru_cache(maxsize=2)
def encoder(path: str):
    """Text to ids with the vocabulary of a byte-level BPE file, equal to the tokenizers library's.

    Runs the vocabulary's ranks in tiktoken, several times faster; a text that spells an added token of the
    file, or that the pattern matcher can't take (very long runs), goes to the tokenizers library.
    """
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    symbol = _byte_of_symbol()
    special = {t["content"] for t in spec.get("added_tokens", ())}
    ranks = {bytes(symbol[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    plain = Tokenizer.from_file(path)

    def encode(text: str) -> list[int]:
        if any(token in text for token in special):
            return plain.encode(text.encode("utf-8", "replace").decode("utf-8"), add_special_tokens=False).ids
        try:
            return fast.encode_ordinary(text)
        except BaseException as e:
            if type(e).__name__ not in ("PanicException", "UnicodeEncodeError", "ValueError"):
                raise
            return plain.encode(text.encode("utf-8", "replace").decode("utf-8"), add_special_tokens=False).ids

    return encode


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: only the first may be shorter than the capacity."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def run(batches):
        encode = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                out: list[list] = [[] for _ in range(5 + with_ids)]
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.array([*encode(text or ""), end], "<u4")
                    for n, (start, length) in enumerate(cut(len(ids), capacity)):
                        own = ids[start:start + length]
                        for o, v in zip(out, (doc_id, n, start, length, zlib.crc32(own.tobytes()), own.tolist() if with_ids else None), strict=False):
                            o.append(v)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds, strict=False)], names=names[:5 + with_ids])
            release_memory()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


# ------------------------------------------------------------- the program


def dearest(price: np.ndarray, capacity: int) -> np.ndarray:
    """Copies of each length (index) in the configuration of the greatest price. price[0] is unused."""
    best = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, np.int64)
    for w in range(1, capacity + 1):
        value = best[w - 1::-1] + price[1:w + 1]  # the last piece has length 1..w
        k = int(value.argmax())
        best[w], last[w] = (value[k], k + 1) if value[k] > best[w - 1] else (best[w - 1], 0)
    copies = np.zeros(capacity + 1, np.int64)
    w = capacity
    while w > 0:
        if last[w]:
            copies[last[w]] += 1
            w -= last[w]
        else:
            w -= 1
    return copies


def configurations(need: np.ndarray, capacity: int = CAPACITY) -> list[tuple[np.ndarray, float]]:
    """A fractional solution of the covering program: (copies per length, number of sequences)."""
    have = np.flatnonzero(need)
    if not len(have):
        return []
    covered = np.zeros(capacity + 1)
    amounts: dict[bytes, float] = {}
    for _ in range(ITERATIONS):
        share = np.full(capacity + 1, np.inf)
        share[have] = covered[have] / need[have]
        low = share.min()
        if low >= 1:
            break
        # A piece costs as much room as its length; coverage beyond the least lowers its price.
        price = np.where(share < 1, np.arange(capacity + 1) ** POWER * np.exp(-RATE * (np.minimum(share, 9) - low)), 0.0)
        copies = dearest(price, capacity)
        used = np.flatnonzero(copies)
        # Never beyond what is still needed, so that all lengths run out together.
        amount = STEP * ((need[used] - covered[used]) / copies[used]).min()
        amounts[copies.tobytes()] = amounts.get(copies.tobytes(), 0) + amount
        covered += copies * amount
    return [(np.frombuffer(k, np.int64), v) for k, v in amounts.items()]


def best_fill(left: np.ndarray, room: int) -> np.ndarray:
    """Copies of lengths, no more than `left`, whose sum comes closest to `room`."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in np.flatnonzero(left)[::-1]:
        length = int(length)
        many, size = min(int(left[length]), room // length), 1
        while many > 0 and not reach >> room & 1:
            take = min(size, many)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            many, size = many - take, size * 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    copies = np.zeros(len(left), np.int64)
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            copies[length] += take
            at -= length * take
    return copies


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[np.ndarray, int]]:
    """Whole configurations and how many sequences take each; together they hold exactly the histogram."""
    left = np.zeros(capacity + 1, np.int64)
    for length, many in histogram.items():
        left[length] = many
    chosen: list[tuple[np.ndarray, int]] = []

    def take(copies: np.ndarray, most: int) -> None:
        used = np.flatnonzero(copies)
        many = min(most, int((left[used] // copies[used]).min()))
        if many > 0:
            chosen.append((copies, many))
            left[used] -= copies[used] * many

    if left[capacity]:
        whole = np.zeros(capacity + 1, np.int64)
        whole[capacity] = 1
        take(whole, int(left[capacity]))
    fractional = configurations(left.copy(), capacity)
    full = [c for c in fractional if int(c[0] @ np.arange(capacity + 1)) == capacity]
    for copies, amount in sorted(full, key=lambda c: -c[1]):
        take(copies, int(amount))
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        rest = left.copy()
        rest[longest] -= 1
        copies = best_fill(rest, capacity - longest) if capacity > longest else np.zeros(capacity + 1, np.int64)
        copies[longest] += 1
        take(copies, int(left.max()))
    return chosen


def segments(chosen: list[tuple[np.ndarray, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, copies, offset): where the pieces of a length go."""
    rows, ranks, sequence = [], {}, 0
    for copies, many in chosen:
        offset = 0
        for length in np.flatnonzero(copies)[::-1].tolist():
            k = int(copies[length])
            r = ranks.get(length, 0)
            rows.append((length, r, r + many * k, sequence, k, offset))
            ranks[length] = r + many * k
            offset += k * length
        sequence += many
    return rows


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids): one row per piece.

    `docs` has doc_id (long) and text. Sequences are numbered from 0 and hold their pieces without gaps from offset 0.
    """
    spark = docs.sparkSession
    cut_docs = write_shared(pieces(docs, path, capacity, end, with_ids), "pieces")
    histogram = {r[0]: r[1] for r in cut_docs.groupBy("length").count().collect()}
    rows = segments(plan(histogram, capacity))
    # At most a row per length of each configuration: bounded by the capacity, not by the table.
    place = F.broadcast(spark.createDataFrame(
        rows, "at bigint, first_rank bigint, end_rank bigint, first_sequence bigint, copies bigint, first_offset bigint"))
    most = max(histogram.values(), default=1)
    salted = cut_docs.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(-(-most // PIECES_PER_SALT))))
    before = (salted.groupBy("length", "salt").count()
              .withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count"))
              .drop("count"))
    ranked = (salted.withColumn("own", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1)
              .join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("own")))
    inside = F.col("rank") - F.col("first_rank")
    return (ranked.join(place, (F.col("length") == F.col("at")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("first_sequence") + F.expr("(rank - first_rank) div copies")).alias("sequence_id"),
                    (F.col("first_offset") + F.pmod(inside, F.col("copies")) * F.col("length")).alias("offset"),
                    *(["ids"] if with_ids else [])))
