"""Packed messages between blocks of documents and buckets of keys.

A block sends, per bucket, one row with the columns of its entries as bytes; a bucket
answers, per block, with one row of bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

REPLY = "block bigint, kind int, payload binary"
SENT = "bucket bigint, block bigint, payload binary"


def groups_of(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of an ordered array, and where each one's entries start and end."""
    start = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    return ordered[start], start, np.r_[start, len(ordered)][1:]


def packed(block: int, buckets: int, keys: np.ndarray, columns: list[np.ndarray]) -> pa.Table:
    """One row per bucket: its number of entries and the columns, one after the other."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    columns = [c[order] for c in columns]
    names, start, ends = groups_of(bucket[order])
    return pa.table({
        "bucket": names.astype(np.int64), "block": np.full(len(names), block, np.int64),
        "payload": pa.array([b"".join(c[s:e].tobytes() for c in columns)
                             for s, e in zip(start, ends, strict=True)], pa.binary())})


def unpacked(payloads: list[bytes], kinds: list) -> list[np.ndarray]:
    """The columns of such payloads, put together, and each entry's payload."""
    width = sum(np.dtype(k).itemsize for k in kinds)
    sizes = [len(p) // width for p in payloads]
    out = []
    offset = 0
    for k in kinds:
        size = np.dtype(k).itemsize
        out.append(np.concatenate([np.frombuffer(p, k, n, offset * n) for p, n in zip(payloads, sizes, strict=True)]
                                  or [np.zeros(0, k)]))
        offset += size
    return [*out, np.repeat(np.arange(len(payloads)), sizes)]


def replies(blocks: list[int], owner: np.ndarray, parts: list[tuple[int, np.ndarray, list[np.ndarray]]]) -> pa.Table:
    """Rows (block, kind, payload): for each kind, the chosen entries' columns, by the block that sent them."""
    rows: list[tuple[int, int, bytes]] = []
    for kind, chosen, columns in parts:
        o = owner[chosen]
        order = np.argsort(o, kind="stable")
        names, start, ends = groups_of(o[order])
        columns = [c[chosen][order] for c in columns]
        rows += [(blocks[n], kind, b"".join(c[s:e].tobytes() for c in columns))
                 for n, s, e in zip(names, start, ends, strict=True)]
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()),
                     "kind": pa.array([r[1] for r in rows], pa.int32()),
                     "payload": pa.array([r[2] for r in rows], pa.binary())})
