"""Operator 10: suffix-array dedup by a depth-limited radix sort.

Every 50-byte window is a suffix cut at the threshold depth; two windows meet
in the sort exactly when they are the same string, so the groups left at full
depth are the repeated windows. The sort runs most significant digit first and
drops what has no partner after each digit:

1. digit of 16 bytes. A window is placed by its smallest 16-byte gram (by
   hash, leftmost on ties): equal windows choose the same gram, so only one in
   about 18 places is dealt out. Grams that stand in one document only leave.
2. digit of 33 bytes. Windows that share a gram form a run. Runs equal as a
   whole are settled here. A run with other runs at its gram goes on only if
   its gram with the 17 bytes before it, or after it, occurs in another run
   (each window of the run holds one of the two).
3. full 50 bytes, for the windows of those runs only.

Text is dealt once into blocks of a bounded size; a digit pass sends, per block
and bucket, packed hashes, and the replies go back to the block, so no group of
equal strings ever meets in one row or task: a group has at most one entry per
block. Strings are compared by 64-bit hashes of their gram and of the whole.

Rows whose doc_id is NULL have no order and are left as they are (nothing is
removed, and they remove nothing). Rows of the same doc_id never remove from
each other.
"""

from __future__ import annotations

import hashlib
from inspect import signature

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.llm.blocks import REPLY, SENT, packed, replies, unpacked
from applens.llm.common import mix, quoted, release_memory, text_bytes

WINDOW, GRAM = 50, 16
SPAN = WINDOW - GRAM + 1          # gram places in a window
HALF = 17                         # bytes beside the gram in the second digit
BLOCK_BYTES = 1 << 20
BUCKET_ENTRIES = 1 << 19
NO_ID = np.iinfo(np.int64).max

_BASE = np.uint64(0x5851F42D4C957F2D)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if len(_powers.get("up", ())) < n:
        n = 1 << (n - 1).bit_length()
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p)
    return _powers["up"], _powers["down"]


class Block:
    """The texts of one block as bytes, with the runs of windows that share a gram."""

    def __init__(self, table: pa.Table):
        self.table = table
        texts = [(x or "").encode("utf-8", "surrogatepass") for x in table.column("text").to_pylist()]
        ids = table.column("doc_id").to_numpy(zero_copy_only=False) if not table.column("doc_id").null_count \
            else np.array([NO_ID if x is None else x for x in table.column("doc_id").to_pylist()], np.int64)
        self.ids = ids.astype(np.int64)
        self.lengths = np.array([len(x) for x in texts], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self._find_runs()

    def _find_runs(self) -> None:
        n = len(self.bytes)
        empty = np.zeros(0, np.int64)
        self.at = self.first = self.last = self.doc = empty
        self.gram = np.zeros(0, np.uint64)
        if n < WINDOW:
            return
        h = _BYTE[self.bytes]
        width = 1
        while width < GRAM:
            h = h[:-width] * np.uint64(pow(int(_BASE), width, 1 << 64)) + h[width:]
            width *= 2
        gram = mix(h)
        # The order hash in the high half, the place in the low half: a minimum is a leftmost place.
        m = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
        have = 1
        while have < SPAN:
            step = min(have, SPAN - have)
            m = np.minimum(m[:-step], m[step:])
            have += step
        valid = np.ones(len(m), bool)
        for start, end, usable in zip(self.starts, self.ends, self.ids != NO_ID, strict=True):
            valid[max(start, end - WINDOW + 1) if usable else start:end] = False
        window = np.flatnonzero(valid)
        if not len(window):
            return
        place = (m[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        self.at, self.first = place[new], window[new]
        self.last = window[np.r_[new[1:], len(window)] - 1]
        self.gram = gram[self.at]
        self.doc = self.ids[np.searchsorted(self.ends, self.at, side="right")]

    def hash_between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hashes of the byte strings [a, b)."""
        if not hasattr(self, "sums"):
            _, down = _power(len(self.bytes) + 1)
            self.sums = np.zeros(len(self.bytes) + 1, np.uint64)
            np.cumsum(_BYTE[self.bytes] * down[:len(self.bytes)], out=self.sums[1:])
        up, _ = _power(len(self.bytes) + 1)
        return mix((self.sums[b] - self.sums[a]) * up[a])

    def keep_runs(self, mask: np.ndarray) -> None:
        for name in ("at", "first", "last", "gram", "doc"):
            setattr(self, name, getattr(self, name)[mask])

    def run_hashes(self) -> np.ndarray:
        inner = self.hash_between(self.first, self.last + WINDOW)
        extent = ((self.last - self.first) << 8) + (self.at - self.first)
        return mix(inner * np.uint64(3) + extent.astype(np.uint64))

    def digits(self) -> tuple[np.ndarray, np.ndarray]:
        """16-bit digits of the 33 bytes ending and starting with the gram; 0 where no window has them."""
        out = []
        for has, a, b in ((self.first <= self.at - HALF, self.at - HALF, self.at + GRAM),
                          (self.last > self.at - HALF, self.at, self.at + GRAM + HALF)):
            d = np.zeros(len(self.at), np.uint16)
            d[has] = self.hash_between(a[has], b[has]) % np.uint64(65535) + np.uint64(1)
            out.append(d)
        return out[0], out[1]

    def windows(self, runs: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the windows of the given runs and each one's run: those holding the bytes
        before the gram where `left`, and the others where `right`."""
        first = np.where(left, self.first[runs], np.maximum(self.first[runs], self.at[runs] - HALF + 1))
        last = np.where(right, self.last[runs], np.minimum(self.last[runs], self.at[runs] - HALF))
        count = np.maximum(last - first + 1, 0)
        run = np.repeat(np.arange(len(runs)), count)
        start = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count) + first[run]
        return start, runs[run]


def _least(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, each one's least document, and the place of every entry's key."""
    unique, place = np.unique(keys, return_inverse=True)
    least = np.full(len(unique), NO_ID, np.int64)
    np.minimum.at(least, place, docs)
    return unique, least, place


GRAM_BYTES = 6  # of a gram's hash, sent in the first digit


def _short(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.uint8).reshape(-1, 8)[:, 8 - GRAM_BYTES:]


def _tidy(work):
    """The same work on a group, without the memory it took left behind."""
    if len(signature(work).parameters) == 1:
        def tidy(table: pa.Table) -> pa.Table:
            out = work(table)
            release_memory()
            return out
    else:
        def tidy(texts: pa.Table, answers: pa.Table) -> pa.Table:
            out = work(texts, answers)
            release_memory()
            return out
    return tidy


def first_digit(buckets: int):
    def send(table: pa.Table) -> pa.Table:
        keys = np.unique(Block(table).gram)
        return packed(table.column("block")[0].as_py(), buckets, keys, [_short(keys)])

    def settle(table: pa.Table) -> pa.Table:
        blocks, payloads = table.column("block").to_pylist(), table.column("payload").to_pylist()
        raw = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, GRAM_BYTES)
        keys = np.zeros((len(raw), 8), np.uint8)
        keys[:, 8 - GRAM_BYTES:] = raw
        keys = keys.view(np.uint64).ravel()
        owner = np.repeat(np.arange(len(payloads)), [len(p) // GRAM_BYTES for p in payloads])
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        again = np.zeros(len(keys), bool)
        again[order] = np.r_[False, same] | np.r_[same, False]
        return replies(blocks, owner, [(0, np.flatnonzero(again), [raw])])

    return send, settle


def _run_key(gram: np.ndarray, run: np.ndarray) -> np.ndarray:
    return mix(gram * np.uint64(0x9E3779B97F4A7C15) ^ run)


RUN_KINDS = [np.uint64, np.uint64, np.uint16, np.uint16, np.int64]


def second_digit(buckets: int):
    def send(texts: pa.Table, answers: pa.Table) -> pa.Table:
        b = Block(texts)
        raw = np.frombuffer(b"".join(answers.column("payload").to_pylist()), np.uint8).reshape(-1, GRAM_BYTES)
        wanted = np.zeros((len(raw), 8), np.uint8)
        wanted[:, 8 - GRAM_BYTES:] = raw
        prefix, least, place = _least(b.gram, b.doc)
        most = np.full(len(least), np.iinfo(np.int64).min)
        np.maximum.at(most, place, b.doc)
        low = np.uint64((1 << (64 - 8 * GRAM_BYTES)) - 1)
        go_on = np.isin(prefix & ~low, wanted.view(np.uint64).ravel()) | (most > least)
        b.keep_runs(go_on[place])
        run, (left, right) = b.run_hashes(), b.digits()
        key = _run_key(b.gram, run)
        _, index, place = np.unique(key, return_index=True, return_inverse=True)
        least = np.full(len(index), NO_ID, np.int64)
        np.minimum.at(least, place, b.doc)
        return packed(texts.column("block")[0].as_py(), buckets, b.gram[index],
                     [b.gram[index], run[index], left[index], right[index], least])

    def settle(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_pylist()
        gram, run, left, right, doc, owner = unpacked(table.column("payload").to_pylist(), RUN_KINDS)
        key = _run_key(gram, run)
        _, index, place = np.unique(key, return_index=True, return_inverse=True)
        least = np.full(len(index), NO_ID, np.int64)
        np.minimum.at(least, place, doc)
        flag = np.zeros(len(index), np.uint8)
        for bit, digit in ((1, left), (2, right)):
            d, g = digit[index], gram[index]
            order = np.lexsort((d, g))
            same = (g[order][1:] == g[order][:-1]) & (d[order][1:] == d[order][:-1]) & (d[order][1:] != 0)
            flag[order] |= (np.r_[False, same] | np.r_[same, False]).astype(np.uint8) * np.uint8(bit)
        covered = np.flatnonzero(doc > least[place])
        asked = np.flatnonzero((doc == least[place]) & (flag[place] > 0))
        return replies(blocks, owner, [(0, covered, [key]), (1, asked, [key, flag[place]])])

    return send, settle


def _open_windows(b: Block, key: np.ndarray, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, hashes and documents of the windows still to be sorted at full depth."""
    asked = [p for k, p in zip(answers.column("kind").to_pylist(), answers.column("payload").to_pylist(), strict=True) if k == 1]
    wanted, flag, _ = unpacked(asked, [np.uint64, np.uint8])
    order = np.argsort(wanted)
    wanted, flag = wanted[order], flag[order]
    _, least, place = _least(key, b.doc)
    runs = np.flatnonzero(np.isin(key, wanted) & (b.doc == least[place])) if len(wanted) else np.zeros(0, np.int64)
    f = flag[np.searchsorted(wanted, key[runs])] if len(runs) else np.zeros(0, np.uint8)
    start, run = b.windows(runs, (f & 1) > 0, (f & 2) > 0)
    return start, b.hash_between(start, start + WINDOW), b.doc[run]


def full_depth(buckets: int):
    def send(texts: pa.Table, answers: pa.Table) -> pa.Table:
        b = Block(texts)
        _, key, doc = _open_windows(b, _run_key(b.gram, b.run_hashes()), answers)
        unique, least, _ = _least(key, doc)
        return packed(texts.column("block")[0].as_py(), buckets, unique, [unique, least])

    def settle(table: pa.Table) -> pa.Table:
        key, doc, owner = unpacked(table.column("payload").to_pylist(), [np.uint64, np.int64])
        _, least, place = _least(key, doc)
        return replies(table.column("block").to_pylist(), owner, [(2, np.flatnonzero(doc > least[place]), [key])])

    return send, settle


def _cut(new_text: bool):
    def cut(texts: pa.Table, answers: pa.Table) -> pa.Table:
        b = Block(texts)
        key = _run_key(b.gram, b.run_hashes())
        payloads = {k: [p for kk, p in zip(answers.column("kind").to_pylist(), answers.column("payload").to_pylist(), strict=True) if kk == k] for k in (0, 2)}
        _, least, place = _least(key, b.doc)
        gone = np.isin(key, unpacked(payloads[0], [np.uint64])[0]) | (b.doc > least[place])
        start, window, doc = _open_windows(b, key, answers)
        _, least, place = _least(window, doc)
        start = start[np.isin(window, unpacked(payloads[2], [np.uint64])[0]) | (doc > least[place])]
        edge = np.zeros(len(b.bytes) + 1, np.int32)
        for a, e in ((b.first[gone], b.last[gone] + WINDOW), (start, start + WINDOW)):
            np.add.at(edge, a, 1)
            np.add.at(edge, e, -1)
        covered = np.cumsum(edge[:-1]) > 0
        out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept_text")}
        for s, e in zip(b.starts, b.ends, strict=True):
            c = covered[s:e]
            kept = b.bytes[s:e][~c].tobytes() if c.any() else b.bytes[s:e].tobytes()
            step = np.diff(np.r_[0, c.astype(np.int8), 0])
            a, z = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
            out["n_bytes"].append(e - s)
            out["n_removed"].append(int(c.sum()))
            out["n_spans"].append(len(a))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if new_text:
                out["spans"].append([{"start": int(x), "end": int(y)} for x, y in zip(a, z, strict=True)])
                out["kept_text"].append(kept.decode("utf-8", "ignore"))
        table = texts.drop_columns(["block"]) if new_text else texts.select(["doc_id"])
        types = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}
        if new_text:
            types |= {"spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), "kept_text": pa.string()}
        for k, t in types.items():
            table = table.append_column(k, pa.array(out[k], t))
        return table

    return cut


COUNTS = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
OWN = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept_text")


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Remove every byte covered by a 50-byte string that also starts in a smaller doc_id.

    `docs` has doc_id (long) and text; NULL text is empty. With `with_text` the
    result is every column of `docs` (columns named as the result's are replaced),
    then n_bytes, n_removed, n_spans, kept_sha256, spans (byte offsets) and kept_text
    (the remaining bytes; a character that lost a byte is left out). Otherwise it
    is doc_id and the four counts. One row per input row.
    """
    total = text_bytes(docs)
    blocks = max(1, -(-total // BLOCK_BYTES))
    buckets = max(1, -(-total // ((SPAN + 1) // 2 * BUCKET_ENTRIES)))
    parts = max(1, -(-blocks // 4))
    columns = [c for c in docs.columns if c not in OWN] if with_text else ["doc_id", "text"]
    # A row without an id is dealt by its text; the order of rows plays no part.
    dealt = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.xxhash64("text"))), F.lit(blocks))
    inner = {c: c if c in ("doc_id", "text") else f"other_{i}" for i, c in enumerate(columns)}  # safe in any API
    texts = (docs.select(*[F.col(quoted(c)).alias(n) for c, n in inner.items()])
             .withColumn("block", dealt).repartition(parts, "block"))

    def reduced(sent: DataFrame, settle) -> DataFrame:
        return sent.repartition(max(1, min(buckets, parts)), "bucket").groupBy("bucket").applyInArrow(_tidy(settle), REPLY)

    def asked(answers: DataFrame, fn, schema: str) -> DataFrame:
        return texts.groupBy("block").cogroup(answers.repartition(parts, "block").groupBy("block")).applyInArrow(_tidy(fn), schema)

    send, settle = first_digit(buckets)
    grams = reduced(texts.groupBy("block").applyInArrow(_tidy(send), SENT), settle)
    send, settle = second_digit(buckets)
    runs = reduced(asked(grams, send, SENT), settle)
    send, settle = full_depth(buckets)
    windows = reduced(asked(runs, send, SENT), settle)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = (", ".join(f"{n} {kinds[c]}" for c, n in inner.items()) + f", {COUNTS}, "
              "spans array<struct<start:bigint,end:bigint>>, kept_text string") if with_text else f"doc_id bigint, {COUNTS}"
    cut = asked(runs.unionByName(windows), _cut(with_text), schema)
    names = {n: c for c, n in inner.items()}
    return cut.select(*[F.col(n).alias(names.get(n, n)) for n in cut.columns])
