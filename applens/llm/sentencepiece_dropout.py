"""Operator 6: SentencePiece BPE encoding and decoding with seeded merge-dropout.

A text is written as the model's normaliser would (a word mark in front and for every blank) and
cut before each run of word marks: no piece of such a vocabulary goes on past one, so no merge
crosses the cuts. Inside a chunk an agenda holds the candidate merges, best score first,
then leftmost. A candidate is skipped if the keyed hash of (seed, variant, its two
pieces) falls below the dropout rate: merges are dropped by type, and what is built on them
takes other ways. The variant is the crc32 of doc_id and seed: every document has merges dropped of its own,
the same text and id always in the same way.

A slice of documents is merged at once: the chunks of a length are rows of a matrix of symbols, every row with the key
of its document, and a step makes the best merge of every row that has one left. Candidates are
looked up in a table of all pairs of symbols that make a piece; a chunk that a document repeats is one row.

Without dropout the ids are the library's. Characters that the vocabulary lacks, and a word mark that
the text itself holds, become byte pieces, so decoding gives back the exact text.
A NULL text has no ids and decodes to NULL.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applens.llm.common import mix, quoted

MARK = "▁"
PAIRS = 200_000          # pairs whose score and hash a worker remembers
SLOTS = 20               # bits of a slot number in the table of pairs
SHORT = 24               # characters of a chunk whose agenda is a plain list
NONE = float("-inf")
ROW_CHARS = 64           # longer chunks are merged by themselves
SLICE, SLICE_CHARS = 512, 1 << 20
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


_M64 = (1 << 64) - 1


def _mix(x: int) -> int:
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _M64
    x = (x ^ x >> 27) * 0x94D049BB133111EB & _M64
    return x ^ x >> 31


def _hash(key: str) -> int:
    return int.from_bytes(hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def pair_hash(left: str, right: str) -> int:
    return _hash(f"{len(left)}:{left}{right}")


def skipped(seed: int, variant: int, left: str, right: str, rate: float) -> bool:
    """Whether this type of merge is dropped: a keyed hash against the rate."""
    return _mix(pair_hash(left, right) ^ _hash(f"{seed}:{variant}")) < rate * 2.0 ** 64


class Merges(dict):
    """(left, right) to the merged piece's score, NONE if there is none or it is dropped; filled as pairs are met.

    `known` holds scores and hashes of pairs and may be shared by all documents.
    """

    def __init__(self, score: dict[str, float], seed: int, variant: int, rate: float, known: dict | None = None):
        super().__init__()
        self.score, self.key, self.below = score, _hash(f"{seed}:{variant}"), rate * 2.0 ** 64
        self.known = {} if known is None else known

    def __missing__(self, pair: tuple[str, str]) -> float:
        entry = self.known.get(pair)
        if entry is None:
            found = self.score.get(pair[0] + pair[1], NONE)
            entry = found, 0 if found == NONE else pair_hash(*pair)
            if len(self.known) < PAIRS:
                self.known[pair] = entry
        found = entry[0]
        if found != NONE and self.below > 0 and _mix(entry[1] ^ self.key) < self.below:
            found = NONE
        if len(self) < PAIRS:
            self[pair] = found
        return found


class Vocabulary:
    """The pieces of a byte-fallback BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.byte_id = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        plain = [i for i in range(len(self.pieces)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.id = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: model.get_score(i) for i in plain}
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece goes on past a word mark: chunks can't be cut before it")
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte pieces")
        space = [p.replace(MARK, " ").encode("utf-8") for p in self.pieces]
        self.bytes_of = [bytes((self.byte_of[i],)) if i in self.byte_of else b for i, b in enumerate(space)]
        self.pairs: dict[tuple[str, str], tuple[float, int]] = {}
        self.mark = [self.byte_id[b] for b in MARK.encode()]
        self.pairs_table: Pairs | None = None

    def chunk(self, chunk: str, merges: Merges) -> tuple[int, ...]:
        """Ids of a chunk: merge the best candidate, leftmost first, until none is left."""
        return self.ids((self._merged_by_agenda if len(chunk) > SHORT else self._merged)(chunk, merges))

    def ids(self, symbols: list[str]) -> tuple[int, ...]:
        try:
            return tuple(map(self.id.__getitem__, symbols))
        except KeyError:  # a character that the vocabulary lacks
            return tuple(x for s in symbols for x in (
                (self.id[s],) if s in self.id else map(self.byte_id.__getitem__, s.encode("utf-8", "surrogatepass"))))

    @staticmethod
    def _merged(chunk: str, merges: Merges) -> list[str]:
        """A short chunk: its agenda is a plain list, one score for each pair."""
        symbols = list(chunk)
        scores = list(map(merges.__getitem__, zip(symbols, symbols[1:])))
        while scores:
            best = max(scores)
            if best == NONE:
                break
            i = scores.index(best)
            merged = symbols[i] + symbols[i + 1]
            symbols[i] = merged
            del symbols[i + 1], scores[i]
            if i:
                scores[i - 1] = merges[symbols[i - 1], merged]
            if i < len(scores):
                scores[i] = merges[merged, symbols[i + 1]]
        return symbols

    @staticmethod
    def _merged_by_agenda(chunk: str, merges: Merges) -> list[str]:
        """A long chunk: a heap of candidates over linked symbols."""
        symbols: list[str | None] = list(chunk)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[float, int, str, str]] = []

        def offer(i: int) -> None:
            if after[i] < n:
                score = merges[symbols[i], symbols[after[i]]]
                if score != NONE:
                    heapq.heappush(agenda, (-score, i, symbols[i], symbols[after[i]]))

        for i in range(n - 1):
            offer(i)
        while agenda:
            _, i, left, right = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = left + right, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [s for s in symbols if s is not None]

    def encode(self, text: str, seed: int = 0, variant: int = 0, rate: float = 0.0) -> list[int]:
        """Ids of one text, chunk by chunk."""
        merges = Merges(self.score, seed, variant, rate, self.pairs)
        known: dict[str, tuple[int, ...]] = {}
        ids: list[int] = []
        for c in self._chunks(text):
            if c is None:
                ids += self.mark
            else:
                if c not in known:
                    known[c] = self.chunk(c, merges)
                ids += known[c]
        return ids

    @staticmethod
    def _chunks(text: str) -> list[str | None]:
        """The chunks of a text; None is a word mark of the text itself: its bytes, which decode to no blank."""
        if not text:
            return []
        if MARK not in text:
            return _CHUNK.findall(MARK + text.replace(" ", MARK))
        out: list[str | None] = []
        for n, own in enumerate(text.split(MARK)):
            out += [None] * (n > 0) + _CHUNK.findall((MARK if n == 0 else "") + own.replace(" ", MARK))
        return out

    def encode_all(self, texts: list[str], keys: list[str], rate: float) -> Iterator[np.ndarray]:
        """Ids of texts (as `encode`), each with the key "seed:variant", some texts at a time."""
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= SLICE_CHARS):
                chars += len(texts[end])
                end += 1
            yield from self._encode_some(texts[at:end], keys[at:end], rate)
            at = end

    def _encode_some(self, texts: list[str], keys: list[str], rate: float) -> Iterator[np.ndarray]:
        if self.pairs_table is None:
            self.pairs_table = Pairs(self)
        table = self.pairs_table
        chunks = Numbers()
        words, counts = [], []
        for text in texts:
            here = self._chunks(text)
            counts.append(len(here))
            words += map(chunks.__getitem__, here)
        # One row for a document and chunk.
        doc = np.repeat(np.arange(len(texts)), counts)
        rows, row_of = np.unique(doc * len(chunks) + np.array(words, np.int64), return_inverse=True)
        doc, chunk = np.divmod(rows, max(1, len(chunks)))
        hashes = np.array([_hash(k) for k in keys], np.uint64)[doc]
        names = list(chunks)
        sizes = np.array([0 if c is None else len(c) for c in names], np.int64)[chunk]
        symbols = table.symbol_of[np.frombuffer("".join(c or "" for c in names).encode("utf-32-le", "surrogatepass"), np.uint32)]
        first = np.r_[0, np.cumsum([0 if c is None else len(c) for c in names])[:-1]].astype(np.int64)[chunk] if names else chunk
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # row numbers, lengths, symbols one after the other
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            if size == 0:
                parts.append((own, np.ones(len(own), np.int64), np.full(len(own), table.base + ord(MARK))))
            elif size > ROW_CHARS:
                for r in own.tolist():
                    ids = self.chunk(names[chunk[r]], Merges(self.score, *map(int, keys[doc[r]].split(":")), rate, self.pairs))
                    parts.append((np.array([r]), np.array([len(ids)]), np.array(ids)))
            else:
                parts += table.merged(own, symbols[first[own][:, None] + np.arange(size)], hashes[own], rate)
        flat, lengths = _ordered(parts, len(rows))
        flat, lengths = table.as_ids(flat, lengths, self.byte_id)
        lengths, flat = lengths[row_of], _gathered(flat, lengths, row_of)
        bounds = np.r_[0, np.cumsum(lengths)][np.r_[0, np.cumsum(counts)].astype(np.int64)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield flat[a:b]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


class Numbers(dict):
    """Values numbered in the order in which they are first asked for."""

    def __missing__(self, value) -> int:
        n = self[value] = len(self)
        return n


def _gathered(flat: np.ndarray, lengths: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The stretches of `rows`, one after the other, of stretches of those lengths that lie one after the other."""
    start = (np.cumsum(lengths) - lengths)[rows]
    n = lengths[rows]
    return flat[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _ordered(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of symbols in the order of their rows, and their lengths."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, lengths, flat = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.argsort(rows, kind="stable")
    return _gathered(flat, lengths, order), lengths[order]


class Pairs:
    """All pairs of symbols that make a piece. A symbol is a piece's id, or `base` + code point of a character without
    one. Ranks order the pieces by score, the best first; equal scores have the same rank."""

    def __init__(self, vocab: Vocabulary):
        self.base = len(vocab.pieces)
        self.symbol_of = np.arange(0x110000, dtype=np.int64) + self.base
        for piece, i in vocab.id.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        rank_of = {v: i for i, v in enumerate(sorted(set(vocab.score.values()), reverse=True))}
        symbol = lambda s: vocab.id.get(s, self.base + ord(s) if len(s) == 1 else None)
        made = []
        for piece, i in vocab.id.items():
            for k in range(1, len(piece)):
                left, right = symbol(piece[:k]), symbol(piece[k:])
                if left is not None and right is not None:
                    made.append((left << 21 | right, rank_of[vocab.score[piece]], i, pair_hash(piece[:k], piece[k:])))
        made.sort()
        self.key = np.array([m[0] for m in made] + [-1], np.int64)
        self.rank = np.array([m[1] for m in made], np.int32)
        self.piece = np.array([m[2] for m in made], np.int32)
        self.hash = np.array([m[3] for m in made], np.uint64)
        # The first key of a slot lies in it; the others of the slot are searched for.
        slot = self._slot(self.key[:-1])
        self.slot_pair = np.full(1 << SLOTS, len(made), np.int32)
        taken, at = np.unique(slot, return_index=True)
        self.slot_pair[taken] = at
        self.shared = np.bincount(slot, minlength=1 << SLOTS) > 1
        self.none = np.int32(len(rank_of))

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOTS)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray, key: np.ndarray, least_kept: int) -> tuple[np.ndarray, np.ndarray]:
        """The rank and the piece that merging each pair makes; rank `none` if nothing, or if the document of that key drops it."""
        pair = left << 21 | right
        slot = self._slot(pair)
        at = self.slot_pair[slot]
        found = self.key[at] == pair
        more = np.flatnonzero(~found & self.shared[slot])
        if len(more):
            at[more] = np.searchsorted(self.key[:-1], pair[more])
            found[more] = self.key[at[more]] == pair[more]
        rank, piece = np.full(len(pair), self.none, np.int32), np.zeros(len(pair), np.int32)
        hit = np.flatnonzero(found)
        at = at[hit]
        if least_kept:
            kept = mix(self.hash[at] ^ key[hit]) >= np.uint64(min(least_kept, (1 << 64) - 1))
            if least_kept >= 1 << 64:
                kept[:] = False
            hit, at = hit[kept], at[kept]
        rank[hit], piece[hit] = self.rank[at], self.piece[at]
        return rank, piece

    def merged(self, rows: np.ndarray, symbols: np.ndarray, key: np.ndarray, rate: float):
        """Merge rows of one length until none has a candidate left: (row numbers, lengths, symbols) by final length."""
        least_kept = math.ceil(rate * 2.0 ** 64)
        out = []
        n, size = symbols.shape
        rank, piece = self.ranks(symbols[:, :-1].ravel(), symbols[:, 1:].ravel(), np.repeat(key, size - 1), least_kept)
        rank, piece = rank.reshape(n, size - 1), piece.reshape(n, size - 1)
        while True:
            size = symbols.shape[1]
            best = rank.min(axis=1) if size > 1 else np.full(len(rows), self.none)
            done = best == self.none
            if done.any():
                out.append((rows[done], np.full(int(done.sum()), size), symbols[done].ravel()))
                go = ~done
                rows, symbols, key, rank, piece = rows[go], symbols[go], key[go], rank[go], piece[go]
            if not len(rows):
                return out
            at = rank.argmin(axis=1)  # the leftmost of equals
            each = np.arange(len(rows))
            made = piece[each, at].astype(np.int64)
            symbols[each, at] = made
            symbols = symbols[np.arange(size) != at[:, None] + 1].reshape(len(rows), size - 1)
            rest = np.arange(size - 1) != at[:, None]
            rank, piece = rank[rest].reshape(len(rows), size - 2), piece[rest].reshape(len(rows), size - 2)
            before, after = np.flatnonzero(at > 0), np.flatnonzero(at < size - 2)
            new = self.ranks(np.r_[symbols[before, at[before] - 1], made[after]], np.r_[made[before], symbols[after, at[after] + 1]],
                             np.r_[key[before], key[after]], least_kept)
            for matrix, values in ((rank, new[0]), (piece, new[1])):
                matrix[before, at[before] - 1] = values[:len(before)]
                matrix[after, at[after]] = values[len(before):]

    def as_ids(self, flat: np.ndarray, lengths: np.ndarray, byte_id: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as the ids of their bytes."""
        odd = np.flatnonzero(flat >= self.base)
        if not len(odd):
            return flat, lengths
        spelt = [[byte_id[b] for b in chr(c - self.base).encode("utf-8", "surrogatepass")] for c in flat[odd].tolist()]
        many = np.ones(len(flat), np.int64)
        many[odd] = [len(x) for x in spelt]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        out = np.repeat(flat, many)
        out[np.repeat(flat >= self.base, many)] = [b for x in spelt for b in x]
        return out, np.bincount(owner, many, len(lengths)).astype(np.int64)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per worker."""
    return Vocabulary(path)


def variant_of(doc_id: int | None, seed: int) -> int:
    """Of each document its own."""
    return zlib.crc32(f"{doc_id}:{seed}".encode())


RESULT = {"n_pieces": "bigint", "ids_crc32": "bigint", "lossless": "boolean"}


def encode(docs: DataFrame, path: str, seed: int = 1, rate: float = 0.1, with_ids: bool = True) -> DataFrame:
    """n_pieces, ids_crc32 (unsigned, of little-endian 32-bit ids), lossless (the ids decode to the text) and
    ids of every whole text, after all columns of `docs` (those named as the result's are replaced);
    without `with_ids` after doc_id alone and without the ids."""
    result = RESULT | ({"ids": "array<int>"} if with_ids else {})
    kept = [c for c in docs.columns if c not in result] if with_ids else ["doc_id", "text"]
    names = [c if c in ("doc_id", "text") else f"other_{i}" for i, c in enumerate(kept)]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32())]

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                out: list[list] = [[] for _ in result]
                doc_ids = part.column(names.index("doc_id")).to_pylist()
                texts = part.column(names.index("text")).to_pylist()
                own = [i for i, t in enumerate(texts) if t is not None]
                found = dict(zip(own, vocab.encode_all([texts[i] for i in own], [f"{seed}:{variant_of(doc_ids[i], seed)}" for i in own], rate)))
                for i, text in enumerate(texts):
                    ids = found.get(i)
                    row = (0, 0, None, None) if ids is None else (
                        len(ids), zlib.crc32(ids.astype("<u4").tobytes()), vocab.decode(ids.tolist()) == text, ids)
                    for o, v in zip(out, row, strict=False):
                        o.append(v)
                columns = list(part.columns) if with_ids else [part.column(0)]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(o, t) for o, t in zip(out, types, strict=False)],
                                                 names=[*(names if with_ids else names[:1]), *result])

    head = [f"{n} {kinds[c]}" for n, c in zip(names, kept, strict=True)] if with_ids else ["doc_id bigint"]
    schema = ", ".join(head + [f"{n} {t}" for n, t in result.items()])
    out = docs.select(*[F.col(quoted(c)).alias(n) for n, c in zip(names, kept, strict=True)]).mapInArrow(run, schema)
    back = dict(zip(names, kept, strict=True))
    return out.select(*[F.col(n).alias(back.get(n, n)) for n in out.columns])


def decode(tokens: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Every column of `tokens` and the text of its ids (NULL for NULL)."""
    kept = [c for c in tokens.columns if c != into]
    names = [f"c{i}" for i in range(len(kept))]
    kinds = {f.name: f.dataType.simpleString() for f in tokens.schema}

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            text = [None if x is None else vocab.decode(x) for x in batch.column(kept.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], names=[*names, "text"])

    schema = ", ".join(f"{n} {kinds[c]}" for n, c in zip(names, kept, strict=True)) + ", text string"
    out = tokens.select(*[F.col(quoted(c)).alias(n) for n, c in zip(names, kept, strict=True)]).mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip([*names, "text"], [*kept, into], strict=True)])
