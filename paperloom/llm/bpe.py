"""Byte-level BPE: encoding and decoding in padded numpy matrices.

Pieces (matches of the pattern) that a worker has not met before are put into matrices by length.  In each round every
row merges its leftmost pair of least rank, found in a hash table of all mergeable pairs, and closes the gap;
rows without a mergeable pair leave the matrix.  Pieces beyond ``MATRIX_BYTES`` go through a heap, which merges in
the same order without a round per merge over the whole row.

Texts are cut a block at a time where no match of the pattern goes on, and every distinct chunk is cut by the pattern and encoded once; known
chunks are remembered, and beyond a fixed number of them the older half is forgotten.  Besides a text and its ids, memory does not follow its length.

Defined results: a null text counts as empty and has no ids; repeated rows give repeated results; an empty table
gives an empty table; a column that is to be kept must not be named ``ids`` or ``decoded``.
"""

from __future__ import annotations

import base64
import heapq
import itertools

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from paperloom.llm.arrow import enter, get_file, joined, small_batches
from paperloom.llm.tokenbin import Chunked, _meets

MATRIX_BYTES = 256
MATRIX_CELLS = 1 << 19
#: Chunks that a worker remembers.
REMEMBERED = 1_000_000
#: Text that is encoded at a time.
BATCH_BYTES = 1 << 22
#: The pattern of which it is known that letters, digits and marks are matched apart.
PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = np.uint32(0xFFFFFFFF)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file's lines of base64 and number."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class PairTable:
    """(left id, right id) to the rank of both together, by open addressing."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.mask = np.uint64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, _EMPTY)
        self.values = np.full(1 << self.bits, _NONE, np.uint32)
        self.direct = dict(zip(keys, values))
        wanted, ranked = np.array(keys, np.uint64), np.array(values, np.uint32)
        at = self._slot(wanted)
        while wanted.size:
            free = self.keys[at] == _EMPTY
            self.keys[at[free]] = wanted[free]
            placed = self.keys[at] == wanted
            self.values[at[placed]] = ranked[placed]
            wanted, ranked, at = wanted[~placed], ranked[~placed], at[~placed] + np.uint64(1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return keys * _SPREAD >> np.uint64(64 - self.bits)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, the largest number where it cannot be merged."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        at = self._slot(keys)
        met = self.keys[at]
        out = np.where(met == keys, self.values[at], _NONE)
        open_ = np.flatnonzero((met != keys) & (met != _EMPTY))
        while open_.size:
            at[open_] = at[open_] + np.uint64(1) & self.mask
            met = self.keys[at[open_]]
            hit = met == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (met != _EMPTY)]
        return out


class ByteBpe(Chunked):
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__(np.dtype("<u4"), _meets(pattern == PLAIN))
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.uint32)
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.token_bytes = pa.array(self.tokens, pa.binary())

    def _most(self) -> int:
        return REMEMBERED

    def _matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of about one length."""
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths.max())
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        used = np.arange(width) < lengths[:, None]
        ids = np.where(used, self.byte_ids[data], _NONE)
        ranks = np.full((len(pieces), width), _NONE, np.uint32)
        if width > 1:
            both = used[:, 1:]
            ranks[:, :-1][both] = self.pairs.ranks(ids[:, :-1][both], ids[:, 1:][both])
        out: list = [None] * len(pieces)
        rows = np.arange(len(pieces))
        while rows.size:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(rows.size), at]
            done = best == _NONE
            if done.any():
                for i in np.flatnonzero(done):
                    row = ids[i]
                    out[rows[i]] = row[row != _NONE]
                rows, ids, ranks, at, best = (x[~done] for x in (rows, ids, ranks, at, best))
                if not rows.size:
                    break
            n, here = ids.shape[1], np.arange(rows.size)
            source = np.arange(n - 1) + (np.arange(n - 1) > at[:, None])
            ids = np.take_along_axis(ids, source, 1)
            # The pair right of the merged one starts where the merged one started.
            ranks = np.take_along_axis(ranks, np.arange(n - 1) + (np.arange(n - 1) >= at[:, None]), 1)
            ids[here, at] = best
            for left in (at - 1, at):
                ok = np.flatnonzero((left >= 0) & (left + 1 < n - 1))
                l, r = ids[ok, left[ok]], ids[ok, np.minimum(left[ok] + 1, n - 2)]
                ranks[ok, left[ok]] = np.where(r == _NONE, _NONE, self.pairs.ranks(l, r))
            ranks[:, -1] = _NONE
        return out

    def _heap(self, piece: bytes) -> np.ndarray:
        """The same merges, in the same order, for one long piece."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n, pairs = len(ids), self.pairs.direct
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or pairs.get(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else n
                if b < n and (r := pairs.get(ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return np.array([x for x in ids if x >= 0], np.uint32)

    def _merge(self, pieces: list[bytes]) -> list[bytes]:
        """Little-endian ids of distinct pieces."""
        out: list = [None] * len(pieces)
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
        group: list[int] = []

        def flush() -> None:
            if group:
                for i, ids in zip(group, self._matrix([pieces[i] for i in group])):
                    out[i] = ids.astype("<u4").tobytes()
                group.clear()

        for i in order:
            whole = self.ranks.get(pieces[i])
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(pieces[i]) > MATRIX_BYTES:
                out[i] = self._heap(pieces[i]).astype("<u4").tobytes()
            else:
                n = len(pieces[i])
                if group and (n > len(pieces[group[0]]) * 5 // 4 + 1 or n * len(group) > MATRIX_CELLS):
                    flush()
                group.append(i)
        flush()
        return out

    def _learn(self, new: list[bytes]) -> None:
        split = [self.pattern.findall(c.decode()) for c in new]
        pieces = list(set(itertools.chain.from_iterable(split)))
        ids = dict(zip(pieces, self._merge([p.encode() for p in pieces])))
        self.known.update(zip(new, (ids[s[0]] if len(s) == 1 else b"".join(map(ids.__getitem__, s)) for s in split)))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        return super().encode(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)

    def decode(self, ids: bytes) -> bytes:
        return self.decode_all(ids, np.array([0, len(ids) // 4]))[0].as_py()

    def decode_all(self, ids: bytes, before: np.ndarray) -> pa.Array:
        """The bytes that ids stand for, of each text; ``before``: how many ids stand before each and at the end."""
        taken = self.token_bytes.take(pa.array(np.frombuffer(ids, "<u4")))
        data, starts = joined(taken)
        return _values(data, starts[before])


def _values(data: bytes | np.ndarray, starts: np.ndarray) -> pa.Array:
    """Binary values that stand one after another, from where each starts and the last one ends."""
    places = pa.py_buffer(np.ascontiguousarray(starts, np.int64))
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, places, pa.py_buffer(data)])
    return whole.cast(pa.binary())


_MODELS: dict[tuple[str, str], ByteBpe] = {}


def _model(name: str, pattern: str, data: bytes) -> ByteBpe:
    """One model per worker process and vocabulary."""
    if (name, pattern) not in _MODELS:
        _MODELS[name, pattern] = ByteBpe(read_ranks(data), pattern)
    return _MODELS[name, pattern]


def _forget_models() -> None:
    _MODELS.clear()


def encode_texts(docs: DataFrame, rank_file: str, pattern: str, keep: list[str], decode: bool = False) -> DataFrame:
    """``keep`` columns with ``ids`` (binary, little-endian unsigned 32-bit) of the column text.

    ``decode`` adds ``decoded``, the bytes that the ids stand for.  The driver reads the rank
    file; its size is that of the vocabulary.
    """
    spark = docs.sparkSession
    data = spark.sparkContext.broadcast(get_file(rank_file))

    def run(batches):
        enter("bpe", _forget_models)
        model = _model(rank_file, pattern, data.value)
        for batch in small_batches(batches, "_text", BATCH_BYTES, 1 << 16):
            ids, before = model.lay_out(batch.column("_text"))
            columns = [batch.column(c) for c in keep] + [_values(ids, 4 * before)]
            if decode:
                columns.append(model.decode_all(ids, before))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "ids", *["decoded"] * decode])

    rows = docs.select(*keep, F.col("text").alias("_text"))
    fields = [rows.schema[c] for c in keep] + [T.StructField(c, T.BinaryType()) for c in ("ids", *["decoded"] * decode)]
    return rows.mapInArrow(run, T.StructType(fields))
