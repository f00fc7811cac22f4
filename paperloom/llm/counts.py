"""Token counts of texts without their token ids.

Each block of texts (about ``BLOCK_BYTES``) is cut into pre-tokens.  Per document only the frequencies of its distinct
pre-tokens are kept, as places in a list of the block's distinct pre-tokens.  These lists are dealt into buckets by a hash of the pre-token and
shuffled by bucket, so that the tokenizer library meets every distinct pre-token of the corpus once and only its number of
pieces goes on.  The numbers return to their blocks, where they are joined to the frequencies and summed.

A pre-token that is in every document is in the shuffle once per block, never once per document.  What a task holds is one block, or the distinct
pre-tokens of one bucket; there are the more buckets the more partitions the texts have.  The cut texts are written once to the shared folder; nothing is collected or broadcast but
the tokenizer's file.

Defined results: a null or empty text has 0 tokens; a string of a special token inside a text is one token, as
the library takes it by default; repeated rows give repeated results; a text is counted whole however long, cut and counted
in stretches; an empty table gives an empty table; ``into`` must not be the name of a kept column; further
columns of any name do not matter.
"""

from __future__ import annotations

import json
import math
import os
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from paperloom.llm.arrow import chunks, enter, get_file, small_batches, stretches
from paperloom.llm.common import stage

#: Text whose pre-tokens are listed together.
BLOCK_BYTES = 8 << 20
# Fixed value: how byte-level tokenizers cut a text before merging.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# --- numbers as bytes ---------------------------------------------------------


def pack_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of seven bits each, low ones first, and the place where each number ends."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), np.int64)
    for bits in range(7, 64, 7):
        size += values >= np.uint64(1 << bits)
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for i in range(int(size.max(initial=0))):
        on = np.flatnonzero(size > i)
        part = values[on] >> np.uint64(7 * i) & np.uint64(127)
        out[ends[on] - size[on] + i] = part | (size[on] > i + 1) * np.uint64(128)
    return out, ends


def unpack_numbers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers, and the place where each ends."""
    ends = np.flatnonzero(data < 128) + 1
    starts = np.concatenate([[0], ends])[:-1].astype(np.int64)
    place = np.arange(len(data)) - np.repeat(starts, ends - starts)
    parts = (data & np.uint8(127)).astype(np.int64) << (7 * place)
    return (np.add.reduceat(parts, starts) if len(ends) else np.zeros(0, np.int64)), ends


# --- pre-tokens ---------------------------------------------------------------


class PreTokens:
    """How a byte-level tokenizer file cuts texts: at special tokens first, then by its pattern.

    Characters from U+0530 on are cut by the library itself, since pattern engines may know other characters there.
    """

    def __init__(self, data: str):
        from tokenizers import Tokenizer

        said = json.loads(data)
        cut = said["pre_tokenizer"] or {}
        if cut.get("type") != "ByteLevel" or not cut.get("use_regex") or cut.get("add_prefix_space") or said["normalizer"]:
            raise ValueError("not a plain byte-level tokenizer")
        added = said["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that take in what stands around them")
        strings = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, strings)) + ")") if strings else None
        self.strings = strings
        self.pattern = regex.compile(BYTE_LEVEL)
        self.library = Tokenizer.from_str(data).pre_tokenizer

    def chunks(self, text: str) -> Counter:
        """Frequencies of chunks, which are cut into pre-tokens apart from each other."""
        met = Counter()
        special = self.special is not None and any(s in text for s in self.strings)
        for part in self.special.split(text) if special else [text]:
            if special and part in self.strings:
                met[part] += 1
            elif len(part) <= 1 << 20:
                met.update(chunks(part))
            else:
                for stretch in stretches(part):
                    met.update(chunks(stretch))
        return met

    def cut(self, chunk: str) -> list[str]:
        if chunk in self.strings:
            return [chunk]
        if chunk.isascii() or max(chunk) < "\u0530":
            return self.pattern.findall(chunk)
        return [chunk[a:b] for _, (a, b) in self.library.pre_tokenize_str(chunk)]


def frequencies(texts: list[str], cutter: PreTokens, buckets: int = 1) -> tuple[list[list[bytes]], list[bytes]]:
    """The distinct pre-tokens of some texts by bucket; per text its (place in that order, times), ascending, as bytes."""
    places: dict[str, int] = {}
    known: dict[str, int] = {}
    spans: list[list[int]] = []
    held, times, sizes = [], [], []
    for text in texts:
        met = cutter.chunks(text)
        for chunk in [c for c in met if c not in known]:
            known[chunk] = len(spans)
            spans.append([places.setdefault(p, len(places)) for p in cutter.cut(chunk)])
        held.append(np.fromiter(map(known.__getitem__, met), np.int64, len(met)))
        times.append(np.fromiter(met.values(), np.int64, len(met)))
        sizes.append(len(met))
    if not spans:
        return [[] for _ in range(buckets)], [b""] * len(texts)
    pieces = [p.encode() for p in places]
    bucket = np.fromiter((crc32(p) % buckets for p in pieces), np.int64, len(pieces))
    by_bucket = np.argsort(bucket, kind="stable")
    rank = np.empty(len(pieces), np.int64)
    rank[by_bucket] = np.arange(len(pieces))
    edges = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1)).tolist()
    dealt = [[pieces[i] for i in by_bucket[a:b]] for a, b in zip(edges[:-1], edges[1:])]
    # Chunks become the pre-tokens in them; equal ones of a text are added up.
    width = np.array([len(s) for s in spans])
    first = np.cumsum(width) - width
    flat = rank[np.fromiter((p for s in spans for p in s), np.int64, int(width.sum()))]
    chunk, count = np.concatenate(held), np.concatenate(times)
    owner = np.repeat(np.arange(len(texts)), sizes)
    n = width[chunk]
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    key = np.repeat(owner, n) * len(places) + flat[np.repeat(first[chunk], n) + inside]
    order = np.argsort(key, kind="stable")
    key, count = key[order], np.repeat(count, n)[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    total = np.add.reduceat(count, new)
    owner, place = np.divmod(key[new], len(places))
    # Places of a text as steps from one to the next.
    step = np.diff(place, prepend=0)
    opens = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    step[opens] = place[opens]
    data, ends = pack_numbers(np.stack([step, total], 1).ravel())
    ends = np.concatenate([[0], ends])
    edge = ends[2 * np.searchsorted(owner, np.arange(len(texts) + 1))]
    whole = data.tobytes()
    return dealt, [whole[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]


def add_up(parts: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Per text the sum of times x size over its (place, times)."""
    lengths = np.array([len(p) for p in parts], np.int64)
    numbers, ends = unpack_numbers(np.frombuffer(b"".join(parts), np.uint8))
    pairs = numbers.reshape(-1, 2)
    # A text's pairs, from the bytes in which they end.
    edge = np.concatenate([[0], np.searchsorted(ends, np.cumsum(lengths), side="right")]) // 2
    steps = np.concatenate([[0], np.cumsum(pairs[:, 0])])
    owner = np.repeat(np.arange(len(parts)), np.diff(edge))
    place = steps[1:] - steps[edge[:-1]][owner]
    out = np.concatenate([[0], np.cumsum(pairs[:, 1] * sizes[place])])
    return out[edge[1:]] - out[edge[:-1]]


def count_tokens(docs: DataFrame, tokenizer_file: str, keep: list[str], into: str = "n_tokens") -> DataFrame:
    """``keep`` columns with the number of tokens of the column text by a byte-level tokenizer file of the
    tokenizers library, without tokens added around the text, without truncation or padding."""
    if into in keep:
        raise ValueError(f"{into} is the name of a kept column")
    file = docs.sparkSession.sparkContext.broadcast(get_file(tokenizer_file))
    names = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)], F.col("text").alias("_text"))
    kept = [T.StructField(n, rows.schema[n].dataType) for n in names]
    buckets = 32 * math.isqrt(max(1, docs.rdd.getNumPartitions()))
    cut_schema = T.StructType(
        [T.StructField("_block", T.LongType()), *kept, T.StructField("_times", T.BinaryType())]
        + [T.StructField("_bucket", T.IntegerType())]
        + [T.StructField(c, T.BinaryType()) for c in ("_lengths", "_letters")]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("counts")
        cutter = PreTokens(file.value.decode())
        block = TaskContext.get().partitionId() << 32
        for batch in small_batches(batches, "_text", BLOCK_BYTES, 1 << 16):
            dealt, times = frequencies([t or "" for t in batch.column("_text").to_pylist()], cutter, buckets)
            n = batch.num_rows
            columns = [batch.column(c) for c in names]
            none = [pa.nulls(n, t) for t in (pa.int32(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block)), *columns, pa.array(times, pa.binary()), *none], names=cut_schema.names
            )
            used = [i for i, pieces in enumerate(dealt) if pieces]
            lengths = [pack_numbers(np.array([len(p) for p in dealt[i]]))[0].tobytes() for i in used]
            letters = [b"".join(dealt[i]) for i in used]
            m = len(used)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, block)), *[pa.nulls(m, c.type) for c in columns], pa.nulls(m, pa.binary())]
                + [pa.array(used, pa.int32()), pa.array(lengths, pa.binary()), pa.array(letters, pa.binary())],
                names=cut_schema.names,
            )
            block += 1

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces per pre-token; the lists of a bucket come one after the other."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        library = Tokenizer.from_str(file.value.decode())
        library.no_truncation()
        library.no_padding()
        library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        current, known = None, {}
        for batch in batches:
            blocks, own, lengths, letters = (batch.column(c).to_pylist() for c in ("_block", "_bucket", "_lengths", "_letters"))
            out = []
            for bucket, sizes, data in zip(own, lengths, letters):
                if bucket != current:
                    current, known = bucket, {}
                ends = np.cumsum(unpack_numbers(np.frombuffer(sizes, np.uint8))[0]).tolist()
                pieces = [data[a:b] for a, b in zip([0, *ends], ends)]
                fresh = [p for p in pieces if p not in known]
                for i in range(0, len(fresh), 4096):
                    some = fresh[i : i + 4096]
                    found = library.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)
                    known.update(zip(some, map(len, found)))
                numbers = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
                out.append(pack_numbers(numbers)[0].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_block"), batch.column("_bucket"), pa.array(out, pa.binary())], names=["_block", "_bucket", "_sizes"]
            )

    out_schema = T.StructType([*kept, T.StructField("_sum", T.LongType())])

    def total(texts: pa.Table, pieces: pa.Table) -> pa.Table:
        by_bucket = pieces.sort_by("_bucket").column("_sizes").to_pylist()
        sizes, _ = unpack_numbers(np.frombuffer(b"".join(by_bucket), np.uint8))
        sums = add_up(texts.column("_times").to_pylist(), sizes)
        return pa.table([*[texts.column(c) for c in names], pa.array(sums, pa.int64())], names=out_schema.names)

    made = stage(rows.mapInArrow(cut, cut_schema), "pre-tokens")
    listed = made.where(F.col("_bucket").isNotNull()).select("_block", "_bucket", "_lengths", "_letters")
    by_bucket = listed.repartition("_bucket").sortWithinPartitions("_bucket")
    sized = by_bucket.mapInArrow(size, "_block bigint, _bucket int, _sizes binary")
    texts = made.where(F.col("_bucket").isNull()).select("_block", *names, "_times")
    summed = texts.groupBy("_block").cogroup(sized.groupBy("_block")).applyInArrow(total, out_schema)
    return summed.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], F.col("_sum").alias(into))
