"""Token ids in Huffman-coded files.

Ids are counted over the whole corpus; lengths of a canonical code of at most ``MAX_BITS`` bits come from package-merge over
those counts, of which there are as many as the vocabulary has ids.  Documents are split into size-balanced key ranges,
one file each.  A document starts at a byte; blocks of ``block_ids`` ids never cross documents,
and the bit offset of every block is stored, so blocks are decoded apart from each other (here
all blocks of a file side by side, one id of each per step through one lookup table).

A file: ``MAGIC``, the length of a JSON header (u32), the header, code lengths (u8 each), then per document its id
(i64), whether it has one (u8) and its number of ids (u64), per block its bit offset (u64), then the coded bits.  A file
counts once the manifest names it; a repeated task writes the same bytes under the same name.

Defined results: a null text has the end id alone; documents without an id come first; equal ids are ordered by a hash of
the text; repeated rows are repeated documents; an empty table gives no file and a manifest without rows.
"""

from __future__ import annotations

import itertools
import json
import os
import string
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.functions.literals import constant
from paperloom.llm.arrow import enter, forget, get_file, joined, put_file, small_batches
from paperloom.llm.common import new_folder
from paperloom.llm.shards import _Ranges

MAGIC = b"IDHUF001"
MANIFEST = "file string, start bigint, docs bigint, ids bigint, bytes bigint"
MAX_BITS = 16
#: Chunks that a worker remembers.
REMEMBERED = 1_500_000
#: Text that is cut at a time.
BLOCK_BYTES = 1 << 24
#: Words that the library gets in one text.
JOINED = 128


# --- the code -----------------------------------------------------------------


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Bits per symbol of an optimal prefix code of at most ``most`` bits (package-merge); 0 where the count is 0."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} symbols need more than {most} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    rows, level = [], leaves
    leaf = np.ones(len(leaves), bool)
    for _ in range(most - 1):
        rows.append(leaf)
        even = len(level) // 2 * 2
        packages = level[0:even:2] + level[1:even:2]
        both = np.concatenate([leaves, packages])
        at = np.argsort(both, kind="stable")
        level, leaf = both[at], at < len(leaves)
    rows.append(leaf)
    bits, take = np.zeros(len(leaves), np.uint8), 2 * len(leaves) - 2
    for leaf in reversed(rows):
        own = int(leaf[:take].sum())
        bits[:own] += 1
        take = 2 * (take - own)
    lengths[order] = bits
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes counted up by length, then symbol."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    bits = lengths[order].astype(np.int64)
    # Left-aligned, each code starts where the one before ends.
    width = 1 << (MAX_BITS - bits)
    codes[order] = (np.cumsum(width) - width) >> (MAX_BITS - bits)
    return codes


def pack(ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, codes: np.ndarray, block: int):
    """Coded bytes of documents with ``sizes`` ids each, and the bit offsets of their blocks within each."""
    bits = lengths[ids].astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(bits)])
    first = np.concatenate([[0], np.cumsum(sizes)])
    starts = ends[first[:-1]]
    n_bytes = (ends[first[1:]] - starts + 7) // 8
    byte_at = np.concatenate([[0], np.cumsum(n_bytes)])
    place = ends[:-1] + np.repeat(byte_at[:-1] * 8 - starts, sizes)
    words = np.zeros(byte_at[-1] // 4 + 3, np.uint32)
    if ids.size:
        word = place >> 5
        shifted = codes[ids] << (64 - (place & 31) - bits).astype(np.uint64)
        new = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        joined = np.bitwise_or.reduceat(shifted, new)
        words[word[new]] |= (joined >> np.uint64(32)).astype(np.uint32)
        words[word[new] + 1] |= (joined & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    data = words.astype(">u4").tobytes()
    coded, offsets = [], []
    for i, n in enumerate(sizes):
        coded.append(data[byte_at[i] : byte_at[i + 1]])
        offsets.append((place[first[i] : first[i] + n : block] - byte_at[i] * 8).astype("<u8").tobytes())
    return coded, offsets


def unpack(data: bytes, offsets: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ids of blocks of ``sizes`` ids that start at bit ``offsets``, one after the other."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    width = 1 << (MAX_BITS - lengths[order].astype(np.int64))
    # Symbol above its length, by the next bits; and the 24 bits from every byte on.
    entry = np.zeros(1 << MAX_BITS, np.int64)
    entry[: width.sum()] = np.repeat(order << 5 | lengths[order], width)
    padded = np.frombuffer(data + b"\0" * 4, np.uint8).astype(np.int32)
    ahead = padded[:-2] << 16 | padded[1:-1] << 8 | padded[2:]
    out = np.empty(int(sizes.sum()), np.uint32)
    into = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    by_size = np.argsort(-sizes, kind="stable")
    at, into, left = offsets[by_size].astype(np.int64), into[by_size], sizes[by_size]
    # How many blocks still have an id at each step; longer blocks stand first.
    most = int(left[0]) if len(left) else 0
    live = np.searchsorted(-left, -np.arange(most), side="left")
    for i in range(most):
        here = at[: live[i]]
        found = entry[ahead[here >> 3] >> (8 - (here & 7)) & 0xFFFF]
        out[into[: live[i]] + i] = found >> 5
        here += found & 31
    return out


# --- tokens -------------------------------------------------------------------


def _kinds() -> np.ndarray:
    """0 what is not told apart, 1 letters, 2 digits, 3 marks, 4 white space, 5 the apostrophe; for every byte."""
    kinds = np.zeros(256, np.uint8)
    kinds[0x21:0x7F] = 3
    for kind, those in ((1, string.ascii_letters), (2, string.digits), (4, "\t\n\v\f\r "), (5, "'")):
        kinds[list(those.encode())] = kind
    return kinds


def _meets(fine: bool) -> np.ndarray:
    """Whether no match of the pattern spans the place between two kinds, the one before times 8 plus the one behind."""
    met = np.zeros(48, bool)
    for one in (1, 2, 3, 5):
        met[8 * one + 4] = True
    if fine:
        # An apostrophe may belong to the letters behind it, or to the marks before it.
        for one, other in ((1, 2), (1, 3), (1, 5), (2, 1), (2, 3), (2, 5), (3, 1), (3, 2)):
            met[8 * one + other] = True
    return met


_KINDS = _kinds()


def edges(data: np.ndarray, meets: np.ndarray) -> np.ndarray:
    """For every byte of UTF-8 text whether a chunk that can be encoded apart starts there, as told from ``meets``."""
    kinds = _KINDS[data]
    # U+00C0 to U+00FF are letters but for two signs.
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kinds[lead] = kinds[lead + 1] = 1
    starts = np.ones(len(data), bool)
    starts[1:] = meets[kinds[:-1] << 3 | kinds[1:]]
    # White space behind other characters, unless these may be white space themselves.
    at = np.flatnonzero((kinds[1:] == 4) & (kinds[:-1] == 0) & (data[:-1] >= 0x80)) + 1
    three, two, one = data[at - 3], data[at - 2], data[at - 1]
    white = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    white |= (three >= 0xE1) & (three <= 0xE3) & ((two == 0x80) | (two == 0x81) | (two == 0x9A))
    starts[at[~white]] = True
    return starts


def _alphabet() -> list[str]:
    """The character by which byte-level tokenizers write each byte."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = itertools.count(0x100)
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Chunked:
    """An encoder that remembers what it has met.

    Texts are cut where no match of the encoder's pattern goes on, all places of a block of texts at once; of a block's
    distinct chunks those are encoded (by ``_learn``, into ``known``) that are not remembered, and their ids are laid out for all places.
    """

    def __init__(self, kind: np.dtype, meets: np.ndarray):
        self.kind, self.meets = kind, meets
        self.known: dict[bytes, bytes] = {}

    def _learn(self, new: list[bytes]) -> None:
        raise NotImplementedError

    def _most(self) -> int:
        """Chunks to remember."""
        return REMEMBERED

    def _ids(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks between ``places`` one after another, and how many stand before each place."""
        forget(self.known, self._most())
        ends = places.astype(np.int32)
        all_chunks = pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])
        coded = all_chunks.dictionary_encode()
        whole, at = joined(coded.dictionary)
        whole = whole.tobytes()
        distinct = [whole[a:b] for a, b in itertools.pairwise(at.tolist())]
        found = list(map(self.known.get, distinct))
        unknown = [i for i, ids in enumerate(found) if ids is None]
        self._learn([distinct[i] for i in unknown])
        for i in unknown:
            found[i] = self.known[distinct[i]]
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // self.kind.itemsize
        flat, first = np.frombuffer(b"".join(found), self.kind), np.cumsum(sizes, dtype=np.int32) - sizes
        chunk = coded.indices.to_numpy()
        many = sizes[chunk]
        upto = np.concatenate([[0], np.cumsum(many, dtype=np.int64)])
        source = np.repeat((first[chunk] - upto[:-1]).astype(np.int32), many)
        source += np.arange(len(source), dtype=np.int32)
        return flat[source], upto

    def lay_out(self, texts: pa.Array) -> tuple[bytes, np.ndarray]:
        """Ids of all texts one after another as little-endian numbers, and how many stand before each text and at the end; a null text has none."""
        data, starts = joined(texts)
        found, before, at, held = [], np.zeros(len(starts), np.int64), 0, 0
        size = BLOCK_BYTES
        while at < len(data):
            part = data[at : at + size]
            first, last = np.searchsorted(starts, [at, at + len(part)])
            cut = edges(part, self.meets)
            cut[starts[first:last] - at] = True
            places = np.flatnonzero(cut)
            if at + size >= len(data):
                places = np.append(places, len(part))
            elif len(places) < 2:
                # Not a whole chunk.
                size *= 2
                continue
            last = np.searchsorted(starts, at + places[-1])
            ids, upto = self._ids(part, places)
            before[first:last] = held + upto[np.searchsorted(places, starts[first:last] - at)]
            found.append(ids.tobytes())
            at, held, size = at + int(places[-1]), held + len(ids), BLOCK_BYTES
        before[np.searchsorted(starts, at) :] = held
        return b"".join(found), before

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian numbers; a null text has none."""
        (whole, before), size = self.lay_out(texts), self.kind.itemsize
        return [whole[size * a : size * b] for a, b in itertools.pairwise(before.tolist())]


class Tokens(Chunked):
    """A byte-level tokenizer of the tokenizers library.

    Words of letters are one match each, so the library gets many of them as one text, with a byte between them that no
    merge knows, and without its pattern.  Beyond the scripts below U+0530, where it could know other letters, it gets the chunk.
    """

    def __init__(self, data: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(data)
        self.whole.encode_special_tokens = True
        own = json.loads(data)
        splits, model = own["pre_tokenizer"], own["model"]
        plain = splits["type"] == "ByteLevel" and splits["use_regex"] and not splits["add_prefix_space"]
        super().__init__(np.dtype(f"<u{width}"), _meets(plain))
        self.words = None
        other = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if plain and model["type"] == "BPE" and own["normalizer"] is None and not any(model.get(k) for k in other):
            alphabet = _alphabet()
            merged = set().union(*itertools.chain.from_iterable(m.split(" ") if isinstance(m, str) else m for m in model["merges"]))
            # Bytes that are in no text.
            free = [b for b in (0xC0, 0xC1, *range(0xF5, 0x100)) if alphabet[b] not in merged]
            if free and model["vocab"].keys() >= set(alphabet):
                self.words = Tokenizer.from_str(json.dumps(own | {"pre_tokenizer": None, "added_tokens": []}))
                self.shown = dict(enumerate(alphabet))
                self.gap, self.gap_id = bytes(free[-1:]), model["vocab"][alphabet[free[-1]]]

    def _keep(self, chunks: list[bytes], flat: np.ndarray, starts: list[int], ends: list[int]) -> None:
        size, flat = self.kind.itemsize, flat.tobytes()
        self.known.update(zip(chunks, (flat[size * a : size * b] for a, b in zip(starts, ends))))

    def _learn(self, new: list[bytes]) -> None:
        words, others = [], []
        for chunk in new:
            text = chunk.decode()
            letters = text.removeprefix(" ").isalpha() and (text.isascii() or max(text) < "\u0530")
            (words if letters and self.words else others).append(chunk)
        for i in range(0, len(words), 256 * JOINED):
            part = words[i : i + 256 * JOINED]
            texts = [self.gap.join(part[k : k + JOINED]).decode("latin-1").translate(self.shown) for k in range(0, len(part), JOINED)]
            told = self.words.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.array(list(itertools.chain.from_iterable([*e.ids, self.gap_id] for e in told)), self.kind)
            ends = np.flatnonzero(ids == self.gap_id).tolist()
            self._keep(part, ids, [0, *(e + 1 for e in ends)], ends)
        for i in range(0, len(others), 4096):
            part = others[i : i + 4096]
            told = [e.ids for e in self.whole.encode_batch_fast([c.decode() for c in part], add_special_tokens=False)]
            ends = list(itertools.accumulate(map(len, told), initial=0))
            self._keep(part, np.array(list(itertools.chain.from_iterable(told)), self.kind), ends, ends[1:])


_TOKENS: dict[tuple[str, int], Tokens] = {}


def tokenize(docs: DataFrame, tokenizer_file: str, keep: list[str], end_id: int | None = 0, width: int = 4) -> DataFrame:
    """``keep`` columns with ``ids`` of the column text by a byte-level tokenizer file.

    ``ids`` is binary: little-endian unsigned numbers of ``width`` bytes, 2 or 4; 2 holds ids below 65,536.

    Strings of special tokens in a text are ordinary text.
    """
    data = docs.sparkSession.sparkContext.broadcast(get_file(tokenizer_file))
    end = b"" if end_id is None else int(end_id).to_bytes(width, "little")

    def run(batches):
        enter("tokens")
        if (tokenizer_file, width) not in _TOKENS:
            _TOKENS[tokenizer_file, width] = Tokens(data.value.decode(), width)
        encode = _TOKENS[tokenizer_file, width].encode
        for batch in small_batches(batches, "_text", BLOCK_BYTES, 1 << 16):
            ids = encode(batch.column("_text"))
            columns = [batch.column(c) for c in keep] + [pa.array([i + end for i in ids], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "ids"])

    rows = docs.select(*keep, F.col("text").alias("_text"))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{schema}, ids binary")


def count_ids(rows: DataFrame, width: int) -> DataFrame:
    """(id, n) over all rows; a task sends each id once."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in small_batches(batches, "ids"):
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), f"<u{width}")
            counts = np.bincount(ids, minlength=len(total))
            counts[: len(total)] += total
            total = counts
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    parts = rows.select("ids").mapInArrow(run, "id bigint, n bigint")
    return parts.groupBy("id").agg(F.sum("n").alias("n"))


# --- files --------------------------------------------------------------------


def write_token_files(
    docs: DataFrame,
    tokenizer_file: str,
    path: str | None = None,
    end_id: int | None = 0,
    ids_per_file: int = 1 << 24,
    block_ids: int = 4096,
    id_width: int = 2,
) -> str:
    """Tokenize the texts and write them in ascending order of doc_id; returns the folder.

    ``id_width`` is the bytes an id is staged in: 2 below 65,536 ids, else 4.
    """
    spark = docs.sparkSession
    path = path or new_folder(spark, "token-files")
    # The serial number is stored with the ids; it lets rows that repeat without end be split over files too.
    serial = F.monotonically_increasing_id().alias("serial")
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"), serial)
    made = tokenize(keyed, tokenizer_file, ["doc_id", "tie", "serial"], end_id, id_width)
    # Sizes are stored too, so that finding the ranges does not read the ids.
    made = made.withColumn("n", (F.octet_length("ids") / id_width).cast("bigint"))
    folder = new_folder(spark, "token-ids")
    made.write.option("compression", "zstd").parquet(folder)
    ids = spark.read.schema(made.schema).parquet(folder)
    counted = count_ids(ids, id_width).collect()
    if not counted:
        spark.createDataFrame([], MANIFEST).write.parquet(f"{path}/manifest")
        return path
    counts = np.zeros(max(r[0] for r in counted) + 1, np.int64)
    for r in counted:
        counts[r[0]] = r[1]
    lengths = code_lengths(counts)
    codes = canonical_codes(lengths)

    key = F.struct(F.col("doc_id").alias("k0"), F.col("tie"), F.col("serial"))
    files = max(1, -(-int(counts.sum()) // ids_per_file))
    ranges = _Ranges(ids.select(key.alias("_key"), F.col("n").alias("_size")), files, max(40_000, 40 * files))
    starts, at = {}, 0
    for r, size, _ in ranges.fit():
        starts[r], at = at, at + size
    shared = spark.sparkContext.broadcast((lengths, codes))
    start = F.get(constant([starts.get(i, 0) for i in range(len(ranges.bounds) + 1)], "array<bigint>"), F.col("file"))
    ranges.rows = ids.select(key.alias("_key"), "ids")
    placed = ranges.located().select(F.col("_range").alias("file"), "_key.k0", "_key.tie", "_key.serial", "ids")

    def encode(batches):
        lengths, codes = shared.value
        for batch in small_batches(batches, "ids", 1 << 18):
            parts = batch.column("ids").to_pylist()
            sizes = np.array([len(p) // id_width for p in parts], np.int64)
            whole = np.frombuffer(b"".join(parts), f"<u{id_width}")
            coded, offsets = pack(whole, sizes, lengths, codes, block_ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("file", "k0", "tie", "serial")]
                + [pa.array(sizes), pa.array(coded, pa.binary()), pa.array(offsets, pa.binary())],
                names=["file", "doc_id", "tie", "serial", "n", "bits", "blocks"],
            )

    coded = placed.mapInArrow(encode, "file int, doc_id bigint, tie bigint, serial bigint, n bigint, bits binary, blocks binary")
    ordered = coded.withColumn("start", start).repartition(files, "file")
    ordered = ordered.sortWithinPartitions("file", "doc_id", "tie", "serial")

    def write(batches):
        lengths, _ = shared.value
        current, rows, first = None, [], 0

        def close():
            if current is None:
                return
            name = f"{path}/{current:08d}.idhuf"
            ids_of, sizes, bits, blocks = zip(*rows)
            sizes = np.array(sizes, np.int64)
            byte_at = np.concatenate([[0], np.cumsum([len(b) for b in bits])])
            table = [np.frombuffer(b, "<u8") + np.uint64(8 * byte_at[i]) for i, b in enumerate(blocks)]
            head = {"start": first, "docs": len(rows), "ids": int(sizes.sum()), "symbols": len(lengths), "block_ids": block_ids}
            text = json.dumps(head).encode()
            size = put_file(
                name,
                [
                    MAGIC,
                    struct.pack("<I", len(text)),
                    text,
                    lengths.tobytes(),
                    np.array([i or 0 for i in ids_of], "<i8").tobytes(),
                    np.array([i is not None for i in ids_of], np.uint8).tobytes(),
                    sizes.astype("<u8").tobytes(),
                    np.concatenate(table).astype("<u8").tobytes() if table else b"",
                    *bits,
                ],
            )
            yield pa.RecordBatch.from_pydict(
                {"file": [name], "start": [first], "docs": [len(rows)], "ids": [head["ids"]], "bytes": [size]}
            )

        for batch in batches:
            for file, doc, n, b, o, s in zip(
                *(batch.column(c).to_pylist() for c in ("file", "doc_id", "n", "bits", "blocks", "start"))
            ):
                if file != current:
                    yield from close()
                    current, rows, first = file, [], s
                rows.append((doc, n, b, o))
        yield from close()

    manifest = ordered.mapInArrow(write, MANIFEST)
    manifest.write.parquet(f"{path}/manifest")
    return path


def decode_file(data: bytes, most_ids: int = 1 << 22) -> Iterator[tuple[list, np.ndarray, np.ndarray, list[bytes]]]:
    """(doc ids, starts, sizes, ids) of groups of documents with about ``most_ids`` ids."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    (n,) = struct.unpack_from("<I", data, 8)
    head = json.loads(data[12 : 12 + n])
    at = 12 + n

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        part = np.frombuffer(data, kind, count, at)
        at += part.nbytes
        return part

    lengths = take("u1", head["symbols"])
    docs, known = take("<i8", head["docs"]), take("u1", head["docs"])
    sizes = take("<u8", head["docs"]).astype(np.int64)
    per_doc = -(-sizes // head["block_ids"])
    offsets = take("<u8", int(per_doc.sum())).astype(np.int64)
    bits = data[at:]
    starts = head["start"] + np.cumsum(sizes) - sizes
    first_block = np.cumsum(per_doc) - per_doc
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + most_ids)))
        blocks = np.arange(first_block[i], first_block[j - 1] + per_doc[j - 1])
        owner = np.repeat(np.arange(i, j), per_doc[i:j])
        in_doc = blocks - first_block[owner]
        n_of = np.minimum(head["block_ids"], sizes[owner] - in_doc * head["block_ids"])
        # The bytes of these documents alone; one starts where its first block does.
        here = offsets[blocks]
        low = int(here[0]) >> 3 if len(here) else 0
        high = int(offsets[first_block[j]]) >> 3 if j < len(sizes) and first_block[j] < len(offsets) else len(bits)
        ids = unpack(bits[low:high], here - 8 * low, n_of, lengths).astype("<u4").tobytes()
        cut = (starts[i:j] - starts[i]) * 4
        parts = [ids[c : c + 4 * s] for c, s in zip(cut.tolist(), sizes[i:j].tolist())]
        yield [int(d) if k else None for d, k in zip(docs[i:j], known[i:j])], starts[i:j], sizes[i:j], parts
        i = j


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files that the manifest names: doc_id, start, n_tokens, ids (binary)."""
    manifest = spark.read.schema("file string").parquet(f"{path}/manifest")

    def run(batches):
        for batch in batches:
            for file in batch.column("file").to_pylist():
                for docs, starts, sizes, parts in decode_file(get_file(file)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs, pa.int64()), pa.array(starts), pa.array(sizes), pa.array(parts, pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    tasks = max(1, spark.sparkContext.defaultParallelism, manifest.rdd.getNumPartitions())
    return manifest.repartition(tasks, "file").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    )
