"""Phrase collocations by dynamic itemset counting.

The words of all texts are written once, in blocks of one language, dealt over ``SHARDS`` shards.  The scans go round the
shards.  Words are counted from the first scan on; a longer phrase is active from the scan after the one in which
the later of its two subphrases (all words but the last, all but the first) reached the threshold, for
exactly one round, in which it meets every shard once.  So lengths interleave: pairs are counted while words still are.
The scans end when no round is open any more, so every phrase at or above the threshold is counted whole.

Counts are a table keyed by the fingerprints of the two subphrases.  A scan adds up within its tasks first, then by one
shuffle together with the open counts so far; a count whose round is over leaves the table.  A phrase that reaches the threshold marks one of
``SLOTS`` bytes, chosen by its fingerprint, with the scan; a byte keeps its first mark.  Tasks get these bytes (16 MB whatever the
corpus) and read off from when on a phrase is active: from the later of the marks of its subphrases, and of theirs.  Where fingerprints meet in a byte, a phrase is active
too early or without need, which costs work, but its round is one full round all the same and its count is whole.

Fingerprints have 64 bits.  The texts of frequent words are read back from all blocks, and if one fingerprint stands for two words, frequent
or not, or for two frequent phrases, the whole is done anew with another seed.  Phrases that differ in the first part alone have different
fingerprints by construction, so a single meeting of others cannot mix two counts.

Defined results: a null text counts as empty, a null language as ``und``; texts without a word add nothing; repeated rows
count as often as they stand there; texts are worked on whole, in stretches of bounded size; an empty table gives
empty results; further columns of any name do not matter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from paperloom.llm.arrow import enter, forget, small_batches
from paperloom.llm.common import new_folder, stage, union_all
from paperloom.plans.staging import delete

#: Words in the longest phrase, and occurrences from which a phrase counts.
LONGEST = 5
THRESHOLD = 100
SHARDS = 3
SLOTS = 1 << 24
#: UTF-8 bytes of text in a block.
BLOCK_BYTES = 8 << 20
#: Counted phrases that a task holds before it sends them on.
HELD = 1 << 19
UNKNOWN = "und"

# Piece ends and word gaps of the contract.
_PIECE_ENDS, _GAPS = b".,;:!?\n\x0b\x0c\r", b"\t"
#: A byte that UTF-8 never has stands for the end of a piece.
_CUT = b"\xff"
_TABLE = bytes(
    _CUT[0] if b in _PIECE_ENDS else 32 if b in _GAPS else b + 32 if 65 <= b <= 90 else b for b in range(256)
)


# --- blocks of words ----------------------------------------------------------


def _tokens(data: bytes) -> Iterator[list[bytes]]:
    """Words and ends of pieces, about a megabyte at a time; stretches are cut at gaps only."""
    at = 0
    while at < len(data):
        end = at + (1 << 20)
        if end < len(data):
            gaps = [e for e in (data.find(b" ", end), data.find(_CUT, end)) if e >= 0]
            end = min(gaps) if gaps else len(data)
        yield data[at:end].replace(_CUT, b" \xff ").split()
        at = end


class _Block:
    """Texts of one language as numbers of words; -1 ends a piece."""

    def __init__(self):
        self.places: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str) -> None:
        data = text.encode().translate(_TABLE)
        self.size += len(data) + 1
        places = self.places
        for tokens in _tokens(data):
            codes, words = pd.factorize(np.array(tokens + [None], object)[:-1])
            own = [-1 if w == _CUT else places.setdefault(w, len(places)) for w in words.tolist()]
            self.parts.append(np.array(own, np.int32)[codes] if own else np.zeros(0, np.int32))
        self.parts.append(np.array([-1], np.int32))

    def ids(self) -> np.ndarray:
        return np.concatenate(self.parts)


def _write_blocks(docs: DataFrame, path: str, seed: int, shards: int) -> None:
    """One row per block: lang, words, their fingerprints, the texts as word numbers."""
    key = f"{seed:016d}"
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        enter("phrases")
        part, made = TaskContext.get().partitionId(), 0
        open_: dict[str, _Block] = {}

        def close(lang: str) -> pa.RecordBatch:
            nonlocal made
            block = open_.pop(lang)
            words = [w.decode() for w in block.places]
            named = np.array([f"{lang}\t{w}" for w in words] + [None], object)[:-1]
            marks = pd.util.hash_array(named, hash_key=key, categorize=False).astype(np.uint64)
            ids = block.ids()
            row = {
                "shard": [(part + made) % shards],
                "lang": [lang],
                "words": [words],
                "marks": [marks.tobytes()],
                "ids": [ids.tobytes()],
                "n": [int((ids >= 0).sum())],
            }
            made += 1
            return pa.RecordBatch.from_pydict(row, pa.schema(
                [("shard", pa.int32()), ("lang", pa.string()), ("words", pa.list_(pa.string()))]
                + [("marks", pa.binary()), ("ids", pa.binary()), ("n", pa.int64())]
            ))

        for batch in small_batches(batches, "text"):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                block = open_.setdefault(lang, _Block())
                block.add(text)
                if block.size >= BLOCK_BYTES:
                    yield close(lang)
            while sum(b.size for b in open_.values()) > 2 * BLOCK_BYTES:
                yield close(max(open_, key=lambda x: open_[x].size))
        for lang in list(open_):
            yield close(lang)

    made = rows.mapInArrow(run, "shard int, lang string, words array<string>, marks binary, ids binary, n bigint")
    made.write.partitionBy("shard").option("compression", "zstd").parquet(path)


# --- scans --------------------------------------------------------------------


def _fingerprint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of a phrase, from those of its words but the last and its words but the first."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slot(marks: np.ndarray, slots: int) -> np.ndarray:
    return (marks & np.uint64(slots - 1)).astype(np.int64)


@dataclass
class _Level:
    """Phrases of one length in a block: per distinct one its parts, fingerprint, times, one place and first scan; per place its number or -1."""

    m: int
    a: np.ndarray
    b: np.ndarray
    mark: np.ndarray
    times: np.ndarray
    first: np.ndarray
    start: np.ndarray
    at: np.ndarray


def _levels(ids: np.ndarray, marks: np.ndarray, known: np.ndarray, longest: int) -> Iterator[_Level]:
    """Phrases whose two subphrases may have reached the threshold, length by length."""
    there = np.flatnonzero(ids >= 0)
    times = np.bincount(ids[there], minlength=len(marks))
    first = np.zeros(len(marks), np.int64)
    first[ids[there][::-1]] = there[::-1]
    level = _Level(1, marks, np.zeros(len(marks), np.uint64), marks, times, first, np.zeros(len(marks), np.uint8), ids.astype(np.int64))
    yield level
    while level.m < longest and len(level.mark):
        marked = known[_slot(level.mark, len(known))]
        reached = marked > 0
        on = (level.at >= 0) & reached[np.maximum(level.at, 0)]
        here = np.flatnonzero(on[:-1] & on[1:])
        pairs = level.at[here] * len(level.mark) + level.at[here + 1]
        keys, first, code, times = np.unique(pairs, return_index=True, return_inverse=True, return_counts=True)
        left, right = np.divmod(keys, len(level.mark))
        at = np.full(len(level.at) - 1, -1, np.int64)
        at[here] = code
        a, b = level.mark[left], level.mark[right]
        # A phrase is seen from when on its parts are marked and seen themselves.
        since = np.maximum(marked, level.start)
        start = np.maximum(since[left], since[right])
        level = _Level(level.m + 1, a, b, _fingerprint(a, b), times, here[first], start, at)
        yield level


def _joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Rows (a, b, kind, n) with equal phrases added up."""
    a, b, kind, n = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return a[new], b[new], kind[order[new]], np.add.reduceat(n[order], new)


def _scan(blocks: DataFrame, known, scan: int, shards: int, longest: int) -> DataFrame:
    """(a, b, kind, n) of the phrases whose round is open in this scan, added up within tasks.

    ``kind`` holds the length and the first scan of the round, which both follow from the parts.
    """

    def run(batches):
        enter("phrases")
        table = _unpacked(known)
        held: list[tuple[np.ndarray, ...]] = []

        def send() -> Iterator[pa.RecordBatch]:
            columns = [pa.array(c) for c in _joined(held)]
            held.clear()
            for i in range(0, len(columns[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([c[i : i + (1 << 16)] for c in columns], names=["a", "b", "kind", "n"])

        for batch in small_batches(batches, "ids", BLOCK_BYTES):
            for ids, marks in zip(batch.column("ids").to_pylist(), batch.column("marks").to_pylist()):
                ids, marks = np.frombuffer(ids, np.int32), np.frombuffer(marks, np.uint64)
                for level in _levels(ids, marks, table, longest):
                    use = np.flatnonzero(level.start.astype(np.int64) > scan - shards)
                    if len(use):
                        kind = level.start[use].astype(np.int32) * 16 + np.int32(level.m)
                        a, b = level.a[use].view(np.int64), level.b[use].view(np.int64)
                        held.append((a, b, kind, level.times[use].astype(np.int64)))
                if sum(len(p[0]) for p in held) > HELD:
                    small = _joined(held)
                    held[:] = [small]
                    if len(small[0]) > HELD // 2:
                        yield from send()
        if held:
            yield from send()

    return blocks.select("ids", "marks").mapInArrow(run, _STATE)


def _with_marks(rows: DataFrame) -> DataFrame:
    """(m, a, b, h, n, over): length and fingerprint h of each phrase."""

    def run(batches):
        for batch in batches:
            a, b = (batch.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("a", "b"))
            m = batch.column("kind").to_numpy() % 16
            h = np.where(m == 1, a, _fingerprint(a, b)).view(np.int64)
            columns = [pa.array(m.astype(np.int32)), batch.column("a"), batch.column("b"), pa.array(h), batch.column("n"), batch.column("over")]
            yield pa.RecordBatch.from_arrays(columns, names=["m", "a", "b", "h", "n", "over"])

    return rows.mapInArrow(run, _SETTLED)


_BLOCKS = "lang string, words array<string>, marks binary, ids binary, n bigint, shard int"
_STATE = "a bigint, b bigint, kind int, n bigint"
_SETTLED = "m int, a bigint, b bigint, h bigint, n bigint, over boolean"


def _count(spark: SparkSession, blocks_path: str, folder: str, threshold: int, shards: int, longest: int) -> DataFrame:
    """(m, a, b, h, n) of every phrase with at least ``threshold`` occurrences."""
    blocks = spark.read.schema(_BLOCKS).parquet(blocks_path)
    known = np.zeros(SLOTS, np.uint8)
    state = spark.createDataFrame([], _STATE)
    scan, last = 0, -1
    while scan <= last + shards or scan < shards:
        marks = _shared(spark, known)
        found = _scan(blocks.where(F.col("shard") == scan % shards), marks, scan, shards, longest)
        summed = state.unionByName(found).groupBy("a", "b").agg(F.max("kind").alias("kind"), F.sum("n").alias("n"))
        over = F.floor(F.col("kind") / 16) == scan - shards + 1
        enough = F.col("n") >= threshold
        summed.where(~over | enough).write.parquet(f"{folder}/scan-{scan}")
        # The counts are written; nothing is made from the table again.
        marks.destroy()
        now = spark.read.schema(_STATE).parquet(f"{folder}/scan-{scan}")
        _with_marks(now.where(enough).withColumn("over", over)).write.parquet(f"{folder}/settled/scan={scan}")
        reached = _settled(spark, folder).where((F.col("scan") == scan) & (F.col("m") < longest))
        # At most one row per slot comes to the driver.
        slots = reached.select(F.col("h").bitwiseAND(SLOTS - 1).cast("int").alias("slot")).distinct().toArrow()
        fresh = slots.column(0).to_numpy()
        fresh = fresh[known[fresh] == 0]
        if len(fresh):
            last = scan
            known[fresh] = scan + 1
        if scan:
            delete(spark, f"{folder}/scan-{scan - 1}")
        # What the scan shuffled goes once the driver knows that nothing refers to it.
        del found, summed
        spark._jvm.System.gc()
        state = now.where(~over)
        scan += 1
    return _settled(spark, folder).where("over").select("m", "a", "b", "h", "n")


def _settled(spark: SparkSession, folder: str) -> DataFrame:
    """Phrases at or above the threshold after each scan in which their round was open."""
    return spark.read.schema(f"{_SETTLED}, scan int").parquet(f"{folder}/settled")


def _shared(spark: SparkSession, known: np.ndarray):
    """The table of marks for tasks; packed, as it is mostly empty for small inputs."""
    return spark.sparkContext.broadcast(zlib.compress(known.tobytes(), 1))


def _unpacked(marks) -> np.ndarray:
    return np.frombuffer(zlib.decompress(marks.value), np.uint8)


def _words(blocks: DataFrame, known: np.ndarray) -> DataFrame:
    """(h, lang, word) of the words in the blocks that may be frequent, each once.

    A task gives lists of the words that it has not given before, by bucket of their fingerprint; a bucket's lists are merged.
    """
    spark = blocks.sparkSession
    shared = _shared(spark, known)
    buckets = 8 * math.isqrt(max(1, blocks.rdd.getNumPartitions()))

    def run(batches):
        enter("phrases")
        table = _unpacked(shared)
        # A word that meets another under one fingerprint is given too.
        told: dict[int, tuple[str, str]] = {}
        for batch in small_batches(batches, "marks", BLOCK_BYTES):
            dealt: dict[int, list[tuple[int, str, str]]] = {}
            for lang, words, marks in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "marks"))):
                forget(told, HELD)
                marks = np.frombuffer(marks, np.uint64)
                use = np.flatnonzero(table[_slot(marks, len(table))] > 0)
                for h, i in zip(marks[use].view(np.int64).tolist(), use.tolist()):
                    if told.get(h) != (lang, words[i]):
                        told[h] = lang, words[i]
                        dealt.setdefault(h % buckets, []).append((h, lang, words[i]))
            lists = [list(zip(*rows)) for rows in dealt.values()]
            columns = [pa.array(list(dealt), pa.int32())]
            for i, kind in enumerate((pa.int64(), pa.string(), pa.string())):
                columns.append(pa.array([x[i] for x in lists], pa.list_(kind)))
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "h", "lang", "word"])

    def merge(batches):
        current, met = None, set()
        for batch in batches:
            fresh: list[tuple[int, str, str]] = []
            for bucket, *lists in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if bucket != current:
                    current, met = bucket, set()
                new = set(zip(*lists)) - met
                met |= new
                fresh += new
            columns = [pa.array([x[i] for x in fresh], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "lang", "word"])

    lists = blocks.select("lang", "words", "marks").mapInArrow(
        run, "bucket int, h array<bigint>, lang array<string>, word array<string>"
    )
    return lists.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "h bigint, lang string, word string")


def _named(counts: DataFrame, words: DataFrame, longest: int) -> DataFrame:
    """Counted phrases with their language and text: that of all words but the last, and the last word."""
    level = counts.where("m = 1").join(words, "h").withColumn("last", F.col("phrase"))
    levels = [level]
    for m in range(2, longest + 1):
        front = level.select(F.col("h").alias("a"), "lang", F.col("phrase").alias("front"))
        back = level.select(F.col("h").alias("b"), "last")
        level = counts.where(F.col("m") == m).join(front, "a").join(back, "b")
        level = level.withColumn("phrase", F.concat("front", F.lit(" "), "last")).select(*levels[0].columns)
        level = stage(level, f"phrases-{m}")
        levels.append(level)
    return union_all(levels).drop("last")


def count_phrases(
    docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, shards: int = SHARDS
) -> tuple[DataFrame, DataFrame]:
    """Every phrase of 1 to ``longest`` words with at least ``threshold`` occurrences in its language, and words per language.

    The first table has m, a, b, h (length, fingerprints of both subphrases and of the phrase), n, lang, phrase; the second
    lang, n.  Reads the columns text and lang.
    """
    spark = docs.sparkSession
    for seed in range(8):
        folder = new_folder(spark, "phrases")
        _write_blocks(docs, f"{folder}/blocks", seed, shards)
        counts = stage(_count(spark, f"{folder}/blocks", folder, threshold, shards, longest), "phrase-counts")
        known = np.zeros(SLOTS, np.uint8)
        slots = counts.where("m = 1").select(F.col("h").bitwiseAND(SLOTS - 1).cast("int").alias("slot")).distinct().toArrow()
        known[slots.column(0).to_numpy()] = 1
        blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
        met = _words(blocks, known).join(counts.where("m = 1").select("h"), "h")
        ends = [f(F.struct("lang", "word")).alias(n) for f, n in ((F.min, "low"), (F.max, "high"))]
        words = stage(met.groupBy("h").agg(*ends), "words")
        alike = counts.groupBy("h").count().where("count > 1")
        if words.where("low <> high").isEmpty() and alike.isEmpty():
            words = words.select("h", "low.lang", F.col("low.word").alias("phrase"))
            whole = _named(counts, words, longest).select("m", "a", "b", "h", "n", "lang", "phrase")
            return whole, blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    raise RuntimeError("fingerprints of different words or phrases meet under every seed")


# --- collocations -------------------------------------------------------------


def score_collocations(phrases: DataFrame, words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the phrases of two and more words that no longer one of equal count holds.

    Every part of a phrase is in ``phrases``, since it occurs at least as often.  Products are decimals of
    up to 38 digits, so they are exact.
    """
    # A longer phrase of equal count that holds a phrase also means one with a single word more.
    longer = phrases.where("m > 2").select(F.explode(F.array("a", "b")).alias("h"), "n").distinct()
    kept = phrases.where("m > 1").join(longer, ["h", "n"], "left_anti")
    word = F.split("phrase", " ")
    cut = F.transform(
        F.sequence(F.lit(1), F.col("m") - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.array_join(F.slice("_words", F.lit(1), k), " ").alias("first"),
            F.array_join(F.slice("_words", k + 1, F.col("m") - k), " ").alias("rest"),
        ),
    )
    rows = kept.withColumn("_words", word).select("lang", "phrase", F.col("n").alias("a"), F.inline(cut))
    part = phrases.where(F.col("m") < longest).select("lang", "phrase", "n")
    rows = rows.join(part.toDF("lang", "first", "l"), ["lang", "first"]).join(part.toDF("lang", "rest", "r"), ["lang", "rest"])
    rows = rows.join(words.select("lang", "n"), "lang")
    top = F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(15,0)") * F.col("n").cast("decimal(18,0)")
    bottom = F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")
    rows = rows.withColumns({"top": top, "bottom": bottom}).withColumn("score", F.expr("top div bottom"))
    best = rows.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("best"))
    return best.select("lang", "phrase", "best.a", "best.l", "best.r", "best.n", "best.score")


def best_collocations(scored: DataFrame, first: int = 2000, spread: int = 64) -> DataFrame:
    """Adds rank to the first rows of each language; a language is cut down in ``spread`` parts before one task sorts it."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(spread))).orderBy(*order)
    few = scored.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= first)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= first)
