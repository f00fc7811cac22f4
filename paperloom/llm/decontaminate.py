"""Benchmark decontamination by SimHash over item-sized windows.

A window is as long as a benchmark item.  Every window of a text is looked at whose words may reach the similarity with an item: the
shingles of the text that are the item's are joined, and a window whose shared ones, each counted as often as it stands there, weigh
less than ``SIMILARITY`` of the item cannot reach it.  All others, shifted ones too, are held to the exact similarity of their weighted
shingles: the shared weight over the weight of either, a shingle weighing as many characters as it has.  So no pair is missed.
The windows of a text are laid out in stretches as long as the item, so the work follows the length of the text.
The 64-bit SimHashes of the words tell how far the best window and the item are apart; no pair is dropped for its distance.

Fixed: shingles of five words, similarity 0.8.  The item shingles are broadcast up to ``BROADCAST_GRAMS`` of them, which is
counted first; beyond that Spark joins them like any table.

Defined results: null or empty texts hold nothing; items of one to four words are one shingle and are
found where all their words stand; items without words are found nowhere; a text shorter than
an item is one window; repeated rows are reported each; empty tables give an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import held, union_all
from paperloom.llm.grams import gram_positions, words

SHINGLE = 5
SIMILARITY = 0.8
BROADCAST_GRAMS = 500_000
#: Low bits of a shingle's number that hold its weight.
WEIGHT = 4095


def simhash(of: str) -> Column:
    """64-bit SimHash of the words in a column.

    Sixteen sums of four 16-bit lanes count how often each bit is set; a bit is set in the result if it is in more
    than half of the words.  A lane holds 65,535 words.
    """
    lanes = F.lit(0x0001000100010001)
    shifts = F.array(*[F.lit(i) for i in range(16)])
    hashes = F.transform(F.col(of), lambda w: F.xxhash64(w))
    add = lambda acc, h: F.zip_with(acc, shifts, lambda a, s: a + F.call_function("shiftrightunsigned", h, s).bitwiseAND(lanes))
    sums = F.aggregate(hashes, F.array_repeat(F.lit(0).cast("bigint"), 16), add)
    lane = lambda s, j: F.shiftrightunsigned(s, 16 * j).bitwiseAND(F.lit(0xFFFF)) * 2 > F.size(of)
    bit = lambda s, i, j: F.when(lane(s, j), F.call_function("shiftleft", F.lit(1).cast("bigint"), i + 16 * j)).otherwise(F.lit(0).cast("bigint"))
    parts = F.transform(sums, lambda s, i: bit(s, i, 0) + bit(s, i, 1) + bit(s, i, 2) + bit(s, i, 3))
    return F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))


def weighted_shingles(of: str) -> Column:
    """Distinct shingles as hash bits above their weight in characters."""
    last = F.size(of) - SHINGLE
    number = lambda s: F.xxhash64(s).bitwiseAND(F.lit(~WEIGHT)).bitwiseOR(
        F.least(F.lit(WEIGHT), F.length(F.array_join(s, ""))).cast("bigint")
    )
    each = F.transform(F.sequence(F.lit(0), last), lambda i: number(F.slice(of, i + 1, SHINGLE)))
    return F.when(last >= 0, F.array_distinct(each)).otherwise(F.array().cast("array<bigint>"))


def _weight(shingles: Column) -> Column:
    return F.aggregate(shingles, F.lit(0).cast("bigint"), lambda a, s: a + s.bitwiseAND(F.lit(WEIGHT)))


def find_passages(docs: DataFrame, items: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, item_id, first_word, n_words, hamming, similarity: the best window of each row and item it holds."""
    item_words = held(items.select("item_id", "text"), part=words(F.col("text"))).where(F.size("part") >= SHINGLE)
    known = held(item_words, i_shingles=weighted_shingles("part"), i_fingerprint=simhash("part"))
    known = known.select("item_id", F.xxhash64("part").alias("item"), F.col("part").alias("words"), "i_shingles", "i_fingerprint")
    need = _weight(F.col("i_shingles")) * SIMILARITY * (1 - 1e-9)
    weight = F.length(F.array_join(F.slice("words", F.col("pos") + 1, SHINGLE), ""))
    grams = gram_positions(known.select("item", "words", need.alias("need")), SHINGLE)
    grams = grams.select("item", "need", F.size("words").alias("span"), F.col("h").alias("g_h"), F.least(F.lit(WEIGHT), weight).alias("weight")).distinct()
    known = known.drop("words").withColumnRenamed("item", "i_item")
    if grams.count() <= BROADCAST_GRAMS:
        grams, known = F.broadcast(grams), F.broadcast(known)
    own = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)])
    rows = held(docs.select(own.alias("own"), F.monotonically_increasing_id().alias("row"), "text"), words=words(F.col("text"))).drop("text")
    met = gram_positions(rows, SHINGLE).join(grams, F.col("h") == F.col("g_h"))
    # A window that holds the shingle begins in its own stretch or in the one before.
    stretch = F.floor(F.col("pos") / F.col("span")).cast("int")
    met = met.withColumn("stretch", F.explode(F.sequence(F.greatest(F.lit(0), stretch - 1), stretch)))
    met = met.withColumn("from", F.col("stretch") * F.col("span"))
    met = met.select(
        "row", "own", "item", "need", "span", "from", F.size("words").alias("size"),
        F.struct("pos", "weight").alias("hit"), F.slice("words", F.col("from") + 1, 2 * F.col("span")).alias("near"),
    )
    by = ["row", "own", "item", "need", "span", "from", "size"]
    near = met.groupBy(*by).agg(F.collect_list("hit").alias("hits"), F.first("near").alias("near"))
    last = F.least(F.col("from") + F.col("span") - 1, F.greatest(F.lit(0), F.col("size") - F.col("span")))
    total = lambda hits: F.aggregate(hits, F.lit(0).cast("bigint"), lambda a, x: a + x["weight"])
    near = near.where((total(F.col("hits")) >= F.col("need")) & (last >= F.col("from")))
    inside = lambda s: lambda x: (x["pos"] >= s) & (x["pos"] <= s + F.col("span") - SHINGLE)
    starts = F.filter(F.sequence("from", last), lambda s: total(F.filter("hits", inside(s))) >= F.col("need"))
    windows = near.select("row", "own", "item", "span", "from", "near", F.explode(starts).alias("start"))
    windows = windows.select("row", "own", "item", "span", "start", F.slice("near", F.col("start") - F.col("from") + 1, F.col("span")).alias("part"))
    pairs = held(windows, shingles=weighted_shingles("part")).join(known, F.col("item") == F.col("i_item"))
    shared = held(pairs, both=_weight(F.array_intersect("shingles", "i_shingles")), either=_weight(F.array_union("shingles", "i_shingles")))
    passed = shared.withColumn("similarity", F.col("both") / F.col("either")).where(F.col("similarity") >= SIMILARITY)
    best = passed.groupBy("row", "own", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"), "span", "part", "i_fingerprint")).alias("best")
    )
    best = held(best.select("*", F.col("best.part").alias("part")), fingerprint=simhash("part"))
    kept = [F.col("own")[f"c{i}"].alias(c) for i, c in enumerate(keep)]
    found = best.select(
        *kept,
        "item_id",
        (-F.col("best.back")).cast("long").alias("first_word"),
        F.col("best.span").cast("long").alias("n_words"),
        F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("best.i_fingerprint"))).alias("hamming"),
        F.col("best.similarity").alias("similarity"),
    )
    short = _short_places(rows, items).select(*kept, *found.columns[len(keep) :])
    return found.unionByName(short)


def _short_places(rows: DataFrame, items: DataFrame) -> DataFrame:
    """First places of items below a shingle's length, which are found where all their words stand."""
    known = held(items.select("item_id", "text"), part=words(F.col("text")))
    known = known.where((F.size("part") > 0) & (F.size("part") < SHINGLE)).select("item_id", "part", F.xxhash64("part").alias("i_h"))
    # At most one row per length.
    lengths = sorted(r[0] for r in known.select(F.size("part")).distinct().collect())
    if not lengths:
        rows = rows.where(F.lit(False))
    found = []
    # Without short items there is nothing to look for, but the columns are the same.
    for k in lengths or [SHINGLE]:
        met = gram_positions(rows, k).join(known.where(F.size("part") == k), F.col("h") == F.col("i_h"))
        met = met.where(F.slice("words", F.col("pos") + 1, k) == F.col("part"))
        found.append(met.groupBy("row", "own", "item_id").agg(F.min("pos").alias("pos")).withColumn("k", F.lit(k)))
    return union_all(found).select(
        "own",
        "item_id",
        F.col("pos").cast("long").alias("first_word"),
        F.col("k").cast("long").alias("n_words"),
        F.lit(0).alias("hamming"),
        F.lit(1.0).alias("similarity"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows, with all their columns, that hold no benchmark item.  Equal texts share one verdict."""
    texts = docs.select(F.xxhash64("text").alias("_key"), "text")
    found = find_passages(texts, items, ["_key"]).select(F.col("_key").alias("_found")).distinct()
    return docs.join(found, F.xxhash64(docs["text"]) == F.col("_found"), "left_anti")
