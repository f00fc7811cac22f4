"""Size-balanced shards by sampled splitters.

Rows are drawn with a chance in proportion to their size, quantiles of the draw become the
boundaries of many small key ranges, and ranges that turn out overfull are split again from a
denser draw.  Running sums inside ranges, on top of the sums of the ranges before, give each row its
exact place in key order, so shards differ by no more than a row.

Only narrow rows are shuffled; the driver sees ``ranges`` boundaries and sums, whatever the input.
Equal keys are told apart by a hash of the row and a serial number, so a key that holds a third of all
rows is split like any other.

Defined results: null keys come first; a null size counts as one; equal rows are spread in no
stated order; an empty table gives an empty table; fewer rows than shards leave shards empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom.functions.literals import constant
from paperloom.llm.common import held, stage


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes plus one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _range_of(key: Column, bounds: Column, count: int) -> Column:
    """How many boundaries are at or below the key, by binary search."""
    steps = F.sequence(F.lit(1), F.lit(max(1, count.bit_length())))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        below = (acc["lo"] < acc["hi"]) & (F.get(bounds, middle) <= key)
        return F.struct(
            F.when(below, middle + 1).otherwise(acc["lo"]).alias("lo"),
            F.when(below | (acc["lo"] >= acc["hi"]), acc["hi"]).otherwise(middle).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.lit(count).alias("hi"))
    return F.aggregate(steps, start, halve, lambda acc: acc["lo"])


class _Ranges:
    """Key ranges over staged rows with columns _key, _size."""

    def __init__(self, rows: DataFrame, ranges: int, draws: int):
        self.rows, self.ranges, self.draws = rows, ranges, draws
        self.total = rows.agg(F.sum("_size")).first()[0] or 0
        self.bounds: set[str] = set()
        self.kind = rows.schema["_key"].dataType.simpleString()

    def located(self) -> DataFrame:
        if not self.bounds:
            return self.rows.withColumn("_range", F.lit(0))
        texts = "[" + ",".join(self.bounds) + "]"
        bounds = F.sort_array(F.from_json(F.lit(texts), f"array<{self.kind}>"))
        return held(self.rows, _range=_range_of(F.col("_key"), bounds, len(self.bounds)))

    def add(self, rows: DataFrame, size: int, ranges: int) -> None:
        """Boundaries at the quantiles of a draw from rows of ``size`` bytes in all.

        The draw has about ``draws`` rows and never more than that by more than chance.
        """
        chance = F.least(F.lit(1.0), F.col("_size") * (self.draws / size))
        coin = F.shiftrightunsigned(F.xxhash64("_key", F.lit(len(self.bounds))), 11) / float(1 << 53)
        drawn = rows.where(coin < chance).select("_key", (F.col("_size") / chance).alias("w"))
        total = drawn.agg(F.sum("w")).first()[0] or 0
        if not total:
            return
        upto = F.sum("w").over(Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, 0))
        step = lambda c: F.floor(c * (ranges / total))
        ends = drawn.withColumn("upto", upto).where(step(F.col("upto")) > step(F.col("upto") - F.col("w")))
        self.bounds |= {r[0] for r in ends.select(F.to_json("_key", {"ignoreNullFields": "false"})).collect()}

    def sums(self) -> list[tuple[int, int, int]]:
        """(range, bytes, rows) in order."""
        got = self.located().groupBy("_range").agg(F.sum("_size"), F.count("*")).collect()
        return sorted((r[0], r[1], r[2]) for r in got)

    def fit(self, rounds: int = 3) -> list[tuple[int, int, int]]:
        if self.total:
            self.add(self.rows, self.total, self.ranges)
        for _ in range(rounds):
            sums = self.sums()
            over = [(r, b) for r, b, n in sums if n > 1 and b > 2 * self.total / self.ranges]
            known = len(self.bounds)
            if over:
                size = sum(b for _, b in over)
                inside = self.located().where(F.col("_range").isin([r for r, _ in over]))
                self.add(inside, size, -(-2 * size * self.ranges // self.total))
            if len(self.bounds) == known:
                return sums
        return self.sums()


def assign_shards(
    rows: DataFrame, keys: list[str], size: Column, shards: int = 16, ranges_per_shard: int = 64, draws: int = 40_000
) -> DataFrame:
    """The rows with ``shard`` and ``slot`` (its place in the shard, from 0), in key order.

    ``draws`` bounds the rows drawn for boundaries.  Pass the columns to be kept and no more.
    """
    mark = uuid.uuid4().hex
    own = [c for c in rows.columns]
    key = F.struct(
        *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)],
        F.xxhash64(*[F.col(f"`{c}`") for c in own]).alias("tie"),
        F.monotonically_increasing_id().alias("serial"),
    )
    kept = stage(
        rows.select(
            F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)]).alias("_row"),
            key.alias("_key"),
            F.coalesce(size, F.lit(1)).cast("long").alias("_size"),
        ),
        f"shards-{mark[:8]}",
    )
    ranges = _Ranges(kept, shards * ranges_per_shard, draws)
    before_bytes, before_rows, at, n = {}, {}, 0, 0
    for r, b, c in ranges.fit():
        before_bytes[r], before_rows[r] = at, n
        at, n = at + b, n + c
    # A range that the search can return always has rows when it is looked up.
    table = lambda d: constant([d.get(i, 0) for i in range(len(ranges.bounds) + 1)], "array<bigint>")
    inside = Window.partitionBy("_range").orderBy("_key")
    upto = F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = ranges.located().select(
        "_row",
        (F.get(table(before_bytes), F.col("_range")) + upto - F.col("_size")).alias("_before"),
        (F.get(table(before_rows), F.col("_range")) + F.row_number().over(inside) - 1).alias("_place"),
    )
    # Whole numbers: bytes before it times shards stays exact as a decimal.
    share = F.floor(F.col("_before").cast("decimal(38,0)") * shards / F.lit(max(1, at)).cast("decimal(20,0)"))
    placed = placed.withColumn("shard", F.least(F.lit(shards - 1), share.cast("int")))
    starts = {r[0]: r[1] for r in placed.groupBy("shard").agg(F.min("_place")).collect()}
    start = F.get(constant([starts.get(i, 0) for i in range(shards)], "array<bigint>"), F.col("shard"))
    return placed.select(
        *[F.col("_row")[f"c{i}"].alias(c) for i, c in enumerate(own)],
        "shard",
        (F.col("_place") - start).alias("slot"),
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order inside its files."""
    spread = assigned.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    spread.write.partitionBy("shard").parquet(path)
