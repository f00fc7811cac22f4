"""Places of rows in files that Spark reads in splits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F


def with_positions(
    rows: DataFrame,
    put: Callable[[DataFrame, str], DataFrame],
    into: str = "position",
    path: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """Add the place of a row in its file, from 0, to rows read from files that are split between tasks; and the
    file's path and whether the row is its last, if ``path`` and ``last`` name columns for them.

    A task reads a split from front to back, so a row's place in its split is a running number less the first one of
    the split; the rows of the splits before it are added up in a table with one row per split.  ``put`` stores the
    numbered rows, so that both sides see the same numbers.
    """
    marked = put(
        rows.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_serial"),
        ),
        "numbered",
    )
    splits = marked.groupBy("_file", "_block").agg(F.min("_serial").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        "_file",
        "_block",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy("_file")).alias("_all"),
    )
    placed = marked.join(starts, ["_file", "_block"])
    more = [F.col("_file").alias(path)] if path else []
    more += [(F.col(into) == F.col("_all") - 1).alias(last)] if last else []
    return placed.withColumn(into, F.col("_serial") + F.col("_shift")).select(*rows.columns, into, *more)
