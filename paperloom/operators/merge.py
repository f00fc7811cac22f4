"""Merging of duplicate records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from paperloom.schemas import ARRIVAL_COLUMNS


def merge_papers(
    candidates: DataFrame,
    arrival: Sequence[str] = ARRIVAL_COLUMNS,
    keys: Sequence[str] = ("paper_id",),
) -> DataFrame:
    """One row per paper: attributes of the first arrival, sources of all of them.

    Needs a ``sources`` array and the ``arrival`` columns.  Both aggregates combine
    before the shuffle, so an id that holds a large part of the rows leaves every
    map task as one row with a set of distinct source lists.
    """
    rest = [c for c in candidates.columns if c not in {*keys, *arrival, "sources"}]
    return (
        candidates.groupBy(*keys)
        .agg(
            F.min_by(F.struct(*rest), F.struct(*arrival)).alias("first"),
            F.array_sort(
                F.array_distinct(F.flatten(F.collect_set("sources")))
            ).alias("sources"),
        )
        .select(*keys, "first.*", "sources")
    )


def in_merged_order(papers: DataFrame) -> DataFrame:
    return papers.orderBy(F.desc("published"), F.desc("paper_id"))
