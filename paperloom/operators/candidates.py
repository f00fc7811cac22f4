"""Candidate selection: which sources put a paper forward.

Sources are numbered in arrival order: one per config category, then one per chunk
of keyword terms.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.config import FilterConfig
from paperloom.functions.dates import day_after
from paperloom.functions.literals import constant
from paperloom.operators.terms import ALL_TIERS, QUERY_TIER, match_terms

_SOURCES = "array<struct<source_ordinal:int,source_name:string>>"


def in_window(
    published: Column, start: dt.date | None = None, end: dt.date | None = None
) -> Column:
    """Inclusive dates against ISO text; both bounds reach the Parquet scan."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (published >= start.isoformat())
    if end is not None:
        inside = inside & (published < day_after(end).isoformat())
    return inside


def category_sources(categories: Column, config: FilterConfig) -> Column:
    offered = constant(
        [
            {"source_ordinal": i, "source_name": f"category:{name}", "category": name}
            for i, name in enumerate(config.categories)
        ],
        "array<struct<source_ordinal:int,source_name:string,category:string>>",
    )
    hit = F.filter(
        offered,
        lambda s: F.coalesce(F.array_contains(categories, s["category"]), F.lit(False)),
    )
    return F.transform(
        hit,
        lambda s: F.struct(
            s["source_ordinal"].alias("source_ordinal"),
            s["source_name"].alias("source_name"),
        ),
    )


def keyword_sources(hits: Column, config: FilterConfig) -> Column:
    chunks = F.array_sort(
        F.array_distinct(F.flatten(F.transform(hits, lambda hit: hit["chunks"])))
    )
    first = len(config.categories) - 1
    return F.transform(
        chunks,
        lambda k: F.struct(
            (k + first).alias("source_ordinal"),
            F.concat(F.lit("keyword_chunk_"), k.cast("string")).alias("source_name"),
        ),
    )


def _exploded(papers: DataFrame, sources: Column) -> DataFrame:
    return papers.select("*", F.inline(sources))


def category_candidates(
    papers: DataFrame,
    config: FilterConfig,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """One row per paper in the window and config category it is filed under."""
    inside = papers.filter(in_window(F.col("published"), start, end))
    return _exploded(inside, category_sources(F.col("categories"), config))


def keyword_candidates(
    papers: DataFrame,
    config: FilterConfig,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """One row per paper in the window and keyword chunk with a term in its text."""
    inside = papers.filter(in_window(F.col("published"), start, end))
    matched = match_terms(inside, config, (QUERY_TIER,))
    return _exploded(matched, keyword_sources(F.col("term_hits"), config)).drop("term_hits")


def all_candidates(
    papers: DataFrame,
    config: FilterConfig,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Bag union of both kinds of candidates from a single scan of the papers."""
    inside = papers.filter(in_window(F.col("published"), start, end))
    matched = match_terms(inside, config, (QUERY_TIER,))
    return _exploded(matched, _all_sources(config)).drop("term_hits")


def tagged_candidates(
    papers: DataFrame,
    config: FilterConfig,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Papers with at least one source, their source names in one sorted array.

    The rows stay one per paper and keep ``term_hits``, so that scoring needs no
    second look at the text.
    """
    inside = papers.filter(in_window(F.col("published"), start, end))
    sources = _all_sources(config)
    names = F.transform(sources, lambda s: s["source_name"])
    return (
        match_terms(inside, config, ALL_TIERS)
        .withColumn("sources", F.array_sort(F.array_distinct(names)))
        .withColumn("source_ordinal", F.array_min(F.transform(sources, lambda s: s["source_ordinal"])))
        .filter(F.size("sources") > 0)
    )


def _all_sources(config: FilterConfig) -> Column:
    return F.concat(
        category_sources(F.col("categories"), config).cast(_SOURCES),
        keyword_sources(F.col("term_hits"), config).cast(_SOURCES),
    )


def union_candidates(*parts: DataFrame) -> DataFrame:
    """Bag union of candidates that come from separate inputs."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
