"""Selection of stored papers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.functions.dates import day_after
from paperloom.functions.literals import small_table
from paperloom.functions.text import contains_ignoring_case
from paperloom.operators.candidates import in_window

# The columns of a stored-paper scan.
SCAN_COLUMNS = [
    "paper_id",
    "title",
    "summary",
    "published",
    "primary_category",
    "authors",
    "abs_url",
    "pdf_url",
]


def author_contains(authors: Column, needle: str) -> Column:
    wanted = F.lower(F.lit(needle))
    return F.coalesce(
        F.exists(authors, lambda name: F.contains(F.lower(name), wanted)), F.lit(False)
    )


def select_papers(
    papers: DataFrame,
    categories: Sequence[str] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    ids: DataFrame | Sequence[str] | None = None,
    title_contains: str | None = None,
    summary_contains: str | None = None,
    author_name_contains: str | None = None,
    text_contains: str | None = None,
) -> DataFrame:
    """Papers that meet every filter supplied; with none, all of them.

    An empty string or category list counts as not supplied.  ``ids`` is a table
    with a ``paper_id`` column, or a list; an empty one selects nothing.
    Text filters look for the literal text and ignore case in any script.  On the
    store's table the date bounds prune month partitions as well as row groups.
    """
    if ids is not None and not isinstance(ids, DataFrame):
        rows = [{"paper_id": i} for i in ids]
        ids = small_table(papers.sparkSession, rows, "paper_id:string")
    if ids is not None:
        papers = papers.join(ids.select("paper_id"), "paper_id", "left_semi")
    if categories:
        papers = papers.filter(F.col("primary_category").isin(list(categories)))
    if start is not None or end is not None:
        papers = papers.filter(in_window(F.col("published"), start, end))
        if "published_month" in papers.columns:
            papers = papers.filter(_month_bounds(start, end))
    if title_contains:
        papers = papers.filter(contains_ignoring_case(F.col("title"), title_contains))
    if summary_contains:
        papers = papers.filter(contains_ignoring_case(F.col("summary"), summary_contains))
    if author_name_contains:
        papers = papers.filter(author_contains(F.col("authors"), author_name_contains))
    if text_contains:
        papers = papers.filter(
            contains_ignoring_case(F.col("title"), text_contains)
            | contains_ignoring_case(F.col("summary"), text_contains)
            | author_contains(F.col("authors"), text_contains)
        )
    return papers


def _month_bounds(start: dt.date | None, end: dt.date | None) -> Column:
    """Months that can hold text between the bounds; a prefix keeps text order."""
    month = F.col("published_month")
    inside = F.lit(True)
    if start is not None:
        inside = inside & (month >= start.isoformat()[:7])
    if end is not None:
        inside = inside & (month <= day_after(end).isoformat()[:7])
    return inside
