"""Incremental ingest: newly landed feed pages into the store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from paperloom.config import FilterConfig
from paperloom.operators.score import score_papers
from paperloom.plans.run import STAGED_COLUMNS, record, triage_feed
from paperloom.plans.staging import staging
from paperloom.plans.store import PaperStore
from paperloom.sources.feed import (
    feed_page_stream,
    page_entries,
    parse_pages,
    quarantine,
    valid_papers,
)
from paperloom.streaming.arrivals import LANDED, first_arrivals


def ingest_batch(
    pages: DataFrame,
    batch: int,
    config: FilterConfig,
    store: PaperStore,
    writer: str,
    collected_at: str | None = None,
) -> int:
    """Merge, score and record a batch of pages as one run; returns the run id.

    Pages are parsed once; what cannot be taken in goes to the quarantine table.
    The store knows the run by ``writer`` and ``batch``: a repeated batch keeps its id, and its
    rows replace those of the attempt before.  The window is what the batch covers.
    """
    with staging(store.spark, store.staging_dir()) as put:
        parsed = put(parse_pages(pages), "pages")
        scored = triage_feed(valid_papers(page_entries(parsed)), config)
        return _record(scored, quarantine(parsed), put, batch, store, writer, collected_at)


def _record(
    scored: DataFrame,
    skipped: DataFrame,
    put: Callable[[DataFrame, str], DataFrame],
    batch: int,
    store: PaperStore,
    writer: str,
    collected_at: str | None = None,
) -> int:
    claim = store.claim(1, writer, batch)
    slug = f"batch_{claim.run_id}"
    placed = scored.withColumns({"window_slug": F.lit(slug), "window_ordinal": F.lit(0).cast("long")})
    rows = put(placed.select(*STAGED_COLUMNS), "batch")
    day = F.left("published", F.lit(10))
    windows = rows.agg(F.min(day).alias("window_start"), F.max(day).alias("window_end")).select(
        F.lit(slug).alias("window_slug"),
        "window_start",
        "window_end",
        F.lit(0).cast("long").alias("window_ordinal"),
    )
    record(rows, windows, store, claim, collected_at=collected_at, skipped=skipped)
    return claim.run_id


def stream_feed(
    path: str,
    config: FilterConfig,
    store: PaperStore,
    checkpoint: str,
    files_per_batch: int | None = None,
    writer: str | None = None,
    merge_within: str | None = None,
) -> StreamingQuery:
    """Take in all pages landed since the last call and stop.

    With ``merge_within`` (such as "30 days") a paper that landed in an earlier batch within that time keeps the attributes of its
    first arrival and gains sources; without it, merging ends at the batch.  A checkpoint belongs to one of the two ways.

    A backlog is worked off in batches of ``files_per_batch`` files, or in one.

    ``checkpoint`` is a folder on the shared file system.  The store knows the stream's batches by
    ``writer``, which is the checkpoint's path unless it is named; give a moved checkpoint its old name.
    """

    def ingest(pages: DataFrame, batch_id: int) -> None:
        ingest_batch(pages, batch_id, config, store, writer or checkpoint)

    def ingest_merged(rows: DataFrame, batch_id: int) -> None:
        with staging(store.spark, store.staging_dir()) as put:
            both = put(rows, "merged")
            papers = both.where(F.col("paper").isNotNull()).select("paper.*")
            skipped = both.where(F.col("skipped").isNotNull()).select("skipped.*")
            _record(score_papers(papers, config), skipped, put, batch_id, store, writer or checkpoint)

    reader = feed_page_stream(store.spark)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    pages = reader.load(path)
    if merge_within:
        rows, ingest = merged_feed(pages, merge_within), ingest_merged
    else:
        rows = pages
    return (
        rows.writeStream.foreachBatch(ingest)
        .outputMode("update" if merge_within else "append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merged_feed(pages: DataFrame, keep: str) -> DataFrame:
    """A stream of papers (``paper``, with all sources so far) and of what cannot be taken in (``skipped``)."""
    landed = pages.withColumn(LANDED, F.col("_metadata.file_modification_time"))
    parsed = parse_pages(landed, LANDED)
    entries = page_entries(parsed, LANDED)
    papers = first_arrivals(valid_papers(entries, LANDED), keep)
    refused = quarantine(parsed)
    none = {c: F.lit(None).cast(t.dataType) for c, t in (("paper", T.StructField("", papers.schema)), ("skipped", T.StructField("", refused.schema)))}
    return papers.select(F.struct(*papers.columns).alias("paper"), none["skipped"].alias("skipped")).unionByName(
        refused.select(none["paper"].alias("paper"), F.struct(*refused.columns).alias("skipped"))
    )
