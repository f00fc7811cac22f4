"""A triage run: candidates to scored papers, store and exports.

All windows of a run go through one job; the window is a column, never a loop.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from paperloom import schemas
from paperloom.config import FilterConfig
from paperloom.functions.dates import published_date, range_slug
from paperloom.operators.candidates import in_window, tagged_candidates
from paperloom.operators.merge import merge_papers
from paperloom.operators.score import (
    SCORE_COLUMNS,
    label_counts,
    relevant,
    score_papers,
    with_scores,
)
from paperloom.operators.windows import (
    in_month_weeks,
    month_windows,
    single_window,
)
from paperloom.plans import exports, single
from paperloom.plans.staging import staging
from paperloom.plans.store import Claim, PaperStore


STAGED_COLUMNS = [
    "window_slug",
    "window_ordinal",
    *schemas.PAPER_COLUMNS,
    "sources",
    *SCORE_COLUMNS,
]


def utc_now() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat()


def triage_documents(
    papers: DataFrame,
    config: FilterConfig,
    start: dt.date | None = None,
    end: dt.date | None = None,
    keys: tuple[str, ...] = ("paper_id",),
    unique: bool = False,
) -> DataFrame:
    """Tag and score the candidates of a table of papers, then merge them by id.

    Tagging and scoring are narrow.  With ``unique`` the caller vouches that no id
    comes twice, and nothing at all is shuffled.  Otherwise the copy whose first
    source comes first wins, and among those the one whose columns sort first.
    """
    tagged = with_scores(tagged_candidates(papers, config, start, end), config)
    columns = [*papers.columns, "sources", *SCORE_COLUMNS]
    if unique:
        return tagged.select(*columns)
    # The order of the struct is the order of preference, and it holds every column once.
    rest = [c for c in papers.columns if c not in keys]
    copy = F.struct("source_ordinal", *rest, *SCORE_COLUMNS)
    sources = F.array_sort(F.array_distinct(F.flatten(F.collect_set("sources"))))
    merged = tagged.groupBy(*keys).agg(F.min(copy).alias("first"), sources.alias("sources"))
    return merged.select(*keys, "first.*", "sources").select(*columns)


def undated(papers: DataFrame) -> DataFrame:
    """Quarantine rows of the papers whose ``published`` is no full date: no window can hold them."""
    lost = papers.filter(published_date(F.col("published")).isNull())
    place = {f.name: f.dataType for f in schemas.QUARANTINE.fields if f.name not in schemas.RUN_KEYS}
    known = {"abs_url": F.col("abs_url"), "reason": F.lit("no full date")}
    return lost.select(
        *[known.get(c, F.col(c) if c in papers.columns else F.lit(None)).cast(t).alias(c) for c, t in place.items()]
    )


def triage_feed(
    candidates: DataFrame, config: FilterConfig, keys: tuple[str, ...] = ("paper_id",)
) -> DataFrame:
    """Merge feed records by id, then score each paper once."""
    return score_papers(merge_papers(candidates, keys=keys), config)


def run_rows(
    scored: DataFrame, windows: DataFrame, first_run_id: int, collected_at: str, config_path: str = ""
) -> DataFrame:
    """One run-log row per window, empty windows included."""
    counts = windows.join(label_counts(scored, "window_slug"), "window_slug", "left")

    def total(name: str):
        return F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)

    return counts.select(
        F.lit(collected_at).alias("collected_at"),
        F.col("window_start").cast("string").alias("window_start"),
        F.col("window_end").cast("string").alias("window_end"),
        total("total_candidates"),
        total("core_count"),
        total("adjacent_count"),
        F.lit(config_path).alias("config_path"),
        (F.col("window_ordinal") + first_run_id).alias("run_id"),
    )


def record(
    scored: DataFrame,
    windows: DataFrame,
    store: PaperStore,
    claim: Claim,
    config_path: str = "",
    collected_at: str | None = None,
    out_dir: str | None = None,
    heading: str = exports.DIGEST_HEADING,
    skipped: DataFrame | None = None,
    single_files: bool = False,
) -> None:
    """Store relevant papers, write exports of all rows, log what was skipped, run papers and runs.

    ``scored`` carries ``window_slug`` and ``window_ordinal``; ``windows`` is the short
    table of windows.  ``single_files`` makes one file of each export of a window instead of ordered parts.
    """
    now = collected_at or utc_now()
    rows = scored.withColumn("run_id", F.col("window_ordinal") + claim.run_id)
    store.upsert(relevant(rows).withColumn("latest_seen_at", F.lit(now)), claim)
    if out_dir:
        write = single.write_single_exports if single_files else exports.write_exports
        write(scored, windows, out_dir, heading)
    if skipped is not None:
        store.record_quarantine(skipped.withColumn("run_id", F.lit(claim.run_id).cast("long")), claim)
    store.record_run_papers(rows, claim)
    store.record_runs(run_rows(scored, windows, claim.run_id, now, config_path), claim)


def run_window(
    candidates: DataFrame,
    config: FilterConfig,
    store: PaperStore,
    start: dt.date,
    end: dt.date,
    landed: bool = False,
    skipped: DataFrame | None = None,
    **options,
) -> int:
    """Run one window over landed feed records or a table of papers; returns the run id.

    ``landed`` records bring their sources and are merged; papers from a table are tagged
    with the sources that would have found them.  ``skipped`` rows (``feed.quarantine``) and papers without a
    full date go to the store's quarantine.
    """
    lost = _lost(candidates, skipped)
    dated = candidates.filter(published_date(F.col("published")).isNotNull())
    if landed:
        inside = dated.filter(in_window(F.col("published"), start, end))
        scored = triage_feed(inside, config)
    else:
        scored = triage_documents(dated, config, start, end)
    scored = scored.withColumns(
        {
            "window_slug": F.lit(range_slug(start, end)),
            "window_ordinal": F.lit(0).cast("long"),
        }
    )
    return _finish(scored, single_window(store.spark, start, end), 1, lost, store, **options)


def run_month(
    candidates: DataFrame,
    config: FilterConfig,
    store: PaperStore,
    month: str,
    landed: bool = False,
    skipped: DataFrame | None = None,
    **options,
) -> int:
    """Run all 7-day windows of a ``YYYY-MM`` month in one pass; returns the first run id.

    Takes the options of ``run_window``; what was skipped is logged with the first run.
    """
    lost = _lost(candidates, skipped)
    windows = month_windows(store.spark, [month])
    first = dt.datetime.strptime(month, "%Y-%m").date()
    last = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    dated = candidates.filter(published_date(F.col("published")).isNotNull())
    weekly = in_month_weeks(dated.filter(in_window(F.col("published"), first, last)))
    keys = ("window_slug", "paper_id")
    if landed:
        scored = triage_feed(weekly, config, keys)
    else:
        scored = triage_documents(weekly, config, keys=keys)
    return _finish(scored, windows, (last.day + 6) // 7, lost, store, **options)


def _lost(candidates: DataFrame, skipped: DataFrame | None) -> DataFrame:
    lost = undated(candidates)
    return lost if skipped is None else lost.unionByName(skipped.select(*lost.columns))


def _finish(
    scored: DataFrame, windows: DataFrame, n_windows: int, lost: DataFrame, store: PaperStore, **options
) -> int:
    claim = store.claim(n_windows)
    with staging(store.spark, store.staging_dir()) as put:
        rows = put(scored.select(*STAGED_COLUMNS), "scored")
        record(rows, windows, store, claim, skipped=lost, **options)
    return claim.run_id
