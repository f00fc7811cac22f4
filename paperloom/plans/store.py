"""The paper store: change log, snapshots, run log and run papers, all Parquet.

The store gives out run ids.  Before anything is written, a claim says which writer and batch
a range of ids belongs to and which attempt at it this is; a repeated batch gets its old ids
and the next attempt.  Data go into partitions of run and attempt, the run-log rows come last.  Readers
join the run log, so they see the last finished attempt of every run and nothing of unfinished
ones, whatever their ids.  One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from paperloom import schemas


@dataclass(frozen=True)
class Claim:
    """Consecutive run ids, from ``run_id`` on, for one attempt at a batch."""

    run_id: int
    runs: int
    attempt: int


def latest_changes(changes: DataFrame) -> DataFrame:
    """Newest row per paper, whole: the last run wins, whatever its dates."""
    rest = [c for c in changes.columns if c not in ("paper_id", "run_id")]
    return (
        changes.groupBy("paper_id")
        .agg(
            F.max_by(F.struct(*rest), "run_id").alias("latest"),
            F.max("run_id").alias("run_id"),
        )
        .select("paper_id", "latest.*", "run_id")
    )


def apply_changes(base: DataFrame, changes: DataFrame, buckets: int | None = None) -> DataFrame:
    """Upsert: for every paper the row of the newest run, from the base or from the changes.

    Base rows without a change are only filtered against the changed ids.  Spark broadcasts
    those when their size allows it, and then the base is not shuffled at all.  With ``buckets`` the newest
    rows of changed papers lie in so many parts by the hash of their id, as in a bucketed base.
    """
    ids = changes.select("paper_id").distinct()
    kept = base.join(ids, "paper_id", "left_anti")
    # A run that was finished late may be older than the base row.
    touched = base.join(ids, "paper_id", "left_semi").select(*changes.columns)
    newest = latest_changes(changes.unionByName(touched))
    if buckets:
        newest = newest.repartition(buckets, "paper_id")
    return kept.select(*newest.columns).unionByName(newest)


def run_history(run_papers: DataFrame, runs: DataFrame, papers: DataFrame) -> DataFrame:
    """Label of every stored paper in every run that saw it."""
    seen = run_papers.select("run_id", "paper_id", "label")
    when = runs.select("run_id", "window_start", "window_end")
    return seen.join(when, "run_id").join(papers.select("paper_id", "title"), "paper_id")


def run_orphans(run_papers: DataFrame, papers: DataFrame) -> DataFrame:
    """Run papers that were never stored."""
    return run_papers.join(papers.select("paper_id"), "paper_id", "left_anti")


class PaperStore:
    """Tables under one directory of the shared file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def create(self) -> PaperStore:
        """Make the tables that do not exist yet."""
        for name, schema, keys in (
            ("claims", schemas.CLAIMS, []),
            ("changes", schemas.CHANGES, schemas.RUN_KEYS),
            ("base", schemas.BASE, ["snapshot", "published_month"]),
            ("snapshots", schemas.SNAPSHOTS, []),
            ("runs", schemas.RUNS, schemas.RUN_KEYS),
            ("run_papers", schemas.RUN_PAPERS, schemas.RUN_KEYS),
            ("quarantine", schemas.QUARANTINE, schemas.RUN_KEYS),
        ):
            empty = self.spark.createDataFrame([], schema)
            empty.write.mode("ignore").partitionBy(*keys).parquet(self._path(name))
        return self

    def claim(self, runs: int = 1, writer: str | None = None, batch: int = 0) -> Claim:
        """Ids for the runs of a batch; the same ones if this writer has claimed the batch before."""
        claims = self._read("claims", schemas.CLAIMS)
        mine = claims.filter((F.col("writer") == (writer or "")) & (F.col("batch") == batch))
        old = mine.agg(F.min("run_id"), F.max("attempt"), F.max("runs")).first() if writer else None
        if old and old[0] is not None:
            if runs != old[2]:
                raise ValueError(f"batch {batch} of {writer} was claimed for {old[2]} runs, not {runs}")
            made = Claim(old[0], runs, old[1] + 1)
        else:
            last = claims.agg(F.max(F.col("run_id") + F.col("runs") - 1)).first()[0] or 0
            made = Claim(last + 1, runs, 1)
        row = (writer or uuid.uuid4().hex, batch, made.run_id, runs, made.attempt)
        self.spark.createDataFrame([row], schemas.CLAIMS).write.mode("append").parquet(self._path("claims"))
        return made

    def _finished(self) -> DataFrame:
        """run_id and attempt of the last finished attempt of every run."""
        log = self._read("runs", schemas.RUNS)
        return log.groupBy("run_id").agg(F.max("attempt").alias("attempt"))

    def _of_finished(self, table: str, schema: StructType) -> DataFrame:
        rows = self._read(table, schema).join(self._finished(), schemas.RUN_KEYS, "left_semi")
        return rows.select(*[c for c in schema.fieldNames() if c != "attempt"])

    def runs(self) -> DataFrame:
        return self._of_finished("runs", schemas.RUNS)

    def run_papers(self) -> DataFrame:
        """Rows of finished runs."""
        return self._of_finished("run_papers", schemas.RUN_PAPERS)

    def quarantine(self) -> DataFrame:
        """Pages and records that finished runs could not take in."""
        return self._of_finished("quarantine", schemas.QUARANTINE)

    def last_run_id(self) -> int:
        """The greatest id of a finished run."""
        return self._finished().agg(F.max("run_id")).first()[0] or 0

    def last_snapshot(self) -> int:
        """The newest snapshot whose runs have not been repeated since, or 0."""
        parts = self._read("snapshots", schemas.SNAPSHOTS)
        same = parts.join(self._finished(), schemas.RUN_KEYS, "left_semi").groupBy("snapshot").count()
        whole = parts.groupBy("snapshot").count().join(same, ["snapshot", "count"], "left_semi")
        return whole.agg(F.max("snapshot")).first()[0] or 0

    def papers(self) -> DataFrame:
        """Current papers: newest snapshot plus the changes of finished runs that are not in it."""
        snapshot = self.last_snapshot()
        wanted = self._finished()
        if snapshot:
            parts = self._read("snapshots", schemas.SNAPSHOTS).filter(F.col("snapshot") == snapshot)
            wanted = wanted.join(parts, schemas.RUN_KEYS, "left_anti")
        changes = (
            self._read("changes", schemas.CHANGES)
            .join(wanted, schemas.RUN_KEYS, "left_semi")
            .select(*schemas.CHANGE_COLUMNS)
            .withColumn("published_month", F.left("published", F.lit(7)))
        )
        if snapshot:
            base = self._read("base", schemas.BASE).filter(F.col("snapshot") == snapshot)
            current = apply_changes(base, changes)
        else:
            current = latest_changes(changes)
        return current.select(*schemas.CHANGE_COLUMNS, "published_month")

    def upsert(self, papers: DataFrame, claim: Claim) -> None:
        """Log papers that carry ``run_id`` and ``latest_seen_at``, unique per run."""
        self._write(papers, "changes", schemas.CHANGES, claim)

    def record_run_papers(self, rows: DataFrame, claim: Claim) -> None:
        self._write(rows, "run_papers", schemas.RUN_PAPERS, claim)

    def record_quarantine(self, rows: DataFrame, claim: Claim) -> None:
        self._write(rows, "quarantine", schemas.QUARANTINE, claim)

    def record_runs(self, rows: DataFrame, claim: Claim) -> None:
        """Finish runs; written after everything else that belongs to them."""
        self._write(rows, "runs", schemas.RUNS, claim)

    def compact(self) -> int:
        """Write current papers as a new snapshot by month and switch readers to it.

        The snapshot is listed last, with the runs and attempts it holds.  One that died half-way is
        not listed, and its number is not used again.
        """
        last = self.last_snapshot()
        held = self._read("snapshots", schemas.SNAPSHOTS).filter(F.col("snapshot") == last)
        if self._finished().join(held, schemas.RUN_KEYS, "left_anti").isEmpty():
            return last
        known = [
            self._read(name, schema).agg(F.max("snapshot")).first()[0] or 0
            for name, schema in (("base", schemas.BASE), ("snapshots", schemas.SNAPSHOTS))
        ]
        snapshot = max(known) + 1
        current = self.papers().withColumn("snapshot", F.lit(snapshot).cast("long"))
        by_month = current.hint("rebalance", "published_month").select(*schemas.BASE.fieldNames())
        by_month.write.mode("append").partitionBy("snapshot", "published_month").parquet(self._path("base"))
        # One writer at a time: the log is what it was when the papers were read.
        done = self._finished().select(F.lit(snapshot).cast("long").alias("snapshot"), *schemas.RUN_KEYS)
        done.write.mode("append").parquet(self._path("snapshots"))
        return snapshot

    def history(self) -> DataFrame:
        return run_history(self.run_papers(), self.runs(), self.papers())

    def orphans(self) -> DataFrame:
        return run_orphans(self.run_papers(), self.papers())

    def staging_dir(self) -> str:
        return self._path("staging")

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _read(self, table: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self._path(table))

    def _write(self, rows: DataFrame, table: str, schema: StructType, claim: Claim) -> None:
        (
            rows.withColumn("attempt", F.lit(claim.attempt).cast("long"))
            .select(*schema.fieldNames())
            .hint("rebalance", "run_id")
            .write.mode("append")
            .partitionBy(*schemas.RUN_KEYS)
            .parquet(self._path(table))
        )
