"""Label history as validity intervals, and labels at a date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def label_intervals(run_papers: DataFrame) -> DataFrame:
    """(paper_id, label, from_run, to_run, runs): a paper has the label from one run up to, not including, another.

    ``to_run`` is null for the label that still holds; ``runs`` is how many runs gave it.  A run that did not see the paper
    changes nothing.  A paper's rows are sorted by run within its partition, and there are at most as many as runs.
    """
    by_run = Window.partitionBy("paper_id").orderBy("run_id")
    seen = run_papers.select("paper_id", "run_id", "label")
    changed = ~F.col("label").eqNullSafe(F.lag("label").over(by_run)) | (F.row_number().over(by_run) == 1)
    marked = seen.withColumn("_change", changed).withColumn("_seen", F.row_number().over(by_run))
    last = F.max("_seen").over(Window.partitionBy("paper_id"))
    turns = marked.withColumn("_last", last).filter("_change")
    later = F.lead("_seen").over(by_run)
    return turns.select(
        "paper_id",
        "label",
        F.col("run_id").alias("from_run"),
        F.lead("run_id").over(by_run).alias("to_run"),
        (F.coalesce(later, F.col("_last") + 1) - F.col("_seen")).cast("bigint").alias("runs"),
    )


def labels_as_of(run_papers: DataFrame, runs: DataFrame, questions: DataFrame) -> DataFrame:
    """Questions (paper_id, as_of) with the label that the paper had then; null before its first run.

    ``runs`` tells when a run was (``collected_at``, text in time order); of several at one time the latest counts.  Labels and
    questions are one sorted sequence per paper in which a question takes the last label before it, so no pairs are made
    and an interval with many questions costs no more than they do.
    """
    when = runs.select("run_id", F.col("collected_at").alias("_at"))
    given = run_papers.select("paper_id", "run_id", "label").join(when, "run_id")
    facts = given.select("paper_id", "_at", F.lit(0).alias("_kind"), "run_id", F.struct("label", "run_id").alias("_label"))
    kind = facts.schema["_label"].dataType
    asked = questions.select(
        "paper_id",
        F.col("as_of").alias("_at"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast("bigint").alias("run_id"),
        F.lit(None).cast(kind).alias("_label"),
    )
    order = Window.partitionBy("paper_id").orderBy("_at", "_kind", "run_id")
    known = F.last("_label", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = facts.unionByName(asked).withColumn("_known", known).filter("_kind = 1")
    return rows.select(
        "paper_id", F.col("_at").alias("as_of"), F.col("_known.label").alias("label"), F.col("_known.run_id").alias("run_id")
    )
