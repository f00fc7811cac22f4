"""Reports on labels: shortlist, agreement with ground truth, config comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom.config import FilterConfig
from paperloom.operators.score import is_relevant, with_scores
from paperloom.operators.terms import SCORING_TIERS, match_terms


def shortlist(scored: DataFrame) -> DataFrame:
    """Core and adjacent papers with their reasons on one line."""
    return scored.filter(F.col("label").isin("core", "adjacent")).select(
        "paper_id", "title", "label", "score", F.array_join("reasons", ", ").alias("why")
    )


def label_confusion(scored: DataFrame, truth: DataFrame, is_positive: Column) -> DataFrame:
    """Per label: how many papers the ground truth calls positive or negative.

    ``truth`` is keyed by ``paper_id``.  A relevant label on a negative is a false
    positive, ``unlikely`` on a positive a false negative.
    """
    judged = scored.select("paper_id", "label", "score").join(
        truth.select("paper_id", is_positive.alias("positive")), "paper_id"
    )
    called = is_relevant(F.col("score"))
    positive = F.col("positive")
    return judged.groupBy("label").agg(
        F.count("*").alias("papers"),
        F.count_if(called & positive).alias("true_positives"),
        F.count_if(called & ~positive).alias("false_positives"),
        F.count_if(~called & positive).alias("false_negatives"),
        F.count_if(~called & ~positive).alias("true_negatives"),
    )


def threshold_curve(scored: DataFrame, truth: DataFrame, is_positive: Column) -> DataFrame:
    """Precision and recall of calling a paper relevant from each score on, highest first.

    One pass makes a histogram of positives and negatives by score; running sums over it, with one row per distinct score, give
    every threshold.  ``recall`` is null without positives.
    """
    judged = scored.select("paper_id", "score").join(truth.select("paper_id", is_positive.alias("positive")), "paper_id")
    histogram = judged.groupBy("score").agg(
        F.count_if("positive").alias("positives"), F.count_if(~F.col("positive")).alias("negatives")
    )
    from_top = Window.orderBy(F.desc("score"))
    hits, misses = F.sum("positives").over(from_top), F.sum("negatives").over(from_top)
    total = F.sum("positives").over(Window.partitionBy())
    rows = histogram.select(
        F.col("score").alias("threshold"),
        hits.alias("true_positives"),
        misses.alias("false_positives"),
        (total - hits).alias("false_negatives"),
    )
    called = F.col("true_positives") + F.col("false_positives")
    positives = F.col("true_positives") + F.col("false_negatives")
    return rows.withColumns(
        {
            "precision": F.col("true_positives") / called,
            "recall": F.when(positives > 0, F.col("true_positives") / positives),
        }
    )


def config_diff(papers: DataFrame, old: FilterConfig, new: FilterConfig) -> DataFrame:
    """Label transitions between two configs, both scored in one scan."""
    needed = papers.select("title", "summary", "primary_category")
    both = match_terms(match_terms(needed, old, SCORING_TIERS, "old"), new, SCORING_TIERS, "new")
    before = with_scores(both, old, "old").select(
        F.col("label").alias("old_label"), "new", "primary_category"
    )
    after = with_scores(before, new, "new")
    return after.groupBy("old_label", F.col("label").alias("new_label")).agg(
        F.count("*").alias("papers")
    )
