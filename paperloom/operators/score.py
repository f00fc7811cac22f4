"""Relevance scores, reasons and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paperloom import defaults
from paperloom.config import FilterConfig
from paperloom.operators.terms import SCORING_TIERS, match_terms, on_tier

LABELS = ("core", "adjacent", "unlikely")
SCORE_COLUMNS = ["score", "label", "reasons", "has_anchor"]


def listed(value: Column, names: tuple[str, ...]) -> Column:
    """Membership in a config list; null is on no list."""
    return F.coalesce(value.isin(list(names)), F.lit(False)) if names else F.lit(False)


def label_of(score: Column) -> Column:
    return (
        F.when(score >= defaults.CORE_SCORE, "core")
        .when(score >= defaults.ADJACENT_SCORE, "adjacent")
        .otherwise("unlikely")
    )


def label_rank(label: Column) -> Column:
    return F.when(label == "core", 0).when(label == "adjacent", 1).otherwise(2)


def is_relevant(score: Column) -> Column:
    return score >= defaults.ADJACENT_SCORE


def has_anchor(hits: Column, primary_category: Column, config: FilterConfig) -> Column:
    """Only the primary category can anchor a paper, never its further categories."""
    return listed(primary_category, config.anchors) | F.exists(
        hits, lambda hit: on_tier(hit, "anchor")
    )


def raw_score(hits: Column, primary_category: Column, config: FilterConfig) -> Column:
    """Points of all hits and of the category, before the anchor rule."""
    points = F.aggregate(
        hits,
        F.lit(0),
        lambda total, hit: total
        + F.when(hit["place"] == "title", hit["title_points"]).otherwise(
            hit["summary_points"]
        ),
    )
    return points + F.when(
        listed(primary_category, config.categories), defaults.CATEGORY_POINTS
    ).otherwise(0)


def reasons(
    hits: Column, primary_category: Column, anchored: Column, config: FilterConfig
) -> Column:
    """Sorted distinct notes on what moved the score."""

    def noted(hit: Column) -> Column:
        return F.array(
            F.when(
                on_tier(hit, "core", "adjacent"),
                F.concat(hit["place"], F.lit(":"), hit["term"]),
            ),
            F.when(on_tier(hit, "exclude"), F.concat(F.lit("exclude:"), hit["term"])),
        )

    paper_notes = F.array(
        F.when(
            listed(primary_category, config.categories),
            F.concat(F.lit("category:"), primary_category),
        ),
        F.when(~anchored, F.lit("no-anchor")),
    )
    notes = F.concat(F.flatten(F.transform(hits, noted)), paper_notes)
    return F.array_sort(F.array_distinct(F.array_compact(notes)))


def with_scores(matched: DataFrame, config: FilterConfig, hits: str = "term_hits") -> DataFrame:
    """Score papers that already carry their term hits."""
    found, primary = F.col(hits), F.col("primary_category")
    anchored = has_anchor(found, primary, config)
    raw = raw_score(found, primary, config)
    # ``least`` skips nulls: an anchored paper has no ceiling.
    score = F.least(raw, F.when(~anchored, defaults.NO_ANCHOR_CEILING))
    return matched.withColumns(
        {"has_anchor": anchored, "raw_score": raw, "score": score}
    ).withColumns(
        {
            "label": label_of(F.col("score")),
            "reasons": reasons(found, primary, F.col("has_anchor"), config),
        }
    )


def score_papers(papers: DataFrame, config: FilterConfig) -> DataFrame:
    """Add ``score``, ``label``, ``reasons`` and ``has_anchor``; a narrow operation."""
    scored = with_scores(match_terms(papers, config, SCORING_TIERS), config)
    return scored.drop("term_hits", "raw_score")


def relevant(scored: DataFrame) -> DataFrame:
    return scored.filter(is_relevant(F.col("score")))


def label_counts(scored: DataFrame, *keys: str) -> DataFrame:
    """Totals per label for the whole input or per key, in one pass."""
    return scored.groupBy(*keys).agg(
        F.count("*").alias("total_candidates"),
        *[F.count_if(F.col("label") == name).alias(f"{name}_count") for name in LABELS],
    )
