"""New scores after a change of the config, without another search for terms that were searched before."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paperloom.config import FilterConfig
from paperloom.operators.score import with_scores
from paperloom.operators.terms import SCORING_TIERS, describe_hits, match_entries, term_entries


def added_terms(old: FilterConfig, new: FilterConfig) -> list[str]:
    """Terms whose hits are not stored."""
    known = term_entries(old, SCORING_TIERS)
    return [term for term in term_entries(new, SCORING_TIERS) if term not in known]


def rescore(stored: DataFrame, old: FilterConfig, new: FilterConfig, hits: str = "term_hits") -> DataFrame:
    """Papers with the hits of the old config, scored by the new one.

    Hits of terms that stay are taken from ``hits`` and given their new lists and points, hits of removed terms fall away, and
    only added terms are looked for; without any, no text is read.  Gives the columns of ``score_papers`` and the new hits,
    so that the result can be rescored in turn.
    """
    entries = term_entries(new, SCORING_TIERS)
    added = {term: entries[term] for term in added_terms(old, new)}
    kept = F.filter(F.transform(hits, lambda h: F.struct(h["term"], h["place"])), lambda h: h["term"].isin(list(entries)))
    if not entries:
        kept = F.filter(kept, lambda h: F.lit(False))
    rows = stored.withColumn("_kept", kept).drop(hits)
    if added:
        rows = match_entries(rows, added, "_new")
        found = F.concat("_kept", F.transform("_new", lambda h: F.struct(h["term"], h["place"])))
    else:
        found = F.col("_kept")
    rows = rows.withColumn(hits, describe_hits(found, entries)).drop("_kept", "_new")
    return with_scores(rows, new, hits).drop("raw_score")
