"""Substring matching of config terms against titles and summaries.

Every term of the config is looked for once per paper, whatever lists it is on.
The hits feed scoring, reasons, the anchor rule and keyword sources alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from paperloom import defaults
from paperloom.config import FilterConfig
from paperloom.functions.literals import as_bytes, constant

SCORING_TIERS = ("core", "adjacent", "exclude", "anchor")
QUERY_TIER = "query"
ALL_TIERS = (*SCORING_TIERS, QUERY_TIER)

_ENTRY = "struct<tiers:array<string>,title_points:int,summary_points:int,chunks:array<int>>"


@dataclass
class TermEntry:
    """What one distinct term stands for: its lists, points and keyword chunks."""

    tiers: list[str] = field(default_factory=list)
    title_points: int = 0
    summary_points: int = 0
    chunks: list[int] = field(default_factory=list)


def term_entries(config: FilterConfig, tiers: Iterable[str] = ALL_TIERS) -> dict[str, TermEntry]:
    """Distinct terms of the wanted lists.

    A term listed twice, or on two lists, adds up here.  Titles and summaries are
    lowered before matching, scoring terms are not; query terms are.
    """
    points = {
        "core": (config.core_terms, defaults.CORE_TITLE_POINTS, defaults.CORE_SUMMARY_POINTS),
        "adjacent": (
            config.adjacent_terms, defaults.ADJACENT_TITLE_POINTS, defaults.ADJACENT_SUMMARY_POINTS,
        ),
        "exclude": (config.exclude_terms, defaults.EXCLUDE_POINTS, defaults.EXCLUDE_POINTS),
        "anchor": (config.anchor_terms, 0, 0),
        QUERY_TIER: ([term.lower() for term in config.keywords], 0, 0),
    }
    entries: dict[str, TermEntry] = {}
    for tier in ALL_TIERS:
        if tier not in tiers:
            continue
        terms, in_title, in_summary = points[tier]
        for ordinal, term in enumerate(terms):
            entry = entries.setdefault(term, TermEntry())
            entry.title_points += in_title
            entry.summary_points += in_summary
            if tier not in entry.tiers:
                entry.tiers.append(tier)
            if tier == QUERY_TIER and config.keyword_chunk(ordinal) not in entry.chunks:
                entry.chunks.append(config.keyword_chunk(ordinal))
    return entries


def guarded(terms: Iterable[str]) -> dict[str, list[str]]:
    """Terms grouped under a word that all of a group contain.

    A text without the word has none of its terms.  A term that shares no word with
    another stands under itself.
    """
    terms = list(dict.fromkeys(terms))
    words = {word for term in terms for word in re.findall(r"\w+", term)}
    shared = {word: sum(word in term for term in terms) for word in words}
    groups: dict[str, list[str]] = {}
    for term in terms:
        inside = [word for word in re.findall(r"\w+", term) if shared[word] > 1]
        guard = max(inside, key=lambda word: (shared[word], word), default=term)
        groups.setdefault(guard, []).append(term)
    return groups


def terms_in(text: Column, terms: Iterable[str]) -> Column:
    """Those of the terms that a text contains, as an array.

    ``text`` is UTF-8 in binary form: containing the bytes is containing the text, and
    Spark searches byte arrays faster than strings.
    """
    groups = constant(
        [
            {"guard": as_bytes(guard), "terms": [as_bytes(term) for term in members]}
            for guard, members in guarded(terms).items()
        ],
        "array<struct<guard:binary,terms:array<binary>>>",
    )
    possible = F.filter(groups, lambda group: F.contains(text, group["guard"]))
    candidates = F.flatten(F.transform(possible, lambda group: group["terms"]))
    found = F.filter(candidates, lambda term: F.contains(text, term))
    return found.cast("array<string>")


def match_terms(
    papers: DataFrame,
    config: FilterConfig,
    tiers: Iterable[str] = ALL_TIERS,
    into: str = "term_hits",
) -> DataFrame:
    """Add the array of terms found in each paper, with the place they were found.

    ``place`` is ``title`` when the title has the term and ``summary`` when only the
    summary does.  The search itself comes out of an ``explode`` over an array of
    exactly one element: the texts are lowered once per paper rather than once per
    term, and no later filter on a score can pull a second search below it.
    """
    return match_entries(papers, term_entries(config, tiers), into)


def match_entries(papers: DataFrame, entries: dict[str, TermEntry], into: str = "term_hits") -> DataFrame:
    """``match_terms`` for terms that are already looked up."""
    texts = F.array(
        F.struct(
            F.lower(F.coalesce(F.col("title"), F.lit(""))).cast("binary").alias("title"),
            F.lower(F.coalesce(F.col("summary"), F.lit(""))).cast("binary").alias("summary"),
        )
    )
    found = F.transform(
        texts,
        lambda text: F.struct(
            terms_in(text["title"], entries).alias("title"),
            terms_in(text["summary"], entries).alias("summary"),
        ),
    )
    title = F.col(f"{into}.title")
    summary_only = F.array_except(F.col(f"{into}.summary"), title)
    placed = F.concat(_placed(title, "title"), _placed(summary_only, "summary"))
    return papers.select("*", F.explode(found).alias(into)).withColumn(into, describe_hits(placed, entries))


def _placed(words: Column, place: str) -> Column:
    return F.transform(words, lambda word: F.struct(word.alias("term"), F.lit(place).alias("place")))


def describe_hits(placed: Column, entries: dict[str, TermEntry]) -> Column:
    """Hits (term, place) with what the terms stand for."""
    lookup = constant({term: asdict(entry) for term, entry in entries.items()}, f"map<string,{_ENTRY}>")

    def described(hit: Column) -> Column:
        entry = lookup[hit["term"]]
        return F.struct(
            hit["term"].alias("term"),
            *[entry[name].alias(name) for name in ("tiers", "title_points", "summary_points", "chunks")],
            hit["place"].alias("place"),
        )

    return F.transform(placed, described)


def on_tier(hit: Column, *tiers: str) -> Column:
    on = F.array_contains(hit["tiers"], tiers[0])
    for tier in tiers[1:]:
        on = on | F.array_contains(hit["tiers"], tier)
    return on


def term_matches(papers: DataFrame, config: FilterConfig) -> DataFrame:
    """One row per paper, list and matching term; no join, no shuffle."""
    return (
        match_terms(papers.select("paper_id", "title", "summary"), config, SCORING_TIERS)
        .select("paper_id", F.explode("term_hits").alias("hit"))
        .select(
            "paper_id",
            F.explode("hit.tiers").alias("tier"),
            F.col("hit.term").alias("term"),
            F.col("hit.place").alias("place"),
        )
    )


def context_gated_terms(
    papers: DataFrame, gates: dict[str, list[str]] = defaults.CONTEXT_GATES
) -> DataFrame:
    """Terms that count because one of their context terms is in the same paper."""
    rules = constant(
        [{"term": term, "contexts": contexts} for term, contexts in gates.items()],
        "array<struct<term:string,contexts:array<string>>>",
    )
    texts = F.array(
        F.struct(F.lower("title").alias("title"), F.lower("summary").alias("summary"))
    )

    def anywhere(text: Column, term: Column) -> Column:
        return F.contains(text["title"], term) | F.contains(text["summary"], term)

    def passed(text: Column) -> Column:
        return F.transform(
            F.filter(rules, lambda rule: anywhere(text, rule["term"])),
            lambda rule: F.struct(
                rule["term"].alias("term"),
                F.filter(rule["contexts"], lambda c: anywhere(text, c)).alias("contexts"),
            ),
        )

    return (
        papers.select("paper_id", F.explode(F.transform(texts, passed)).alias("passed"))
        .select("paper_id", F.inline("passed"))
        .filter(F.size("contexts") > 0)
    )
