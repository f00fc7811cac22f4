import random

import pytest
from pyspark.sql import functions as F

from paperloom import defaults
from paperloom.config import FilterConfig
from paperloom.operators.candidates import all_candidates, tagged_candidates
from paperloom.operators.evaluate import config_diff, label_confusion, shortlist
from paperloom.operators.score import score_papers
from paperloom.operators.terms import context_gated_terms, guarded, term_matches, terms_in
from tests.conftest import plan_text

# Hand-worked: primary category, title, summary, score, label, reasons.
VECTORS = [
    ("k", "a", "a", 5, "adjacent", ["category:k", "title:a"]),
    ("k", "z", "a", 3, "adjacent", ["category:k", "summary:a"]),
    ("k", "a b", "z", 7, "core", ["category:k", "title:a", "title:b"]),
    ("k", "a x", "x", 2, "unlikely", ["category:k", "exclude:x", "title:a"]),
    ("q", "a b", "z", 2, "unlikely", ["no-anchor", "title:a", "title:b"]),
    ("q", "x", "z", -3, "unlikely", ["exclude:x", "no-anchor"]),
    ("k", "A B", "Z", 7, "core", ["category:k", "title:a", "title:b"]),
    (None, "z", "z", 0, "unlikely", ["no-anchor"]),
]


@pytest.mark.parametrize("primary, title, summary, score, label, reasons", VECTORS)
def test_vectors(make_papers, small_config, primary, title, summary, score, label, reasons):
    paper = make_papers({"primary_category": primary, "title": title, "summary": summary})
    row = score_papers(paper, small_config).first()
    assert (row.score, row.label, row.reasons) == (score, label, reasons)


def test_overlaps_and_repeats_add_up(make_papers):
    config = FilterConfig(
        categories=("k",),
        core_terms=("code", "codes", "code"),
        adjacent_terms=("code",),
        exclude_terms=("code",),
    )
    row = score_papers(make_papers({"title": "codes"}), config).first()
    assert row.score == 4 + 4 + 4 + 2 - 3 + 1
    assert row.reasons == ["category:k", "exclude:code", "title:code", "title:codes"]


def test_scoring_terms_are_not_lowered_but_keywords_are(make_papers):
    config = FilterConfig(
        categories=("k",), core_terms=("CSS",), adjacent_terms=(), exclude_terms=(), query_terms=("CSS",)
    )
    papers = make_papers({"title": "CSS codes", "categories": ["other"]})
    assert score_papers(papers, config).first().score == 1
    assert tagged_candidates(papers, config).first().sources == ["keyword_chunk_1"]


def test_anchor_is_primary_category_or_term(make_papers):
    config = FilterConfig(
        categories=("k", "m"), anchor_categories=("k",), anchor_terms=("tie",),
        core_terms=("a",), adjacent_terms=(), exclude_terms=(),
    )
    papers = make_papers(
        {"primary_category": "m", "categories": ["m", "k"], "title": "a"},
        {"primary_category": "m", "title": "a", "summary": "a tie"},
    )
    rows = score_papers(papers, config).orderBy("paper_id").collect()
    assert [(r.score, r.has_anchor) for r in rows] == [(2, False), (5, True)]


def test_empty_term_is_in_every_paper(make_papers):
    config = FilterConfig(categories=("k",), core_terms=("",), adjacent_terms=(), exclude_terms=())
    assert score_papers(make_papers({"title": "", "summary": ""}), config).first().score == 5


def test_guards_are_inside_their_terms():
    groups = guarded(FilterConfig.shipped().core_terms)
    assert sorted(t for members in groups.values() for t in members) == sorted(FilterConfig.shipped().core_terms)
    assert all(guard in term for guard, members in groups.items() for term in members)
    assert len(groups["code"]) > 5
    assert guarded(["", "a b", "b c", "-"]) == {"": [""], "b": ["a b", "b c"], "-": ["-"]}


@pytest.mark.parametrize("seed", range(3))
def test_term_search_against_brute_force(spark, seed):
    chance = random.Random(seed)

    def phrase(words):
        return chance.choice(["", " ", "-"]).join(chance.choices(["a", "ab", "b", "é", "aé", "\U0001f600", "c"], k=words))

    words = [phrase(chance.randint(0, 3)) for _ in range(40)]
    texts = [phrase(chance.randint(0, 8)) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = rows.select("text", terms_in(F.col("text").cast("binary"), words).alias("found"))
    for row in found.collect():
        assert sorted(row.found) == sorted({w for w in words if w in row.text})


def test_sample_paper_under_shipped_config(make_papers):
    paper = make_papers(
        {
            "title": "A Survey of Quantum Error Correction",
            "summary": "We review quantum error correction.",
            "primary_category": "quant-ph",
        }
    )
    row = score_papers(paper, FilterConfig.shipped()).first()
    assert (row.score, row.label) == (5, "adjacent")
    assert row.reasons == ["category:quant-ph", "title:quantum error correction"]


def test_sources(make_papers):
    config = FilterConfig(
        categories=("k", "l"), core_terms=(), adjacent_terms=(), exclude_terms=(),
        query_terms=("t1", "t2", "t3", "t4", "t5", "t6", "Fault-Tolerant"),
    )
    papers = make_papers(
        {"categories": ["l", "k"], "title": "t6 t1", "summary": "fault-tolerant"},
        {"categories": ["q"], "title": "t"},
        {"categories": ["q"], "published": "2026-03-22T00:00:00Z", "title": "t2"},
    )
    rows = all_candidates(papers, config).filter("paper_id = 'p0'").orderBy("source_ordinal").collect()
    assert [(r.source_ordinal, r.source_name) for r in rows] == [
        (0, "category:k"), (1, "category:l"), (2, "keyword_chunk_1"), (3, "keyword_chunk_2"),
    ]
    tagged = tagged_candidates(papers, config).orderBy("paper_id").collect()
    assert [(r.paper_id, r.source_ordinal) for r in tagged] == [("p0", 0), ("p2", 2)]
    assert tagged[0].sources == ["category:k", "category:l", "keyword_chunk_1", "keyword_chunk_2"]


def test_matches_and_reports(make_papers, small_config):
    papers = make_papers({"title": "a", "summary": "b x"}, {"primary_category": "q", "title": "a b"})
    rows = {tuple(r) for r in term_matches(papers, small_config).collect()}
    assert rows == {
        ("p0", "core", "a", "title"), ("p0", "adjacent", "b", "summary"), ("p0", "exclude", "x", "summary"),
        ("p1", "core", "a", "title"), ("p1", "adjacent", "b", "title"),
    }
    scored = score_papers(papers, small_config)
    listed = shortlist(scored).collect()
    assert [(r.paper_id, r.why) for r in listed] == [("p0", "category:k, exclude:x, summary:b, title:a")]
    truth = scored.select("paper_id", F.lit(1).alias("quality"))
    confusion = {r.label: r for r in label_confusion(scored, truth, F.col("quality") == 1).collect()}
    assert confusion["adjacent"].true_positives == 1
    assert confusion["unlikely"].false_negatives == 1
    wider = FilterConfig(categories=("k", "q"), core_terms=("a",), adjacent_terms=("b",), exclude_terms=())
    moves = {(r.old_label, r.new_label): r.papers for r in config_diff(papers, small_config, wider).collect()}
    assert moves == {("adjacent", "core"): 1, ("unlikely", "core"): 1}


def test_context_gates(make_papers):
    papers = make_papers(
        {"title": "Magic state factories", "summary": "for FTQC"},
        {"title": "Magic state", "summary": "nothing else"},
        {"title": "Erasure", "summary": "and decoding"},
    )
    rows = {(r.paper_id, r.term): r.contexts for r in context_gated_terms(papers).collect()}
    assert rows == {("p0", "magic state"): ["ftqc"], ("p2", "erasure"): ["coding", "decoding"]}
    assert "magic state" in defaults.CONTEXT_GATES


def test_scoring_plan_is_narrow_and_lowers_each_text_once(make_papers, small_config):
    scored = score_papers(make_papers({}), small_config)
    for frame in (scored, scored.filter("score >= 3"), scored.select("paper_id", "label")):
        optimized = frame._jdf.queryExecution().optimizedPlan().toString()
        assert optimized.count("lower(") == 2
        # Bound to the outer lambda's text, not inlined next to each term.
        assert "Contains(lower" not in optimized and "Contains(cast" not in optimized
        plan = plan_text(frame)
        assert "Exchange" not in plan
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        assert "EvalPython" not in plan
