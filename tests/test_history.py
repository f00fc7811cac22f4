import random

from pyspark.sql import functions as F

from paperloom.config import FilterConfig
from paperloom.operators.intervals import label_intervals, labels_as_of
from paperloom.operators.rescore import added_terms, rescore
from paperloom.operators.score import score_papers
from paperloom.operators.terms import SCORING_TIERS, match_terms
from tests.conftest import plan_text

SEEN = "run_id bigint, paper_id string, label string"


def test_intervals(spark):
    rows = [(1, "a", "x"), (2, "a", "x"), (5, "a", "y"), (6, "a", "x"), (3, "b", "x"), (1, "c", None), (2, "c", None), (3, "c", "x")]
    got = label_intervals(spark.createDataFrame(rows, SEEN)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [("a", "x", 1, 5, 2), ("a", "y", 5, 6, 1), ("a", "x", 6, None, 1), ("b", "x", 3, None, 1), ("c", None, 1, 3, 2), ("c", "x", 3, None, 1)],
        key=str,
    )
    assert label_intervals(spark.createDataFrame([], SEEN)).collect() == []


def test_labels_at_dates(spark):
    draw = random.Random(1)
    seen = [(r, f"p{p}", draw.choice("xyz")) for r in range(1, 8) for p in range(6) if draw.random() < 0.6]
    when = {r: f"2026-03-{(r + 1) // 2:02d}" for r in range(1, 8)}
    asked = [(f"p{draw.randint(0, 7)}", f"2026-03-{draw.randint(0, 9):02d}") for _ in range(80)]
    got = labels_as_of(
        spark.createDataFrame(seen, SEEN),
        spark.createDataFrame(list(when.items()), "run_id bigint, collected_at string"),
        spark.createDataFrame(asked, "paper_id string, as_of string"),
    ).collect()
    want = []
    for paper, at in asked:
        known = [(when[r], r, label) for r, p, label in seen if p == paper and when[r] <= at]
        label, run = (max(known)[2], max(known)[1]) if known else (None, None)
        want.append((paper, at, label, run))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


CONFIGS = [
    FilterConfig(("k",), ("alpha", "beta"), ("gamma",), ("delta",), anchor_terms=("alp",)),
    # One removed, one added, one with other points, one on two lists.
    FilterConfig(("q",), ("gamma", "eps"), ("alpha",), ("delta", "gamma"), anchor_terms=("zeta",)),
    FilterConfig(("k",), ("alpha",), (), ()),
    FilterConfig(("k",), (), (), ()),
]


def test_rescoring_equals_scoring(spark, make_papers):
    draw = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "none"]
    papers = make_papers(
        *[
            {"title": " ".join(draw.choices(words, k=2)), "summary": " ".join(draw.choices(words, k=3)), "primary_category": draw.choice("kq")}
            for _ in range(60)
        ]
    )
    columns = ["paper_id", "score", "label", "has_anchor", "reasons"]
    for old in CONFIGS:
        stored = match_terms(papers, old, SCORING_TIERS)
        for new in CONFIGS:
            got = rescore(stored, old, new)
            want = score_papers(papers, new)
            assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    # A result can be rescored in turn.
    twice = rescore(rescore(match_terms(papers, CONFIGS[0], SCORING_TIERS), CONFIGS[0], CONFIGS[1]), CONFIGS[1], CONFIGS[0])
    assert sorted(map(str, twice.select(*columns).collect())) == sorted(map(str, score_papers(papers, CONFIGS[0]).select(*columns).collect()))


def test_only_added_terms_are_searched(spark, make_papers, tmp_path):
    old, new = CONFIGS[:2]
    assert added_terms(old, new) == ["eps", "zeta"]
    path = str(tmp_path / "hits")
    match_terms(make_papers({"title": "alpha"}), old, SCORING_TIERS).write.parquet(path)
    stored = spark.read.parquet(path)
    # What stays needs no text at all.
    same = rescore(stored, old, CONFIGS[2]).select("paper_id", "score")
    read = next(line for line in plan_text(same).splitlines() if "ReadSchema" in line)
    assert "title:" not in read and "summary:" not in read
    assert "lower" not in plan_text(same)
    searched = plan_text(rescore(stored, old, new).select("paper_id", "score"))
    assert "lower" in searched
