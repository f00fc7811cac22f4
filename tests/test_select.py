import datetime as dt

import pytest

from paperloom.operators.select import select_papers
from paperloom.plans.store import PaperStore
from tests.conftest import plan_text

D = dt.date

ROWS = [
    {"title": "Surface codes 100%", "summary": "an École", "primary_category": "k"},
    {"title": "ldpc", "summary": "Surface", "primary_category": "l", "authors": ["José Núñez"],
     "published": "2026-03-20T23:59:59Z"},
    {"title": "other", "summary": "text", "primary_category": None, "authors": [],
     "published": "2026-04-01T00:00:00Z"},
]


@pytest.mark.parametrize(
    "filters, expected",
    [
        ({}, "012"),
        ({"categories": []}, "012"),
        ({"categories": ["k", "l"]}, "01"),
        ({"start": D(2026, 3, 20), "end": D(2026, 3, 20)}, "01"),
        ({"start": D(2026, 3, 21)}, "2"),
        ({"end": D(2026, 3, 31)}, "01"),
        ({"title_contains": "SURFACE"}, "0"),
        ({"title_contains": "0%"}, "0"),
        ({"title_contains": "s_r"}, ""),
        ({"title_contains": ""}, "012"),
        ({"summary_contains": "éCOLE"}, "0"),
        ({"author_name_contains": "núñ"}, "1"),
        ({"author_name_contains": "hopper"}, "0"),
        ({"text_contains": "surface"}, "01"),
        ({"text_contains": "NÚÑEZ"}, "1"),
        ({"ids": ["p0", "p2", "p9"]}, "02"),
        ({"ids": []}, ""),
        ({"categories": ["k", "l"], "text_contains": "surface", "ids": ["p1"]}, "1"),
    ],
)
def test_filters(make_papers, filters, expected):
    rows = select_papers(make_papers(*ROWS), **filters).collect()
    assert "".join(sorted(r.paper_id[1] for r in rows)) == expected


def test_dates_prune_the_store(spark, make_papers, tmp_path):
    from pyspark.sql import functions as F

    store = PaperStore(spark, str(tmp_path)).create()
    claim = store.claim()
    store.upsert(
        make_papers(*ROWS).withColumns({"run_id": F.lit(1).cast("long"), "latest_seen_at": F.lit("now")}), claim
    )
    store.record_runs(spark.createDataFrame([("now", "a", "b", 3, 3, 0, "", 1)],
                      "collected_at string, window_start string, window_end string, total_candidates long,"
                      " core_count long, adjacent_count long, config_path string, run_id long"), claim)
    store.compact()
    chosen = select_papers(store.papers(), categories=["l"], start=D(2026, 3, 1), end=D(2026, 3, 31))
    chosen = chosen.select("paper_id", "title")
    assert [r.paper_id for r in chosen.collect()] == ["p1"]
    plan = plan_text(chosen)
    base = next(part for part in plan.split("\n\n") if "/base" in part)
    assert "published_month" in base.split("PartitionFilters")[1].split("PushedFilters")[0]
    pushed = base.split("PushedFilters")[1]
    assert "GreaterThanOrEqual(published,2026-03-01)" in pushed
    assert "LessThan(published,2026-04-01)" in pushed
    assert "primary_category" in pushed
    assert "summary" not in base.split("ReadSchema")[1]


def test_a_million_ids_are_not_broadcast(make_papers):
    papers = make_papers({})
    many = plan_text(select_papers(papers, ids=[f"p{i}" for i in range(1_000_000)]))
    assert "BroadcastHashJoin" not in many
    few = select_papers(papers, ids=["p0", "p9"])
    assert "BroadcastHashJoin" in plan_text(few) and few.count() == 1
    assert select_papers(papers, ids=[]).count() == 0
