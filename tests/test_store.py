import datetime as dt

import pytest
from pyspark.sql import functions as F

from paperloom.plans.run import record, run_month, run_window, undated
from paperloom.plans.store import PaperStore
from paperloom.sources.feed import page_entries, parse_pages, valid_papers
from tests.conftest import feed_entry, feed_page, plan_text

MARCH = (dt.date(2026, 3, 1), dt.date(2026, 3, 31))


@pytest.fixture
def store(spark, tmp_path):
    return PaperStore(spark, str(tmp_path / "store")).create()


def by_id(df):
    return {r.paper_id: r for r in df.collect()}


def test_empty_store(store):
    assert store.last_run_id() == 0
    assert store.papers().count() == 0
    assert store.history().count() == 0
    assert store.compact() == 0
    store.create()


def test_upsert_rules_over_three_runs(spark, make_papers, small_config, store):
    first = make_papers(
        {"title": "a", "pdf_url": "https://p"},
        {"title": "a"},
        {"title": "z", "categories": ["k"]},
    )
    assert run_window(first, small_config, store, *MARCH, collected_at="t1", config_path="c.json") == 1
    # p0 changes and loses its PDF, p1 turns unlikely, p3 is new.
    second = make_papers(
        {"title": "a b", "published": "2026-03-01T00:00:00Z"},
        {"title": "z"},
        {"paper_id": "p3", "title": "b"},
    )
    assert run_window(second, small_config, store, *MARCH, collected_at="t2") == 2
    papers = by_id(store.papers())
    assert set(papers) == {"p0", "p1", "p3"}
    assert (papers["p0"].title, papers["p0"].pdf_url, papers["p0"].latest_seen_at) == ("a b", None, "t2")
    assert (papers["p1"].title, papers["p1"].latest_seen_at) == ("a", "t1")
    runs = {r.run_id: r for r in store.runs().collect()}
    assert (runs[1].total_candidates, runs[1].core_count, runs[1].adjacent_count) == (3, 0, 2)
    assert (runs[1].window_start, runs[1].window_end, runs[1].config_path) == ("2026-03-01", "2026-03-31", "c.json")
    assert {(r.run_id, r.paper_id, r.label) for r in store.history().collect()} == {
        (1, "p0", "adjacent"), (1, "p1", "adjacent"),
        (2, "p0", "core"), (2, "p1", "unlikely"), (2, "p3", "adjacent"),
    }
    assert [r.paper_id for r in store.orphans().collect()] == ["p2"]
    before = sorted(map(str, store.papers().collect()))
    assert store.compact() == 1
    assert sorted(map(str, store.papers().collect())) == before
    assert store.compact() == 1

    run_window(make_papers({"title": "a a"}), small_config, store, *MARCH, collected_at="t3")
    assert by_id(store.papers())["p0"].title == "a a"
    assert store.compact() == 2
    papers = by_id(store.papers())
    assert {p: r.latest_seen_at for p, r in papers.items()} == {"p0": "t3", "p1": "t1", "p3": "t2"}


def test_a_run_that_died_is_invisible_and_can_be_repeated(spark, make_papers, small_config, store):
    run_window(make_papers({"title": "a"}), small_config, store, *MARCH)
    half = make_papers({"title": "b", "paper_id": "half"}).withColumns(
        {"run_id": F.lit(2).cast("long"), "latest_seen_at": F.lit("t")}
    )
    dead = store.claim(1, "importer", 5)
    assert (dead.run_id, dead.attempt) == (2, 1)
    store.upsert(half, dead)
    assert set(by_id(store.papers())) == {"p0"}
    # A later run finishes; the dead one below it stays unseen.
    assert run_window(make_papers({"title": "a", "paper_id": "q"}), small_config, store, *MARCH) == 3
    assert set(by_id(store.papers())) == {"p0", "q"}
    # The dead batch comes again, without any relevant paper this time.
    again = store.claim(1, "importer", 5)
    assert (again.run_id, again.attempt) == (2, 2)
    finish(spark, make_papers({"title": "z", "paper_id": "half"}), small_config, store, again)
    assert set(by_id(store.papers())) == {"p0", "q"}
    assert {r.run_id: r.total_candidates for r in store.runs().collect()} == {1: 1, 2: 1, 3: 1}
    with pytest.raises(ValueError):
        store.claim(2, "importer", 5)


def finish(spark, papers, config, store, claim):
    """Record papers as the run of a claim."""
    from paperloom.operators.score import score_papers
    from paperloom.operators.windows import single_window

    rows = score_papers(papers, config).withColumns(
        {"sources": F.array(F.lit("s")), "window_slug": F.lit("20260301_20260331"), "window_ordinal": F.lit(0).cast("long")}
    )
    record(rows, single_window(spark, *MARCH), store, claim, collected_at="t")


def test_a_repeat_that_shrinks_replaces_the_attempt_before_it(spark, make_papers, small_config, store):
    for compacted in (False, True):
        both = store.claim(1, "w", int(compacted))
        finish(spark, make_papers({"title": "a"}, {"title": "b"}), small_config, store, both)
        assert set(by_id(store.papers())) == {"p0", "p1"}
        if compacted:
            store.compact()
        finish(spark, make_papers({"title": "a"}), small_config, store, store.claim(1, "w", int(compacted)))
        # The first batch of the second round still holds p0 alone.
        assert set(by_id(store.papers())) == {"p0"}
        assert {r.paper_id for r in store.run_papers().collect()} == {"p0"}


def test_every_row_is_accounted_for(spark, make_papers, make_pages, small_config, store, tmp_path):
    from paperloom.sources.feed import quarantine

    papers = make_papers(
        {"title": "a"},
        {"title": "a", "published": "2026-04-01T00:00:00Z"},
        {"title": "a", "published": "2026-03"},
        {"title": "a", "published": "2026"},
        {"title": "a", "published": ""},
        {"title": "q", "summary": "q", "primary_category": "n", "categories": ["n"]},
    )
    run_month(papers, small_config, store, "2026-03", out_dir=str(tmp_path / "out"))
    scored = store.run_papers().count()
    lost = store.quarantine().collect()
    outside = 1
    no_candidate = 1
    assert papers.count() == scored + outside + no_candidate + len(lost)
    assert {r.reason for r in lost} == {"no full date"} and len(lost) == 3
    assert not list(tmp_path.rglob("*HIVE_DEFAULT*"))
    assert undated(papers).count() == 3

    pages = make_pages((feed_page(feed_entry("1"), feed_entry("2", title="")), 0, "category:k", 0), ("broken", 0, "category:k", 100))
    parsed = parse_pages(pages)
    run_window(
        valid_papers(page_entries(parsed)), small_config, store, *MARCH, landed=True, skipped=quarantine(parsed)
    )
    reasons = [(r.run_id, r.reason) for r in store.quarantine().collect() if r.run_id == 6]
    assert sorted(reasons) == [(6, "no title"), (6, "unreadable page")]


def test_a_table_with_a_column_named_sources_is_still_tagged(make_papers, small_config, store):
    papers = make_papers({"title": "a"}, {"title": "a", "published": "2026-09-01T00:00:00Z"})
    run_window(papers.withColumn("origin", F.lit("x")), small_config, store, *MARCH)
    assert [r.paper_id for r in store.papers().collect()] == ["p0"]


def test_month_runs_all_windows_at_once(spark, make_papers, small_config, store, tmp_path):
    papers = make_papers(
        {"title": "a b", "published": "2026-03-01T00:00:00Z"},
        {"title": "a", "published": "2026-03-31T23:59:59Z"},
        {"title": "a", "published": "2026-04-01T00:00:00Z"},
        {"title": "a", "published": "2026-02-28T23:59:59Z"},
        {"title": "z", "published": "2026-03-07T10:00:00Z"},
    )
    assert run_month(papers, small_config, store, "2026-03", out_dir=str(tmp_path / "out")) == 1
    runs = {r.run_id: r for r in store.runs().collect()}
    assert set(runs) == {1, 2, 3, 4, 5}
    assert (runs[1].total_candidates, runs[1].core_count) == (2, 1)
    assert (runs[2].total_candidates, runs[2].window_start) == (0, "2026-03-08")
    assert (runs[5].adjacent_count, runs[5].window_end) == (1, "2026-03-31")
    assert set(by_id(store.papers())) == {"p0", "p1"}
    slugs = {p.name for p in (tmp_path / "out" / "digest").glob("window_slug=*")}
    assert slugs == {f"window_slug=2026_Mar_Wk{i}" for i in range(1, 6)}
    assert run_month(papers, small_config, store, "2026-04") == 6


def test_feed_run_merges_across_pages(make_pages, small_config, store):
    pages = make_pages(
        (feed_page(feed_entry("9", title="late a")), 1, "keyword_chunk_1", 0),
        (feed_page(feed_entry("8", title="b"), feed_entry("9", title="a b")), 0, "category:k", 100),
        (feed_page(feed_entry("9", title="first a")), 0, "category:k", 0),
        (feed_page(feed_entry("7", published="2026-05-01T00:00:00Z")), 0, "category:k", 200),
    )
    candidates = valid_papers(page_entries(parse_pages(pages)))
    run_window(candidates, small_config, store, *MARCH, landed=True)
    papers = by_id(store.papers())
    assert {p: r.title for p, r in papers.items()} == {"9": "first a", "8": "b"}
    logged = by_id(store.run_papers())
    assert logged["9"].sources == ["category:k", "keyword_chunk_1"]


def test_duplicate_rows_in_a_table_are_merged(make_papers, small_config, store):
    papers = make_papers({"title": "a"}, {"title": "a b"}, {"title": "a"}).withColumn("paper_id", F.lit("same"))
    run_window(papers, small_config, store, *MARCH)
    assert store.runs().first().total_candidates == 1
    assert store.papers().count() == 1


def test_recording_twice_changes_nothing(spark, make_papers, small_config, store):
    from paperloom.operators.score import score_papers
    from paperloom.operators.windows import in_month_weeks, month_windows

    rows = in_month_weeks(score_papers(make_papers({"title": "a"}), small_config)).withColumn(
        "sources", F.array(F.lit("s"))
    )
    windows = month_windows(spark, ["2026-03"])
    for _ in range(2):
        record(rows, windows, store, store.claim(5, "weekly"), collected_at="t")
    assert store.runs().count() == 5
    assert store.run_papers().count() == 1
    assert store.papers().count() == 1


def test_base_is_not_shuffled_for_a_small_change(spark, make_papers, small_config, store):
    run_window(make_papers({"title": "a"}, {"title": "b"}), small_config, store, *MARCH)
    store.compact()
    run_window(make_papers({"title": "a b"}), small_config, store, *MARCH)
    plan = plan_text(store.papers())
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


def test_staged_rows_go_to_the_shared_folder_and_are_dropped(spark, make_papers, small_config, store):
    from pathlib import Path

    from paperloom.plans.staging import staging

    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    with staging(spark, "unused") as put:
        rows = put(make_papers({"title": "a"}), "some")
        assert len(set(shared.iterdir()) - before) == 1 and rows.count() == 1
    run_window(make_papers({"title": "a"}), small_config, store, *MARCH)
    assert set(shared.iterdir()) == before


def test_copies_of_a_table_carry_their_text_once(make_papers, small_config):
    from paperloom.plans.run import triage_documents

    plan = plan_text(triage_documents(make_papers({"title": "a"}), small_config))
    partial = next(line for line in plan.splitlines() if "partial_min" in line)
    assert partial.count("summary#") == 1 and partial.count("title#") == 1
