import shutil

from paperloom.plans.store import PaperStore
from paperloom.sources.feed import read_feed_pages
from paperloom.streaming.ingest import ingest_batch, stream_feed
from tests.conftest import feed_entry, feed_page


def land(root, name, page, ordinal=0, source="category%3Ak", start=0):
    folder = root / f"source_ordinal={ordinal}" / f"source_name={source}" / f"page_start={start}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(page)


def snapshot(store):
    return (
        sorted((r.paper_id, r.title, r.run_id) for r in store.papers().collect()),
        sorted((r.run_id, r.paper_id, r.label, tuple(r.sources)) for r in store.run_papers().collect()),
        sorted((r.run_id, r.window_start, r.window_end, r.total_candidates) for r in store.runs().collect()),
    )


def test_two_batches_and_a_replay(spark, small_config, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "progress")
    store = PaperStore(spark, str(tmp_path / "store")).create()
    land(landing, "1.xml", feed_page(feed_entry("1", title="a"), feed_entry("2", title="b")))
    land(landing, "bad.xml", "not xml", ordinal=1, source="broken")
    stream_feed(str(landing), small_config, store, checkpoint).awaitTermination()
    assert [(p, r) for p, _, r in snapshot(store)[0]] == [("1", 1), ("2", 1)]
    refused = store.quarantine().collect()
    assert [(r.source_name, r.reason, r.run_id) for r in refused] == [("broken", "unreadable page", 1)]

    land(
        landing, "2.xml",
        feed_page(feed_entry("2", title="a b", published="2026-03-22T00:00:00Z"), feed_entry("3", title="z", primary="q")),
        start=100,
    )
    stream_feed(str(landing), small_config, store, checkpoint).awaitTermination()
    papers, run_papers, runs = snapshot(store)
    assert papers == [("1", "a", 1), ("2", "a b", 2)]
    assert [(r, p, label) for r, p, label, _ in run_papers] == [
        (1, "1", "adjacent"), (1, "2", "adjacent"), (2, "2", "core"), (2, "3", "unlikely"),
    ]
    assert runs == [(1, "2026-03-20", "2026-03-20", 2), (2, "2026-03-20", "2026-03-22", 2)]

    # Nothing new landed, then the second batch comes again.
    stream_feed(str(landing), small_config, store, checkpoint).awaitTermination()
    assert snapshot(store) == (papers, run_papers, runs)
    again = tmp_path / "again"
    shutil.copytree(landing / "source_ordinal=0" / "source_name=category%3Ak" / "page_start=100",
                    again / "source_ordinal=0" / "source_name=category%3Ak" / "page_start=100")
    ingest_batch(read_feed_pages(spark, str(again)), 1, small_config, store, checkpoint)
    assert snapshot(store) == (papers, run_papers, runs)


def test_window_runs_and_stream_batches_share_a_store(spark, make_papers, small_config, tmp_path):
    import datetime as dt

    from paperloom.plans.run import run_window

    store = PaperStore(spark, str(tmp_path / "store")).create()
    march = (dt.date(2026, 3, 1), dt.date(2026, 3, 31))
    assert run_window(make_papers({"paper_id": "w1", "title": "a"}), small_config, store, *march) == 1
    land(tmp_path / "landing", "1.xml", feed_page(feed_entry("1", title="a")))
    stream_feed(str(tmp_path / "landing"), small_config, store, str(tmp_path / "progress")).awaitTermination()
    store.compact()
    assert run_window(make_papers({"paper_id": "w2", "title": "a"}), small_config, store, *march) == 3
    land(tmp_path / "landing", "2.xml", feed_page(feed_entry("2", title="a")), start=100)
    stream_feed(str(tmp_path / "landing"), small_config, store, str(tmp_path / "progress")).awaitTermination()
    assert sorted((r.paper_id, r.run_id) for r in store.papers().collect()) == [("1", 2), ("2", 4), ("w1", 1), ("w2", 3)]


def test_backlog_in_several_batches(spark, small_config, tmp_path):
    store = PaperStore(spark, str(tmp_path / "store")).create()
    for i in range(3):
        land(tmp_path / "landing", f"{i}.xml", feed_page(feed_entry(str(i), title="a")), start=i * 100)
    stream_feed(
        str(tmp_path / "landing"), small_config, store, str(tmp_path / "progress"), 1
    ).awaitTermination()
    assert sorted(r.run_id for r in store.papers().collect()) == [1, 2, 3]


def test_batch_of_broken_pages_only(spark, small_config, tmp_path):
    store = PaperStore(spark, str(tmp_path / "store")).create()
    land(tmp_path / "landing", "bad.xml", "not xml")
    stream_feed(str(tmp_path / "landing"), small_config, store, str(tmp_path / "progress")).awaitTermination()
    assert [(r.run_id, r.total_candidates) for r in store.runs().collect()] == [(1, 0)]
    assert store.papers().count() == 0
