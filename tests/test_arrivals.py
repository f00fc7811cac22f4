import datetime as dt
import json
import random

import pytest
from pyspark.sql import Window, functions as F

from paperloom.operators.merge import merge_papers
from paperloom.plans.store import PaperStore
from paperloom.streaming.arrivals import LANDED, first_arrivals
from paperloom.streaming.ingest import stream_feed
from tests.conftest import feed_entry, feed_page
from tests.test_stream import land

SCHEMA = "paper_id string, title string, authors array<string>, sources array<string>, source_ordinal int, page_start long, pos int, landed_at timestamp"
DAY = dt.datetime(2026, 3, 1)


def run(spark, folder, checkpoint, keep="30 days", **more):
    """Latest row per paper of every batch, batch by batch."""
    batches = []
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
    (
        first_arrivals(stream, keep, **more)
        .writeStream.foreachBatch(lambda rows, n: batches.append({r.paper_id: r for r in rows.collect()}))
        .outputMode("update")
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return batches


def landing(folder, number, rows):
    folder.mkdir(exist_ok=True)
    file = folder / f"{number:03d}.json"
    file.write_text("".join(json.dumps(r, default=str) + "\n" for r in rows))
    import os

    os.utime(file, (1_700_000_000 + number, 1_700_000_000 + number))


def row(paper, title, source, day, ordinal=0, pos=0, authors=("A",)):
    return dict(paper_id=paper, title=title, authors=list(authors), sources=[source], source_ordinal=ordinal, page_start=0, pos=pos, landed_at=DAY + dt.timedelta(days=day))


def test_later_batches_add_sources_and_keep_the_first_row(spark, tmp_path):
    folder = tmp_path / "in"
    landing(folder, 0, [row("1", "first", "s1", 0, 3, authors=("B", "ü")), row("1", "other", "s0", 0, 5), row("2", None, "s2", 0)])
    landing(folder, 1, [row("1", "later", "s9", 1), row("1", "later", "s1", 1), row("3", "new", "s3", 1)])
    batches = run(spark, folder, tmp_path / "c")
    assert [set(b) for b in batches if b] == [{"1", "2"}, {"1", "3"}]
    assert (batches[0]["1"].title, batches[0]["1"].sources, batches[0]["1"].authors) == ("first", ["s0", "s1"], ["B", "ü"])
    assert (batches[1]["1"].title, batches[1]["1"].sources) == ("first", ["s0", "s1", "s9"])
    assert batches[0]["2"].title is None
    # State outlives the query.
    landing(folder, 2, [row("2", "x", "s7", 2)])
    (again,) = [b for b in run(spark, folder, tmp_path / "c") if b]
    assert (again["2"].title, again["2"].sources) == (None, ["s2", "s7"])


def test_a_paper_not_seen_for_long_is_forgotten(spark, tmp_path):
    folder = tmp_path / "in"
    landing(folder, 0, [row("1", "first", "s1", 0), row("2", "first", "s1", 0)])
    landing(folder, 1, [row("2", "again", "s2", 8)])
    landing(folder, 2, [row("9", "x", "s", 14)])
    landing(folder, 3, [row("9", "x", "s", 15)])
    landing(folder, 4, [row("1", "anew", "s4", 16), row("2", "more", "s4", 16), row("8", "late", "s", 1)])
    batches = [b for b in run(spark, folder, tmp_path / "c", "10 days") if b]
    assert set(batches[-1]) == {"1", "2"}
    assert (batches[-1]["1"].title, batches[-1]["1"].sources) == ("anew", ["s4"])
    assert (batches[-1]["2"].title, batches[-1]["2"].sources) == ("first", ["s1", "s2", "s4"])


def test_the_stream_ends_where_the_batch_merge_does(spark, tmp_path):
    draw, folder = random.Random(3), tmp_path / "in"
    rows = [[row(str(draw.randint(0, 20)), f"t{draw.randint(0, 9)}", f"s{draw.randint(0, 5)}", day, draw.randint(0, 4), i) for i in range(25)] for day in range(4)]
    # One paper with most of the rows.
    rows[2] += [row("hot", "t", f"s{i % 7}", 2, 4, i) for i in range(3000)]
    for n, part in enumerate(rows):
        landing(folder, n, part)
    last = {}
    for batch in run(spark, folder, tmp_path / "c"):
        last.update(batch)
    table = spark.read.schema(SCHEMA).json(str(folder))
    merged = merge_papers(table, arrival=[LANDED, "source_ordinal", "page_start", "pos"])
    want = {r.paper_id: (r.title, r.sources) for r in merged.collect()}
    assert {p: (r.title, r.sources) for p, r in last.items()} == want


def test_feed_streams_merge_over_batches(spark, small_config, tmp_path):
    store = PaperStore(spark, str(tmp_path / "store")).create()
    pages, progress = tmp_path / "landing", str(tmp_path / "progress")

    def take_in():
        stream_feed(str(pages), small_config, store, progress, merge_within="30 days").awaitTermination()

    land(pages, "1.xml", feed_page(feed_entry("1", title="a"), feed_entry("2", title="b")))
    land(pages, "bad.xml", "not xml", ordinal=1, source="broken")
    take_in()
    land(pages, "2.xml", feed_page(feed_entry("2", title="z"), feed_entry("3", title="a b")), ordinal=2, source="other")
    take_in()
    assert {r.paper_id: r.title for r in store.papers().collect()} == {"1": "a", "2": "b", "3": "a b"}
    seen = {(r.run_id, r.paper_id): r.sources for r in store.run_papers().collect()}
    first, second = sorted({r for r, _ in seen})
    assert seen[first, "2"] == ["category:k"] and seen[second, "2"] == ["category:k", "other"]
    assert (second, "1") not in seen
    assert [(r.source_name, r.reason) for r in store.quarantine().collect()] == [("broken", "unreadable page")]


def test_a_batch_has_a_bounded_number_of_states(spark, tmp_path):
    folder = tmp_path / "in"
    landing(folder, 0, [row(str(i), f"t{i}", "s1", 0) for i in range(300)])
    stream = spark.readStream.schema(SCHEMA).json(str(folder))
    seen = []
    query = (
        first_arrivals(stream, groups=4).writeStream.foreachBatch(lambda rows, n: seen.extend(rows.collect()))
        .outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.paper_id for r in seen) == sorted(str(i) for i in range(300))
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) == 4


def test_ids_of_one_group_are_forgotten_each_by_its_own_time(spark, tmp_path):
    folder = tmp_path / "in"
    landing(folder, 0, [row("1", "first", "s1", 0), row("2", "first", "s1", 0), row(None, "none", "s1", 0)])
    landing(folder, 1, [row("2", "again", "s2", 8), row(None, "none again", "s2", 8)])
    landing(folder, 2, [row("9", "x", "s", 15)])
    landing(folder, 3, [row("1", "anew", "s4", 16), row("2", "more", "s4", 16), row(None, "more", "s4", 16)])
    last = [b for b in run(spark, folder, tmp_path / "c", "10 days", groups=1) if b][-1]
    assert {p: (r.title, r.sources) for p, r in last.items()} == {
        "1": ("anew", ["s4"]), "2": ("first", ["s1", "s2", "s4"]), None: ("none", ["s1", "s2", "s4"]),
    }
