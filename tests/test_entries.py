import uuid

import pytest
from pyspark.sql import functions as F

from paperloom.sources import feed, feed_entries
from tests.conftest import feed_entry, feed_page
from tests.test_stream import land


@pytest.fixture
def put(spark, tmp_path):
    def staged(rows, name):
        path = str(tmp_path / f"staged-{uuid.uuid4().hex}")
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    return staged


def both(spark, path, put):
    whole = feed.page_entries(feed.parse_pages(feed.read_feed_pages(spark, path)))
    return feed_entries.stream_entries(spark, path, put), whole


def rows_of(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_entries_are_those_of_whole_pages(spark, tmp_path, put):
    landing = tmp_path / "landing"
    odd = [
        feed_entry("1", title=" two\n  lines ", summary="a &amp; b &lt;c&gt;", authors=("Ada", "  Grace  H ")),
        feed_entry("2", title="with <i>markup</i> inside", authors=()),
        feed_entry("3", title="", extra='<link title="pdf" href="http://x.example/pdf/3" rel="related"/>'),
        feed_entry("4", title="<![CDATA[raw <b>]]>", summary="é 日本"),
    ]
    land(landing, "1.xml", feed_page(*odd))
    land(landing, "2.xml", feed_page(*[feed_entry(f"9{i}") for i in range(20)]), ordinal=3, source="a%3Ab", start=100)
    land(landing, "3.xml", feed_page(), ordinal=4, source="none")
    streamed, whole = both(spark, str(landing), put)
    assert rows_of(streamed, *whole.columns) == rows_of(whole, *whole.columns)


def test_large_pages_are_split(spark, tmp_path, put):
    landing = tmp_path / "landing"
    entries = [feed_entry(str(i), title=f"title {i}", summary="words " * (i % 200)) for i in range(4000)]
    land(landing, "1.xml", feed_page(*entries))
    land(landing, "2.xml", feed_page(*entries[:10]), start=100)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        streamed, whole = both(spark, str(landing), put)
        assert rows_of(streamed, *whole.columns) == rows_of(whole, *whole.columns)
        raw = feed_entries.read_records(spark, str(landing))
        assert raw.rdd.getNumPartitions() >= 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_a_cut_page_gives_its_whole_entries(spark, tmp_path, put):
    landing = tmp_path / "landing"
    page = feed_page(feed_entry("1"), feed_entry("2"), feed_entry("3"))
    land(landing, "1.xml", page[: page.index("2601") if "2601" in page else page.rindex("<author>")])
    streamed, whole = both(spark, str(landing), put)
    assert whole.count() == 0
    assert sorted(r.paper_id for r in feed.valid_papers(streamed).collect()) == ["1", "2"]


def test_declared_totals(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "1.xml", feed_page(feed_entry("1"), total=250))
    land(landing, "2.xml", feed_page(feed_entry("1"), total="many"), start=100)
    got = {r.page_start: r.declared_total for r in feed_entries.declared_totals(spark, str(landing)).collect()}
    assert got == {0: 250, 100: None}


def test_missing_ranges(spark, make_pages):
    entry = "<entry><id>1</id></entry>"

    def page(source, start, total=1000, cut=0):
        text = f"<feed><totalResults>{total}</totalResults>{entry}</feed>"
        return (text[: len(text) - cut], source, f"s{source}", start)

    pages = [page(0, s) for s in (0, 100, 500, 900)] + [page(0, 100), page(0, 550), page(0, 2000)]
    # Nothing missing; the end missing; unreadable pages are missing; a total of nothing.
    pages += [page(1, 0, 100), page(2, 0, 101), page(3, 0, 300), page(3, 100, 300, 5), page(3, 200, 300), page(4, 0, 0), page(5, 0, 300, 5)]
    got = feed.missing_page_ranges(feed.parse_pages(make_pages(*pages)))
    assert sorted((r.source_ordinal, r.first_missing, r.last_missing, r.pages) for r in got.collect()) == [
        (0, 200, 400, 3), (0, 600, 800, 3), (2, 100, 100, 1), (3, 100, 100, 1),
    ]


def test_written_pages_are_those_of_the_partitioned_writer(spark, tmp_path, make_pages):
    names = ["category:a", "50% [x]=y/z", "é 日本", "a\\b'c\"", "", None]
    pages = make_pages(*[(feed_page(feed_entry(str(i))), i if name else None, name, 100 * i) for i, name in enumerate(names)], (None, 7, "s", 0))
    pages.write.partitionBy(*feed.PAGE_COLUMNS).text(str(tmp_path / "spark"))
    feed_entries.write_pages(pages, f"file://{tmp_path}/own")
    want = spark.read.schema(pages.schema).text(str(tmp_path / "spark"), wholetext=True)
    got = feed.read_feed_pages(spark, str(tmp_path / "own"))
    assert rows_of(got, *pages.columns) == rows_of(want, *pages.columns)
    # Spark's writer leaves a file of its own per task, and the driver has moved none of these.
    assert sorted({p.name for p in (tmp_path / "own").rglob("*") if p.is_file()}) == ["page.txt"]
