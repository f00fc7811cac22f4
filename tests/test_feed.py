import pytest
from pyspark.sql import functions as F

from paperloom.sources.feed import (
    corrupt_pages,
    ingest_completeness,
    invalid_records,
    page_entries,
    parse_pages,
    read_feed_pages,
    valid_papers,
)
from tests.conftest import feed_entry, feed_page

SAMPLE = feed_page(
    """<entry>
    <author><name>Emmy  Noether</name></author><author><name>Kurt Gödel</name></author>
    <title>Codes on
      curved lattices</title>
    <summary>Short &amp; plain.</summary>
    <id>http://x.example/abs/2702.00417v3</id>
    <published>2027-02-01T08:30:00Z</published><updated>2027-02-09T00:00:00Z</updated>
    <category term="math.CO" /><category term="cs.DM" /><arxiv:primary_category term="math.CO" />
    <link href="http://x.example/abs/2702.00417v3" rel="alternate" type="text/html" />
    <link href="http://x.example/pdf/2702.00417v3" rel="related" title="pdf" type="application/pdf" />
  </entry>"""
)


def entries(pages):
    return page_entries(parse_pages(pages))


def test_sample_page(make_pages):
    rows = valid_papers(entries(make_pages(SAMPLE))).collect()
    assert len(rows) == 1
    paper = rows[0]
    assert paper.paper_id == "2702.00417"
    assert paper.abs_url == "http://x.example/abs/2702.00417v3"
    assert paper.pdf_url == "https://x.example/pdf/2702.00417v3"
    assert (paper.title, paper.summary) == ("Codes on curved lattices", "Short & plain.")
    assert (paper.published, paper.updated) == ("2027-02-01T08:30:00Z", "2027-02-09T00:00:00Z")
    assert paper.primary_category == "math.CO"
    assert paper.categories == ["math.CO", "cs.DM"]
    assert paper.authors == ["Emmy Noether", "Kurt Gödel"]
    assert paper.sources == ["source0"]
    assert (paper.source_ordinal, paper.page_start, paper.pos) == (0, 0, 0)


@pytest.mark.parametrize(
    "title, expected",
    [
        ("a <i>b</i> c", "a"),
        ("a &lt;i&gt; b", "a <i> b"),
        ("<![CDATA[a < b]]> <i>c</i>", "a < b"),
        ("a <!-- note --> b", "a b"),
        ("first</title><title>second", "first"),
        ("x   y\x85", "x y"),
    ],
)
def test_title_text(make_pages, title, expected):
    row = entries(make_pages(feed_page(feed_entry(title=title)))).first()
    assert row.title == expected


def test_markup_first_leaves_no_title(make_pages):
    row = entries(make_pages(feed_page(feed_entry(title="<i>b</i> c")))).first()
    assert (row.title, row.skip_reason) == ("", "no title")


def test_long_summary_with_markup(make_pages):
    summary = "word " * 60_000 + "<b>bold</b> rest"
    row = entries(make_pages(feed_page(feed_entry(summary=summary)))).first()
    assert row.summary == ("word " * 60_000).strip()


def test_skip_reasons(make_pages):
    page = feed_page(
        feed_entry("", title=""),
        feed_entry("1", title=" \n ", published=""),
        feed_entry("2", published="", authors=()),
        feed_entry("3", authors=()),
        feed_entry("4", authors=("",)),
        '<entry><id>http://x.example/abs/v2</id><title>t</title></entry>',
    )
    rows = entries(make_pages(page))
    reasons = {r.pos: r.skip_reason for r in invalid_records(rows).collect()}
    assert reasons[1] == "no title"
    assert reasons[2] == "no published date"
    assert reasons[3] == "no authors"
    assert reasons[0] == reasons[5] == "no id"
    assert [r.authors for r in valid_papers(rows).collect()] == [[""]]


def test_bad_pages_do_not_sink_the_rest(make_pages):
    good = feed_page(feed_entry())
    parsed = parse_pages(
        make_pages(good, good[:-12], "not xml", feed_page(feed_entry(), total="many"), "", feed_page())
    )
    assert {r.source_ordinal for r in corrupt_pages(parsed).collect()} == {1, 2, 3, 4}
    assert page_entries(parsed).count() == 1
    totals = {r.source_ordinal: r.declared_total for r in parsed.filter("not corrupt").collect()}
    assert totals == {0: 1, 5: 0}


def test_missing_total_and_terms(make_pages):
    page = feed_page(feed_entry(extra="<category/>")).replace("opensearch:totalResults", "other")
    row = parse_pages(make_pages(page))
    assert row.first().declared_total == 0
    paper = page_entries(row).first()
    assert paper.categories == ["k", ""]
    assert paper.pdf_url is None


def test_completeness(make_pages):
    page = feed_page(feed_entry("1"), feed_entry("2"), total=5)
    last = feed_page(feed_entry("5"), total=5)
    pages = make_pages(
        (page, 0, "gap", 0), (last, 0, "gap", 4),
        (page, 1, "whole", 0), (page, 1, "whole", 2), (last, 1, "whole", 4),
        ("junk", 2, "broken", 0),
    )
    rows = {r.source_name: r for r in ingest_completeness(parse_pages(pages), 2).collect()}
    assert (rows["gap"].declared_total, rows["gap"].landed_entries) == (5, 3)
    assert (rows["gap"].expected_pages, rows["gap"].has_gap, rows["gap"].complete) == (3, True, False)
    assert (rows["whole"].has_gap, rows["whole"].complete) == (False, True)
    assert (rows["broken"].corrupt_pages, rows["broken"].landed_entries) == (1, 0)


def test_pages_from_files(spark, tmp_path):
    folder = tmp_path / "source_ordinal=3" / "source_name=category%3Ak" / "page_start=100"
    folder.mkdir(parents=True)
    (folder / "page.xml").write_text(feed_page(feed_entry(), feed_entry("2601.00002")))
    rows = valid_papers(entries(read_feed_pages(spark, str(tmp_path)))).orderBy("pos").collect()
    assert [(r.source_ordinal, r.page_start, r.pos) for r in rows] == [(3, 100, 0), (3, 100, 1)]
    assert rows[0].sources == ["category:k"]


def test_page_parsed_once(make_pages):
    rows = valid_papers(entries(make_pages(SAMPLE)))
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_xml") == 1
