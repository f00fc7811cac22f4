import csv
import datetime as dt
import io
import json

from pyspark.sql import functions as F

from paperloom.operators.score import score_papers
from paperloom.operators.windows import in_month_weeks, month_windows, single_window
from paperloom.plans import exports
from tests.conftest import read_parts

WINDOW = (dt.date(2026, 3, 16), dt.date(2026, 3, 22))


def scored(papers, config):
    rows = score_papers(papers, config).withColumn("sources", F.array(F.lit("s2"), F.lit("s1")))
    return in_month_weeks(rows)


def written(spark, rows, tmp_path, months=("2026-03",)):
    exports.write_exports(rows, month_windows(spark, months), str(tmp_path))
    return tmp_path


def test_csv_round_trip(spark, make_papers, small_config, tmp_path):
    tricky = 'a "quoted", comma; semicolon\\slash'
    papers = make_papers(
        {"title": tricky, "summary": " padded ", "authors": ["A, B", 'C "D"']},
        {"title": "", "summary": "ünï", "authors": [], "pdf_url": "https://p"},
    )
    written(spark, scored(papers, small_config), tmp_path)
    rows = []
    for part in sorted((tmp_path / "csv" / "window_slug=2026_Mar_Wk3").glob("part-*")):
        rows += csv.DictReader(io.StringIO(part.read_text(encoding="utf-8")))
    assert list(rows[0]) == [
        "label", "arxiv_id", "pdf_url", "title", "summary", "published", "updated",
        "primary_category", "categories", "authors", "source_queries", "abs_url",
    ]
    first = next(r for r in rows if r["arxiv_id"] == "p0")
    assert first["title"] == tricky
    assert first["summary"] == " padded "
    assert first["authors"] == 'A, B; C "D"'
    assert first["source_queries"] == "s1; s2"
    assert first["pdf_url"] == ""
    second = next(r for r in rows if r["arxiv_id"] == "p1")
    assert (second["title"], second["authors"], second["pdf_url"]) == ("", "", "https://p")


def test_jsonl_round_trip(spark, make_papers, small_config, tmp_path):
    papers = make_papers({"title": 'é "x" \\ \U0001f600', "primary_category": None})
    written(spark, scored(papers, small_config), tmp_path)
    text = read_parts(tmp_path / "jsonl" / "window_slug=2026_Mar_Wk3")
    assert text.isascii()
    row = json.loads(text)
    assert list(row) == [
        "arxiv_id", "title", "summary", "published", "updated", "primary_category",
        "categories", "authors", "abs_url", "pdf_url", "label", "source_queries",
    ]
    assert row["title"] == 'é "x" \\ \U0001f600'
    assert row["primary_category"] is None
    assert row["pdf_url"] == ""
    assert row["source_queries"] == ["s1", "s2"]


def test_digest_text(spark, make_papers, small_config, tmp_path):
    papers = make_papers(
        {"title": "a b", "published": "2026-03-16T00:00:00Z"},
        {"title": "a b", "published": "2026-03-17T00:00:00Z"},
        {"title": "z"},
        {"title": "b a", "published": "2026-03-17T00:00:00Z"},
    )
    rows = score_papers(papers, small_config).withColumn("window_slug", F.lit("20260316_20260322"))
    lines = exports.digest_lines(rows, single_window(spark, *WINDOW), "My Digest")
    exports.write_digest(lines, str(tmp_path / "d"))
    assert read_parts(tmp_path / "d" / "window_slug=20260316_20260322") == (
        "# My Digest (2026-03-16 to 2026-03-22)\n"
        "\n"
        "- Core papers: 3\n"
        "- Adjacent papers: 0\n"
        "- Other candidates included in this digest only: 1\n"
        "\n"
        "## Core\n"
        "\n"
        "- [b a](http://x.example/abs/p3) | p3\n"
        "- [a b](http://x.example/abs/p1) | p1\n"
        "- [a b](http://x.example/abs/p0) | p0\n"
        "\n"
        "## Adjacent\n"
        "\n"
        "- None\n"
    )


def test_many_windows_keep_their_order_across_parts(spark, make_papers, small_config, tmp_path):
    base = make_papers({}).drop("paper_id", "title", "published", "summary")
    rows = spark.range(4000).select(
        F.format_string("%05d", "id").alias("paper_id"),
        F.element_at(F.array(F.lit("a b"), F.lit("a"), F.lit("z")), (F.col("id") % 3 + 1).cast("int")).alias("title"),
        F.lit("z").alias("summary"),
        # The last two thirds fall into one week.
        F.format_string("2026-03-%02dT00:00:00Z", F.when(F.col("id") % 3 == 0, F.col("id") % 31 + 1).otherwise(20)).alias("published"),
    ).crossJoin(base)
    scored_rows = scored(rows, small_config)
    written(spark, scored_rows, tmp_path)
    expected = {}
    rank = {"core": 0, "adjacent": 1, "unlikely": 2}
    for r in scored_rows.select("window_slug", "label", "published", "paper_id").collect():
        expected.setdefault(r.window_slug, []).append(r)
    assert len(expected) == 5
    total_parts = 0
    for slug, wanted in expected.items():
        wanted.sort(key=lambda r: r.paper_id, reverse=True)
        wanted.sort(key=lambda r: r.published, reverse=True)
        wanted.sort(key=lambda r: rank[r.label])
        folder = tmp_path / "jsonl" / f"window_slug={slug}"
        total_parts += len(list(folder.glob("part-*")))
        ids = [json.loads(line)["arxiv_id"] for line in read_parts(folder).splitlines()]
        assert ids == [r.paper_id for r in wanted]
        digest = read_parts(tmp_path / "digest" / f"window_slug={slug}").splitlines()
        assert digest[0].startswith("# Paper Digest (2026-03-")
        bullets = [line.rsplit("| ", 1)[1] for line in digest if " | " in line]
        assert bullets == [r.paper_id for r in wanted if r.label != "unlikely"]


def test_windows_without_papers_have_digests(spark, make_papers, small_config, tmp_path):
    written(spark, scored(make_papers({}), small_config), tmp_path)
    empty = read_parts(tmp_path / "digest" / "window_slug=2026_Mar_Wk1")
    assert empty.count("- None") == 2
    assert "- Core papers: 0\n" in empty


def test_windows_stand_side_by_side_and_a_rerun_replaces_its_own(spark, make_papers, small_config, tmp_path):
    week = lambda i: single_window(spark, dt.date(2026, 3, i), dt.date(2026, 3, i + 6))
    slug = lambda i: f"202603{i:02d}_202603{i + 6:02d}"

    def write(i, *rows):
        papers = score_papers(make_papers(*rows), small_config).withColumn("sources", F.array(F.lit("s")))
        exports.write_exports(papers.withColumn("window_slug", F.lit(slug(i))), week(i), str(tmp_path))

    def ids(i):
        text = read_parts(tmp_path / "jsonl" / f"window_slug={slug(i)}")
        return [json.loads(line)["arxiv_id"] for line in text.splitlines()]

    write(10, {"title": "a"}, {"title": "b"})
    write(17, {"title": "a"})
    assert (ids(10), ids(17)) == (["p1", "p0"], ["p0"])
    write(10, {"title": "a"})
    assert (ids(10), ids(17)) == (["p0"], ["p0"])
    assert read_parts(tmp_path / "digest" / f"window_slug={slug(17)}").startswith("# ")
    # The first week again, now without any row.
    write(10)
    assert (ids(10), ids(17)) == ([], ["p0"])
    header = read_parts(tmp_path / "csv" / f"window_slug={slug(10)}")
    assert header.startswith("label,arxiv_id,") and header.count("\n") == 1
