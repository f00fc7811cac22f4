import pytest
from pyspark.sql import functions as F

from paperloom.functions.bibtex import bibtex_escape, citation_key, truncate_abstract
from paperloom.plans.exports import bibtex_entries, write_bibtex
from tests.conftest import read_parts


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def entry(papers):
    return bibtex_entries(papers).first().entry


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("a\\b", "a\\\\b"),
        ("{x}", "\\{x\\}"),
        ('say "hi"', "say ``hi``"),
        (" a\r\n b ", "a b"),
        (None, ""),
    ],
)
def test_escape(spark, raw, expected):
    assert one(spark, bibtex_escape(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize(
    "authors, paper_id, expected",
    [
        (["Emmy Noether"], "2702.00417", "Noether_2702_00417"),
        (["  Vera  O'Brien-Smith  "], "a/b.c", "OBrienSmith_a_b_c"),
        (["Łukasz Żółć_2"], "1", "Żółć_2_1"),
        (["..."], "1.2", "1_2"),
        ([""], "1.2", "1_2"),
        ([], "1.2", "1_2"),
        (None, "1.2", "1_2"),
    ],
)
def test_citation_key(spark, authors, paper_id, expected):
    names = (
        F.lit(None).cast("array<string>")
        if authors is None
        else F.array(*map(F.lit, authors)).cast("array<string>")
    )
    assert one(spark, citation_key(names, F.lit(paper_id))) == expected


def test_abstract_limit(spark):
    assert one(spark, truncate_abstract(F.lit("x" * 1000))) == "x" * 1000
    assert one(spark, truncate_abstract(F.lit("é" * 1001))) == "é" * 1000 + "..."
    assert one(spark, truncate_abstract(F.lit(None).cast("string"))) is None


def test_whole_entry(make_papers):
    papers = make_papers(
        {"paper_id": "2601.1", "title": "T {x}", "summary": "S", "pdf_url": "https://x.example/p"}
    )
    assert entry(papers) == (
        "% arXiv:2601.1\n"
        "@article{Lovelace_2601_1,\n"
        "  title = {T \\{x\\}},\n"
        "  author = {Ada Lovelace and Grace Hopper},\n"
        "  year = {2026},\n"
        "  journal = {arXiv:2601.1},\n"
        "  month = {03},\n"
        "  day = {20},\n"
        "  eprint = {2601.1},\n"
        "  archivePrefix = {arXiv},\n"
        "  primaryClass = {k},\n"
        "  url = {http://x.example/abs/p0},\n"
        "  pdf = {https://x.example/p},\n"
        "  abstract = {S}\n"
        "}"
    )


def test_missing_fields_move_the_journal(make_papers):
    papers = make_papers(
        {
            "paper_id": "7", "title": " ", "authors": [], "published": "", "summary": "",
            "primary_category": None, "abs_url": "u",
        }
    )
    assert entry(papers) == (
        "% arXiv:7\n@article{7,\n  eprint = {7},\n  archivePrefix = {arXiv},\n"
        "  url = {u}\n  journal = {arXiv:7},\n}"
    )
    papers = make_papers(
        {
            "paper_id": "7", "title": "", "authors": [], "published": "", "summary": "",
            "primary_category": "", "abs_url": "",
        }
    )
    assert entry(papers) == (
        "% arXiv:7\n@article{7,\n  eprint = {7},\n  archivePrefix = {arXiv}\n"
        "  journal = {arXiv:7},\n}"
    )


def test_file_is_newest_first_with_blank_lines(make_papers, tmp_path):
    papers = make_papers(
        {"paper_id": "a"}, {"paper_id": "c"}, {"paper_id": "b", "published": "2026-04-01"}
    )
    write_bibtex(papers, str(tmp_path / "deep" / "bib"))
    entries = read_parts(tmp_path / "deep" / "bib").rstrip("\n").split("\n\n")
    assert [e.split("\n")[0] for e in entries] == ["% arXiv:b", "% arXiv:c", "% arXiv:a"]
