import pytest
from pyspark.sql import functions as F

from paperloom.functions import text
from paperloom.sources.ids import read_id_list


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "url, expected",
    [
        ("http://x.example/abs/2702.00417v2", "2702.00417"),
        ("http://x.example/abs/2702.00417v2//", "2702.00417"),
        ("http://x.example/abs/math/9901001v1", "9901001"),
        ("2601.1", "2601.1"),
        ("http://x.example/abs/v1", ""),
        ("", ""),
    ],
)
def test_paper_id(spark, url, expected):
    assert one(spark, text.paper_id_from_url(F.lit(url))) == expected


@pytest.mark.parametrize(
    "raw", ["  a \t\n b  ", "a\x1cb", "　a b ", "a\x0b\x0c\r\nb", "", "\x85", "ab"]
)
def test_whitespace_matches_split_and_join(spark, raw):
    assert one(spark, text.compact_whitespace(F.lit(raw))) == " ".join(raw.split())


def test_link_attributes(spark):
    def links(*rows):
        schema = "struct<_href:string,_rel:string,_title:string,_type:string>"
        return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("_href", "_rel", "_title", "_type"), r)]).cast(schema) for r in rows])

    assert one(spark, text.pdf_link(links(("h", "self", None, "text/html")))) is None
    assert one(spark, text.pdf_link(links((None, None, "pdf", None), ("", None, "pdf", None), ("http://a", None, "PDF", None)))) == "https://a"
    assert one(spark, text.pdf_link(links(("ftp://h/PDF/", "related", None, None)))) is None
    assert one(spark, text.pdf_link(links(("https://h/pdf/http://z", "RELATED", None, None)))) == "https://h/pdf/https://z"


def test_json_lists(spark):
    assert one(spark, text.json_list(F.array(F.lit("é"), F.lit('"')))) == '["é","\\""]'
    for bad in ("", "[1", "nope", "{}"):
        assert one(spark, text.parse_json_list(F.lit(bad))) == []
    assert one(spark, text.parse_json_list(F.lit('["a", "\\u00e9"]'))) == ["a", "é"]
    assert one(spark, text.parse_json_list(F.lit(None).cast("string"))) == []


def test_id_file(spark, tmp_path):
    (tmp_path / "ids.txt").write_text(" 2601.1 \n\n\t\n2601.2\n2601.1\n")
    ids = [r.paper_id for r in read_id_list(spark, str(tmp_path / "ids.txt")).collect()]
    assert sorted(ids) == ["2601.1", "2601.2"]
