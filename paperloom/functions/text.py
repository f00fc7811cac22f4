"""Column expressions over paper text: whitespace, ids, links, JSON lists."""

from pyspark.sql import Column, functions as F

# Fixed value: every Unicode white space plus the four ASCII separators U+001C-U+001F.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def compact_whitespace(text: Column) -> Column:
    """Collapse white space runs to one space and strip both ends."""
    return F.trim(F.regexp_replace(text, WHITESPACE_RUN, " "))


def paper_id_from_url(url: Column) -> Column:
    """Last path segment of the URL, cut at its first ``v``."""
    segment = F.substring_index(F.rtrim(url, F.lit("/")), "/", -1)
    return F.substring_index(segment, "v", 1)


def secure_link(url: Column) -> Column:
    """Turn the first ``http://`` into ``https://``."""
    return F.regexp_replace(url, r"(?s)^(.*?)http://", "$1https://")


def pdf_link(links: Column) -> Column:
    """First link that points to a PDF, or null.

    ``links`` is an array of ``struct<_href, _rel, _title, _type>``.
    """

    def lowered(link: Column, attribute: str) -> Column:
        return F.lower(F.coalesce(link[attribute], F.lit("")))

    def is_pdf(link: Column) -> Column:
        href = F.coalesce(link["_href"], F.lit(""))
        return (href != "") & (
            (lowered(link, "_title") == "pdf")
            | (lowered(link, "_type") == "application/pdf")
            | ((lowered(link, "_rel") == "related") & F.contains(href, F.lit("/pdf/")))
        )

    return secure_link(F.get(F.filter(links, is_pdf), F.lit(0))["_href"])


def json_list(values: Column) -> Column:
    return F.to_json(values)


def parse_json_list(text: Column) -> Column:
    """JSON text to an array of strings; anything unreadable becomes empty."""
    return F.coalesce(
        F.from_json(text, "array<string>"), F.array().cast("array<string>")
    )


def joined(values: Column) -> Column:
    """List cell of the CSV export."""
    return F.array_join(values, "; ")


def contains_ignoring_case(text: Column, needle: str) -> Column:
    """Literal substring test, insensitive to case for any script."""
    return F.contains(F.lower(text), F.lower(F.lit(needle)))
