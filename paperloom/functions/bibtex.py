"""BibTeX text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from paperloom import defaults
from paperloom.functions.dates import day_part, month_part, year_part
from paperloom.functions.text import compact_whitespace

# Characters rewritten in a BibTeX value, in this order.
ESCAPES = [("\\", "\\\\"), ("{", "\\{"), ("}", "\\}"), ('"', "``")]

# Field names of an entry in order, and the line at which the journal goes in.
FIELD_ORDER = [
    "title",
    "author",
    "year",
    "month",
    "day",
    "eprint",
    "archivePrefix",
    "primaryClass",
    "url",
    "pdf",
    "abstract",
]
ARCHIVE = "arXiv"
JOURNAL_LINE = 3


def bibtex_escape(text: Column) -> Column:
    """Escape a value and put it on one line; null becomes empty."""
    escaped = F.coalesce(text, F.lit(""))
    for found, replacement in ESCAPES:
        escaped = F.replace(escaped, F.lit(found), F.lit(replacement))
    return compact_whitespace(escaped)


def truncate_abstract(summary: Column) -> Column:
    limit = F.lit(defaults.ABSTRACT_CHARS)
    return F.when(
        F.length(summary) > limit, F.concat(F.left(summary, limit), F.lit("..."))
    ).otherwise(summary)


def citation_key(authors: Column, paper_id: Column) -> Column:
    """Last name of the first author and the id, or the id alone."""
    first = compact_whitespace(F.coalesce(F.get(authors, F.lit(0)), F.lit("")))
    last_name = F.regexp_replace(
        F.substring_index(first, " ", -1), r"[^\p{L}\p{N}_]", ""
    )
    plain_id = F.translate(paper_id, "/.", "__")
    return F.when(last_name == "", plain_id).otherwise(
        F.concat(last_name, F.lit("_"), plain_id)
    )


def bibtex_entry(
    paper_id: Column,
    title: Column,
    summary: Column,
    published: Column,
    primary_category: Column,
    authors: Column,
    abs_url: Column,
    pdf_url: Column,
) -> Column:
    """One ``@article`` entry under a comment line, without a final newline.

    Empty fields are left out.  The journal always takes the fourth body line, or
    the end of a shorter body, after the commas were settled without it.
    """
    values = {
        "title": bibtex_escape(title),
        "author": F.array_join(
            F.transform(F.coalesce(authors, F.array()), bibtex_escape), " and "
        ),
        "year": year_part(published),
        "month": month_part(published),
        "day": day_part(published),
        "eprint": bibtex_escape(paper_id),
        "archivePrefix": F.lit(ARCHIVE),
        "primaryClass": bibtex_escape(primary_category),
        "url": bibtex_escape(abs_url),
        "pdf": bibtex_escape(pdf_url),
        "abstract": bibtex_escape(truncate_abstract(summary)),
    }
    fields = F.array(
        *[F.struct(F.lit(n).alias("name"), values[n].alias("value")) for n in FIELD_ORDER]
    )
    kept = F.filter(fields, lambda field: field["value"] != "")
    lines = F.transform(
        kept,
        lambda field: F.concat(
            F.lit("  "), field["name"], F.lit(" = {"), field["value"], F.lit("}")
        ),
    )
    # Lines are joined with commas; the journal carries its own comma, so the body is
    # two joined stretches around it.
    head = F.slice(lines, 1, JOURNAL_LINE)
    tail = F.slice(lines, JOURNAL_LINE + 1, len(FIELD_ORDER))
    journal = F.concat(
        F.lit("  journal = {"),
        bibtex_escape(F.concat(F.lit(f"{ARCHIVE}:"), paper_id)),
        F.lit("},"),
    )
    body = F.when(
        F.size(tail) > 0,
        F.concat(
            F.array_join(head, ",\n"), F.lit(",\n"), journal, F.lit("\n"),
            F.array_join(tail, ",\n"),
        ),
    ).otherwise(F.concat(F.array_join(head, ",\n"), F.lit("\n"), journal))
    return F.concat(
        F.lit(f"% {ARCHIVE}:"), paper_id, F.lit("\n@article{"),
        citation_key(authors, paper_id), F.lit(",\n"), body, F.lit("\n}"),
    )
