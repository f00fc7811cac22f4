"""Review exports and bibliographies.

Exports are directories of part files.  Rows are range partitioned by the export
order, so reading the parts in name order gives the whole export in order without
any task holding all of it; one sub-directory per window.  Writing replaces the windows that are
written and leaves others as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, functions as F

from paperloom import defaults, schemas
from paperloom.functions.bibtex import bibtex_entry
from paperloom.functions.text import joined
from paperloom.operators.score import label_counts, label_rank
from paperloom.operators.select import SCAN_COLUMNS
from paperloom.plans.staging import delete, write_text

DIGEST_HEADING = "Paper Digest"


def export_rows(scored: DataFrame, *keys: str) -> DataFrame:
    """The exported fields of every scored row, unlikely ones included."""
    renamed = {
        "paper_id": "arxiv_id",
        "sources": "source_queries",
    }
    columns = [*schemas.PAPER_COLUMNS, "label", "sources"]
    rows = scored.withColumns(
        {
            "pdf_url": F.coalesce("pdf_url", F.lit("")),
            "sources": F.array_sort("sources"),
        }
    )
    return rows.select(*keys, *columns).withColumnsRenamed(renamed)


def in_export_order(rows: DataFrame, *keys: str) -> DataFrame:
    """Label rank, then newest first, then id; after the given keys."""
    return rows.orderBy(
        *keys, label_rank(F.col("label")), F.desc("published"), F.desc("arxiv_id")
    )


def csv_rows(rows: DataFrame, *keys: str) -> DataFrame:
    """Exported rows with list cells joined, in CSV column order."""
    flat = rows.withColumns(
        {c: joined(F.col(c)) for c in ("categories", "authors", "source_queries")}
    )
    return flat.select(*keys, *defaults.CSV_COLUMNS)


def jsonl_lines(rows: DataFrame) -> Column:
    return F.to_json(
        F.struct(*defaults.JSONL_COLUMNS), {"ignoreNullFields": "false"}
    )


def _replacing(rows: DataFrame, *keys: str) -> DataFrameWriter:
    """A writer that replaces the folders of the keys that the rows have."""
    return rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys)


def write_csv(ordered: DataFrame, path: str, *keys: str) -> None:
    """Header in every part; embedded quotes doubled, empty cells left empty."""
    (
        _replacing(csv_rows(ordered, *keys), *keys)
        .options(
            header=True,
            escape='"',
            emptyValue="",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )


def write_jsonl(ordered: DataFrame, path: str, *keys: str) -> None:
    """One object per line, ASCII only."""
    (
        _replacing(ordered.select(*keys, *defaults.JSONL_COLUMNS), *keys)
        .options(writeNonAsciiCharacterAsCodePoint=True, ignoreNullFields=False)
        .json(path)
    )


def digest_lines(
    scored: DataFrame, windows: DataFrame, heading: str = DIGEST_HEADING
) -> DataFrame:
    """Lines of one Markdown digest per window, with the columns that order them.

    ``section`` is 0 for the head, 1 for core papers, 2 for the second heading and 3
    for adjacent papers.  Windows without candidates get a digest too.
    """
    counts = windows.join(label_counts(scored, "window_slug"), "window_slug", "left")
    n = {c: F.coalesce(F.col(f"{c}_count"), F.lit(0)) for c in ("core", "adjacent", "unlikely")}

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    # The lines around the two lists.
    layout = [
        (0, text(f"# {heading} (", F.col("window_start"), " to ", F.col("window_end"), ")")),
        (0, text("")),
        (0, text("- Core papers: ", n["core"])),
        (0, text("- Adjacent papers: ", n["adjacent"])),
        (0, text("- Other candidates included in this digest only: ", n["unlikely"])),
        (0, text("")),
        (0, text("## Core")),
        (0, text("")),
        (1, F.when(n["core"] == 0, "- None")),
        (2, text("")),
        (2, text("## Adjacent")),
        (2, text("")),
        (3, F.when(n["adjacent"] == 0, "- None")),
    ]
    frame = counts.select(
        "window_slug",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(section).alias("section"),
                        F.lit(seq).alias("seq"),
                        line.alias("line"),
                    )
                    for seq, (section, line) in enumerate(layout)
                ]
            )
        ),
    ).filter(F.col("line").isNotNull())
    bullets = scored.filter(F.col("label").isin("core", "adjacent")).select(
        "window_slug",
        F.when(F.col("label") == "core", 1).otherwise(3).alias("section"),
        F.lit(0).alias("seq"),
        text("- [", F.col("title"), "](", F.col("abs_url"), ") | ", F.col("paper_id")).alias("line"),
        "published",
        "paper_id",
    )
    return bullets.unionByName(
        frame.withColumns({"published": F.lit(""), "paper_id": F.lit("")})
    )


def in_digest_order(lines: DataFrame) -> DataFrame:
    return lines.orderBy(
        "window_slug", "section", "seq", F.desc("published"), F.desc("paper_id")
    )


def write_digest(lines: DataFrame, path: str) -> None:
    _replacing(in_digest_order(lines).select("window_slug", "line"), "window_slug").text(path)


def write_exports(
    scored: DataFrame, windows: DataFrame, out_dir: str, heading: str = DIGEST_HEADING
) -> None:
    """CSV, JSON Lines and digest of every window, each under its own folder.

    ``scored`` should be a stored table, as every export reads it.  A window without rows gets a CSV with
    the header alone and an empty JSON Lines file.
    """
    ordered = in_export_order(export_rows(scored, "window_slug"), "window_slug")
    write_csv(ordered, f"{out_dir}/csv", "window_slug")
    write_jsonl(ordered, f"{out_dir}/jsonl", "window_slug")
    write_digest(digest_lines(scored, windows, heading), f"{out_dir}/digest")
    spark = scored.sparkSession
    empty = windows.select("window_slug").join(scored.select("window_slug").distinct(), "window_slug", "left_anti")
    # One row per window of the run at most.
    for (slug,) in empty.collect():
        for kind, text in (("csv", ",".join(defaults.CSV_COLUMNS) + "\n"), ("jsonl", "")):
            folder = f"{out_dir}/{kind}/window_slug={slug}"
            delete(spark, folder)
            write_text(spark, f"{folder}/part-00000-empty.{kind}", text)


def bibtex_entries(papers: DataFrame) -> DataFrame:
    """Entry text per paper, with the columns that order a bibliography."""
    entry = bibtex_entry(*[F.col(c) for c in SCAN_COLUMNS])
    return papers.select("paper_id", "published", entry.alias("entry"))


def in_bibliography_order(entries: DataFrame) -> DataFrame:
    return entries.orderBy(F.desc("published"), F.desc("paper_id"))


def write_bibtex(papers: DataFrame, path: str) -> None:
    """Newest first, ties by id; a blank line after every entry.

    Papers are sorted before their entries are made, so what Spark samples for the sort are stored columns.
    """
    (
        bibtex_entries(in_bibliography_order(papers.select(*SCAN_COLUMNS)))
        .select(F.concat("entry", F.lit("\n")).alias("value"))
        .write.mode("overwrite")
        .text(path)
    )
