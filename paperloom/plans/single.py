"""Exports as one ordered file per window, or one file.

Tasks write parts side by side, in the order of the whole.  The file system then joins them by its own concatenation: on HDFS
that moves block lists, so neither a task nor the driver carries the bytes, whatever the size.  The header stands once, as the first
part.  A file takes its name when it is whole.

File systems that cannot join files are refused; there the ordered parts of ``exports`` remain the export.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom import defaults
from paperloom.plans.exports import (
    DIGEST_HEADING,
    bibtex_entries,
    csv_rows,
    digest_lines,
    export_rows,
    in_bibliography_order,
    in_digest_order,
    in_export_order,
)
from paperloom.plans.staging import delete, file_system, write_text

CSV_HEADER = ",".join(defaults.CSV_COLUMNS) + "\n"
#: Names of the single files of a window.
NAMES = {"csv": "{}.csv", "jsonl": "{}.jsonl", "digest": "{}.md"}


def join_parts(spark: SparkSession, folder: str, target: str, head: str = "") -> None:
    """The part files of a folder, in name order, as one file that replaces ``target``; the parts are used up."""
    jvm = spark._jvm
    place, files = file_system(spark, folder)
    if is_checksummed(spark, files):
        # Checksums beside the parts know nothing of the whole.
        files = files.getRawFileSystem()
    sizes = {}
    if files.exists(place):
        sizes = {s.getPath().getName(): s.getLen() for s in files.listStatus(place)}
    names = sorted(n for n, size in sizes.items() if n.startswith("part-") and size)
    if head or not names:
        write_text(spark, f"{folder}/head", head)
        names, sizes["head"] = ["head", *names], len(head.encode())
    paths = [jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}") for n in names]
    made = paths[0]
    if len(paths) > 1:
        if not files.hasPathCapability(place, "fs.capability.paths.concat"):
            raise NotImplementedError(f"the file system of {folder} does not join files")
        if files.getUri().getScheme() == "file":
            # Local files are joined into a new one, where HDFS adds to the first.
            made = jvm.org.apache.hadoop.fs.Path(f"{folder}/whole")
        rest = [p for p in paths if p is not made]
        sources = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(rest))
        for i, path in enumerate(rest):
            sources[i] = path
        files.concat(made, sources)
        found = files.getFileStatus(made).getLen()
        if found != sum(sizes[n] for n in names):
            raise OSError(f"the parts of {folder} were joined to {found} bytes")
    whole, _ = file_system(spark, target)
    files.mkdirs(whole.getParent())
    files.delete(whole, False)
    # The name first, for checksums of an earlier file would not fit.
    files.delete(jvm.org.apache.hadoop.fs.Path(whole.getParent(), f".{whole.getName()}.crc"), False)
    if not files.rename(made, whole):
        raise OSError(f"{target} could not be given its name")


def is_checksummed(spark: SparkSession, files) -> bool:
    return spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.ChecksumFileSystem").isInstance(files)


def write_single(lines: DataFrame, slugs: list[str], folder: str, name: str = "{}", head: str = "") -> None:
    """One file per window out of ordered rows (window_slug, line); windows without rows get the head alone.

    The driver names and joins files, a window at a time; ``slugs`` are the windows of a run.
    """
    spark = lines.sparkSession
    parts = f"{folder}/.parts-{uuid.uuid4().hex}"
    try:
        lines.select("window_slug", "line").write.partitionBy("window_slug").text(parts)
        for slug in slugs:
            join_parts(spark, f"{parts}/window_slug={slug}", f"{folder}/{name.format(slug)}", head)
    finally:
        delete(spark, parts)


def csv_lines(ordered: DataFrame) -> DataFrame:
    """CSV lines as ``exports.write_csv`` writes them."""
    options = {
        "escape": '"',
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    rows = csv_rows(ordered, "window_slug")
    return rows.select("window_slug", F.to_csv(F.struct(*defaults.CSV_COLUMNS), options).alias("line"))


def jsonl_lines(ordered: DataFrame) -> DataFrame:
    """Lines as ``exports.write_jsonl`` writes them."""
    options = {"ignoreNullFields": "false", "writeNonAsciiCharacterAsCodePoint": "true"}
    return ordered.select("window_slug", F.to_json(F.struct(*defaults.JSONL_COLUMNS), options).alias("line"))


def write_single_exports(
    scored: DataFrame, windows: DataFrame, out_dir: str, heading: str = DIGEST_HEADING
) -> None:
    """``<slug>.csv``, ``<slug>.jsonl`` and ``<slug>.md`` of every window.  ``scored`` should be a stored table."""
    # One row per window of the run.
    slugs = [r.window_slug for r in windows.select("window_slug").collect()]
    ordered = in_export_order(export_rows(scored, "window_slug"), "window_slug")
    write_single(csv_lines(ordered), slugs, f"{out_dir}/csv", NAMES["csv"], CSV_HEADER)
    write_single(jsonl_lines(ordered), slugs, f"{out_dir}/jsonl", NAMES["jsonl"])
    digest = in_digest_order(digest_lines(scored, windows, heading))
    write_single(digest, slugs, f"{out_dir}/digest", NAMES["digest"])


def write_single_bibtex(papers: DataFrame, target: str) -> None:
    """One bibliography file, newest first; the entries are stored before they are sorted, so they are made once."""
    spark = papers.sparkSession
    folder = f"{target.rpartition('/')[0]}/.parts-{uuid.uuid4().hex}"
    try:
        bibtex_entries(papers).write.parquet(f"{folder}/entries")
        entries = spark.read.schema("paper_id string, published string, entry string").parquet(f"{folder}/entries")
        lines = in_bibliography_order(entries).select(F.concat("entry", F.lit("\n")).alias("value"))
        lines.write.text(f"{folder}/text")
        join_parts(spark, f"{folder}/text", target)
    finally:
        delete(spark, folder)
