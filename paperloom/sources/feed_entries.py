"""Feed entries read one by one out of pages of any size.

A page is text that Spark splits like any large file, with the end of an entry as the end of a record, so that no task holds a page
and several tasks share a large one.  What belongs to a page as a whole is not judged this way: a page that ends too early gives the
entries that are whole, and the rest behind the last of them is skipped as malformed.

Entries are elements named ``entry`` without a prefix, and the text ``</entry>`` stands nowhere but at their end; other pages are for
``feed.parse_pages``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paperloom import schemas
from paperloom.plans.staging import file_system
from paperloom.sources.feed import FEED_OPTIONS, INLINE_MARKUP, PAGE_COLUMNS, paper_fields, skip_reason
from paperloom.sources.positions import with_positions

_END = "</entry>"
# What Spark escapes in names of directories.
_ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")


def _directory(column: str, value: object) -> str:
    """Name of a directory as Spark's writer has it."""
    text = "" if value is None else str(value)
    return f"{column}=" + (_ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", text) or "__HIVE_DEFAULT_PARTITION__")


def write_pages(pages: DataFrame, path: str) -> None:
    """Land pages (``feed.PAGE_COLUMNS``, unique, and ``value``) as one file each under ``path``.

    Spark's writer takes some 30 ms of a core for every file of a partition and the driver moves each once more; here the task that holds a page
    writes it under a temporary name and moves it to its own, so a repeated task gives the same files.  ``page_start`` is the
    upper directory: sources are few, and one listing then goes through all pages side by side.
    """
    columns = sorted(PAGE_COLUMNS, key="page_start".__ne__)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = fs.FileSystem.from_uri(f"/{path[5:].lstrip('/')}" if path.startswith("file:") else path)
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                folder = "/".join([place, *(_directory(c, row[c]) for c in columns)])
                store.create_dir(folder, recursive=True)
                held = f"{folder}/.{uuid.uuid4().hex}"
                with store.open_output_stream(held, compression=None) as out:
                    out.write(f"{row['value'] or ''}\n".encode())
                store.move(held, f"{folder}/page.txt")
            yield pa.RecordBatch.from_pydict({"pages": [batch.num_rows]})

    place, files = file_system(pages.sparkSession, path)
    files.mkdirs(place)
    pages.select(*columns, "value").mapInArrow(write, "pages bigint").agg(F.sum("pages")).collect()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Texts up to the end of an entry, and what follows the last one, of one page per file under the directories of ``feed``."""
    return spark.read.schema(schemas.FEED_PAGE).text(path, lineSep=_END)


def stream_entries(spark: SparkSession, path: str, put: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Rows as ``feed.page_entries`` gives them; an entry that is not well-formed is skipped instead of its whole page.

    ``put`` stores rows for the length of the job.
    """
    kind = T._parse_datatype_string(schemas.FEED_XML)["entry"].dataType.elementType
    kind = T.StructType([*kind.fields, T.StructField("_bad", T.StringType())])
    records = with_positions(read_records(spark, path), put, "pos", last="ends")
    whole = F.concat(F.regexp_extract("value", r"(?s)<entry[\s>].*", 0), F.lit(_END))
    entries = records.where(F.contains("value", F.lit("<entry"))).withColumn("text", whole)
    entry = F.from_xml(F.regexp_replace("text", INLINE_MARKUP, "$1$3"), kind, FEED_OPTIONS)
    # Out of a one-element array, so that the text is parsed once.
    parsed = entries.select(*PAGE_COLUMNS, F.col("pos").cast("int").alias("pos"), "ends", F.explode(F.array(entry)).alias("entry"))
    fields = paper_fields(F.col("entry"))
    rows = parsed.select(
        *PAGE_COLUMNS, "pos", *[fields[c].alias(c) for c in schemas.PAPER_COLUMNS],
        (F.col("ends") | F.col("entry").isNull() | F.col("entry._bad").isNotNull()).alias("_bad"),
    )
    broken = F.coalesce(F.when(F.col("_bad"), "malformed entry"), skip_reason({c: F.col(c) for c in schemas.PAPER_COLUMNS}))
    return rows.withColumn("skip_reason", broken).drop("_bad")


def declared_totals(spark: SparkSession, path: str) -> DataFrame:
    """Declared total of every page that has one; null where it is no number."""
    found = F.regexp_extract("value", r"<(?:\w+:)?totalResults(?:\s[^<>]*)?>([^<]*)<", 1)
    rows = read_records(spark, path).where(F.contains("value", F.lit("totalResults>"))).where(found != "")
    total = F.trim(found).try_cast("bigint")
    return rows.groupBy(*PAGE_COLUMNS).agg(F.max(total).alias("declared_total"))
