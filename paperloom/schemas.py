"""Schemas of papers, feed pages and store tables."""

from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())

# One paper.  ``published`` and ``updated`` stay ISO-8601 text: text order is time
# order, Parquet keeps min/max for it, and no session time zone can shift it.
PAPER = T.StructType(
    [
        T.StructField("paper_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("published", T.StringType()),
        T.StructField("updated", T.StringType()),
        T.StructField("primary_category", T.StringType()),
        T.StructField("categories", _STRINGS),
        T.StructField("authors", _STRINGS),
        T.StructField("abs_url", T.StringType()),
        T.StructField("pdf_url", T.StringType()),
    ]
)
PAPER_COLUMNS = PAPER.fieldNames()

# Where a record came from; also the order in which duplicates arrive.
ARRIVAL = T.StructType(
    [
        T.StructField("source_ordinal", T.IntegerType()),
        T.StructField("page_start", T.LongType()),
        T.StructField("pos", T.IntegerType()),
    ]
)
ARRIVAL_COLUMNS = ARRIVAL.fieldNames()

# Landed feed pages: one XML document per row.
FEED_PAGE = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("source_ordinal", T.IntegerType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("page_start", T.LongType()),
    ]
)

# Feed elements that must be single are read as arrays, so that the first one wins.
FEED_XML = """
    totalResults BIGINT,
    entry ARRAY<STRUCT<
        id ARRAY<STRING>,
        published ARRAY<STRING>,
        updated ARRAY<STRING>,
        title ARRAY<STRING>,
        summary ARRAY<STRING>,
        author ARRAY<STRUCT<name: ARRAY<STRING>>>,
        link ARRAY<STRUCT<_href: STRING, _rel: STRING, _title: STRING, _type: STRING>>,
        primary_category ARRAY<STRUCT<_term: STRING>>,
        category ARRAY<STRUCT<_term: STRING>>>>,
    _bad STRING
"""

FILTER_FILE = T.StructType(
    [
        T.StructField(name, _STRINGS)
        for name in (
            "categories",
            "anchor_categories",
            "query_terms",
            "anchor_terms",
            "core_terms",
            "adjacent_terms",
            "exclude_terms",
        )
    ]
)

# Store tables.  The last fields of each are its partition columns.
RUN_KEYS = ["run_id", "attempt"]
CLAIMS = T.StructType(
    [
        T.StructField("writer", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("run_id", T.LongType()),
        T.StructField("runs", T.LongType()),
        T.StructField("attempt", T.LongType()),
    ]
)
_RUN = [T.StructField(name, T.LongType()) for name in RUN_KEYS]
CHANGES = T.StructType(PAPER.fields + [T.StructField("latest_seen_at", T.StringType()), *_RUN])
CHANGE_COLUMNS = [name for name in CHANGES.fieldNames() if name != "attempt"]
BASE = T.StructType(
    PAPER.fields
    + [
        T.StructField("latest_seen_at", T.StringType()),
        T.StructField("run_id", T.LongType()),
        T.StructField("snapshot", T.LongType()),
        T.StructField("published_month", T.StringType()),
    ]
)
# Which attempts at which runs a snapshot holds.
SNAPSHOTS = T.StructType([T.StructField("snapshot", T.LongType()), *_RUN])
RUNS = T.StructType(
    [
        T.StructField("collected_at", T.StringType()),
        T.StructField("window_start", T.StringType()),
        T.StructField("window_end", T.StringType()),
        T.StructField("total_candidates", T.LongType()),
        T.StructField("core_count", T.LongType()),
        T.StructField("adjacent_count", T.LongType()),
        T.StructField("config_path", T.StringType()),
        *_RUN,
    ]
)
QUARANTINE = T.StructType(
    [
        T.StructField("source_ordinal", T.IntegerType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("page_start", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("abs_url", T.StringType()),
        T.StructField("reason", T.StringType()),
        *_RUN,
    ]
)
RUN_PAPERS = T.StructType(
    [
        T.StructField("paper_id", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("sources", _STRINGS),
        *_RUN,
    ]
)
