"""Papers and config used by the registered queries.

Papers are derived from the ``documents`` table by rule: every document is one
paper.  ``PAPERS_SQL`` states the same rules for the SQL oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.config import FilterConfig
from paperloom.sources.documents import read_documents, summary_from_text, title_from_text

CONFIG = FilterConfig.from_mapping(
    {
        "categories": ["src0", "src1", "src2", "src3", "src4", "src5"],
        "anchor_categories": ["src0", "src1", "src2", "src3"],
        "anchor_terms": ["of the", "ement", "heit"],
        "query_terms": [
            "of the", "in the", "heit", "ción", "edst", "on the", "with the", "ouer", "tiea",
        ],
        "core_terms": ["of the", "in the", "heit", "ción", "edst"],
        "adjacent_terms": ["on the", "with the", "ouer", "tiea"],
        "exclude_terms": ["eaux", "ingly"],
    }
)

# A second config for comparisons: other core terms, no anchor terms.
OTHER_CONFIG = FilterConfig.from_mapping(
    {
        "categories": ["src0", "src1", "src2", "src3", "src4", "src5", "src6", "src7"],
        "anchor_terms": ["heit", "ment"],
        "core_terms": ["on the", "heit", "ouer"],
        "adjacent_terms": ["of the", "in the", "heit"],
        "exclude_terms": ["ción"],
    }
)

CONTEXT_GATES = {"heit": ["der ", "und "], "ción": ["de la", "los "], "of the": ["ouer", "edst"]}

WINDOW = (dt.date(2024, 1, 1), dt.date(2024, 3, 31))


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(
        spark, f"{sf_dir}/documents.parquet", "doc_id", "text", "lang", "source"
    )
    number = F.col("doc_id").cast("string")
    hours = (F.col("doc_id") * 3 % 8760).cast("int")
    published = F.timestamp_add("HOUR", hours, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return docs.select(
        number.alias("paper_id"),
        title_from_text(F.col("text")).alias("title"),
        summary_from_text(F.col("text")).alias("summary"),
        F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published"),
        F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated"),
        F.col("source").alias("primary_category"),
        F.array("source", "lang").alias("categories"),
        F.array(
            F.concat(F.lit("Ada K"), (F.col("doc_id") % 97).cast("string")),
            F.concat(F.lit("Ben "), F.col("source")),
        ).alias("authors"),
        F.concat(
            F.lit("http://x.example/abs/"), number, F.lit("v"),
            (F.col("doc_id") % 3 + 1).cast("string"),
        ).alias("abs_url"),
        F.when(
            F.col("doc_id") % 5 != 0,
            F.concat(F.lit("https://x.example/pdf/"), number, F.lit("v1")),
        ).alias("pdf_url"),
    )


PAPERS_SQL = r"""
papers AS (
  SELECT CAST(doc_id AS VARCHAR) AS paper_id,
    trim(regexp_replace(split_part(text, chr(10), 1), '\s+', ' ', 'g')) AS title,
    trim(regexp_replace(substr(text, length(split_part(text, chr(10), 1)) + 2), '\s+', ' ', 'g')) AS summary,
    strftime(TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id * 3 % 8760 AS INT)), '%Y-%m-%dT%H:%M:%SZ') AS published,
    strftime(TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id * 3 % 8760 AS INT)), '%Y-%m-%dT%H:%M:%SZ') AS updated,
    source AS primary_category,
    [source, lang] AS categories,
    ['Ada K' || CAST(doc_id % 97 AS VARCHAR), 'Ben ' || source] AS authors,
    'http://x.example/abs/' || CAST(doc_id AS VARCHAR) || 'v' || CAST(doc_id % 3 + 1 AS VARCHAR) AS abs_url,
    CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'https://x.example/pdf/' || CAST(doc_id AS VARCHAR) || 'v1' END AS pdf_url
  FROM documents
)"""
