"""Papers from any table of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.functions.text import compact_whitespace


#: Spark's setting for the least number of partitions of a scan.
LEAST_PARTITIONS = "spark.sql.files.minPartitionNum"


def read_documents(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The columns asked for, and nothing else, from a Parquet table, read where it lies.

    Spark cannot split a file below its row groups.  Where the session asks for a least number of partitions, rows are
    spread by the first column to give it; a large table has many row groups and is read without that setting.
    """
    rows = spark.read.parquet(path).select(*columns)
    least = spark.conf.get(LEAST_PARTITIONS, None)
    return rows.repartition(int(least), columns[0]) if least else rows


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def title_from_text(text: Column) -> Column:
    return compact_whitespace(first_line(text))


def summary_from_text(text: Column) -> Column:
    """Everything after the first line."""
    body = F.substring(text, F.length(first_line(text)) + 2, F.length(text))
    return compact_whitespace(body)
