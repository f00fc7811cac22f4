"""Lists of paper ids."""

from pyspark.sql import DataFrame, SparkSession, functions as F


def id_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """Trimmed, non-blank, distinct ids from a column of lines."""
    trimmed = F.regexp_replace(column, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    return lines.select(trimmed.alias("paper_id")).filter("paper_id <> ''").distinct()


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    return id_list(spark.read.text(path))
