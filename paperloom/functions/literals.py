"""Parameters as literals in a plan."""

import base64
import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def constant(value: object, type_name: str) -> Column:
    """A list or mapping as one literal.

    The optimizer folds the parsed text into the plan once, where an expression per
    element would be built and analyzed again with every step on the frame.  A value that
    does not fit the type is an error.
    """
    return F.from_json(F.lit(json.dumps(value)), type_name, {"mode": "FAILFAST"})


def as_bytes(text: str) -> str:
    """How a text is spelled in the JSON of a constant that holds it as binary."""
    return base64.b64encode(text.encode()).decode()


def small_table(spark: SparkSession, rows: list[dict], fields: str) -> DataFrame:
    """A table of parameters whose size the planner knows.

    It becomes a local relation, whose size grows with its rows: joins with it are broadcast
    below Spark's threshold and shuffled above it.
    """
    schema = T._parse_datatype_string(fields)
    table = pa.Table.from_pylist(rows, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)
