"""Scratch tables and small helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.plans.staging import SETTING

#: Where a session without a shared folder (a test) keeps its scratch tables.
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from the session's settings."""
    named = spark.conf.get(SETTING, None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="llm-")
    return _OWN[app]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Write rows once to the shared folder and go on from there.

    Later steps read only the columns they use, and a lost executor costs its own tasks.
    """
    path = new_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def held(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose values are computed once per row.

    The optimizer moves a projected expression into whatever uses it, even into a
    lambda that runs per array element; it does not move one through a generator.
    """
    packed = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    kept = [c for c in rows.columns if c not in columns]
    out = rows.select(*[F.col(f"`{c}`") for c in kept], packed.alias("_held"))
    return out.select(*[F.col(f"`{c}`") for c in kept], *[F.col("_held")[n].alias(n) for n in columns])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
