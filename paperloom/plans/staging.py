"""Tables that cut the lineage of a result used by several sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession, fallback: str) -> str:
    """The shared folder the cluster names, or ``fallback`` where it names none."""
    return (spark.conf.get(SETTING, None) or fallback).rstrip("/")


def file_system(spark: SparkSession, path: str):
    """Hadoop path and file system of a path, seen from the driver."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    place, files = file_system(spark, path)
    files.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, made whole or not at all visible."""
    place, files = file_system(spark, path)
    stream = files.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


@contextmanager
def staging(spark: SparkSession, fallback: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives a function that writes rows to Parquet in the shared folder and reads them back.

    Every sink then reads only the columns it needs, and losing an executor costs
    at most the tasks that ran on it.  The tables are dropped at the end, so all sinks
    have to be written inside.
    """
    folder = f"{shared_dir(spark, fallback)}/staged-{uuid.uuid4().hex}"

    def put(rows: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}"
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    try:
        yield put
    finally:
        delete(spark, folder)
