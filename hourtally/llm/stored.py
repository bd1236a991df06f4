"""Tables between the jobs of an operator, written to the folder all executors share."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally import session

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
_WRITING: list[str | None] = []


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame's rows from a table written now. A lost executor takes nothing with it.

    Spark is told that the shuffle files of this one write are not needed afterwards.
    """
    spark = frame.sparkSession
    path = session.scratch(spark, name)
    with _shuffles_cleaned(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def _shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    """The setting holds from the first of several writes at the same time to the end of the last."""
    with _LOCK:
        if not _WRITING:
            _WRITING.append(spark.conf.get(CLEANUP, "false"))
            spark.conf.set(CLEANUP, "true")
        _WRITING.append(None)
    try:
        yield
    finally:
        with _LOCK:
            _WRITING.pop()
            if len(_WRITING) == 1:
                spark.conf.set(CLEANUP, _WRITING.pop())


def released(*frames: DataFrame) -> None:
    """Delete tables that ``written`` has made, once what was made from them is written too."""
    for frame in frames:
        files = frame.inputFiles()
        if files:
            session.delete(frame.sparkSession, files[0].rpartition("/")[0])


def key_of(doc_id: str, text: str) -> Column:
    """A key of a row that differs when its id or its text does."""
    number = F.col(doc_id).cast("long")
    return F.xxhash64(F.coalesce(number, F.lit(-1)), number.isNull(), F.coalesce(text, F.lit("")))


def keyed(docs: DataFrame) -> DataFrame:
    """``row_key, doc_id, text`` of documents."""
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(key_of("doc_id", "text").alias("row_key"), doc_id, F.col("text").cast("string").alias("text"))
