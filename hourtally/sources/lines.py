"""Text files as streams: one record per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hourtally.operators import envelope


def stream_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Lines of the files in a folder, as they arrive. Column: value."""
    return spark.readStream.options(**options).text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_line_records(spark: SparkSession, path: str, topic: str, **options: str) -> DataFrame:
    """Lines as the records of a topic, each line being the payload."""
    return envelope.line_records(stream_lines(spark, path, **options), topic)
