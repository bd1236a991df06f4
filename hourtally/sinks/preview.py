"""Looks at a few rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Fixed value: how many rows a preview shows.
PREVIEW_ROWS = 10


def preview(frame: DataFrame, order_by: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows by a column; each task keeps only its own first rows."""
    return frame.orderBy(order_by).limit(rows)


def head(frame: DataFrame):
    """The first row, or None."""
    return frame.head()


def first_row(frame: DataFrame, order_by: str) -> DataFrame:
    """The first row by a column, as a frame."""
    return preview(frame, order_by, rows=1)


def console(stream: DataFrame, checkpoint: str, rows: int = PREVIEW_ROWS, **trigger) -> StreamingQuery:
    """Print the first rows of every micro-batch."""
    return (
        stream.writeStream.format("console")
        .option("numRows", rows)
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
