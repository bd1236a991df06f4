"""Publishing the new rows of a relational table to a topic, poll by poll."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally import schemas, session
from hourtally.operators import envelope
from hourtally.sources import tables
from hourtally.sources.tables import Database

# Fixed value: time between two polls.
POLL_INTERVAL_SECONDS = 2


def last_mark(spark: SparkSession, marks: str) -> int | None:
    """The largest key published so far, or None at the start."""
    return _kept(spark, f"{marks}/done")


def _kept(spark: SparkSession, path: str) -> int | None:
    written = session.read_if_there(spark, "mark bigint, slot int", path)
    return None if written is None else written.agg(F.max("mark")).first()[0]


def _keep(spark: SparkSession, path: str, mark: int) -> None:
    """Keep a mark in the slot that does not hold the newest one: two files, however many polls."""
    written = session.read_if_there(spark, "mark bigint, slot int", path)
    newest = None if written is None else written.agg(F.max_by("slot", "mark")).first()[0]
    row = spark.range(1).select(F.lit(mark).cast("bigint").alias("mark")).coalesce(1)
    row.write.mode("overwrite").parquet(f"{path}/slot={0 if newest is None else 1 - newest}")


def publish_poll(
    spark: SparkSession, found: tables.Poll, key: str, table: str, prefix: str, path: str, marks: str
) -> int | None:
    """Publish what a poll found to topic ``prefix + table``, then move the mark.

    Its files are written out of sight and appear at once, under a name that follows from
    the old mark. How far the poll goes is noted first, so one that failed is done again over
    the same range; if its files had appeared, only the mark is moved. A stream never sees
    a row twice. Returns the new mark.
    """
    before = last_mark(spark, marks)
    intended = _kept(spark, f"{marks}/intent")
    if intended is None or (before is not None and intended <= before):
        if found.mark is None or found.mark == before:
            return before
        intended = found.mark
        _keep(spark, f"{marks}/intent", intended)
    name = f"above={'nothing' if before is None else before}"
    if not session.exists(spark, f"{path}/{name}"):
        rows = found.rows.where(F.col(key) <= intended)
        _write_poll(envelope.table_records(rows, prefix + table, key), f"{path}/_next")
        session.rename(spark, f"{path}/_next", f"{path}/{name}")
    _keep(spark, f"{marks}/done", intended)
    return intended


def _write_poll(records: DataFrame, path: str) -> None:
    records.select(*schemas.RECORD.fieldNames()).write.mode("overwrite").parquet(path)


def poll_and_publish(
    spark: SparkSession,
    database: Database,
    table: str,
    key: str,
    prefix: str,
    path: str,
    marks: str,
    partitions: int | None = None,
) -> int | None:
    """One poll of a JDBC table: rows with a key above the mark become records.

    Without a number of partitions, the poll has one for every ``tables.KEYS_PER_TASK`` keys.
    """
    found = tables.poll_table(spark, database, table, key, last_mark(spark, marks), partitions)
    return publish_poll(spark, found, key, table, prefix, path, marks)
