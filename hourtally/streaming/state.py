"""Running totals held in Spark's state store instead of a ledger."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourtally import schemas
from hourtally.operators import readings, rollup
from hourtally.operators.feeds import Feed
from hourtally.sinks import ledger
from hourtally.streaming import jobs

# State is one row per hour, so a few stores hold it, whatever the size of the stream.
STATE_STORES = 8
_PARTITIONS = "spark.sql.shuffle.partitions"
# What a batch writes of the state: its changes.
STORE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_STARTING = threading.Lock()


def running_totals(records: DataFrame, feeds: Sequence[Feed]) -> DataFrame:
    """Totals per hour over the whole stream so far: a stateful aggregate.

    State is one row per hour, so it needs no watermark to stay small, and no event is
    ever too late.
    """
    return rollup.hourly(readings.contributions(readings.read_feeds(records, feeds), feeds))


def start_state_job(
    totals: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = jobs.FEED_INTERVAL,
    stores: int = STATE_STORES,
    fold_every: int = jobs.FOLD_EVERY,
) -> StreamingQuery:
    """Write the new totals of the hours that a batch changed, batch by batch, like a ledger.

    A batch run again replaces its own entry. Every ``fold_every`` batches the newest totals of all
    hours become one entry, so that reads and folders stay short. State is kept in RocksDB, of which a
    batch writes the changes only. ``stores`` counts only when the checkpoint is new.
    """

    def write(changed: DataFrame, batch_id: int) -> None:
        ledger.record(changed, path, batch_id)

    spark = totals.sparkSession
    action = jobs.kept_by(spark, path, checkpoint, write, fold_every, newest)
    writer = totals.writeStream.outputMode("update").foreachBatch(lambda batch, batch_id: action(batch, batch_id))
    writer = writer.option("checkpointLocation", checkpoint).trigger(**jobs.trigger(interval))
    # A query takes its settings from the session when it starts.
    wanted = {_PARTITIONS: str(stores), **STORE_SETTINGS}
    with _STARTING:
        before = {name: spark.conf.get(name, None) for name in wanted}
        for name, value in wanted.items():
            spark.conf.set(name, value)
        try:
            return writer.start()
        finally:
            for name, value in before.items():
                if value is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, value)


def start_state_jobs(
    records: DataFrame,
    feeds: Sequence[Feed],
    path: str,
    checkpoint: str,
    dead_letter_path: str,
    interval: str | None = jobs.FEED_INTERVAL,
) -> list[StreamingQuery]:
    """The totals of a stream, and beside them a job that keeps what they leave out."""
    if not dead_letter_path:
        raise ValueError("name a folder for the records that cannot be used")
    letters = jobs.start_dead_letter_job(records, feeds, dead_letter_path, f"{checkpoint}-dead-letters", interval)
    return [start_state_job(running_totals(records, feeds), path, checkpoint, interval), letters]


def newest(rows: DataFrame) -> DataFrame:
    """Of the totals that several entries give for an hour, the newest."""
    top = F.max_by(F.struct(*schemas.ADDED), F.col("entry")).alias("newest")
    return rows.groupBy("report_date").agg(top).select("report_date", "newest.*")


def latest_totals(spark: SparkSession, path: str) -> DataFrame:
    """The newest total of every hour."""
    return newest(ledger.entries(spark, path))
