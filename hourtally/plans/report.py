"""The hourly report as a batch job, and into a database."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourtally import session
from hourtally.operators import feeds as feed_specs
from hourtally.operators import readings, rollup
from hourtally.operators.feeds import Feed
from hourtally.sinks import database as database_sink
from hourtally.sinks import ledger
from hourtally.sources.tables import Database
from hourtally.streaming import jobs


def hourly_deltas(records: DataFrame, feeds: Sequence[Feed] = feed_specs.ALL_FEEDS) -> DataFrame:
    """Records of any of the feeds to measures per hour (money as decimal)."""
    read = readings.read_feeds(records, feeds)
    return rollup.hourly(readings.contributions(read, feeds))


def hourly_report(records: DataFrame, feeds: Sequence[Feed] = feed_specs.ALL_FEEDS) -> DataFrame:
    """Records of any of the feeds to the measures per hour as reported.

    One pass over the records and one small shuffle; no join, whatever the number
    of feeds.
    """
    return rollup.shown(hourly_deltas(records, feeds))


def unreadable(records: DataFrame, feeds: Sequence[Feed] = feed_specs.ALL_FEEDS) -> DataFrame:
    """What the reports above leave out, with raw values and reasons: read it next to them."""
    return readings.dead_letters(readings.read_feeds(records, feeds))


def write_report(
    records: DataFrame, path: str, dead_letter_path: str, feeds: Sequence[Feed] = feed_specs.ALL_FEEDS
) -> int:
    """The hourly report as a table, and what it leaves out in another; none of a batch is lost unseen.

    One pass over the records writes the report and counts the others; only if there are any does a second
    one write these. Both tables are replaced. Returns the number of records set aside.
    """
    if not dead_letter_path:
        raise ValueError("name a folder for the records that cannot be used")
    seen, written = Observation(), Observation()
    read = readings.read_feeds(records, feeds)
    added = readings.contributions(read, feeds, "problem").observe(seen, F.count("problem").alias("unusable"))
    hours = rollup.shown(rollup.hourly(added)).observe(written, F.count(F.lit(1)).alias("n"))
    hours.write.mode("overwrite").parquet(path)
    # Without any record Spark drops the count, so it is only asked when hours were written.
    unusable = seen.get["unusable"] if written.get["n"] else readings.dead_letters(read).count()
    if unusable:
        readings.dead_letters(read).write.mode("overwrite").parquet(dead_letter_path)
    else:
        session.delete(records.sparkSession, dead_letter_path)
    return unusable


def overall(records: DataFrame, feeds: Sequence[Feed] = feed_specs.ALL_FEEDS) -> DataFrame:
    """Records of any of the feeds to one row of totals."""
    read = readings.read_feeds(records, feeds)
    return rollup.grand_total(readings.contributions(read, feeds))


def overwrite_sales(spark: SparkSession, database: Database, table: str, records: DataFrame) -> None:
    """Set the sales of every row of a summary table to the total of the sales records."""
    total = overall(records, [feed_specs.GARMENT_SALES]).transform(rollup.shown).first()
    database_sink.set_every_row(spark, database, table, {"SALES": total.sales})


def add_to_every_row(spark: SparkSession, database: Database, table: str, ledgers: Sequence[str]) -> bool:
    """Add what is new in the overall totals of ledgers to every row of a summary table.

    Run again, or after a batch that added nothing, it adds nothing.
    """
    totals = {ledger.owner(spark, path) or path: ledger.overall(spark, path).first() for path in ledgers}
    return database_sink.add_new_totals(spark, database, table, totals)


def start_publishing_job(
    records: DataFrame,
    feeds: Sequence[Feed],
    ledger_path: str,
    checkpoint: str,
    dead_letter_path: str,
    database: Database,
    table: str,
    scope: str = database_sink.BY_HOUR,
    **options,
) -> StreamingQuery:
    """The feed job, which also adds every batch to a summary table in a database, once."""

    def entry_of(spark: SparkSession, batch_id: int) -> DataFrame:
        return ledger.entry_of(spark, ledger_path, batch_id)

    after = database_sink.publisher(database, table, scope, lambda spark: jobs.job_id(spark, checkpoint), entry_of)
    return jobs.start_feed_job(
        records, feeds, ledger_path, checkpoint, dead_letter_path, after_batch=after, **options
    )
