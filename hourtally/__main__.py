"""Jobs for ``spark-submit``: ``python -m hourtally <job> ...``.

feed      keep the ledger of one or more feeds up to date
state     the same totals in Spark's state store
preview   print the payloads of a topic as they arrive
report    the hourly report of a file-backed topic as a table, in one batch
fold      shorten a ledger
publish   write the totals of ledgers to a database table, or add what is new to every row
overwrite-sales   set the sales of every row of a table to the total of a topic
poll      publish the new rows of a database table to a file-backed topic

The report zone is that of ``--zone``. Topics come from Kafka (``--servers``, needs the
Kafka package of Spark) or from files (``--topic-path``).
"""

from __future__ import annotations

import argparse
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally import session
from hourtally.functions import variants
from hourtally.operators import envelope, feeds, rollup
from hourtally.plans import report
from hourtally.sinks import database as database_sink
from hourtally.sinks import ledger, preview
from hourtally.sources import polling, topics
from hourtally.sources.tables import Database
from hourtally.streaming import jobs, state


def _arguments(argv) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="hourtally", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("--zone", default="UTC", help="zone of the hour labels")
    commands = parser.add_subparsers(dest="job", required=True)

    def streaming(name: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name)
        source = command.add_mutually_exclusive_group(required=True)
        source.add_argument("--servers", help="Kafka bootstrap servers")
        source.add_argument("--topic-path", help="folder of a file-backed topic")
        command.add_argument("--starting", default=topics.EARLIEST, choices=["earliest", "latest", "largest", "smallest"])
        command.add_argument("--checkpoint", required=True)
        command.add_argument("--once", action="store_true", help="work off what is there and stop")
        command.add_argument("--max-offsets", type=int, default=1_000_000, help="records of a batch, from Kafka")
        command.add_argument("--max-files", type=int, default=1000, help="files of a batch, from files")
        return command

    names = [feed.name for feed in feeds.ALL_FEEDS]
    for name in ("feed", "state"):
        command = streaming(name)
        command.add_argument("--feeds", nargs="+", choices=names, default=names)
        command.add_argument("--out", required=True, help="folder of the ledger or totals")
        command.add_argument("--dead-letters", required=True, help="folder of records that could not be used")
        if name == "feed":
            command.add_argument("--publish-url", help="database whose summary table gets every batch")
            command.add_argument("--publish-driver")
            command.add_argument("--publish-table")
            command.add_argument("--publish-scope", choices=["hour", "all"], default="hour")
            command.add_argument("--user")
            command.add_argument("--password-file", help="file that holds the password")
            command.add_argument("--quote", default="", help="quote for column names, if the database needs one")
            command.add_argument("--fold-every", type=int, default=jobs.FOLD_EVERY, help="batches between folds")
    command = streaming("preview")
    command.add_argument("--topics", nargs="+", required=True)

    command = commands.add_parser("report")
    command.add_argument("--topic-path", required=True, help="folder of a file-backed topic")
    command.add_argument("--feeds", nargs="+", choices=names, default=names)
    command.add_argument("--out", required=True, help="folder of the report")
    command.add_argument("--dead-letters", required=True, help="folder of records that could not be used")

    command = commands.add_parser("fold")
    command.add_argument("--ledger", required=True)
    command.add_argument("--drop", action="store_true", help="delete the files of earlier folds")

    def with_database(name: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name)
        command.add_argument("--url", required=True)
        command.add_argument("--driver", required=True)
        command.add_argument("--table", required=True)
        command.add_argument("--user")
        command.add_argument("--password-file", help="file that holds the password")
        command.add_argument("--quote", default="", help="quote for column names, if the database needs one")
        return command

    command = with_database("publish")
    command.add_argument("--ledgers", nargs="+", required=True)
    command.add_argument("--scope", choices=["hour", "all"], default="hour", help="rows by hour, or totals added to every row")
    command.add_argument("--new-definition", action="store_true", help="create the table anew, without its keys and defaults")
    command = with_database("overwrite-sales")
    command.add_argument("--topic-path", required=True, help="folder of a file-backed topic")
    command = with_database("poll")
    command.add_argument("--key", required=True)
    command.add_argument("--prefix", default=feeds.TOPIC_PREFIX)
    command.add_argument("--topic-path", required=True)
    command.add_argument("--marks", required=True, help="folder of the marks reached")
    command.add_argument("--partitions", type=int, help="tasks of a poll; by its range of keys if not given")
    command.add_argument("--once", action="store_true")
    return parser.parse_args(argv)


def _records(spark: SparkSession, args: argparse.Namespace, wanted: list[str]) -> DataFrame:
    if args.servers:
        return topics.kafka_stream(spark, args.servers, wanted, args.starting, args.max_offsets)
    return topics.stream_topic(spark, args.topic_path, wanted, maxFilesPerTrigger=str(args.max_files))


def _skips(args: argparse.Namespace) -> bool:
    """Must the job skip what is there? Kafka does that itself."""
    return not args.servers and topics.start_option(args.starting) == topics.LATEST


def run(spark: SparkSession, argv=None) -> None:
    args = _arguments(argv)
    session.pin_report_settings(spark, args.zone)
    if args.job in ("feed", "state"):
        chosen = [feed for feed in feeds.ALL_FEEDS if feed.name in args.feeds]
        records = _records(spark, args, [feed.topic for feed in chosen])
        interval = None if args.once else jobs.FEED_INTERVAL
        if args.job == "feed":
            place = (args.out, args.checkpoint, args.dead_letters)
            options = {"interval": interval, "fold_every": args.fold_every, "from_latest": _skips(args)}
            if args.publish_url:
                database = _database(args, args.publish_url, args.publish_driver)
                target = (database, args.publish_table, args.publish_scope)
                started = [report.start_publishing_job(records, chosen, *place, *target, **options)]
            else:
                started = [jobs.start_feed_job(records, chosen, *place, **options)]
        elif _skips(args):
            raise ValueError("the state job starts at earliest with a file-backed topic")
        else:
            started = state.start_state_jobs(records, chosen, args.out, args.checkpoint, args.dead_letters, interval)
        for query in started:
            query.awaitTermination()
    elif args.job == "preview":
        document = variants.parse_json(envelope.value_text())
        payload = F.try_variant_get(document, "$.payload", "string").alias("payload")
        interval = None if args.once else jobs.PREVIEW_INTERVAL
        shown = _records(spark, args, args.topics).select("topic", payload)
        if _skips(args):
            jobs.skip_present(shown, args.checkpoint)
        preview.console(shown, args.checkpoint, **jobs.trigger(interval)).awaitTermination()
    elif args.job == "report":
        chosen = [feed for feed in feeds.ALL_FEEDS if feed.name in args.feeds]
        report.write_report(topics.read_topic(spark, args.topic_path), args.out, args.dead_letters, chosen)
    elif args.job == "fold":
        ledger.fold(spark, args.ledger)
        if args.drop:
            ledger.drop_folded(spark, args.ledger)
    elif args.job == "publish":
        if args.scope == "all":
            report.add_to_every_row(spark, _database(args), args.table, args.ledgers)
        else:
            totals = rollup.shown(ledger.totals(spark, args.ledgers))
            database_sink.publish_summary(totals, _database(args), args.table, not args.new_definition)
    elif args.job == "overwrite-sales":
        records = topics.read_topic(spark, args.topic_path, [feeds.GARMENT_SALES.topic])
        report.overwrite_sales(spark, _database(args), args.table, records)
    elif args.job == "poll":
        _poll(spark, args)


def _database(args: argparse.Namespace, url: str | None = None, driver: str | None = None) -> Database:
    login = {}
    if args.user:
        login["user"] = args.user
    if args.password_file:
        login["password"] = Path(args.password_file).read_text().strip()
    return Database(url or args.url, driver or args.driver, login, args.quote)


def _poll(spark: SparkSession, args: argparse.Namespace) -> None:
    database = _database(args)
    while True:
        polling.poll_and_publish(
            spark, database, args.table, args.key, args.prefix, args.topic_path, args.marks, args.partitions
        )
        if args.once:
            return
        time.sleep(polling.POLL_INTERVAL_SECONDS)


if __name__ == "__main__":
    run(SparkSession.builder.appName("hourtally").config(map=session.BUILDER_SETTINGS).getOrCreate())
