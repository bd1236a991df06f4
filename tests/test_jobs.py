"""The command-line jobs, end to end: table, topic, ledger, table."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourtally import __main__ as main
from hourtally import schemas, session
from hourtally.functions import hours
from hourtally.operators import envelope, feeds
from hourtally.plans import embedded, report
from hourtally.sinks import database as sink
from hourtally.sources import literals, polling, tables, topics
from hourtally.streaming import state
from tests import helpers


@pytest.fixture
def database(spark):
    return embedded.database(spark)


def _name():
    return "T_" + uuid.uuid4().hex[:12].upper()


def test_from_sales_table_to_summary_table(spark, scratch, database):
    source, target = "garment_sales", _name()
    at = ["--url", database.url, "--driver", database.driver, "--quote", database.quote]
    sink.overwrite(literals.garment_seed(spark), database, source)
    poll = ["poll", *at, "--table", source, "--key", "ID", "--topic-path", f"{scratch}/topic"]
    poll += ["--marks", f"{scratch}/marks", "--once"]
    feed = ["feed", "--topic-path", f"{scratch}/topic", "--feeds", "garment_sales", "--out", f"{scratch}/ledger"]
    feed += ["--checkpoint", f"{scratch}/checkpoint", "--dead-letters", f"{scratch}/dead", "--once"]
    main.run(spark, poll)
    main.run(spark, feed)
    main.run(spark, poll)  # nothing new
    sink.append(literals.garment_seed(spark).withColumn("ID", F.col("ID") + 2), database, source)
    main.run(spark, poll)
    main.run(spark, feed)
    main.run(spark, ["fold", "--ledger", f"{scratch}/ledger", "--drop"])
    main.run(spark, ["publish", *at, "--table", target, "--ledgers", f"{scratch}/ledger"])
    rows = tables.read_table(spark, database, target).collect()
    assert sum(r.SALES for r in rows) == pytest.approx(151.96)
    assert polling.last_mark(spark, f"{scratch}/marks") == 4


def test_failed_poll_is_replaced(spark, scratch):
    frame = spark.createDataFrame([(1, 5.0), (2, 6.0)], "ID int, V double")
    place = ("ID", "t", "p-", f"{scratch}/topic", f"{scratch}/marks")
    found = tables.poll(frame, "ID")
    polling._write_poll(helpers.records(spark, ["{}"] * 3, "p-t"), f"{scratch}/topic/_next")  # died while writing
    assert polling.publish_poll(spark, found, *place) == 2
    assert topics.read_topic(spark, f"{scratch}/topic").count() == 2
    files = topics.read_topic(spark, f"{scratch}/topic").inputFiles()
    session.delete(spark, f"{scratch}/marks/done")  # died before the mark was moved, and the table has grown since
    grown = frame.unionByName(spark.createDataFrame([(3, 1.0)], "ID int, V double"))
    assert polling.publish_poll(spark, tables.poll(grown, "ID"), *place) == 2
    assert topics.read_topic(spark, f"{scratch}/topic").inputFiles() == files
    assert helpers.record_columns(topics.read_topic(spark, f"{scratch}/topic"))
    more = frame.unionByName(spark.createDataFrame([(7, 1.0)], "ID int, V double"))
    assert polling.publish_poll(spark, tables.poll(more, "ID", 2), *place) == 7
    assert topics.read_topic(spark, f"{scratch}/topic", ["p-t"]).count() == 3
    assert polling.publish_poll(spark, tables.poll(more, "ID", 7), *place) == 7


def test_state_and_preview_jobs(spark, scratch):
    values = [helpers.sale(1496767720000, 2.5), helpers.sale(1496767720000, 1.0)]
    topics.write_topic(helpers.records(spark, values, feeds.GARMENT_SALES.topic), f"{scratch}/topic")
    common = ["--topic-path", f"{scratch}/topic", "--once", "--checkpoint"]
    main.run(spark, ["state", *common, f"{scratch}/c1", "--feeds", "garment_sales", "--out", f"{scratch}/totals", "--dead-letters", f"{scratch}/dead"])
    assert float(state.latest_totals(spark, f"{scratch}/totals").first().sales) == 3.5
    main.run(spark, ["preview", *common, f"{scratch}/c2", "--topics", feeds.GARMENT_SALES.topic])


def test_sales_of_every_row_set_to_the_total(spark, database):
    table = _name()
    sink.overwrite(spark.sql("SELECT 1 AS ID, 0D AS SALES UNION ALL SELECT 2, 7D"), database, table)
    records = helpers.records(spark, [helpers.sale(1, 45.99), helpers.sale(2, 29.99)], feeds.GARMENT_SALES.topic)
    report.overwrite_sales(spark, database, table, records)
    rows = tables.read_table(spark, database, table).collect()
    assert sorted((r.ID, r.SALES) for r in rows) == [(1, 75.98), (2, 75.98)]


def test_totals_added_to_every_row_and_sales_set(spark, scratch, database):
    table = _name()
    at = ["--url", database.url, "--driver", database.driver, "--quote", database.quote, "--table", table]
    zero = "0 AS TWEETS, 0 AS TWEETS_POSITIVE"
    sink.overwrite(spark.sql(f"SELECT 1 AS ID, 1D AS SALES, 2 AS WEB_HITS, {zero} UNION ALL SELECT 2, 5D, 0, 0, 0"), database, table)
    values = [helpers.sale(1, 45.99), helpers.sale(7_200_000, 29.99)]
    topics.write_topic(helpers.records(spark, values, feeds.GARMENT_SALES.topic), f"{scratch}/topic")
    feed = ["feed", "--topic-path", f"{scratch}/topic", "--feeds", "garment_sales", "--out", f"{scratch}/ledger"]
    main.run(spark, [*feed, "--checkpoint", f"{scratch}/c", "--dead-letters", f"{scratch}/dead", "--once"])
    for _ in range(2):
        main.run(spark, ["publish", *at, "--ledgers", f"{scratch}/ledger", "--scope", "all"])
    rows = sorted(tuple(r)[:3] for r in tables.read_table(spark, database, table).collect())
    assert rows == [(1, 76.98, 2), (2, 80.98, 0)]
    main.run(spark, ["overwrite-sales", *at, "--topic-path", f"{scratch}/topic"])
    rows = sorted(tuple(r)[:3] for r in tables.read_table(spark, database, table).collect())
    assert rows == [(1, 75.98, 2), (2, 75.98, 0)]


def test_pings_as_a_topic(spark, scratch):
    pings = literals.ping_seed(spark)
    found = tables.poll(pings, "TEST_ID")
    polling.publish_poll(spark, found, "TEST_ID", "jdbc_source", "jdbc-source-", f"{scratch}/topic", f"{scratch}/marks")
    records = topics.read_topic(spark, f"{scratch}/topic", ["jdbc-source-jdbc_source"])
    wire = T.StructType.fromDDL("TEST_ID int, TEST_TIMESTAMP bigint")
    rows = envelope.payload_of(records, wire).withColumn("at", hours.event_time(F.col("TEST_TIMESTAMP")))
    assert pings.schema.fieldNames() == schemas.PING.fieldNames()
    assert sorted(r.TEST_ID for r in rows.where("at <= current_timestamp()").collect()) == [1, 2, 3, 4]


def test_report_job(spark, scratch):
    values = [helpers.sale(1496767720000, 2.5), "{broken"]
    topics.write_topic(helpers.records(spark, values, feeds.GARMENT_SALES.topic), f"{scratch}/topic")
    args = ["report", "--topic-path", f"{scratch}/topic", "--out", f"{scratch}/hours", "--dead-letters", f"{scratch}/dead"]
    main.run(spark, args)
    assert [r.sales for r in spark.read.parquet(f"{scratch}/hours").collect()] == [2.5]
    assert [bytes(r.value) for r in spark.read.parquet(f"{scratch}/dead").collect()] == [b"{broken"]
    with pytest.raises(ValueError, match="cannot be used"):
        report.write_report(topics.read_topic(spark, f"{scratch}/topic"), f"{scratch}/hours", "")
