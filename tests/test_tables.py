"""Relational tables, on the in-memory database that comes with Spark."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import functions as F

from hourtally import schemas
from hourtally.operators import envelope, feeds, summary
from hourtally.plans import embedded, report
from hourtally.sinks import database as sink
from hourtally.sources import literals, tables
from tests import helpers


@pytest.fixture
def database(spark):
    return embedded.database(spark)


@pytest.fixture
def name():
    return "T_" + uuid.uuid4().hex[:12].upper()


def test_round_trip(spark, database, name):
    rows = spark.range(1, 101).select("id", (F.col("id") * 1.5).alias("amount"), F.concat(F.lit("n"), "id").alias("label"))
    sink.overwrite(rows, database, name)
    sink.append(spark.sql("SELECT 101L AS id, 0D AS amount, 'n101' AS label"), database, name)
    read = tables.read_table(spark, database, name)
    assert read.count() == 101
    parts = tables.read_table_by_key(spark, database, name, "id", partitions=4)
    assert parts.rdd.getNumPartitions() == 4
    assert sorted(r.id for r in parts.collect()) == list(range(1, 102))


def test_filter_and_columns_reach_the_database(spark, database, name):
    sink.overwrite(spark.range(10).select("id", F.lit(1.0).alias("sales")), database, name)
    plan = tables.read_table(spark, database, name).where("id > 5").select("sales")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,5)" in text and "ReadSchema: struct<sales:double>" in text


def test_overwrite_of_the_table_being_read(spark, database, name):
    sink.overwrite(spark.range(5).select("id", F.lit(1.0).alias("sales")), database, name)
    loaded = tables.read_table(spark, database, name)
    sink.overwrite(summary.constant_column(loaded, "sales", 9.0), database, name)
    rows = tables.read_table(spark, database, name).collect()
    assert sorted((r.id, r.sales) for r in rows) == [(i, 9.0) for i in range(5)]


def test_polls_of_a_growing_table(spark, database, name):
    grow = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("ID"), F.lit("x").alias("V"))
    sink.overwrite(grow(1, 1), database, name)
    empty = tables.poll_table(spark, database, name, "ID")
    assert (empty.rows.count(), empty.mark) == (0, None)
    sink.append(grow(1, 11), database, name)
    first = tables.poll_table(spark, database, name, "ID", partitions=3)
    assert first.mark == 10
    sink.append(grow(11, 16), database, name)
    # Rows that came after the poll belong to the next one.
    assert sorted(r.ID for r in first.rows.collect()) == list(range(1, 11))
    second = tables.poll_table(spark, database, name, "ID", first.mark, partitions=3)
    assert (sorted(r.ID for r in second.rows.collect()), second.mark) == (list(range(11, 16)), 15)
    third = tables.poll_table(spark, database, name, "ID", second.mark)
    assert (third.rows.count(), third.mark) == (0, 15)


def test_poll_of_a_frame(spark):
    frame = spark.range(10)
    assert tables.poll(frame, "id").mark == 9
    after = tables.poll(frame, "id", 6)
    assert (sorted(r.id for r in after.rows.collect()), after.mark) == ([7, 8, 9], 9)
    done = tables.poll(frame, "id", 9)
    assert (done.rows.count(), done.mark) == (0, 9)


def test_tables_to_topics(spark, database, name):
    sink.overwrite(literals.garment_seed(spark), database, name)
    read = lambda table: tables.read_table(spark, database, table)
    feed = tables.tables_to_topics({name: "ID"}, read, "use-case-")
    assert helpers.record_columns(feed)
    rows = feed.select("topic", envelope.value_text().alias("v")).collect()
    assert {r.topic for r in rows} == {f"use-case-{name}"}
    assert {json.loads(r.v)["payload"]["ORDER_VALUE"] for r in rows} == {45.99, 29.99}
    sold = feeds.GARMENT_SALES.but(topic=f"use-case-{name}")
    assert [r.sales for r in report.hourly_report(feed, [sold]).collect()] == [75.98]


def test_tables_to_publish_must_be_named():
    with pytest.raises(ValueError, match="name the tables"):
        tables.tables_to_topics({}, None, "p-")
    with pytest.raises(ValueError, match="no key column"):
        tables.tables_to_topics({"a": "ID"}, None, "p-", ["b"])


def test_publish_summary(spark, database, name):
    records = helpers.records(spark, [helpers.sale(1496767720000, 45.99)], feeds.GARMENT_SALES.topic)
    for keep_definition in (False, True):
        sink.publish_summary(report.hourly_report(records), database, name, keep_definition)
    row = tables.read_table(spark, database, name).collect()
    assert [str(r.REPORT_DATE) for r in row] == ["2017-06-06 16:00:00"]
    assert (row[0].SALES, row[0].WEB_HITS, row[0].TWEETS) == (45.99, 0, 0)
    assert tables.read_table(spark, database, name).columns == schemas.EXEC_SUMMARY.fieldNames()[1:]


def test_a_failed_write_leaves_the_old_rows(spark, database, name):
    old = spark.sql("SELECT 1 AS ID, 2D AS SALES")
    sink.overwrite(old, database, name)
    broken = spark.sql("SELECT 3 AS ID, IF(rand() < 2, raise_error('lost'), 0D) AS SALES")
    with pytest.raises(Exception, match="lost"):
        sink.overwrite(broken, database, name, keep_definition=True)
    unknown = spark.sql("SELECT 3 AS ID, 4 AS OTHER")  # written beside, but the table cannot take it
    with pytest.raises(Exception, match="OTHER"):
        sink.overwrite(unknown, database, name, keep_definition=True)
    assert [tuple(r) for r in tables.read_table(spark, database, name).collect()] == [(1, 2.0)]
    sink.overwrite(spark.sql("SELECT 5 AS ID, 6D AS SALES"), database, name, keep_definition=True)
    assert [tuple(r) for r in tables.read_table(spark, database, name).collect()] == [(5, 6.0)]


def test_database_named_by_the_session(spark):
    spark.conf.set("spark.hourtally.jdbc.url", "jdbc:some://host/db")
    spark.conf.set("spark.hourtally.jdbc.driver", "some.Driver")
    spark.conf.set("spark.hourtally.jdbc.user", "me")
    try:
        options = embedded.database(spark).options()
        assert options == {"url": "jdbc:some://host/db", "driver": "some.Driver", "user": "me", "fetchsize": tables.FETCH_ROWS}
    finally:
        for part in ("url", "driver", "user"):
            spark.conf.unset(f"spark.hourtally.jdbc.{part}")
