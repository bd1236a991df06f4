"""Adding batches and totals to a summary table in a database, once."""

from __future__ import annotations

import uuid

import pytest

from hourtally.operators import feeds, rollup
from hourtally.plans import embedded, report
from hourtally.sinks import database as sink
from hourtally.sinks import ledger
from hourtally.sources import tables, topics
from tests import helpers

MS = 1496767720000
HOUR = 3_600_000
SELLING = [feeds.GARMENT_SALES]
COLUMNS = "SALES DOUBLE PRECISION NOT NULL, WEB_HITS INT NOT NULL, TWEETS INT NOT NULL, TWEETS_POSITIVE INT NOT NULL"


@pytest.fixture
def database(spark):
    return embedded.database(spark)


def _deltas(spark, *pairs):
    records = helpers.records(spark, [helpers.sale(ms, v) for ms, v in pairs], feeds.GARMENT_SALES.topic)
    return report.hourly_deltas(records, SELLING)


@pytest.fixture
def every_row(spark, database):
    name = "T_" + uuid.uuid4().hex[:12].upper()
    sink.execute(spark, database, f"CREATE TABLE {name} (ID INT NOT NULL, {COLUMNS})", f"INSERT INTO {name} VALUES (1, 0, 0, 0, 0), (2, 10, 0, 0, 0)")
    return name


@pytest.fixture
def by_hour(spark, database):
    name = "T_" + uuid.uuid4().hex[:12].upper()
    sink.execute(
        spark, database,
        f"CREATE TABLE {name} (REPORT_DATE TIMESTAMP NOT NULL UNIQUE, {COLUMNS})",
        f"INSERT INTO {name} VALUES ('2001-01-01 00:00:00', 7, 1, 2, 3)",
    )
    return name


def _sales(spark, database, table):
    return sorted(r.SALES for r in tables.read_table(spark, database, table).collect())


def test_a_batch_adds_once_to_every_row(spark, database, every_row):
    first, second = _deltas(spark, (MS, 1.5), (MS + HOUR, 2.0)), _deltas(spark, (MS, 4.0))
    assert sink.add_batch(first, database, every_row, "job", 0, sink.EVERY_ROW)
    assert not sink.add_batch(first, database, every_row, "job", 0, sink.EVERY_ROW)
    assert sink.add_batch(second, database, every_row, "job", 1, sink.EVERY_ROW)
    assert not sink.add_batch(first, database, every_row, "job", 0, sink.EVERY_ROW)
    assert _sales(spark, database, every_row) == [7.5, 17.5]
    assert sink.add_batch(first, database, every_row, "another job", 0, sink.EVERY_ROW)
    assert _sales(spark, database, every_row) == [11.0, 21.0]
    with pytest.raises(ValueError, match="scope"):
        sink.add_batch(first, database, every_row, "job", 9, "some")


def test_a_batch_adds_once_to_its_hours(spark, database, by_hour):
    first = _deltas(spark, (MS, 1.5), (MS + HOUR, 2.0))
    second = _deltas(spark, (MS, 4.0), (MS + 2 * HOUR, 8.0))
    for number, deltas in enumerate((first, second)):
        assert sink.add_batch(deltas, database, by_hour, "job", number)
        assert not sink.add_batch(deltas, database, by_hour, "job", number)
    rows = {str(r.REPORT_DATE): tuple(r)[1:] for r in tables.read_table(spark, database, by_hour).collect()}
    assert rows == {
        "2001-01-01 00:00:00": (7.0, 1, 2, 3),
        "2017-06-06 16:00:00": (5.5, 0, 0, 0),
        "2017-06-06 17:00:00": (2.0, 0, 0, 0),
        "2017-06-06 18:00:00": (8.0, 0, 0, 0),
    }


def test_a_batch_that_fails_is_not_noted(spark, database, by_hour, every_row):
    sink.execute(spark, database, f"ALTER TABLE {by_hour} ADD CONSTRAINT LIMIT_{by_hour} CHECK (SALES < 100)")
    with pytest.raises(Exception, match="LIMIT_"):
        sink.add_batch(_deltas(spark, (MS, 99.0), (MS, 99.0)), database, by_hour, "job", 0)
    assert _sales(spark, database, by_hour) == [7.0]
    assert sink.add_batch(_deltas(spark, (MS, 9.0)), database, by_hour, "job", 0)
    assert _sales(spark, database, by_hour) == [7.0, 9.0]


def test_totals_published_again_add_what_is_new(spark, database, every_row, scratch):
    paths = [f"{scratch}/us", f"{scratch}/eu"]
    for path in paths:
        ledger.claim(spark, path, f"job of {path}")
        ledger.record(_deltas(spark, (MS, 1.25)), path, 0)
    assert report.add_to_every_row(spark, database, every_row, paths)
    assert not report.add_to_every_row(spark, database, every_row, paths)
    ledger.record(_deltas(spark, (MS, 2.0), (MS + HOUR, 1e20)), paths[0], 1)
    assert report.add_to_every_row(spark, database, every_row, paths)
    assert not report.add_to_every_row(spark, database, every_row, paths[:1])
    assert _sales(spark, database, every_row) == [1e20 + 4.5, 1e20 + 14.5]
    ledger.fold(spark, paths[0])
    assert not report.add_to_every_row(spark, database, every_row, paths)


def test_two_that_publish_at_once_add_once(spark, database, every_row, scratch, monkeypatch):
    ledger.record(_deltas(spark, (MS, 3.0)), f"{scratch}/us", 0)
    totals = {"us": ledger.overall(spark, f"{scratch}/us").first()}
    marks, again = sink._marks, []

    def overtaken(*given):
        row = marks(*given)
        if not again:
            again.append(True)
            assert sink.add_new_totals(spark, database, every_row, totals)
        return row

    monkeypatch.setattr(sink, "_marks", overtaken)
    assert not sink.add_new_totals(spark, database, every_row, totals)
    assert _sales(spark, database, every_row) == [3.0, 13.0]


def test_sales_set_in_place(spark, database, every_row):
    records = helpers.records(spark, [helpers.sale(MS, 1.5), helpers.sale(MS, 2.5)], feeds.GARMENT_SALES.topic)
    report.overwrite_sales(spark, database, every_row, records)
    assert _sales(spark, database, every_row) == [4.0, 4.0]


def test_a_job_that_publishes(spark, database, by_hour, scratch):
    def publish(*pairs):
        topics.write_topic(helpers.records(spark, [helpers.sale(ms, v) for ms, v in pairs], feeds.GARMENT_SALES.topic).coalesce(1), f"{scratch}/topic")

    def run():
        records = topics.stream_topic(spark, f"{scratch}/topic", maxFilesPerTrigger="1")
        place = (f"{scratch}/ledger", f"{scratch}/checkpoint", f"{scratch}/dead")
        report.start_publishing_job(records, SELLING, *place, database, by_hour, interval=None).awaitTermination()

    publish((MS, 1.0))
    publish((MS, 2.0), (MS + HOUR, 4.0))
    run()
    publish((MS + HOUR, 8.0))
    run()
    assert _sales(spark, database, by_hour) == [3.0, 7.0, 12.0]
    shown = rollup.shown(ledger.totals(spark, f"{scratch}/ledger")).collect()
    assert sorted(r.sales for r in shown) == [3.0, 12.0]
