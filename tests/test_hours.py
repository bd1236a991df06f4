"""Hour labels, in several zones."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourtally import session
from hourtally.functions import hours

ZONES = ["UTC", "America/New_York", "Asia/Kolkata", "Australia/Lord_Howe"]


@pytest.fixture(params=ZONES)
def zone(spark, request):
    session.pin_report_settings(spark, request.param)
    yield request.param
    session.pin_report_settings(spark)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 4_102_444_800_000), min_size=50, max_size=200))
def _labels(spark, zone, moments):
    frame = spark.createDataFrame([(m,) for m in moments], "ms bigint")
    time = hours.event_time(F.col("ms"))
    rows = frame.select(
        "ms",
        hours.hour_bucket(time).alias("direct"),
        hours.hour_label(hours.hour_number(time)).alias("by_number"),
    ).collect()
    for row in rows:
        local = dt.datetime.fromtimestamp(row.ms / 1000, ZoneInfo(zone))
        assert row.direct == local.strftime("%Y-%m-%d %H:00:00")
        assert row.by_number == row.direct


def test_labels_follow_the_zone(spark, zone):
    _labels(spark, zone)


def test_repeated_hour_has_one_label(spark):
    session.pin_report_settings(spark, "America/New_York")
    try:
        twice = [1730611800000, 1730615400000]  # 01:30 before and after clocks go back
        frame = spark.createDataFrame([(m,) for m in twice], "ms bigint")
        numbers = frame.select(hours.hour_number(hours.event_time(F.col("ms"))).alias("n")).distinct()
        assert [r[0] for r in numbers.select(hours.hour_label(F.col("n"))).collect()] == ["2024-11-03 01:00:00"]
    finally:
        session.pin_report_settings(spark)


def test_edges_of_the_range(spark):
    edges = [-12_219_292_800_000, -1, 0, 253_402_214_400_000]
    frame = spark.createDataFrame([(m,) for m in edges], "ms bigint")
    time = hours.event_time(F.col("ms"))
    got = [tuple(r) for r in frame.select(hours.hour_bucket(time), hours.hour_label(hours.hour_number(time))).collect()]
    wanted = ["1582-10-15 00:00:00", "1969-12-31 23:00:00", "1970-01-01 00:00:00", "9999-12-31 00:00:00"]
    assert got == [(label, label) for label in wanted]


def test_labels_of_any_year(spark):
    moments = {
        hours.EARLIEST_MS: "-290308", hours.LATEST_MS: "+294247", -62_135_596_800_001: "0000", 253_402_300_800_000: "+10000",
        -62_167_219_200_001: "-0001", -50_000_000_000_000: "0385",
    }
    frame = spark.createDataFrame([(m,) for m in moments], "ms bigint")
    label = hours.hour_label(hours.hour_number(hours.event_time(F.col("ms"))))
    for row in frame.select("ms", label.alias("label")).collect():
        assert row.label.rsplit("-", 2)[0] == moments[row.ms] or moments[row.ms] == "0000"


def test_epoch_of_times_without_zone(spark):
    row = spark.sql("SELECT TIMESTAMP_NTZ'2017-06-06 16:48:40.1239' AS t").select(hours.epoch_ms(F.col("t"))).first()
    assert row[0] == 1496767720123
