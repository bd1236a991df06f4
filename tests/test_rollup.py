"""Sums per hour, summaries and their updates."""

from __future__ import annotations

import re
from collections import defaultdict
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourtally import schemas
from hourtally.operators import feeds, readings, rollup, summary
from hourtally.plans import report
from hourtally.sinks import preview
from hourtally.sources import literals
from tests import helpers

H16 = "2017-06-06 16:00:00"
HOUR = 3_600_000
MS = 1496767720000

# Sample inputs: six clicks and five messages, all within one hour.
CLICKS = [
    (0, "firstPage"),
    (10, "browseProduct"),
    (10, "firstPage"),
    (20, "browseProduct"),
    (30, "ViewReviews"),
    (20, "firstPage"),
]
TWEETS = [
    f"{MS},Your product is awesome.#cool. I really like it",
    f"{MS + 10000},I had a bad experience. Wont buy again. #sorry",
    f"{MS + 20000},You should use this product. Its really great.",
    f"{MS + 30000},I need some support help here.",
    f"{MS + 70000},Why cant we improve this?",
]


def _sample(spark):
    pairs = [(feeds.WEB_CLICKS.topic, helpers.click(MS + s * 1000, c)) for s, c in CLICKS]
    pairs += [(feeds.TWEETS.topic, helpers.tweet(t)) for t in TWEETS]
    pairs += [(feeds.GARMENT_SALES.topic, helpers.sale(MS, v)) for _, v in literals.FIRST_GARMENTS]
    return helpers.records(spark, pairs, None)


def test_golden_hour(spark):
    rows = report.hourly_report(_sample(spark)).collect()
    assert [tuple(r) for r in rows] == [(H16, 75.98, 3, 5, 2)]


def test_an_hour_needs_something_added(spark):
    pairs = [
        (feeds.WEB_CLICKS.topic, helpers.click(MS, "browseProduct")),
        (feeds.GARMENT_SALES.topic, helpers.sale(MS + HOUR, 0)),
        (feeds.GARMENT_SALES.topic, "{broken"),
    ]
    rows = report.hourly_report(helpers.records(spark, pairs, None)).collect()
    assert [tuple(r) for r in rows] == [("2017-06-06 17:00:00", 0.0, 0, 0, 0)]


def test_no_records(spark):
    none = _sample(spark).where("false")
    assert report.hourly_report(none).collect() == []
    assert [tuple(r) for r in report.overall(none).collect()] == [(Decimal(0), 0.0, 0, 0, 0)]
    assert rollup.is_zero(report.hourly_deltas(none))


amounts = st.integers(-10_000_000, 10_000_000).map(lambda cents: cents / 100)
events = st.one_of(
    st.tuples(st.just("sale"), st.integers(0, 5), amounts),
    st.tuples(st.just("book"), st.integers(0, 5), amounts),
    st.tuples(st.just("click"), st.integers(0, 5), st.sampled_from(["firstPage", "browseProduct"])),
    st.tuples(st.just("tweet"), st.integers(0, 5), st.sampled_from(["so cool", "great", "meh", ""])),
    st.tuples(st.just("broken"), st.integers(0, 5), st.just("")),
)


def _record(kind, hour, what):
    ms = MS + hour * HOUR
    return {
        "sale": lambda: (feeds.GARMENT_SALES.topic, helpers.sale(ms, what)),
        "book": lambda: (feeds.BOOK_SALES.topic, helpers.book(ms, what)),
        "click": lambda: (feeds.WEB_CLICKS.topic, helpers.click(ms, what)),
        "tweet": lambda: (feeds.TWEETS.topic, helpers.tweet(f"{ms},{what}")),
        "broken": lambda: (feeds.GARMENT_SALES.topic, '{"payload":'),
    }[kind]()


def _by_hand(chosen):
    hours = defaultdict(lambda: [Decimal(0), 0, 0, 0])
    for kind, hour, what in chosen:
        label = f"2017-06-06 {16 + hour}:00:00"
        if kind == "sale":
            hours[label][0] += Decimal(str(what))
        elif kind == "book":
            hours[label][0] += Decimal(str(what)) * Decimal("1.5")
        elif kind == "click" and what == "firstPage":
            hours[label][1] += 1
        elif kind == "tweet":
            hours[label][2] += 1
            hours[label][3] += what in ("so cool", "great")
    return {label: tuple(v) for label, v in hours.items()}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(chosen=st.lists(events, min_size=1, max_size=60), cut=st.integers(0, 60), data=st.data())
def test_totals_do_not_depend_on_order_or_batches(spark, chosen, cut, data):
    wanted = _by_hand(chosen)
    shuffled = data.draw(st.permutations(chosen))
    pairs = [_record(*event) for event in shuffled]
    frame = helpers.records(spark, pairs, None)
    whole = {r.report_date: tuple(r)[1:] for r in report.hourly_deltas(frame).drop("sales_rest").collect()}
    assert whole == wanted
    parts = [report.hourly_deltas(helpers.records(spark, p, None)) for p in (pairs[:cut], pairs[cut:]) if p]
    merged = {r.report_date: tuple(r)[1:] for r in rollup.merge_totals(*parts).drop("sales_rest").collect()}
    assert merged == wanted
    assert all(v[3] <= v[2] for v in whole.values())
    total = report.overall(frame).drop("sales_rest").first()
    assert tuple(total) == tuple(sum((v[i] for v in wanted.values()), Decimal(0)) for i in range(4))


def test_maps(spark):
    selling = [feeds.GARMENT_SALES]
    values = [helpers.sale(MS + h * HOUR, v) for h, v in ((0, 1.25), (0, 2.0), (1, 4.0), (10, 8.0))]
    frame = helpers.records(spark, values, feeds.GARMENT_SALES.topic)
    totals = report.hourly_report(frame, selling)
    maps = {r.report_day: r.hour_values for r in rollup.hour_value_maps(totals, "sales").collect()}
    assert maps == {
        "2017-06-06": {H16: 3.25, "2017-06-06 17:00:00": 4.0},
        "2017-06-07": {"2017-06-07 02:00:00": 8.0},
    }
    added = readings.contributions(readings.read_feeds(frame, selling), selling)
    entries = added.select(rollup.hour_entry(F.col("hour"), F.col("sales")).alias("entry"))
    sums = sorted(float(r.value) for r in rollup.add_entries(entries, "entry").collect())
    assert sums == [3.25, 4.0, 8.0]


def test_update_every_row(spark):
    base = spark.createDataFrame([(1, 10.0, 1), (2, 0.0, 0)], "id int, sales double, web_hits int")
    updated = summary.update_every_row(base, report.overall(_sample(spark)))
    assert sorted(tuple(r) for r in updated.collect()) == [(1, 85.98, 4), (2, 75.98, 3)]
    assert updated.schema["web_hits"].dataType.simpleString() == "int"
    plan = updated._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_upsert_by_hour(spark):
    known = [(H16, 10.0), ("2017-06-06 15:00:00", 1.0)]
    base = summary.with_defaults(spark.createDataFrame(known, "report_date string, sales double"))
    rows = rollup.shown(summary.upsert_by_hour(base, report.hourly_deltas(_sample(spark))))
    assert sorted(tuple(r) for r in rows.collect()) == [
        ("2017-06-06 15:00:00", 1.0, 0, 0, 0),
        (H16, 85.98, 3, 5, 2),
    ]


def test_seed_and_checks(spark):
    seed = summary.seed_row(spark)
    row = seed.first()
    assert re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:00:00", row.report_date)
    assert tuple(row)[1:] == (0.0, 0, 0, 0)
    summary.assert_publishable(seed)
    with pytest.raises(ValueError, match="more than once"):
        summary.assert_publishable(seed.unionByName(seed))
    with pytest.raises(ValueError, match="NULL"):
        summary.assert_publishable(seed.withColumn("tweets", F.lit(None).cast("int")))
    table = summary.as_table(seed)
    assert table.columns == schemas.EXEC_SUMMARY.fieldNames()[1:]
    assert [f.dataType for f in table.schema] == [f.dataType for f in schemas.EXEC_SUMMARY][1:]


def test_counter_too_large_for_its_table_fails(spark):
    big = summary.seed_row(spark).withColumn("web_hits", F.lit(3_000_000_000))
    with pytest.raises(Exception, match="web_hits"):
        summary.as_table(big).collect()


def test_literal_rows(spark):
    garments = literals.garment_seed(spark)
    assert garments.columns == schemas.GARMENT_SALES.fieldNames()
    assert garments.agg(F.sum("ORDER_VALUE")).first()[0] == pytest.approx(75.98)
    assert literals.ping_seed(spark).count() == 4


def test_preview(spark):
    frame = spark.range(100)
    assert [r.id for r in preview.preview(frame, "id").collect()] == list(range(10))
    assert preview.head(frame).id == 0
    assert preview.head(frame.where("id < 0")) is None


@pytest.mark.parametrize("amount", [123456789.0000004, 1000000.0000005, 45.99, 1e-9, 0.1 + 0.2, 987654321987.123456])
def test_amounts_keep_their_digits(spark, amount):
    records = helpers.records(spark, [helpers.sale(MS, amount)], feeds.GARMENT_SALES.topic)
    assert report.hourly_report(records, [feeds.GARMENT_SALES]).first().sales == pytest.approx(amount, rel=2.0**-52, abs=0)
