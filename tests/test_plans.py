"""What the physical plans look like."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hourtally.operators import envelope, feeds, readings
from hourtally.plans import registered, report, stand_ins
from hourtally.sources import tables, topics
from tests import helpers

SF_DIR = "/root/testdata/sf0.001"

# Queries that only read: running them for their plan starts no job of note.
DECLARATIVE = [
    name
    for name in registered.QUERIES
    if not name.startswith(("jdbc", "stream", "text_stream", "batch_delta", "upsert_summary", "incremental_scan", "table_to", "literal", "empty", "update_all", "topic_pruning", "topic_offsets", "report_from_parsed", "report_with"))
]


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", DECLARATIVE)
def test_stays_in_the_jvm_and_joins_nothing(spark, name):
    plan = _plan(registered.queries()[name](spark, SF_DIR))
    for node in ("Python", "Pandas", "Arrow", "Join", "Cartesian", "Sort ", "Window"):
        assert node not in plan, node


def test_summary_needs_one_shuffle_of_partial_sums(spark):
    plan = _plan(registered.queries()["exec_summary_hourly"](spark, SF_DIR))
    assert plan.count("Exchange ") == 1
    assert plan.count("partial_sum(sales#") == 1
    assert "Exchange hashpartitioning(hour" in plan


def test_each_table_is_read_once(spark):
    plan = _plan(registered.queries()["exec_summary_hourly"](spark, SF_DIR))
    assert [plan.count(f"{name}.parquet") for name in ("events", "orders", "documents")] == [1, 1, 1]


# How often each query parses: once per envelope read and scan, twice for nested JSON.
PARSES = {
    "hourly_us_sales": 1,
    "hourly_eu_sales": 1,
    "hourly_web_hits": 2,
    "hourly_tweets": 1,
    "exec_summary_hourly": 4,
    "grand_total": 2,
    "hour_value_map": 2,
    "dead_letter": 2,
    "nested_payload": 2,
    "first_page_filter": 2,
    "tweet_slice": 1,
    "keyword_filter": 1,
    "keyword_filter_custom": 1,
    "lenient_numbers": 1,
    "currency_convert": 1,
    "table_list_scan": 4,
}


@pytest.mark.parametrize("name", sorted(PARSES))
def test_each_record_is_parsed_once(spark, name):
    assert _plan(registered.queries()[name](spark, SF_DIR)).count("parseJson") == PARSES[name]


def test_dead_letters_parse_once(spark):
    events = stand_ins.table(spark, SF_DIR, "events")
    read = readings.read_feeds(stand_ins.broken_records(events), [feeds.GARMENT_SALES])
    assert _plan(readings.dead_letters(read)).count("parseJson") == 1
    assert _plan(read.where("problem IS NOT NULL")).count("parseJson") > 1  # why dead_letters does not


def test_only_needed_columns_are_read(spark):
    events = stand_ins.table(spark, SF_DIR, "events")
    plan = _plan(report.hourly_report(stand_ins.click_records(events), [feeds.WEB_CLICKS]))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in plan
    assert "PushedFilters: [In(event_type, [click,signup,view])]" in plan


def test_poll_filters_in_the_scan(spark):
    events = stand_ins.table(spark, SF_DIR, "events").select("event_id", "value")
    plan = _plan(tables.poll(events, "event_id", 5).rows)
    assert "GreaterThan(event_id,5)" in plan and "LessThanOrEqual(event_id," in plan


def test_hot_hour_is_summed_before_the_shuffle(spark):
    """Nearly all rows in one hour: what is shuffled stays one row per hour and task."""
    moment = F.when(F.col("id") % 100 == 0, F.col("id") * 3600000).otherwise(0).cast("string")
    text = F.concat(F.lit('{"payload":{"ORDER_VALUE":1,"SALES_DATE":'), moment, F.lit("}}"))
    rows = spark.range(0, 20000, 1, 4).select(text.alias("text"))
    records = envelope.to_records(rows, feeds.GARMENT_SALES.topic, F.lit("k"), F.col("text"))
    result = report.hourly_report(records, [feeds.GARMENT_SALES])
    assert sum(r.sales for r in result.collect()) == 20000
    shuffled = _shuffled_rows(result)
    assert shuffled <= 200 + 4


def _shuffled_rows(frame):
    plan = frame._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "Exchange" in text
    stages = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan
    pending, found = [stages], 0
    while pending:
        node = pending.pop()
        if node.nodeName() == "ShuffleQueryStage":
            metrics = node.plan().metrics()
            found += metrics.apply("shuffleRecordsWritten").value()
        children = node.children()
        pending.extend(children.apply(i) for i in range(children.size()))
    return found


def test_marks_come_from_footers(spark, scratch):
    spark.range(100).write.parquet(f"{scratch}/t")
    asking = spark.newSession()
    for name, value in tables.FROM_FOOTERS.items():
        asking.conf.set(name, value)
    plan = tables.footer_maximum(asking, f"{scratch}/t", "id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(id)]" in plan
    assert tables.newest_key(spark, f"{scratch}/t", "id") == 99
    found = tables.poll_files(spark, f"{scratch}/t", "id", 94)
    assert (sorted(r.id for r in found.rows.collect()), found.mark) == ([95, 96, 97, 98, 99], 99)
    assert tables.poll_files(spark, f"{scratch}/t", "id", 99).rows.count() == 0
    spark.range(0).write.parquet(f"{scratch}/none")
    assert tables.poll_files(spark, f"{scratch}/none", "id").mark is None


def test_topics_that_are_not_named_are_not_opened(spark, scratch):
    pairs = [(t, "{}") for t in ("a", "b", "c") for _ in range(3)]
    topics.write_topic(helpers.records(spark, pairs, None), f"{scratch}/topic", topics.BY_TOPIC)
    read = topics.read_topic(spark, f"{scratch}/topic", ["a", "c"])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [topic" in plan
    assert read.count() == 6 and helpers.record_columns(read)
    opened = {r.f.split("topic=")[1][0] for r in read.select(F.input_file_name().alias("f")).distinct().collect()}
    assert opened == {"a", "c"}
    stream = topics.stream_topic(spark, f"{scratch}/topic", ["b"])
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{scratch}/c").trigger(availableNow=True).start(f"{scratch}/out")
    query.awaitTermination()
    assert {r.topic for r in spark.read.parquet(f"{scratch}/out").collect()} == {"b"}


def test_parsed_topics_are_not_parsed_again(spark, scratch):
    topics.write_topic(stand_ins.merged_records(spark, SF_DIR), f"{scratch}/topic", parsed=True)
    read = topics.read_topic(spark, f"{scratch}/topic", parsed=True)
    assert "parse_json" not in _plan(report.hourly_report(read))
    letters = report.unreadable(read).collect()
    plain = report.unreadable(stand_ins.merged_records(spark, SF_DIR)).collect()
    assert sorted((r.topic, r.problem, bytes(r.value)) for r in letters) == sorted((r.topic, r.problem, bytes(r.value)) for r in plain)


def test_places_of_records(spark, scratch):
    for _ in range(2):
        topics.write_topic(helpers.records(spark, [("a", "{}")] * 50, None).repartition(3), f"{scratch}/topic")
    places = [{(r.partition, r.offset) for r in topics.read_topic(spark, f"{scratch}/topic").collect()} for _ in range(2)]
    assert places[0] == places[1] and len(places[0]) == 100
