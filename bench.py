"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores (default 8).
Batch queries: median of five runs after a warm-up, every row produced and dropped.
``report_from_topic`` reads a topic of 20 files written beforehand, ``report_from_parsed_topic`` one whose
records were parsed when they were published. ``stream_all_feeds`` works off a topic of 20 files, one per micro-batch.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from hourtally import session
from hourtally.operators import feeds, rollup
from hourtally.plans import registered, report, stand_ins
from hourtally.sinks import ledger
from hourtally.sources import topics
from hourtally.streaming import jobs

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
FILES = 20

BATCH = (
    "exec_summary_hourly",
    "hourly_us_sales",
    "hourly_eu_sales",
    "hourly_web_hits",
    "hourly_tweets",
    "grand_total",
    "running_total",
    "hour_value_map",
    "envelope_payload",
    "nested_payload",
    "tweet_slice",
    "keyword_filter",
    "dead_letter",
    "topic_filter",
    "incremental_scan",
    "table_list_scan",
    "unique_key_check",
)


def _session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("hourtally-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config(map=session.BUILDER_SETTINGS)
    )
    if "BENCH_SHARED_DIR" in os.environ:
        builder = builder.config("spark.checkpoint.dir", os.environ["BENCH_SHARED_DIR"])
    else:
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return session.pin_report_settings(spark)


def _seconds(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def _batch(spark: SparkSession, name: str) -> float:
    query = registered.queries()[name]

    def run() -> None:
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()

    run()
    return statistics.median(_seconds(run) for _ in range(RUNS))


def _written_topic(spark: SparkSession, parsed: bool) -> float:
    """The hourly report from a topic written beforehand: reading and adding up, no envelopes made."""
    work = session.scratch(spark, "bench-topic")
    topics.write_topic(stand_ins.merged_records(spark, SF_DIR).repartition(FILES), f"{work}/topic", parsed=parsed)

    def run() -> None:
        report.hourly_report(topics.read_topic(spark, f"{work}/topic", parsed=parsed)).write.format("noop").mode("overwrite").save()

    run()
    return statistics.median(_seconds(run) for _ in range(RUNS))


def _stream(spark: SparkSession) -> dict:
    """All feeds in one topic of many files, one file per micro-batch."""
    work = session.scratch(spark, "bench")
    topics.write_topic(stand_ins.merged_records(spark, SF_DIR).repartition(FILES), f"{work}/topic")
    records = topics.stream_topic(spark, f"{work}/topic", maxFilesPerTrigger="1")
    query = jobs.start_feed_job(records, feeds.ALL_FEEDS, f"{work}/ledger", f"{work}/checkpoint", f"{work}/dead", interval=None)
    took = _seconds(query.awaitTermination)
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    rows = sum(p["numInputRows"] for p in batches)
    times = [p["durationMs"]["triggerExecution"] / 1000 for p in batches]
    warm = batches[1:] or batches
    assert not rollup.is_zero(ledger.totals(spark, f"{work}/ledger"))
    return {
        "seconds": took,
        "rows": rows,
        "batches": len(batches),
        "batch_seconds_median": round(statistics.median(times), 3),
        "batch_seconds_max": round(max(times), 3),
        "rows_per_second_median": round(statistics.median(p["processedRowsPerSecond"] for p in warm)),
    }


def main() -> None:
    spark = _session()
    times = {}
    for name in BATCH:
        times[name] = round(_batch(spark, name), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    for name, parsed in (("report_from_topic", False), ("report_from_parsed_topic", True)):
        times[name] = round(_written_topic(spark, parsed), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    stream = _stream(spark)
    times["stream_all_feeds"] = round(stream.pop("seconds"), 3)
    print(
        json.dumps(
            {
                "metric": "total of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "stream": stream,
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
                "cpus": int(CPUS),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
