"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import math
import os
import time
from pathlib import Path

import pytest
from pyspark.sql.streaming import StreamingQueryListener

import __spark_entry__ as entry_points
from hourtally.plans import oracles, registered

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test data")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    yield connection
    connection.close()


def _comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        return "NaN" if isinstance(value, float) and math.isnan(value) else value

    picked = [tuple(cell(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(picked, key=repr)


def test_queries_and_sql_name_the_same_things():
    assert set(registered.queries()) == set(oracles.ORACLES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    frame = entry_points.queries()[name](spark, SF_DIR)
    got = _comparable(frame.columns, [tuple(row) for row in frame.collect()])
    asked = sql.execute(entry_points.oracle_sql()[name])
    wanted = _comparable([c[0] for c in asked.description], asked.fetchall())
    assert got[0] == wanted[0]
    assert len(got[1]) == len(wanted[1])
    assert got[1] == wanted[1]


STREAMS = ["stream_hourly_sales", "stream_topics", "stream_running_state", "batch_delta", "stream_from_latest"]


@pytest.mark.parametrize("name", STREAMS)
def test_streams_run_several_batches(spark, name):
    ran = []

    class Batches(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            ran.append(event.progress.batchId)

        def onQueryTerminated(self, event):
            pass

    listener = Batches()
    spark.streams.addListener(listener)
    try:
        entry_points.queries()[name](spark, SF_DIR).collect()
        deadline = time.time() + 20
        while len(set(ran)) < 2 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert len(set(ran)) >= (2 if name == "stream_from_latest" else 4)


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["report_date", "sales", "web_hits", "tweets", "tweets_positive"]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """The same tables as folders of several files."""
    home = tmp_path_factory.mktemp("folders")
    for name in ("events", "orders", "documents", "region"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").repartition(3).write.parquet(f"{home}/{name}.parquet")
    return str(home)


@pytest.mark.parametrize("name", ["exec_summary_hourly", "stream_hourly_sales", "stream_running_state", "batch_delta"])
def test_tables_may_be_folders(spark, sql, folders, name):
    frame = entry_points.queries()[name](spark, folders)
    got = _comparable(frame.columns, [tuple(row) for row in frame.collect()])
    asked = sql.execute(entry_points.oracle_sql()[name])
    assert got == _comparable([c[0] for c in asked.description], asked.fetchall())
