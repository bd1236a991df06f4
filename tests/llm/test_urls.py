from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hourtally.llm import registered, urls

CHANGES = "list_id string, pattern string, listed boolean, changed_at timestamp"
CAPTURES = "url string, fetched_at timestamp, blocked string, p int"


def day(n, month=1):
    return datetime(2024, month, n)


@pytest.fixture(scope="module")
def changes(spark):
    rows = [
        ("spam", "bad.org", True, day(5)), ("spam", "bad.org", False, day(10)), ("spam", "bad.org", True, day(2, 3)),
        ("spam", "ok.net/x", True, day(1)), ("adult", "bad.org", True, day(8)), ("adult", "deep.bad.org", True, day(9)),
        ("spam", "tie.com", True, day(5)), ("spam", "tie.com", False, day(5)), ("spam", "off.com", False, day(1)),
        ("spam", "twice.com", True, day(3)), ("spam", "twice.com", True, day(6)), ("spam", "twice.com", True, day(6)),
        (None, "x.com", True, day(1)), ("spam", None, True, day(1)), ("spam", "y.com", True, None), ("spam", "z.com", None, day(1)),
    ]
    return spark.createDataFrame(rows, CHANGES)


@pytest.mark.parametrize(
    ("url", "when", "want"),
    [
        ("http://bad.org/", day(4), None),
        ("http://bad.org/", day(5), ("spam", "bad.org")),
        ("https://www.Bad.ORG:8080/p?q", day(6), ("spam", "bad.org")),
        ("http://user@bad.org./", day(9), ("adult", "bad.org")),
        ("http://bad.org", day(15), ("adult", "bad.org")),
        ("http://a.deep.bad.org/", day(12), ("adult", "deep.bad.org")),
        ("http://notbad.org/", day(20), None),
        ("http://ok.net/x", day(2), ("spam", "ok.net/x")),
        ("http://ok.net/x/y/z?w#f", day(2), ("spam", "ok.net/x")),
        ("http://ok.net/xy", day(2), None),
        ("http://tie.com/", day(6), ("spam", "tie.com")),
        ("http://off.com/", day(6), None),
        ("http://twice.com/", day(7), ("spam", "twice.com")),
        ("http://z.com/", day(7), None),
        ("not an address", day(7), None),
        ("", day(7), None),
        (None, day(7), None),
        ("http://bad.org/", None, None),
    ],
)
def test_as_of(spark, changes, url, when, want):
    rows = spark.createDataFrame([(url, when, "x", 1)] * 2, CAPTURES)
    found = urls.checked(rows, changes).collect()
    assert len(found) == 2
    for r in found:
        assert ((r.list_id, r.pattern) if r.blocked else None) == want


def test_intervals(changes):
    rows = {(r.list_id, r.pattern, r.since, r.until) for r in urls.intervals(changes).where("pattern = 'bad.org'").collect()}
    assert rows == {("spam", "bad.org", day(5), day(10)), ("spam", "bad.org", day(2, 3), None), ("adult", "bad.org", day(8), None)}


def test_filter_and_empty_tables(spark, changes):
    rows = spark.createDataFrame([("http://bad.org/", day(6), "x", 1), ("http://fine.org/", day(6), "y", 2)], CAPTURES)
    assert [(r.url, r.p) for r in urls.allowed(rows, changes).collect()] == [("http://fine.org/", 2)]
    assert urls.checked(rows.where("1 = 0"), changes).count() == 0
    assert urls.checked(rows, changes.where("1 = 0")).where("blocked").count() == 0


def test_long_address(spark, changes):
    long = "http://" + ".".join(["a"] * 100) + ".bad.org/" + "/".join(["s"] * 400)
    rows = spark.createDataFrame([(long, day(6), None, None)], CAPTURES)
    assert urls.checked(rows, changes).first().pattern == "bad.org"
    plan = urls.checked(rows, changes)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert urls.checked(rows, changes).where(F.col("blocked")).count() == 1


def test_case_of_paths_and_hosts(spark):
    rows = [
        ("spam", "Case.net/Foo", True, day(1)), ("spam", "case.NET/Foo", False, day(10)),
        ("spam", "case.net/bar", True, day(1)), ("spam", "UP.org", True, day(1)),
    ]
    changes = spark.createDataFrame(rows, CHANGES)
    wanted = {
        ("http://CASE.net/Foo/1", day(5)): "case.net/Foo", ("http://case.net/foo/1", day(5)): None,
        ("http://case.net/Foo/1", day(12)): None, ("http://case.net/Bar", day(5)): None,
        ("http://case.net/bar", day(5)): "case.net/bar", ("http://www.up.org/X", day(5)): "up.org",
    }
    captures = spark.createDataFrame([(url, when, "x", 1) for url, when in wanted], CAPTURES)
    assert {(r.url, r.fetched_at): r.pattern for r in urls.checked(captures, changes).collect()} == wanted


def test_query_on_odd_addresses(spark, tmp_path):
    odd = ["http://plain.org", "http://a.b.org?q=1", "http://a.b.org#f", "http://x.y.z.org/", "http://p.org/F/g", "not one", "", None, "http://", "http://:80"]
    pages = spark.createDataFrame(list(enumerate(odd)), "page_id long, url string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    entries = {(r.list_id, r.pattern) for r in registered.list_changes(pages).collect()}
    assert {("hosts", "plain.org"), ("folders", "plain.org"), ("folders", "a.b.org"), ("folders", "p.org/F"), ("domains", "y.z.org")} <= entries
    found = registered.op5_temporal_url_filter(spark, str(tmp_path)).collect()
    assert sorted((r.page_id, r.url or "") for r in found) == [(i, u or "") for i, u in enumerate(odd)]
