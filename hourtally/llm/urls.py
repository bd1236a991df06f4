"""Filtering captured pages by dated lists of hosts and paths.

A list entry is a change: from a time on, a pattern is listed or no longer is. The changes of
a pattern become validity intervals, and a capture is held against the entries valid when it
was fetched: an as-of join on pattern and time. Patterns are domains, which cover their
subdomains, or a host with leading path segments (``host/a/b``), which cover what is below.

Captures that are equal in address and time are looked at once. A null or unreadable
address, or a null time, matches nothing. Changes with a null pattern, time or list are left
out. Hosts are the same in any case, paths are not. Of changes of a pattern at the same time,
the listing holds. Of several entries that match, the longest pattern is reported, then the list that sorts first. Repeated rows are
kept; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

AUTHORITY = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"
PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case, without user, port and closing dot; empty if there is none."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), AUTHORITY, 1)
    return F.regexp_replace(F.regexp_replace(F.lower(authority), "^.*@", ""), r"[.]?(:[0-9]*)?$", "")


def patterns_of(url: Column) -> Column:
    """All patterns that cover an address: its host's domains, and the host with each
    leading part of its path."""
    host = host_of(url)
    labels = F.split(host, "[.]")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    path = F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    below = F.transform(
        segments, lambda x, i: F.concat_ws("/", host, F.array_join(F.slice(segments, F.lit(1), i + 1), "/"))
    )
    return F.when(host != "", F.array_distinct(F.concat(domains, below))).otherwise(F.array().cast("array<string>"))


def _host_lowered(pattern: Column) -> Column:
    """A pattern with its host in lower case; the case of a path counts."""
    host = F.substring_index(pattern, "/", 1)
    return F.concat(F.lower(host), pattern.substr(F.length(host) + 1, F.length(pattern)))


def intervals(changes: DataFrame) -> DataFrame:
    """``list_id, pattern, since, until`` from ``list_id, pattern, listed, changed_at``.

    Hosts of patterns are put in lower case. ``until`` is the next change of the pattern, null if there is none. The next change is
    looked for within a month first and then among the first ones of later months, so a
    pattern with very many changes does not meet in one task.
    """
    pattern = _host_lowered(F.col("pattern")).alias("pattern")
    usable = changes.select("list_id", pattern, F.coalesce("listed", F.lit(False)).alias("listed"), "changed_at")
    at_once = usable.dropna().groupBy("list_id", "pattern", "changed_at").agg(F.max("listed").alias("listed"))
    monthly = at_once.withColumn("month", F.date_trunc("month", "changed_at"))
    firsts = monthly.groupBy("list_id", "pattern", "month").agg(F.min("changed_at").alias("first"))
    later = F.lead("first").over(Window.partitionBy("list_id", "pattern").orderBy("month"))
    following = firsts.select("list_id", "pattern", "month", later.alias("later"))
    inside = F.lead("changed_at").over(Window.partitionBy("list_id", "pattern", "month").orderBy("changed_at"))
    dated = monthly.withColumn("next", inside).join(following, ["list_id", "pattern", "month"])
    return dated.where("listed").select(
        "list_id", "pattern", F.col("changed_at").alias("since"), F.coalesce("next", "later").alias("until")
    )


def checked(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """The captures (``url, fetched_at`` and any others) with ``blocked, list_id, pattern, since``.

    Columns that had these names are replaced.
    """
    rows = captures.select(F.struct("*").alias("row"), F.col("url").alias("u"), F.col("fetched_at").alias("t"))
    keyed = rows.select("u", "t").distinct().select("u", "t", F.explode(patterns_of(F.col("u"))).alias("p"))
    entries = intervals(changes).select("list_id", F.col("pattern").alias("p"), "since", "until")
    active = (F.col("t") >= F.col("since")) & (F.col("until").isNull() | (F.col("t") < F.col("until")))
    met = keyed.join(entries, "p").where(active)
    rank = F.struct(-F.length("p"), F.col("list_id"), F.col("p"), F.col("since"))
    best = met.groupBy("u", "t").agg(F.min(rank).alias("best"))
    best = best.select(F.col("u").alias("bu"), F.col("t").alias("bt"), "best")
    joined = rows.join(best, (F.col("u") == F.col("bu")) & (F.col("t") == F.col("bt")), "left")
    own = ("blocked", "list_id", "pattern", "since")
    return joined.select(
        *(F.col("row").getField(c).alias(c) for c in captures.columns if c not in own),
        F.col("best").isNotNull().alias("blocked"),
        F.col("best.list_id").alias("list_id"),
        F.col("best.p").alias("pattern"),
        F.col("best.since").alias("since"),
    )


def allowed(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """The captures that no list held when they were fetched."""
    return checked(captures, changes).where(~F.col("blocked")).drop("blocked", "list_id", "pattern", "since")
