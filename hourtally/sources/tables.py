"""Relational tables: plain, partitioned and incremental reads, and tables as topics."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.operators import envelope


# Keys of a range that one task of a poll reads, and rows a database hands over at a time.
KEYS_PER_TASK = 1_000_000
FETCH_ROWS = "10000"


@dataclass(frozen=True)
class Database:
    """Where a JDBC database is. User and password go into ``properties``.

    ``quote`` is put around column names in the text sent to the database itself, for
    databases that fold names written without it.
    """

    url: str
    driver: str
    properties: Mapping[str, str] | None = None
    quote: str = ""

    def options(self) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, "fetchsize": FETCH_ROWS, **(self.properties or {})}


def read_table(spark: SparkSession, database: Database, table: str) -> DataFrame:
    """A table in one partition, for tables of modest size."""
    return spark.read.format("jdbc").options(**database.options(), dbtable=table).load()


def key_range(spark: SparkSession, database: Database, table: str, key: str) -> tuple[int, int] | None:
    """Smallest and largest key, computed by the database."""
    name = f"{database.quote}{key}{database.quote}"
    ask = f"(SELECT MIN({name}) AS LO, MAX({name}) AS HI FROM {table}) KEYS"
    row = read_table(spark, database, ask).first()
    return None if row is None or row[0] is None else (int(row[0]), int(row[1]))


def read_table_by_key(
    spark: SparkSession, database: Database, table: str, key: str, partitions: int
) -> DataFrame:
    """A table in partitions of equal key ranges, read in parallel.

    Rows outside the range found at the start belong to the outer partitions, so
    none is missed.
    """
    found = key_range(spark, database, table, key)
    if found is None:
        return read_table(spark, database, table)
    options = {
        "partitionColumn": key,
        "lowerBound": str(found[0]),
        "upperBound": str(found[1] + 1),
        "numPartitions": str(partitions),
    }
    return spark.read.format("jdbc").options(**database.options(), dbtable=table, **options).load()


@dataclass(frozen=True)
class Poll:
    """Rows with new keys, and the mark to hand to the next poll."""

    rows: DataFrame
    mark: int | None


def poll(table: DataFrame, key: str, mark: int | None = None) -> Poll:
    """Rows with a key above ``mark``, as an incremental table reader fetches them.

    The upper end is fixed before the rows are read: rows inserted meanwhile are left
    for the next poll rather than lost between the two. Both bounds are comparisons
    with literals, so a table or Parquet scan filters by them at the source.
    """
    fresh = table if mark is None else table.where(F.col(key) > mark)
    top = fresh.agg(F.max(key).alias("top")).first().top
    if top is None:
        return Poll(fresh.where(F.lit(False)), mark)
    return Poll(fresh.where(F.col(key) <= top), int(top))


def newest_key(spark: SparkSession, path: str, key: str) -> int | None:
    """The largest key of Parquet files, from their footers: no row is read.

    Asked in a session of its own, whose reader hands a maximum down to the files.
    """
    asking = spark.newSession()
    for name, value in FROM_FOOTERS.items():
        asking.conf.set(name, value)
    return footer_maximum(asking, path, key).first().top


# Settings with which Spark answers minima, maxima and counts from the footers of files.
FROM_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_maximum(asking: SparkSession, path: str, key: str) -> DataFrame:
    return asking.read.parquet(path).agg(F.max(key).alias("top"))


def poll_files(spark: SparkSession, path: str, key: str, mark: int | None = None) -> Poll:
    """``poll`` of a table kept as Parquet files, whose upper bound comes from the footers."""
    top = newest_key(spark, path, key)
    table = spark.read.parquet(path)
    if top is None or (mark is not None and top <= mark):
        return Poll(table.where(F.lit(False)), mark)
    fresh = table.where(F.col(key) <= top)
    return Poll(fresh if mark is None else fresh.where(F.col(key) > mark), int(top))


def poll_table(
    spark: SparkSession,
    database: Database,
    table: str,
    key: str,
    mark: int | None = None,
    partitions: int | None = None,
) -> Poll:
    """``poll`` of a JDBC table. The database finds the bounds; the read is parallel."""
    found = key_range(spark, database, table, key)
    if found is None or (mark is not None and found[1] <= mark):
        return Poll(read_table(spark, database, table).where(F.lit(False)), mark)
    low = found[0] if mark is None else mark + 1
    if partitions is None:
        partitions = max(1, -(-(found[1] - low + 1) // KEYS_PER_TASK))
    options = {
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(found[1] + 1),
        "numPartitions": str(partitions),
    }
    rows = spark.read.format("jdbc").options(**database.options(), dbtable=table, **options).load()
    return Poll(rows.where((F.col(key) >= low) & (F.col(key) <= found[1])), found[1])


def tables_to_topics(
    tables: Mapping[str, str],
    read: Callable[[str], DataFrame],
    prefix: str,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Named tables as one feed; table ``t`` becomes topic ``prefix + t``.

    ``tables`` maps each table to its key column. Which tables to publish must be
    said: an empty list is refused rather than taken as all tables.
    """
    chosen = list(tables if names is None else names)
    if not chosen:
        raise ValueError("name the tables to publish")
    unknown = [name for name in chosen if name not in tables]
    if unknown:
        raise ValueError(f"no key column known for {unknown}")
    feeds = [envelope.table_records(read(name), prefix + name, tables[name]) for name in chosen]
    return reduce(DataFrame.unionByName, feeds)
