"""Sums and counts per hour, in total, and as map views.

Every aggregate is a plain ``groupBy``: Spark adds up inside each task first, so
only one row per hour and task is shuffled, however unevenly the hours are filled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourtally import schemas
from hourtally.functions import hours
from hourtally.operators import readings


def _measures(frame: DataFrame) -> list[str]:
    return [name for name in schemas.ADDED if name in frame.columns]


def _sums(frame: DataFrame) -> list[Column]:
    sums = []
    for name in _measures(frame):
        sums.append(F.coalesce(F.sum(name), F.lit(0)).cast(schemas.KINDS[name]).alias(name))
    return sums


def hourly(contributed: DataFrame, *keys: str) -> DataFrame:
    """Measures per hour label; ``sales`` stays decimal so it can be added up further.

    An hour exists when some record added to it, if only 0.
    """
    # Counting keeps records that add nothing (unusable ones, with hour NULL, and
    # those no measure wants) out after the sum rather than by a filter before it,
    # for which Spark would parse each record twice.
    adds = F.coalesce(*(F.col(name).isNotNull() | F.lit(None) for name in _measures(contributed)))
    totals = contributed.groupBy("hour", *keys).agg(F.count(adds).alias("added"), *_sums(contributed))
    return totals.where(F.col("added") > 0).select(
        hours.hour_label(F.col("hour")).alias("report_date"), *keys, *_measures(contributed)
    )


def shown(totals: DataFrame) -> DataFrame:
    """Totals as they are reported: money as one double."""
    if "sales" not in totals.columns:
        return totals
    sales = F.col("sales").cast("double")
    if schemas.SALES_REST in totals.columns:
        sales = sales + F.col(schemas.SALES_REST)
    return totals.withColumn("sales", sales).drop(schemas.SALES_REST)


def grand_total(contributed: DataFrame) -> DataFrame:
    """One row: each measure over all records."""
    return contributed.agg(*_sums(contributed))


def merge_totals(totals: DataFrame, *more: DataFrame) -> DataFrame:
    """Add up totals that several jobs or batches have for the same hours."""
    return add_up(stack(totals, *more))


def stack(*frames: DataFrame) -> DataFrame:
    """Frames with different measures on top of each other; absent measures are 0."""
    stacked = None
    for frame in frames:
        values = {n: F.col(n) for n in frame.columns}
        if "sales" in values and frame.schema["sales"].dataType == T.DoubleType():
            exact, rest = readings.split_amount(F.col("sales"))
            values |= {"sales": exact, schemas.SALES_REST: rest + values.get(schemas.SALES_REST, F.lit(0.0))}
        full = frame.select(
            "report_date", *(values.get(n, F.lit(0)).cast(schemas.KINDS[n]).alias(n) for n in schemas.ADDED)
        )
        stacked = full if stacked is None else stacked.unionByName(full)
    return stacked


def add_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy("report_date").agg(*_sums(rows))


def hour_entry(hour: Column, value: Column) -> Column:
    """A map of one entry, what one record adds; NULL for a record without an hour."""
    return F.when(hour.isNotNull(), F.create_map(hour, value))


def add_entries(entries: DataFrame, column: str, *parts: str) -> DataFrame:
    """Sum maps key by key: ``(hour, value)`` rows, or one column for each part of a value."""
    # The outer form keeps Spark from building each map a second time to test its size.
    rows = entries.select(F.explode_outer(column).alias("hour", "value"))
    sums = [F.sum(f"value.{part}").alias(part) for part in parts] or [F.sum("value").alias("value")]
    return rows.where(F.col("hour").isNotNull()).groupBy("hour").agg(*sums)


def hour_value_maps(totals: DataFrame, value: str) -> DataFrame:
    """Totals as maps ``{hour label: value}``, one map per report day.

    A day has at most 24 labels, so no map grows with the data.
    """
    return totals.groupBy(F.substring("report_date", 1, 10).alias("report_day")).agg(
        F.map_from_entries(F.collect_list(F.struct("report_date", value))).alias("hour_values")
    )


def is_zero(totals: DataFrame) -> bool:
    """True when nothing was added."""
    return totals.isEmpty()
