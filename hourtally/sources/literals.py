"""Literal rows: the rows the source tables start with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally import schemas

# The garments the sales table starts with, and the number of pings.
FIRST_GARMENTS = (("Mens Pants", 45.99), ("Womens Tops", 29.99))
FIRST_PINGS = 4


def garment_seed(spark: SparkSession) -> DataFrame:
    """First sales rows, dated now."""
    rows = [(i, name, value) for i, (name, value) in enumerate(FIRST_GARMENTS, start=1)]
    seeded = spark.createDataFrame(rows, "ID int, GARMENT_NAME string, ORDER_VALUE double")
    dated = seeded.withColumn("SALES_DATE", F.current_timestamp())
    return dated.select(*schemas.GARMENT_SALES.fieldNames())


def ping_seed(spark: SparkSession, count: int = FIRST_PINGS) -> DataFrame:
    return spark.range(1, count + 1).select(
        F.col("id").cast("int").alias("TEST_ID"), F.current_timestamp().alias("TEST_TIMESTAMP")
    )
