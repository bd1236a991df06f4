"""Explicit schemas: no source in this package is read by inference."""

from __future__ import annotations

from pyspark.sql import types as T

# One record of a topic, as a Kafka reader delivers it.
RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# A record that was parsed when it was published: its document, and the one in its payload's text.
PARSED_RECORD = T.StructType(
    [*RECORD.fields, T.StructField("doc", T.VariantType()), T.StructField("inner", T.VariantType())]
)

# Source tables.
PING = T.StructType(
    [
        T.StructField("TEST_ID", T.IntegerType(), False),
        T.StructField("TEST_TIMESTAMP", T.TimestampType()),
    ]
)
GARMENT_SALES = T.StructType(
    [
        T.StructField("ID", T.IntegerType(), False),
        T.StructField("GARMENT_NAME", T.StringType()),
        T.StructField("SALES_DATE", T.TimestampType(), False),
        T.StructField("ORDER_VALUE", T.DoubleType()),
    ]
)
BOOK_SALES = T.StructType(
    [
        T.StructField("ID", T.IntegerType(), False),
        T.StructField("SALES_DATE", T.TimestampType()),
        T.StructField("ORDER_AMOUNT", T.DoubleType()),
    ]
)

# The summary table as a database holds it.
EXEC_SUMMARY = T.StructType(
    [
        T.StructField("ID", T.IntegerType(), False),
        T.StructField("REPORT_DATE", T.TimestampType(), False),
        T.StructField("SALES", T.DoubleType(), False),
        T.StructField("WEB_HITS", T.IntegerType(), False),
        T.StructField("TWEETS", T.IntegerType(), False),
        T.StructField("TWEETS_POSITIVE", T.IntegerType(), False),
    ]
)

# Money is added up as decimals, so that totals do not depend on the order of
# addition, and shown as doubles. What decimals cannot hold, an amount from DECIMAL_LIMIT on,
# one that is not finite, or what is left of one with more decimals, is added up as a double
# beside them.
AMOUNT = T.DecimalType(24, 6)
DECIMAL_LIMIT = 1e18
AMOUNT_TOTAL = T.DecimalType(38, 6)
# What is left counts if it is more than the last binary digit of the amount.
LEAST_SHARE_LEFT = 2.0**-52

COUNTERS = ("web_hits", "tweets", "tweets_positive")
MEASURES = ("sales", *COUNTERS)
# Measures as they are added up: sales in two parts.
SALES_REST = "sales_rest"
ADDED = ("sales", SALES_REST, *COUNTERS)
KINDS = {"sales": AMOUNT_TOTAL, SALES_REST: T.DoubleType(), **dict.fromkeys(COUNTERS, T.LongType())}

# What one micro-batch adds to the summary.
DELTA = T.StructType(
    [
        T.StructField("report_date", T.StringType()),
        *(T.StructField(name, KINDS[name]) for name in ADDED),
    ]
)
