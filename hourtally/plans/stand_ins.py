"""Topics derived from the given tables, whole tables at a time.

Each function turns a table into records with the envelopes the publishers of the
feeds would write. They work on batch and on streaming frames alike.

=============  ===================================  ==============================
topic          table                                payload
=============  ===================================  ==============================
garment sales  events of type purchase              object
book sales     orders                               object
web clicks     events of type view, click, signup   string holding JSON
tweets         documents                            stamp, comma, whole text
broken sales   events of type error                 object, cut short
=============  ===================================  ==============================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourtally.functions import hours
from hourtally.operators import envelope, feeds

# How stand-in rows get their category and message time.
CATEGORIES = {"view": "firstPage", "click": "browseProduct", "signup": "ViewReviews"}
FIRST_MESSAGE_MS = 1_704_067_200_000
MESSAGE_STEP_MS = 600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def garment_payload() -> Column:
    return F.struct(
        F.col("event_id").alias("ID"),
        F.col("props").alias("GARMENT_NAME"),
        hours.epoch_ms(F.col("ts")).alias("SALES_DATE"),
        F.col("value").alias("ORDER_VALUE"),
    )


def click_payload() -> Column:
    category = F.create_map(*(F.lit(x) for pair in CATEGORIES.items() for x in pair))
    click = F.struct(
        hours.epoch_ms(F.col("ts")).alias("timestamp"),
        F.lit("event").alias("hitType"),
        category[F.col("event_type")].alias("eventCategory"),
        F.lit("enter").alias("eventAction"),
        F.col("props").alias("eventLabel"),
    )
    return F.to_json(click)


def message_payload() -> Column:
    stamp = F.lit(FIRST_MESSAGE_MS) + F.col("doc_id") * MESSAGE_STEP_MS
    return F.concat(stamp.cast("string"), F.lit(","), F.col("text"))


def garment_records(events: DataFrame) -> DataFrame:
    sold = events.where(F.col("event_type") == "purchase")
    return envelope.to_records(
        sold, feeds.GARMENT_SALES.topic, F.col("event_id"), envelope.envelope(garment_payload())
    )


def broken_records(events: DataFrame) -> DataFrame:
    """Sales whose JSON stops short of its last two characters."""
    failed = events.where(F.col("event_type") == "error")
    whole = envelope.envelope(garment_payload())
    return envelope.to_records(
        failed, feeds.GARMENT_SALES.topic, F.col("event_id"), F.substring(whole, F.lit(1), F.length(whole) - 2)
    )


def book_records(orders: DataFrame) -> DataFrame:
    payload = F.struct(
        F.col("o_orderkey").alias("ID"),
        hours.epoch_ms(F.col("o_orderdate")).alias("SALES_DATE"),
        F.col("o_totalprice").alias("ORDER_AMOUNT"),
    )
    return envelope.to_records(
        orders, feeds.BOOK_SALES.topic, F.col("o_orderkey"), envelope.envelope(payload)
    )


def click_records(events: DataFrame) -> DataFrame:
    clicks = events.where(F.col("event_type").isin(*CATEGORIES))
    return envelope.to_records(
        clicks, feeds.WEB_CLICKS.topic, F.col("event_id"), envelope.envelope(click_payload())
    )


def tweet_records(documents: DataFrame) -> DataFrame:
    return envelope.to_records(
        documents, feeds.TWEETS.topic, F.col("doc_id"), envelope.envelope(message_payload())
    )


def event_records(events: DataFrame) -> DataFrame:
    """Sales, broken sales and clicks from one scan of the events."""
    kind = F.col("event_type")
    sale = envelope.envelope(garment_payload())
    value = (
        F.when(kind.isin(*CATEGORIES), envelope.envelope(click_payload()))
        .when(kind == "purchase", sale)
        .otherwise(F.substring(sale, F.lit(1), F.length(sale) - 2))
    )
    topic = F.when(kind.isin(*CATEGORIES), feeds.WEB_CLICKS.topic).otherwise(feeds.GARMENT_SALES.topic)
    return envelope.to_records(events, topic, F.col("event_id"), value)


def merged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All feeds as one, as a subscription to all topics delivers them."""
    return (
        event_records(table(spark, sf_dir, "events"))
        .unionByName(book_records(table(spark, sf_dir, "orders")))
        .unionByName(tweet_records(table(spark, sf_dir, "documents")))
    )
