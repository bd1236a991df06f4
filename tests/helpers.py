from __future__ import annotations

import json

from pyspark.sql import functions as F

from hourtally import schemas
from hourtally.operators import envelope


def records(spark, values, topic):
    """Records of one topic from text values, or of several from (topic, value) pairs."""
    pairs = [(topic, v) for v in values] if topic else list(values)
    rows = spark.createDataFrame(pairs, "topic string, text string")
    return envelope.to_records(rows, F.col("topic"), F.lit("k"), F.col("text"))


def sale(ms, value, **more):
    return json.dumps({"payload": {"SALES_DATE": ms, "ORDER_VALUE": value, **more}})


def book(ms, value):
    return json.dumps({"payload": {"SALES_DATE": ms, "ORDER_AMOUNT": value}})


def click(ms, category, **more):
    return json.dumps({"payload": json.dumps({"timestamp": ms, "eventCategory": category, **more})})


def tweet(text):
    return json.dumps({"payload": text})


def as_dicts(frame, key="report_date"):
    return {row[key]: row.asDict() for row in frame.collect()}


def record_columns(frame):
    return frame.columns == schemas.RECORD.fieldNames()
