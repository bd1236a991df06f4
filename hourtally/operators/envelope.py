"""Records and their JSON envelopes ``{"payload": ...}``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourtally import schemas
from hourtally.functions import hours, variants


def envelope(payload: Column) -> Column:
    """Wrap a payload (struct or text) as envelope text; NULL fields become JSON null."""
    return F.to_json(F.struct(payload.alias("payload")), {"ignoreNullFields": "false"})


def to_records(frame: DataFrame, topic: Column | str, key: Column, value: Column) -> DataFrame:
    """Give any frame the shape of a topic: one record per row.

    Partition and offset are given by a broker, or by the reader of a file-backed topic; here they are NULL.
    """
    columns = {
        "key": key.cast("string").cast("binary"),
        "value": value.cast("binary"),
        "topic": F.lit(topic) if isinstance(topic, str) else topic,
        "partition": F.lit(None).cast("int"),
        "offset": F.lit(None).cast("bigint"),
        "timestamp": F.current_timestamp(),
    }
    return frame.select(*(columns[name].alias(name) for name in schemas.RECORD.fieldNames()))


def table_payload(frame: DataFrame) -> Column:
    """All columns of a table as one payload; times travel as epoch milliseconds."""
    times = (T.TimestampType, T.TimestampNTZType)
    return F.struct(
        *(
            (hours.epoch_ms(F.col(f.name)) if isinstance(f.dataType, times) else F.col(f.name)).alias(f.name)
            for f in frame.schema.fields
        )
    )


def table_records(frame: DataFrame, topic: str, key: str) -> DataFrame:
    """Table rows as the records of a topic, as an incremental table reader publishes them."""
    return to_records(frame, topic, F.col(key), envelope(table_payload(frame)))


def line_records(lines: DataFrame, topic: str) -> DataFrame:
    """Text lines as records: the whole line is the payload."""
    return to_records(lines, topic, F.lit(None), envelope(F.col("value")))


def value_text(column: Column | None = None) -> Column:
    """The value of a record as text."""
    return (F.col("value") if column is None else column).cast("string")


def only_topics(records: DataFrame, topics: Sequence[str]) -> DataFrame:
    """Keep the records of the named topics of a merged feed."""
    return records.where(F.col("topic").isin(*topics))


def payload_of(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The whole payload of each envelope as columns, for payloads of known shape.

    A record that cannot be read gives a row of NULLs.
    """
    wrapped = T.StructType([T.StructField("payload", schema)])
    return records.select(F.from_json(value_text(), wrapped).alias("entry")).select("entry.payload.*")


def inner_document(document: Column) -> Column:
    """Parse a payload that is JSON held in a JSON string.

    A payload that is already an object is not text, so it is not read.
    """
    is_object = variants.is_present(document, "$.payload.timestamp")
    return F.when(~is_object, variants.parse_json(F.try_variant_get(document, "$.payload", "string")))


def parsed(records: DataFrame) -> DataFrame:
    """Records with their documents (``schemas.PARSED_RECORD``), for topics that keep them parsed.

    The value stays, for records that cannot be used.
    """
    with_document = records.select(*schemas.RECORD.fieldNames(), variants.parse_json(value_text()).alias("doc"))
    return with_document.withColumn("inner", inner_document(F.col("doc")))
