"""From records to readings: what each record adds to the summary, or why nothing.

A merged feed of several topics is read in one pass. Each record is parsed once;
a CASE on its topic picks the fields. No record is lost on the way: one that
cannot be read keeps its raw value and gets a ``problem`` instead of measures.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourtally import schemas
from hourtally.functions import hours, text, variants
from hourtally.operators import envelope
from hourtally.operators.feeds import JSON_TEXT, OBJECT, STAMPED_TEXT, Feed

NOT_READABLE = "payload not readable"
NO_TIME = "event time missing"
TIME_RANGE = "event time out of range"
NO_FIELD = "field missing"


def _parts(feed: Feed, document: Column) -> dict[str, Column]:
    """Event time, converted amount and category or text of one kind of payload."""
    if feed.payload == OBJECT:
        parts = {"ms": variants.lenient_long(document, f"$.payload.{feed.time_field}")}
        root = "$.payload"
    elif feed.payload == JSON_TEXT:
        document = F.col("inner")
        parts = {"ms": variants.lenient_long(document, f"$.{feed.time_field}")}
        root = "$"
    elif feed.payload == STAMPED_TEXT:
        payload = F.try_variant_get(document, "$.payload", "string")
        return {"ms": text.stamp(payload), "text": text.after_stamp(payload)}
    else:
        raise ValueError(f"unknown kind of payload: {feed.payload}")
    if feed.amount_field:
        amount = variants.lenient_double(document, f"{root}.{feed.amount_field}")
        parts["amount"] = amount if feed.rate == 1.0 else amount * F.lit(feed.rate)
    if feed.match_field:
        parts["category"] = variants.lenient_text(document, f"{root}.{feed.match_field}")
    return parts


_PART_TYPES = {"ms": "bigint", "amount": "double", "category": "string", "text": "string"}


def _parse(records: DataFrame, feeds: Sequence[Feed]) -> DataFrame:
    """Add ``doc`` (the parsed record) and ``part`` (the fields its feed names).

    Records of a topic that keeps them parsed are not parsed again.
    """
    known = "doc" in records.columns
    document = F.col("doc") if known else variants.parse_json(envelope.value_text())
    more = ["inner"] if known else []
    parsed = records.select("topic", "value", document.alias("doc"), *more)
    nested = [feed.topic for feed in feeds if feed.payload == JSON_TEXT]
    if nested and not known:
        inner = envelope.inner_document(F.col("doc"))
        parsed = parsed.withColumn("inner", F.when(F.col("topic").isin(*nested), inner))

    def fields(feed: Feed) -> Column:
        parts = _parts(feed, F.col("doc"))
        return F.struct(
            *(parts.get(n, F.lit(None)).cast(t).alias(n) for n, t in _PART_TYPES.items())
        )

    return parsed.withColumn("part", _by_topic(feeds, fields))


def _by_topic(feeds: Sequence[Feed], value) -> Column:
    """A value that depends on the feed a record belongs to."""
    first, *rest = feeds
    case = F.when(F.col("topic") == first.topic, value(first))
    for feed in rest:
        case = case.when(F.col("topic") == feed.topic, value(feed))
    return case


def _any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def read_feeds(records: DataFrame, feeds: Sequence[Feed]) -> DataFrame:
    """One reading per record of the given feeds.

    Columns: topic, value (raw), ms, amount (converted), category, text, problem.
    ``problem`` is NULL for a record that can be used.
    """
    part = F.col("part")
    priced = [f.topic for f in feeds if f.amount_field]
    matched = [f.topic for f in feeds if f.match_field]
    needs_amount = F.col("topic").isin(*priced) if priced else F.lit(False)
    needs_category = F.col("topic").isin(*matched) if matched else F.lit(False)
    problem = (
        F.when(F.col("doc").isNull(), NOT_READABLE)
        .when(part.ms.isNull(), NO_TIME)
        .when(~hours.in_range(part.ms), TIME_RANGE)
        .when(needs_amount & part.amount.isNull(), NO_FIELD)
        .when(needs_category & part.category.isNull(), NO_FIELD)
    )
    wanted = envelope.only_topics(records, [f.topic for f in feeds])
    return _parse(wanted, feeds).select("topic", "value", "part.*", problem.alias("problem"))


def contributions(readings: DataFrame, feeds: Sequence[Feed], *keep: str) -> DataFrame:
    """What each reading adds to its hour: ``hour`` (a number) and one column per measure.

    A reading with a problem has NULL throughout, so sums pass over it.
    """
    usable = F.col("problem").isNull()
    by_measure: dict[str, Column] = {}
    for feed in feeds:
        mine = usable & (F.col("topic") == feed.topic)
        if feed.amount_field:
            exact, rest = split_amount(F.col("amount"))
            _add(by_measure, feed.adds_to, mine, exact)
            _add(by_measure, schemas.SALES_REST, mine, rest)
            continue
        counted = mine
        if feed.match_field:
            counted = counted & (F.col("category") == feed.match_value)
        _add(by_measure, feed.adds_to, counted, F.lit(1))
        if feed.matches_to:
            positive = mine & text.contains_any(F.col("text"), feed.keywords)
            _add(by_measure, feed.matches_to, positive, F.lit(1))
    return readings.select(
        *keep,
        F.when(usable, hours.hour_number(hours.event_time(F.col("ms")))).alias("hour"),
        *(by_measure[name].alias(name) for name in schemas.ADDED if name in by_measure),
    )


def split_amount(amount: Column) -> tuple[Column, Column]:
    """An amount as a decimal and, as a double, what the decimal cannot hold of it."""
    fits = F.abs(amount) < schemas.DECIMAL_LIMIT
    exact = F.when(fits, amount).otherwise(F.lit(0.0)).cast(schemas.AMOUNT)
    left = amount - exact.cast("double")
    counts = F.abs(left) > F.abs(amount) * schemas.LEAST_SHARE_LEFT
    return exact, F.when(~fits, amount).when(counts, left).otherwise(F.lit(0.0))


def _add(by_measure: dict[str, Column], name: str, condition: Column, value: Column) -> None:
    # Topics are disjoint, so feeds that share a measure extend one CASE.
    known = by_measure.get(name)
    by_measure[name] = F.when(condition, value) if known is None else known.when(condition, value)


def computed_once(frame: DataFrame) -> DataFrame:
    """The same rows, with every column worked out before any filter behind this point.

    Spark moves a filter below the columns it tests and repeats their expressions in
    it, once per mention; on parsed columns that means parsing a record several times. It
    does not move filters below a row generator, so the rows pass through one.
    """
    return frame.select(F.inline_outer(F.array(F.struct(*frame.columns))))


def dead_letters(readings: DataFrame) -> DataFrame:
    """Records that could not be used, unchanged, with the reason."""
    return computed_once(readings.select("topic", "value", "problem")).where(F.col("problem").isNotNull())
