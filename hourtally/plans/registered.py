"""The queries registered for checking, each over whole tables.

Every query is ``(spark, sf_dir) -> DataFrame``. Feeds go through their envelopes:
tables are serialised to records, then parsed again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourtally import schemas, session
from hourtally.functions import hours, text, variants
from hourtally.operators import envelope, feeds, readings, rollup, summary
from hourtally.plans import embedded, report, stand_ins
from hourtally.sinks import database as database_sink
from hourtally.sinks import ledger, preview
from hourtally.sources import lines, literals, polling, tables, topics
from hourtally.streaming import jobs, state

# Syllables that occur in the documents, for a keyword list other than
# the default one.
OTHER_WORDS = ("heon", "blees")

# A year of 365 days; by such steps the times of wide_amounts are shifted.
YEAR_MS = 31_536_000_000

# An amount with more digits than the decimals hold; wide_amounts adds it to some.
LONG_AMOUNT = 123456789.0000004

# Micro-batches of a registered stream.
BATCHES = 5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return stand_ins.table(spark, sf_dir, name)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def _key(kind: str = "bigint"):
    return F.col("key").cast("string").cast(kind)


# -- records, envelopes, fields ------------------------------------------------------


def record_value(spark, sf_dir):
    events = _events(spark, sf_dir)
    records = envelope.to_records(events, feeds.WEB_CLICKS.topic, F.col("event_id"), F.col("props"))
    return records.select(_key().alias("event_id"), envelope.value_text().alias("value"))


def topic_filter(spark, sf_dir):
    merged = stand_ins.merged_records(spark, sf_dir)
    wanted = [feeds.GARMENT_SALES.topic, feeds.BOOK_SALES.topic]
    return envelope.only_topics(merged, wanted).groupBy("topic").agg(F.count("*").alias("n"))


def topic_pruning(spark, sf_dir):
    """Two topics of a file-backed one that keeps each in a folder of its own: the others are not opened."""
    path = f"{session.scratch(spark, 'by-topic')}/topic"
    topics.write_topic(stand_ins.merged_records(spark, sf_dir), path, topics.BY_TOPIC)
    wanted = [feeds.GARMENT_SALES.topic, feeds.WEB_CLICKS.topic]
    return topics.read_topic(spark, path, wanted).groupBy("topic").agg(F.count("*").alias("n"))


def topic_offsets(spark, sf_dir):
    """Records by topic of a file-backed one appended to twice: how many, and how many places they have,
    in a batch read and in a stream."""
    work = session.scratch(spark, "offsets")
    records = stand_ins.merged_records(spark, sf_dir)
    for part in (0, 1):
        half = F.pmod(F.xxhash64("topic", "key"), F.lit(2)) == part
        topics.write_topic(records.where(half), f"{work}/topic")
    stream = topics.stream_topic(spark, f"{work}/topic", maxFilesPerTrigger="2").select("topic", "partition", "offset")
    place = stream.writeStream.format("parquet").option("checkpointLocation", f"{work}/checkpoint")
    place.trigger(**jobs.trigger(None)).start(f"{work}/out").awaitTermination()
    batch = topics.read_topic(spark, f"{work}/topic").select("topic", "partition", "offset")
    streamed = spark.read.schema(batch.schema).parquet(f"{work}/out")
    both = batch.unionByName(streamed).groupBy("topic", "partition", "offset").agg(F.count("*").alias("times"))
    return both.groupBy("topic").agg(F.count("*").alias("places"), F.sum("times").alias("records"))


def report_from_parsed_topic(spark, sf_dir):
    """The hourly report from a topic whose records were parsed when they were published."""
    path = f"{session.scratch(spark, 'parsed')}/topic"
    topics.write_topic(stand_ins.merged_records(spark, sf_dir), path, parsed=True)
    return report.hourly_report(topics.read_topic(spark, path, parsed=True))


def envelope_payload(spark, sf_dir):
    records = stand_ins.garment_records(_events(spark, sf_dir))
    wire = T.StructType.fromDDL("ID bigint, GARMENT_NAME string, SALES_DATE bigint, ORDER_VALUE double")
    sales = envelope.payload_of(records, wire)
    return sales.select(
        F.col("ID").alias("id"),
        F.col("GARMENT_NAME").alias("garment_name"),
        F.col("SALES_DATE").alias("sales_date"),
        F.col("ORDER_VALUE").alias("order_value"),
    )


def nested_payload(spark, sf_dir):
    records = stand_ins.click_records(_events(spark, sf_dir))
    outer = records.select("key", variants.parse_json(envelope.value_text()).alias("doc"))
    inner = outer.select("key", envelope.inner_document(F.col("doc")).alias("click"))
    return inner.select(
        _key().alias("event_id"),
        variants.lenient_long(F.col("click"), "$.timestamp").alias("ts_ms"),
        variants.lenient_text(F.col("click"), "$.eventCategory").alias("category"),
    )


def tweet_slice(spark, sf_dir):
    records = stand_ins.tweet_records(_table(spark, sf_dir, "documents"))
    doc = variants.parse_json(envelope.value_text())
    payload = records.select("key", F.try_variant_get(doc, "$.payload", "string").alias("payload"))
    return payload.select(
        _key().alias("doc_id"),
        text.stamp(F.col("payload")).alias("ts_ms"),
        text.after_stamp(F.col("payload")).alias("tweet"),
    )


def lenient_numbers(spark, sf_dir):
    """The same number written five ways, one per kind of event; absent ones show as -1."""
    value = F.col("value")
    kind = F.col("event_type")
    as_number = F.to_json(F.struct(value.alias("X")))
    as_text = F.to_json(F.struct(value.cast("string").alias("X")))
    payload = (
        F.when(kind == "purchase", as_number)
        .when(kind == "signup", as_text)
        .when(kind == "view", F.lit('{"X":null}'))
        .when(kind == "click", F.lit('{"X":"n/a"}'))
        .otherwise(F.lit("{}"))
    )
    raw = F.concat(F.lit('{"payload":'), payload, F.lit("} and more"))
    records = envelope.to_records(_events(spark, sf_dir), "numbers", F.col("event_id"), raw)
    read = records.select(_key().alias("event_id"), variants.parse_json(envelope.value_text()).alias("doc"))
    path = "$.payload.X"
    return read.select(
        "event_id",
        variants.is_present(F.col("doc"), path).alias("present"),
        F.coalesce(variants.lenient_double(F.col("doc"), path), F.lit(-1.0)).alias("as_double"),
        F.coalesce(variants.lenient_long(F.col("doc"), path), F.lit(-1)).alias("as_long"),
    )


def epoch_to_timestamp(spark, sf_dir):
    time = hours.event_time(hours.epoch_ms(F.col("ts")))
    shown = F.date_format(time, "yyyy-MM-dd HH:mm:ss")
    return _events(spark, sf_dir).select("event_id", shown.alias("t"))


def hour_bucket(spark, sf_dir):
    time = hours.event_time(hours.epoch_ms(F.col("ts")))
    return _events(spark, sf_dir).select(
        "event_id",
        hours.hour_bucket(time).alias("hour"),
        hours.hour_label(hours.hour_number(time)).alias("hour_by_number"),
    )


def currency_convert(spark, sf_dir):
    records = stand_ins.book_records(_table(spark, sf_dir, "orders"))
    parsed = records.select("key", variants.parse_json(envelope.value_text()).alias("doc"))
    amount = variants.lenient_double(F.col("doc"), "$.payload.ORDER_AMOUNT")
    return parsed.select(_key().alias("id"), (amount * F.lit(feeds.BOOK_SALES.rate)).alias("amount"))


def constant_column(spark, sf_dir):
    return summary.constant_column(_table(spark, sf_dir, "orders"), "sales", 0.0).select("o_orderkey", "sales")


# -- predicates and dead letters -----------------------------------------------------


def first_page_filter(spark, sf_dir):
    clicks = readings.computed_once(nested_payload(spark, sf_dir))
    return clicks.where(F.col("category") == feeds.WEB_CLICKS.match_value).select("event_id")


def keyword_filter(spark, sf_dir):
    tweets = readings.computed_once(tweet_slice(spark, sf_dir))
    return tweets.where(text.contains_any(F.col("tweet"))).select("doc_id")


def keyword_filter_custom(spark, sf_dir):
    tweets = readings.computed_once(tweet_slice(spark, sf_dir))
    return tweets.where(text.contains_any(F.col("tweet"), OTHER_WORDS)).select("doc_id")


def dead_letter(spark, sf_dir):
    """Sound and broken sales: what became of each, with its raw value kept."""
    events = _events(spark, sf_dir)
    records = stand_ins.garment_records(events).unionByName(stand_ins.broken_records(events))
    read = readings.read_feeds(records, [feeds.GARMENT_SALES])
    return read.select("topic", "problem", envelope.value_text().alias("raw"))


# -- hourly totals ---------------------------------------------------------------------


def _hourly(records: DataFrame, feed: feeds.Feed, *measures: str) -> DataFrame:
    totals = report.hourly_report(records, [feed])
    return totals.select(F.col("report_date").alias("hour"), *measures)


def hourly_us_sales(spark, sf_dir):
    return _hourly(stand_ins.garment_records(_events(spark, sf_dir)), feeds.GARMENT_SALES, "sales")


def hourly_eu_sales(spark, sf_dir):
    return _hourly(stand_ins.book_records(_table(spark, sf_dir, "orders")), feeds.BOOK_SALES, "sales")


def hourly_web_hits(spark, sf_dir):
    return _hourly(stand_ins.click_records(_events(spark, sf_dir)), feeds.WEB_CLICKS, "web_hits")


def hourly_tweets(spark, sf_dir):
    records = stand_ins.tweet_records(_table(spark, sf_dir, "documents"))
    return _hourly(records, feeds.TWEETS, "tweets", "tweets_positive")


def hourly_tweets_custom(spark, sf_dir):
    records = stand_ins.tweet_records(_table(spark, sf_dir, "documents"))
    return _hourly(records, feeds.TWEETS.but(keywords=OTHER_WORDS), "tweets", "tweets_positive")


def exec_summary_hourly(spark, sf_dir):
    return report.hourly_report(stand_ins.merged_records(spark, sf_dir))


def report_with_letters(spark, sf_dir):
    """The report of all feeds written as a table, with what it leaves out beside it: rows of both."""
    work = session.scratch(spark, "report")
    report.write_report(stand_ins.merged_records(spark, sf_dir), f"{work}/hours", f"{work}/letters")
    hours_ = spark.read.parquet(f"{work}/hours").select("report_date", *schemas.MEASURES, F.lit(None).cast("string").alias("raw"))
    letters = spark.read.parquet(f"{work}/letters").select(envelope.value_text().alias("raw"))
    return hours_.unionByName(letters, allowMissingColumns=True)


def grand_total(spark, sf_dir):
    records = stand_ins.merged_records(spark, sf_dir)
    return rollup.shown(report.overall(records, [feeds.GARMENT_SALES, feeds.BOOK_SALES])).select("sales")


def hour_value_map(spark, sf_dir):
    """Each sale as a map of one entry, added up by key, shown as maps, and unpacked."""
    selling = [feeds.GARMENT_SALES]
    events = _events(spark, sf_dir)
    records = stand_ins.garment_records(events).unionByName(stand_ins.broken_records(events))
    read = readings.read_feeds(records, selling)
    added = readings.contributions(read, selling)
    parts = ("sales", schemas.SALES_REST)
    entries = added.select(rollup.hour_entry(F.col("hour"), F.struct(*parts)).alias("entry"))
    summed = rollup.add_entries(entries, "entry", *parts)
    labelled = summed.select(hours.hour_label(F.col("hour")).alias("report_date"), *parts)
    maps = rollup.hour_value_maps(rollup.shown(labelled), "sales")
    return maps.select(F.explode("hour_values").alias("hour", "sales"))


def running_total(spark, sf_dir):
    """Every row of a table gets the overall totals added."""
    base = _table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"))
    totals = report.overall(stand_ins.merged_records(spark, sf_dir))
    return summary.update_every_row(summary.with_defaults(base), totals)


# -- tables ----------------------------------------------------------------------------


def incremental_scan(spark, sf_dir):
    """Two polls: everything up to half of the largest key, then what is new since."""
    path = f"{sf_dir}/events.parquet"
    middle = tables.newest_key(spark, path, "event_id") // 2
    events = _events(spark, sf_dir).select("event_id", "value")
    first = tables.poll(events.where(F.col("event_id") <= middle), "event_id")
    second = tables.poll_files(spark, path, "event_id", first.mark)
    fresh = second.rows.select("event_id", "value", F.lit(2).alias("poll"))
    return first.rows.withColumn("poll", F.lit(1)).unionByName(fresh)


def table_list_scan(spark, sf_dir):
    keys = {"nation": "n_nationkey", "region": "r_regionkey", "customer": "c_custkey", "orders": "o_orderkey"}
    feed = tables.tables_to_topics(keys, lambda name: _table(spark, sf_dir, name), feeds.TOPIC_PREFIX)
    parsed = feed.select("topic", "key", variants.parse_json(envelope.value_text()).alias("doc"))
    in_payload = F.lit(None).cast("bigint")
    for name, field in keys.items():
        mine = F.col("topic") == feeds.TOPIC_PREFIX + name
        in_payload = F.when(mine, F.try_variant_get("doc", f"$.payload.{field}", "bigint")).otherwise(in_payload)
    rows = parsed.select("topic", _key().alias("key"), in_payload.alias("in_payload"))
    return rows.groupBy("topic").agg(
        F.count("*").alias("n"),
        F.sum("key").cast("bigint").alias("keys"),
        F.sum("in_payload").cast("bigint").alias("keys_in_payload"),
    )


def jdbc_read(spark, sf_dir):
    database = embedded.database(spark)
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    database_sink.overwrite(customers, database, "HT_CUSTOMER")
    return tables.read_table_by_key(spark, database, "HT_CUSTOMER", "c_custkey", partitions=4)


def jdbc_overwrite(spark, sf_dir):
    """Load a table, set a column, and write it over itself."""
    database = embedded.database(spark)
    suppliers = _table(spark, sf_dir, "supplier").select("s_suppkey", F.lit(1.0).alias("sales"))
    database_sink.overwrite(suppliers, database, "HT_SUPPLIER")
    loaded = tables.read_table_by_key(spark, database, "HT_SUPPLIER", "s_suppkey", partitions=4)
    changed = summary.constant_column(loaded, "sales", 9.0)
    database_sink.overwrite(changed, database, "HT_SUPPLIER", keep_definition=True)
    return tables.read_table_by_key(spark, database, "HT_SUPPLIER", "s_suppkey", partitions=4)


SUMMARY_COLUMNS = (
    "SALES DOUBLE PRECISION DEFAULT 0 NOT NULL, WEB_HITS INT DEFAULT 0 NOT NULL, TWEETS INT DEFAULT 0 NOT NULL, "
    "TWEETS_POSITIVE INT DEFAULT 0 NOT NULL"
)


def _new_summary(spark, database, key: str) -> str:
    """A summary table of a name not used before, with a key column of its own."""
    name = f"HT_SUMMARY_{uuid.uuid4().hex[:12].upper()}"
    database_sink.execute(spark, database, f"CREATE TABLE {name} ({key}, {SUMMARY_COLUMNS})")
    return name


def _with_customers(spark, sf_dir, database) -> str:
    """A summary table with a row for every customer, all measures 0."""
    name = _new_summary(spark, database, "ID INT NOT NULL PRIMARY KEY")
    rows = _table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("ID"))
    kinds = {"SALES": "double", "WEB_HITS": "int", "TWEETS": "int", "TWEETS_POSITIVE": "int"}
    zero = rows.select("ID", *(F.lit(0).cast(kind).alias(column) for column, kind in kinds.items()))
    database_sink.append(zero, database, name)
    return name


def _stored_summary(spark, database, name: str, key: str) -> DataFrame:
    """A summary table as it is, in lower case; sums of doubles are shown to the last digit of the amounts."""
    stored = tables.read_table_by_key(spark, database, name, "ID", partitions=4) if key == "ID" else tables.read_table(spark, database, name)
    rows = stored.select(*(F.col(c).alias(c.lower()) for c in stored.columns))
    return rows.withColumn("sales", F.round("sales", 3))


def update_all_in_database(spark, sf_dir):
    """Every row of a summary table in the database gets the overall totals of a ledger added.

    The totals are published twice before and twice after the second batch.
    """
    database = embedded.database(spark)
    work = session.scratch(spark, "all")
    name = _with_customers(spark, sf_dir, database)
    deltas = session.cut_lineage(report.hourly_deltas(stand_ins.merged_records(spark, sf_dir)))
    early = F.col("report_date") < "2024-02-01"
    for number, rows in enumerate((deltas.where(early), deltas.where(~early))):
        ledger.record(rows, f"{work}/ledger", number)
        for _ in range(2):
            report.add_to_every_row(spark, database, name, [f"{work}/ledger"])
    return _stored_summary(spark, database, name, "ID")


def _published(spark, sf_dir, name: str, scope: str, database) -> None:
    """All feeds streamed into a ledger and, batch by batch, into a summary table.

    The job dies once after the second batch is in the table but before Spark knows, so that batch is
    run again; the last one is added again at the end.
    """
    work = session.scratch(spark, "published")
    rows, files = _dealt(stand_ins.merged_records(spark, sf_dir))
    topics.write_topic(rows, f"{work}/topic")
    names = [f.topic for f in feeds.ALL_FEEDS]
    place = (f"{work}/ledger", f"{work}/checkpoint", f"{work}/dead")

    def records():
        return topics.stream_topic(spark, f"{work}/topic", names, maxFilesPerTrigger=files)

    def start():
        return report.start_publishing_job(records(), feeds.ALL_FEEDS, *place, database, name, scope, interval=None)

    start().awaitTermination()
    for number in (1, BATCHES - 1):
        # As if the commits from here on had been lost.
        for later in range(number, BATCHES):
            session.delete(spark, f"{work}/checkpoint/commits/{later}")
            session.delete(spark, f"{work}/checkpoint/commits/.{later}.crc")
        for later in range(number + 1, BATCHES):
            session.delete(spark, f"{work}/checkpoint/offsets/{later}")
            session.delete(spark, f"{work}/checkpoint/offsets/.{later}.crc")
        start().awaitTermination()


def stream_to_every_row(spark, sf_dir):
    """Batches of a stream added to every row of a summary table, each once."""
    database = embedded.database(spark)
    name = _with_customers(spark, sf_dir, database)
    _published(spark, sf_dir, name, database_sink.EVERY_ROW, database)
    return _stored_summary(spark, database, name, "ID")


def stream_upsert_in_database(spark, sf_dir):
    """Batches of a stream added to the rows of their hours in a summary table, each once.

    An hour that no batch has stays as it was.
    """
    database = embedded.database(spark)
    name = _new_summary(spark, database, "REPORT_DATE TIMESTAMP NOT NULL UNIQUE")
    database_sink.execute(spark, database, f"INSERT INTO {name} VALUES ('1999-12-31 23:00:00', 5, 6, 7, 8)")
    _published(spark, sf_dir, name, database_sink.BY_HOUR, database)
    rows = _stored_summary(spark, database, name, "REPORT_DATE")
    shown = F.date_format("report_date", "yyyy-MM-dd HH:mm:ss").alias("report_date")
    counters = (F.col(name).cast("bigint").alias(name) for name in schemas.COUNTERS)
    return rows.select(shown, "sales", *counters)


def jdbc_incremental(spark, sf_dir):
    """Poll a table, let it grow, poll again from the mark of the first poll."""
    database = embedded.database(spark)
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    middle = tables.poll(orders, "o_orderkey").mark // 2
    database_sink.overwrite(orders.where(F.col("o_orderkey") <= middle), database, "HT_ORDERS")
    first = tables.poll_table(spark, database, "HT_ORDERS", "o_orderkey", partitions=4)
    seen = session.cut_lineage(first.rows.withColumn("poll", F.lit(1)))
    database_sink.append(orders.where(F.col("o_orderkey") > middle), database, "HT_ORDERS")
    second = tables.poll_table(spark, database, "HT_ORDERS", "o_orderkey", first.mark, partitions=4)
    return seen.unionByName(second.rows.withColumn("poll", F.lit(2)))


def preview_first_rows(spark, sf_dir):
    events = _events(spark, sf_dir).select("event_id", "props")
    return preview.preview(events, "event_id")


def seed_defaults(spark, sf_dir):
    rows = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return summary.with_defaults(rows)


def unique_key_check(spark, sf_dir):
    return summary.repeated_keys(_table(spark, sf_dir, "orders"), "o_custkey")


def null_check(spark, sf_dir):
    return summary.null_counts(exec_summary_hourly(spark, sf_dir), ["report_date", *schemas.MEASURES])


def literal_append(spark, sf_dir):
    """Rows of a given table, the literal rows put in after them, and read back."""
    place = session.scratch(spark, "seeded")
    rows = _table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("value"))
    rows.write.parquet(place)
    seed = literals.garment_seed(spark).select(F.col("GARMENT_NAME").alias("name"), F.col("ORDER_VALUE").alias("value"))
    seed.write.mode("append").parquet(place)
    return spark.read.schema(rows.schema).parquet(place)


def current_hour_check(spark, sf_dir):
    """The label of the current hour, set on every row, lies within an hour of now."""
    rows = summary.constant_column(_table(spark, sf_dir, "customer"), "report_date", summary.current_hour())
    passed = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(F.to_timestamp("report_date"))
    return rows.select("c_custkey", ((passed >= 0) & (passed < 3600)).alias("is_current"))


def first_row(spark, sf_dir):
    return preview.first_row(_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")


def empty_delta(spark, sf_dir):
    """By kind of event: do such events, taken as a batch of sales, add anything?"""
    work = session.scratch(spark, "empty")
    events = _events(spark, sf_dir)
    batches = {0: events.where(F.lit(False)), 1: events}
    for number, batch in batches.items():
        deltas = report.hourly_deltas(stand_ins.garment_records(batch), [feeds.GARMENT_SALES])
        ledger.record(deltas, f"{work}/ledger", number)
    kept = spark.read.parquet(f"{work}/ledger/deltas")
    return kept.groupBy(F.col("batch_id").cast("bigint").alias("batch_id")).agg(F.countDistinct("report_date").alias("hours"))


def null_count(spark, sf_dir):
    """NULLs are counted where there are some: values of events that are no purchases are made NULL."""
    bought = F.col("event_type") == "purchase"
    rows = _events(spark, sf_dir).select("event_id", F.when(bought, F.col("value")).alias("value"))
    return summary.null_counts(rows, ["event_id", "value"])


# -- streams ---------------------------------------------------------------------------


def _dealt(rows: DataFrame) -> tuple[DataFrame, str]:
    """Rows dealt out to the files of a stream, and how many of these make a micro-batch.

    There are more files the more parts the rows are read in, so no task writes more of a larger table.
    """
    files = -(-rows.rdd.getNumPartitions() // BATCHES)
    return rows.repartition(files * BATCHES), str(files)


def _stream(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """Rows published as files, streamed in a few micro-batches."""
    dealt, files = _dealt(rows)
    dealt.write.option("parquet.block.size", str(topics.ROW_GROUP)).parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def text_stream(spark, sf_dir):
    """Text lines, streamed from the files of a folder."""
    work = session.scratch(spark, "lines")
    _events(spark, sf_dir).select("props").write.text(f"{work}/in")
    stream = lines.stream_lines(spark, f"{work}/in")
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(**jobs.trigger(None))
        .start(f"{work}/out")
    )
    query.awaitTermination()
    return spark.read.schema("value string").parquet(f"{work}/out")


def stream_hourly_sales(spark, sf_dir):
    """Sales streamed into a ledger, with a stop half-way: the job is started again for the
    files that came meanwhile."""
    work = session.scratch(spark, "sales")
    events = _events(spark, sf_dir)
    late = F.col("event_id") % 2 == 0
    published = stand_ins.garment_records(events.where(~late))
    records = _stream(spark, published, f"{work}/topic")
    place = (f"{work}/ledger", f"{work}/checkpoint", f"{work}/dead")
    jobs.start_feed_job(records, [feeds.GARMENT_SALES], *place, interval=None).awaitTermination()
    topics.write_topic(_dealt(stand_ins.garment_records(events.where(late)))[0], f"{work}/topic")
    jobs.start_feed_job(records, [feeds.GARMENT_SALES], *place, interval=None).awaitTermination()
    totals = rollup.shown(ledger.totals(spark, f"{work}/ledger"))
    return totals.select(F.col("report_date").alias("hour"), "sales")


def stream_topics(spark, sf_dir):
    """All feeds published to one file-backed topic, streamed in one job, dead letters aside."""
    work = session.scratch(spark, "topics")
    rows, files = _dealt(stand_ins.merged_records(spark, sf_dir))
    topics.write_topic(rows, f"{work}/topic")
    names = [f.topic for f in feeds.ALL_FEEDS]
    records = topics.stream_topic(spark, f"{work}/topic", names, maxFilesPerTrigger=files)
    query = jobs.start_feed_job(
        records, feeds.ALL_FEEDS, f"{work}/ledger", f"{work}/checkpoint", f"{work}/dead", interval=None
    )
    query.awaitTermination()
    letters = spark.read.schema("topic string, value binary, problem string").parquet(f"{work}/dead")
    counts = letters.groupBy("problem").agg(F.count("*").alias("n"))
    totals = ledger.overall(spark, f"{work}/ledger")
    return rollup.shown(totals).withColumn("dead_letters", counts.agg(F.sum("n")).scalar())


def stream_dead_letters(spark, sf_dir):
    """All feeds streamed in one job: the records set aside, unchanged, with the reason."""
    work = session.scratch(spark, "letters")
    rows, files = _dealt(stand_ins.merged_records(spark, sf_dir))
    topics.write_topic(rows, f"{work}/topic")
    records = topics.stream_topic(spark, f"{work}/topic", [f.topic for f in feeds.ALL_FEEDS], maxFilesPerTrigger=files)
    place = (f"{work}/ledger", f"{work}/checkpoint", f"{work}/dead")
    jobs.start_feed_job(records, feeds.ALL_FEEDS, *place, interval=None).awaitTermination()
    letters = spark.read.schema("topic string, value binary, problem string").parquet(f"{work}/dead")
    return letters.select("topic", "problem", envelope.value_text().alias("raw"))


def stream_running_state(spark, sf_dir):
    """Sales streamed into Spark's state store; the last total of every hour."""
    work = session.scratch(spark, "state")
    records = _stream(spark, stand_ins.garment_records(_events(spark, sf_dir)), f"{work}/topic")
    place = (f"{work}/totals", f"{work}/checkpoint", f"{work}/dead")
    for query in state.start_state_jobs(records, [feeds.GARMENT_SALES], *place, interval=None):
        query.awaitTermination()
    totals = rollup.shown(state.latest_totals(spark, f"{work}/totals"))
    return totals.select(F.col("report_date").alias("hour"), "sales")


def stream_from_latest(spark, sf_dir):
    """Sales of the later half of the events: the earlier half was there at the first start.

    One file of the later half carries time stamps from before the start.
    """
    work = session.scratch(spark, "latest")
    events = _events(spark, sf_dir)
    sales = stand_ins.garment_records(events)
    number = F.get_json_object(F.col("value").cast("string"), "$.payload.ID").cast("bigint")
    middle = tables.poll(events, "event_id").mark // 2
    topics.write_topic(sales.where(number <= middle), f"{work}/topic")
    records = topics.stream_topic(spark, f"{work}/topic", maxFilesPerTrigger="1")
    place = (f"{work}/ledger", f"{work}/checkpoint", f"{work}/dead")
    selling = [feeds.GARMENT_SALES]
    jobs.start_feed_job(records, selling, *place, interval=None, from_latest=True).awaitTermination()
    later = sales.where(number > middle)
    topics.write_topic(later.where(number % 2 == 0), f"{work}/topic")
    early = later.where(number % 2 == 1).withColumn("timestamp", F.lit("2000-01-01").cast("timestamp"))
    topics.write_topic(early, f"{work}/topic")
    jobs.start_feed_job(records, selling, *place, interval=None, from_latest=True).awaitTermination()
    totals = rollup.shown(ledger.totals(spark, f"{work}/ledger"))
    return totals.select(F.col("report_date").alias("hour"), "sales")


def table_to_summary(spark, sf_dir):
    """From a growing table to hourly sales: two polls, the first done again as after a crash
    before its mark was moved, a topic, the feed job, and the totals."""
    work = session.scratch(spark, "chain")
    date = hours.epoch_ms(F.col("o_orderdate")).alias("SALES_DATE")
    amount = F.col("o_totalprice").alias("ORDER_AMOUNT")
    orders = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ID"), date, amount)
    middle = tables.poll(orders, "ID").mark // 2
    published = ("ID", "book_sales", feeds.TOPIC_PREFIX, f"{work}/topic")
    grown = orders.where(F.col("ID") <= middle)
    polling.publish_poll(spark, tables.poll(grown, "ID"), *published, f"{work}/marks")
    session.delete(spark, f"{work}/marks/done")
    for table in (grown, orders):
        mark = polling.last_mark(spark, f"{work}/marks")
        polling.publish_poll(spark, tables.poll(table, "ID", mark), *published, f"{work}/marks")
    records = topics.stream_topic(spark, f"{work}/topic", maxFilesPerTrigger="1")
    place = (f"{work}/ledger", f"{work}/checkpoint", f"{work}/dead")
    jobs.start_feed_job(records, [feeds.BOOK_SALES], *place, interval=None).awaitTermination()
    totals = rollup.shown(ledger.totals(spark, f"{work}/ledger"))
    return totals.select(F.col("report_date").alias("hour"), "sales")


def wide_amounts(spark, sf_dir):
    """All events as sales, with amounts far larger and smaller, and times far earlier and
    later, than usual, by kind of event."""
    kind = F.col("event_type")
    scale = F.when(kind == "purchase", 1e20).when(kind == "view", 1e-10).otherwise(1.0)
    years = F.when(kind == "click", -500).when(kind == "signup", 9000).otherwise(0)
    events = _events(spark, sf_dir)
    shift = years.cast("bigint") * F.lit(YEAR_MS)
    more = F.when(kind == "click", LONG_AMOUNT).otherwise(0.0)
    payload = F.struct(
        (hours.epoch_ms(F.col("ts")) + shift).alias("SALES_DATE"), (F.col("value") * scale + more).alias("ORDER_VALUE")
    )
    records = envelope.to_records(events, feeds.GARMENT_SALES.topic, F.col("event_id"), envelope.envelope(payload))
    deltas = report.hourly_deltas(records, [feeds.GARMENT_SALES])
    year = F.split("report_date", "(?<=.)-")[0].cast("int").alias("year")
    by_year = deltas.groupBy(year).agg(F.sum("sales").alias("sales"), F.sum(schemas.SALES_REST).alias("rest"))
    # Sums of doubles depend on their order in the last digits, so ten digits are compared.
    return by_year.select("year", F.col("sales").cast("double").alias("sales"), F.format_string("%.9e", "rest").alias("rest"))


def upsert_summary(spark, sf_dir):
    """One batch entered twice, as after a failure, and read once."""
    work = session.scratch(spark, "upsert")
    deltas = session.cut_lineage(report.hourly_deltas(stand_ins.merged_records(spark, sf_dir)))
    for _ in range(2):
        ledger.record(deltas, f"{work}/ledger", 0)
    return rollup.shown(ledger.totals(spark, f"{work}/ledger"))


def upsert_by_hour(spark, sf_dir):
    """A summary of the sales, brought up to date with the deltas of the other feeds."""
    sales = report.hourly_report(stand_ins.event_records(_events(spark, sf_dir)), [feeds.GARMENT_SALES])
    rest = [feeds.BOOK_SALES, feeds.WEB_CLICKS, feeds.TWEETS]
    deltas = report.hourly_deltas(stand_ins.merged_records(spark, sf_dir), rest)
    return rollup.shown(summary.upsert_by_hour(summary.with_defaults(sales), deltas))


def batch_delta(spark, sf_dir):
    """Per micro-batch deltas by kind of event, entered batch by batch and added up."""
    work = session.scratch(spark, "delta")
    events = _stream(spark, _events(spark, sf_dir).select("event_type", "ts", "value"), f"{work}/topic")
    hour = hours.hour_number(hours.event_time(hours.epoch_ms(F.col("ts"))))
    sales = F.col("value").cast(schemas.AMOUNT)
    values = events.select(F.col("event_type").alias("part"), hour.alias("hour"), sales.alias("sales"))

    def enter(batch: DataFrame, batch_id: int) -> None:
        ledger.write_batch(rollup.hourly(batch, "part"), f"{work}/deltas", batch_id)

    jobs.each_batch(values, enter, f"{work}/checkpoint", None).awaitTermination()
    written = spark.read.schema("report_date string, part string, sales decimal(38,6)").parquet(f"{work}/deltas")
    added = written.groupBy("part", F.col("report_date").alias("hour")).agg(F.sum("sales").alias("sales"))
    return added.select("part", "hour", F.col("sales").cast("double").alias("delta"))


QUERIES = {
    "record_value": record_value,
    "topic_filter": topic_filter,
    "topic_pruning": topic_pruning,
    "topic_offsets": topic_offsets,
    "report_from_parsed_topic": report_from_parsed_topic,
    "envelope_payload": envelope_payload,
    "nested_payload": nested_payload,
    "tweet_slice": tweet_slice,
    "lenient_numbers": lenient_numbers,
    "epoch_to_timestamp": epoch_to_timestamp,
    "hour_bucket": hour_bucket,
    "currency_convert": currency_convert,
    "constant_column": constant_column,
    "first_page_filter": first_page_filter,
    "keyword_filter": keyword_filter,
    "keyword_filter_custom": keyword_filter_custom,
    "dead_letter": dead_letter,
    "hourly_us_sales": hourly_us_sales,
    "hourly_eu_sales": hourly_eu_sales,
    "hourly_web_hits": hourly_web_hits,
    "hourly_tweets": hourly_tweets,
    "hourly_tweets_custom": hourly_tweets_custom,
    "exec_summary_hourly": exec_summary_hourly,
    "report_with_letters": report_with_letters,
    "grand_total": grand_total,
    "hour_value_map": hour_value_map,
    "running_total": running_total,
    "incremental_scan": incremental_scan,
    "table_list_scan": table_list_scan,
    "jdbc_read": jdbc_read,
    "jdbc_overwrite": jdbc_overwrite,
    "jdbc_incremental": jdbc_incremental,
    "stream_to_every_row": stream_to_every_row,
    "stream_upsert_in_database": stream_upsert_in_database,
    "update_all_in_database": update_all_in_database,
    "preview": preview_first_rows,
    "seed_defaults": seed_defaults,
    "unique_key_check": unique_key_check,
    "null_check": null_check,
    "text_stream": text_stream,
    "stream_hourly_sales": stream_hourly_sales,
    "stream_topics": stream_topics,
    "stream_dead_letters": stream_dead_letters,
    "stream_running_state": stream_running_state,
    "stream_from_latest": stream_from_latest,
    "table_to_summary": table_to_summary,
    "wide_amounts": wide_amounts,
    "literal_append": literal_append,
    "current_hour_check": current_hour_check,
    "first_row": first_row,
    "empty_delta": empty_delta,
    "null_count": null_count,
    "upsert_summary": upsert_summary,
    "upsert_by_hour": upsert_by_hour,
    "batch_delta": batch_delta,
}


def queries():
    """All registered queries; each pins the report zone before it runs."""

    def pinned(query):
        return lambda spark, sf_dir: query(session.pin_report_settings(spark), sf_dir)

    return {name: pinned(query) for name, query in QUERIES.items()}
