"""The same answers in plain SQL, straight from the tables (no envelopes, no ledger)."""

from __future__ import annotations

_LABEL = "'%Y-%m-%d %H:00:00'"
_TWEET_HOUR = f"strftime(epoch_ms(1704067200000 + doc_id * 600000), {_LABEL})"
_POSITIVE = "(contains(text, 'cool') OR contains(text, 'great'))"
_OTHER = "(contains(text, 'heon') OR contains(text, 'blees'))"

# One row per contribution of any feed.
_CONTRIBUTIONS = f"""
  SELECT strftime(ts, {_LABEL}) AS report_date,
         CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,3)) ELSE 0 END AS s,
         CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS h, 0 AS t, 0 AS p
  FROM events WHERE event_type IN ('purchase', 'view')
  UNION ALL
  SELECT strftime(o_orderdate, {_LABEL}), CAST(o_totalprice * 1.5::DOUBLE AS DECIMAL(18,3)), 0, 0, 0
  FROM orders
  UNION ALL
  SELECT {_TWEET_HOUR}, 0, 0, 1, CASE WHEN {_POSITIVE} THEN 1 ELSE 0 END
  FROM documents
"""
_SUMS = """CAST(sum(s) AS DOUBLE) AS sales, CAST(sum(h) AS BIGINT) AS web_hits,
  CAST(sum(t) AS BIGINT) AS tweets, CAST(sum(p) AS BIGINT) AS tweets_positive"""

_US_SALES = f"""
  SELECT strftime(ts, {_LABEL}) AS hour, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sales
  FROM events WHERE event_type = 'purchase' GROUP BY 1"""
_SUMMARY = f"SELECT report_date, {_SUMS} FROM ({_CONTRIBUTIONS}) c GROUP BY 1"
_TOTALS = f"SELECT {_SUMS} FROM ({_CONTRIBUTIONS}) c"

# The envelope of an event as a sale.
_SALE_TEXTS = """
  SELECT event_type, '{"payload":{"ID":' || event_id || ',"GARMENT_NAME":' || to_json(props)
    || ',"SALES_DATE":' || (epoch_us(ts) // 1000) || ',"ORDER_VALUE":' || value || '}}' AS raw
  FROM events"""
_EVERY_ROW = f"""
  SELECT c_custkey::INTEGER AS id, round(t.sales, 3) AS sales, t.web_hits::INTEGER AS web_hits,
         t.tweets::INTEGER AS tweets, t.tweets_positive::INTEGER AS tweets_positive
  FROM customer CROSS JOIN ({_TOTALS}) t"""

ORACLES = {
    "record_value": "SELECT event_id, props AS value FROM events",
    "topic_filter": """
  SELECT 'use-case-garment_sales' AS topic, count(*) AS n FROM events WHERE event_type IN ('purchase', 'error')
  UNION ALL SELECT 'use-case-book_sales', count(*) FROM orders""",
    "topic_pruning": """
  SELECT 'use-case-garment_sales' AS topic, count(*) AS n FROM events WHERE event_type IN ('purchase', 'error')
  UNION ALL SELECT 'use-case-webclicks', count(*) FROM events WHERE event_type IN ('view', 'click', 'signup')""",
    "report_from_parsed_topic": _SUMMARY,
    "topic_offsets": """
  SELECT topic, count(*) AS places, (2 * count(*))::BIGINT AS records FROM (
    SELECT CASE WHEN event_type IN ('purchase', 'error') THEN 'use-case-garment_sales' ELSE 'use-case-webclicks' END AS topic FROM events
    UNION ALL SELECT 'use-case-book_sales' FROM orders
    UNION ALL SELECT 'use-case-tweets' FROM documents
  ) t GROUP BY topic""",
    "envelope_payload": """
  SELECT event_id AS id, props AS garment_name, epoch_us(ts) // 1000 AS sales_date, value AS order_value
  FROM events WHERE event_type = 'purchase'""",
    "nested_payload": """
  SELECT event_id, epoch_us(ts) // 1000 AS ts_ms,
         CASE event_type WHEN 'view' THEN 'firstPage' WHEN 'click' THEN 'browseProduct' ELSE 'ViewReviews' END AS category
  FROM events WHERE event_type IN ('view', 'click', 'signup')""",
    "tweet_slice": "SELECT doc_id, 1704067200000 + doc_id * 600000 AS ts_ms, text AS tweet FROM documents",
    "lenient_numbers": """
  SELECT event_id, event_type <> 'error' AS present,
         CASE WHEN event_type IN ('purchase', 'signup') THEN value
              WHEN event_type IN ('view', 'click') THEN 0.0::DOUBLE ELSE -1.0::DOUBLE END AS as_double,
         CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(trunc(value) AS BIGINT)
              WHEN event_type IN ('view', 'click') THEN 0 ELSE -1 END AS as_long
  FROM events""",
    "epoch_to_timestamp": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t FROM events",
    "hour_bucket": f"""
  SELECT event_id, strftime(ts, {_LABEL}) AS hour, strftime(ts, {_LABEL}) AS hour_by_number FROM events""",
    "currency_convert": "SELECT o_orderkey AS id, o_totalprice * 1.5::DOUBLE AS amount FROM orders",
    "constant_column": "SELECT o_orderkey, 0.0::DOUBLE AS sales FROM orders",
    "first_page_filter": "SELECT event_id FROM events WHERE event_type = 'view'",
    "keyword_filter": f"SELECT doc_id FROM documents WHERE {_POSITIVE}",
    "keyword_filter_custom": f"SELECT doc_id FROM documents WHERE {_OTHER}",
    "dead_letter": f"""
  SELECT 'use-case-garment_sales' AS topic,
         CASE WHEN event_type = 'error' THEN 'payload not readable' END AS problem,
         CASE WHEN event_type = 'error' THEN left(raw, length(raw) - 2) ELSE raw END AS raw
  FROM ({_SALE_TEXTS}) t WHERE event_type IN ('purchase', 'error')""",
    "hourly_us_sales": _US_SALES,
    "hourly_eu_sales": f"""
  SELECT strftime(o_orderdate, {_LABEL}) AS hour,
         CAST(sum(CAST(o_totalprice * 1.5::DOUBLE AS DECIMAL(18,3))) AS DOUBLE) AS sales
  FROM orders GROUP BY 1""",
    "hourly_web_hits": f"""
  SELECT strftime(ts, {_LABEL}) AS hour, count(*) AS web_hits FROM events WHERE event_type = 'view' GROUP BY 1""",
    "hourly_tweets": f"""
  SELECT {_TWEET_HOUR} AS hour, count(*) AS tweets, count(*) FILTER (WHERE {_POSITIVE}) AS tweets_positive
  FROM documents GROUP BY 1""",
    "hourly_tweets_custom": f"""
  SELECT {_TWEET_HOUR} AS hour, count(*) AS tweets, count(*) FILTER (WHERE {_OTHER}) AS tweets_positive
  FROM documents GROUP BY 1""",
    "exec_summary_hourly": _SUMMARY,
    "report_with_letters": f"""
  SELECT report_date, sales, web_hits, tweets, tweets_positive, NULL::VARCHAR AS raw FROM ({_SUMMARY}) s
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, left(raw, length(raw) - 2) FROM ({_SALE_TEXTS}) t WHERE event_type = 'error'""",
    "grand_total": f"SELECT sales FROM ({_TOTALS}) t",
    "hour_value_map": _US_SALES,
    "running_total": f"""
  SELECT r_regionkey AS id, t.sales, t.web_hits, t.tweets, t.tweets_positive
  FROM region CROSS JOIN ({_TOTALS}) t""",
    "incremental_scan": """
  SELECT event_id, value, CASE WHEN event_id > (SELECT max(event_id) // 2 FROM events) THEN 2 ELSE 1 END AS poll
  FROM events""",
    "table_list_scan": """
  SELECT 'use-case-nation' AS topic, count(*) AS n, CAST(sum(n_nationkey) AS BIGINT) AS keys,
         CAST(sum(n_nationkey) AS BIGINT) AS keys_in_payload FROM nation
  UNION ALL SELECT 'use-case-region', count(*), CAST(sum(r_regionkey) AS BIGINT), CAST(sum(r_regionkey) AS BIGINT) FROM region
  UNION ALL SELECT 'use-case-customer', count(*), CAST(sum(c_custkey) AS BIGINT), CAST(sum(c_custkey) AS BIGINT) FROM customer
  UNION ALL SELECT 'use-case-orders', count(*), CAST(sum(o_orderkey) AS BIGINT), CAST(sum(o_orderkey) AS BIGINT) FROM orders""",
    "jdbc_read": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "jdbc_overwrite": "SELECT s_suppkey, 9.0::DOUBLE AS sales FROM supplier",
    "jdbc_incremental": """
  SELECT o_orderkey, o_totalprice,
         CASE WHEN o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders) THEN 2 ELSE 1 END AS poll
  FROM orders""",
    "update_all_in_database": _EVERY_ROW,
    "stream_to_every_row": _EVERY_ROW,
    "stream_upsert_in_database": f"""
  SELECT report_date, round(sales, 3) AS sales, web_hits, tweets, tweets_positive FROM ({_SUMMARY}) s
  UNION ALL VALUES ('1999-12-31 23:00:00', 5.0::DOUBLE, 6::BIGINT, 7::BIGINT, 8::BIGINT)""",
    "preview": "SELECT event_id, props FROM events ORDER BY event_id LIMIT 10",
    "seed_defaults": """
  SELECT c_custkey AS id, 0.0::DOUBLE AS sales, 0::BIGINT AS web_hits, 0::BIGINT AS tweets,
         0::BIGINT AS tweets_positive
  FROM customer""",
    "unique_key_check": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1",
    "null_check": f"""
  SELECT count(*) FILTER (WHERE report_date IS NULL) AS report_date, count(*) FILTER (WHERE sales IS NULL) AS sales,
         count(*) FILTER (WHERE web_hits IS NULL) AS web_hits, count(*) FILTER (WHERE tweets IS NULL) AS tweets,
         count(*) FILTER (WHERE tweets_positive IS NULL) AS tweets_positive
  FROM ({_SUMMARY}) s""",
    "text_stream": "SELECT props AS value FROM events",
    "stream_hourly_sales": _US_SALES,
    "stream_topics": f"""
  SELECT t.*, (SELECT count(*) FROM events WHERE event_type = 'error') AS dead_letters FROM ({_TOTALS}) t""",
    "stream_dead_letters": f"""
  SELECT 'use-case-garment_sales' AS topic, 'payload not readable' AS problem, left(raw, length(raw) - 2) AS raw
  FROM ({_SALE_TEXTS}) t WHERE event_type = 'error'""",
    "stream_running_state": _US_SALES,
    "stream_from_latest": f"""
  SELECT strftime(ts, {_LABEL}) AS hour, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sales
  FROM events WHERE event_type = 'purchase' AND event_id > (SELECT max(event_id) // 2 FROM events) GROUP BY 1""",
    "table_to_summary": f"""
  SELECT strftime(o_orderdate, {_LABEL}) AS hour,
         CAST(sum(CAST(o_totalprice * 1.5::DOUBLE AS DECIMAL(18,3))) AS DOUBLE) AS sales
  FROM orders GROUP BY 1""",
    "wide_amounts": """
  SELECT CAST(year(ts + to_days(365 * CASE event_type WHEN 'click' THEN -500 WHEN 'signup' THEN 9000 ELSE 0 END)) AS INTEGER) AS year,
         CAST(sum(CASE WHEN event_type IN ('purchase', 'view') THEN 0 ELSE CAST(amount AS DECIMAL(24,6)) END) AS DOUBLE) AS sales,
         printf('%.9e', sum(CASE WHEN event_type IN ('purchase', 'view') THEN amount
                            ELSE amount - CAST(CAST(amount AS DECIMAL(24,6)) AS DOUBLE) END)) AS rest
  FROM (SELECT ts, event_type, CASE event_type WHEN 'purchase' THEN value * 1e20::DOUBLE WHEN 'view' THEN value * 1e-10::DOUBLE
          WHEN 'click' THEN value + 123456789.0000004::DOUBLE ELSE value END AS amount FROM events) t
  GROUP BY 1""",
    "literal_append": """
  SELECT s_name AS name, s_acctbal AS value FROM supplier
  UNION ALL VALUES ('Mens Pants', 45.99::DOUBLE), ('Womens Tops', 29.99::DOUBLE)""",
    "current_hour_check": "SELECT c_custkey, true AS is_current FROM customer",
    "first_row": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1",
    "empty_delta": f"SELECT 1::BIGINT AS batch_id, count(DISTINCT hour) AS hours FROM ({_US_SALES}) s",
    "null_count": """
  SELECT count(*) FILTER (WHERE event_id IS NULL) AS event_id, count(*) FILTER (WHERE event_type <> 'purchase') AS value
  FROM events""",
    "upsert_summary": _SUMMARY,
    "upsert_by_hour": _SUMMARY,
    "batch_delta": f"""
  SELECT event_type AS part, strftime(ts, {_LABEL}) AS hour,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS delta
  FROM events GROUP BY 1, 2""",
}
