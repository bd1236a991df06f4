"""Hourly event rollups as Spark jobs.

Several event feeds (sales rows, page clicks, short messages) are unpacked from
JSON envelopes, bucketed by event hour and rolled up into one summary table.
Everything is a DataFrame expression or a Structured Streaming query; there are
no Python UDFs.
"""
