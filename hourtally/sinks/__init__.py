"""Sinks: the ledger of running totals, relational tables, and previews."""
