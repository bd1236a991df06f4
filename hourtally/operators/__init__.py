"""Operators on records and readings, each a function from frame to frame."""
