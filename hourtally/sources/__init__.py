"""Sources: topics, relational tables, text lines and literal rows."""
