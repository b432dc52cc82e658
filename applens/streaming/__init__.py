"""Streaming forms of the stateless operators (the application has no
stream processing of its own; its row-level cleaning runs unchanged here)."""

from applens.streaming.cleaning import (  # noqa: F401
    clean_catalog_stream, rating_median, run_to_table, start_clean_stream,
)
