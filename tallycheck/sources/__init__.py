"""Readers and writers."""

from tallycheck.sources.files import (
    MissingReference,
    empty_table,
    literal_table,
    read_text_csv,
    read_with_policy,
)
from tallycheck.sources.sinks import Publication, published, write_table

__all__ = ["MissingReference", "Publication", "empty_table", "literal_table", "published", "read_text_csv",
           "read_with_policy", "write_table"]
