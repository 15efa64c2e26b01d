"""Sinks: tables (create, conform, append by a commit list, compaction) and topics."""

from entryflow.sinks.commits import commit_rows, compact, read_table, settle, table_location
from entryflow.sinks.tables import (
    append_table, conform, create_table, insert_promotions, overwrite_batch, promotion_rows,
)
from entryflow.sinks.topics import kafka_sink, write_topic

__all__ = [
    "append_table", "commit_rows", "compact", "conform", "create_table", "insert_promotions",
    "kafka_sink", "overwrite_batch", "promotion_rows", "read_table", "settle", "table_location",
    "write_topic",
]
