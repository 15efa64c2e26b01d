"""Sources: topics (or topic-like files), static tables, driver test tables."""

from entryflow.sources.tables import read_day_keyed, read_promotions_for_day, read_static
from entryflow.sources.topics import (
    declare_stream, kafka_options, read_records_batch, read_records_stream, schema_from_sample,
)

__all__ = [
    "declare_stream", "kafka_options", "read_day_keyed", "read_promotions_for_day",
    "read_records_batch", "read_records_stream", "read_static", "schema_from_sample",
]
