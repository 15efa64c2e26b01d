"""DataFrame -> DataFrame operators built from Spark expressions."""

from entryflow.operators.matching import (
    cogroup_summary, flag_winners, match_winners, unique_by,
)
from entryflow.operators.numbering import assign_numbers, next_numbers
from entryflow.operators.payload import (
    add_json_field, kv_strings, parse_entries, parse_json, to_records,
)
from entryflow.operators.ranking import rollup_metric, row_share, running_total, top_distinct

__all__ = [
    "add_json_field", "assign_numbers", "cogroup_summary", "flag_winners", "kv_strings",
    "match_winners", "next_numbers", "parse_entries", "parse_json", "rollup_metric",
    "row_share", "running_total", "to_records", "top_distinct", "unique_by",
]
