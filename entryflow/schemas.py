"""Schemas of the records and tables the jobs read and write.

Fixed values: the field names below (payload ``email, name, entry_time,
day, participationnumber``; tables ``participation_number``, ``promotion``,
``winner``, ``winnernumber``; posts ``title, body, url, view_count, tags``;
questions/answers/users ``id, parent_id, creation_date, owner_user_id``)
are those of the reference's records and tables, so that data written by
one side reads on the other.
"""

from __future__ import annotations

import json
from typing import Iterable

from pyspark.sql import types as T

# Parse schema of one entry payload.  ``entry_time`` is epoch seconds, as a JSON
# number or as text; it is read as text, so that both survive, and then taken
# as a double (see ``operators.payload.parse_entries``).
ENTRY_SCHEMA = T.StructType([
    T.StructField("email", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("entry_time", T.StringType(), True),
    T.StructField("day", T.StringType(), True),
    T.StructField("participationnumber", T.IntegerType(), True),
])

# Column names after the positional rename of the parsed payload.
ENTRY_COLUMNS = ["email", "name", "entry_time", "day", "participation_number"]

ENTRIES_TABLE = T.StructType([
    T.StructField("email", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("entry_time", T.StringType(), True),
    T.StructField("day", T.StringType(), True),
    T.StructField("participation_number", T.LongType(), True),
])

PROMOTIONS_TABLE = T.StructType([
    T.StructField("day", T.StringType(), False),
    T.StructField("promotion", T.StringType(), False),
    T.StructField("participation_number", T.LongType(), False),
])

WINNERS_TABLE = T.StructType(
    list(ENTRIES_TABLE.fields) + [T.StructField("promotion", T.StringType(), True)]
)

# Entries with the winner flag, as the flagged-entries table stores them
# (numbers decoded from JSON arrive as doubles).
FLAGGED_TABLE = T.StructType([
    T.StructField("entry_time", T.DoubleType(), True),
    T.StructField("winner", T.BooleanType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("participationnumber", T.DoubleType(), True),
    T.StructField("day", T.StringType(), True),
    T.StructField("email", T.StringType(), True),
])

# Daily winners table keyed by calendar day (the Beam source side).
DAILY_WINNERS_TABLE = T.StructType([
    T.StructField("day", T.DateType(), True),
    T.StructField("winnernumber", T.LongType(), True),
])

# Question-and-answer tables used by the reports.
POSTS_TABLE = T.StructType([
    T.StructField("title", T.StringType(), True),
    T.StructField("body", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("view_count", T.LongType(), True),
    T.StructField("tags", T.ArrayType(T.StringType()), True),
])

QUESTIONS_TABLE = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("creation_date", T.TimestampNTZType(), True),
    T.StructField("owner_user_id", T.LongType(), True),
])

ANSWERS_TABLE = T.StructType([
    T.StructField("parent_id", T.LongType(), True),
    T.StructField("creation_date", T.TimestampNTZType(), True),
    T.StructField("owner_user_id", T.LongType(), True),
])

USERS_TABLE = T.StructType([
    T.StructField("id", T.LongType(), True),
    T.StructField("creation_date", T.DateType(), True),
])

KV_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])

# A record with headers and its time, as a topic has them.
HEADED_SCHEMA = T.StructType([
    *KV_SCHEMA.fields,
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType(), True), T.StructField("value", T.BinaryType(), True)])), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

# Warehouse type names (as used in JSON table-schema files) -> Spark types.
_WAREHOUSE_TYPES = {
    "STRING": T.StringType(),
    "BYTES": T.BinaryType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
}


def struct_from_fields(fields: Iterable[dict]) -> T.StructType:
    """Build a StructType from ``[{"name", "type", "mode"}]`` field specs.

    ``mode`` REQUIRED gives ``nullable=False``; REPEATED gives an array.
    """
    out = []
    for f in fields:
        typ = f["type"].upper()
        if typ in ("RECORD", "STRUCT"):
            dtype: T.DataType = struct_from_fields(f.get("fields", []))
        else:
            dtype = _WAREHOUSE_TYPES[typ]
        mode = f.get("mode", "NULLABLE").upper()
        if mode == "REPEATED":
            dtype = T.ArrayType(dtype)
        out.append(T.StructField(f["name"], dtype, mode != "REQUIRED"))
    return T.StructType(out)


def load_table_schema(path: str) -> T.StructType:
    """Read a JSON table-schema file (a list of field specs)."""
    with open(path) as fh:
        return struct_from_fields(json.load(fh))


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE, with NOT NULL on required columns."""
    parts = []
    for f in schema.fields:
        part = f"`{f.name}` {f.dataType.simpleString()}"
        if not f.nullable:
            part += " NOT NULL"
        parts.append(part)
    return ", ".join(parts)
