"""Keyed JSON records: cast, parse, rename, flag and re-encode."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from entryflow.schemas import ENTRY_COLUMNS, ENTRY_SCHEMA


# Length of the schema-registry frame ahead of a registered value: one magic
# byte and a four-byte schema id.
REGISTRY_HEADER_BYTES = 5


def kv_strings(df: DataFrame, key_col: str = "key", value_col: str = "value",
               key_alias: str = "key", value_alias: str = "value",
               value_header_bytes: int = 0) -> DataFrame:
    """Binary (or string) key/value of a topic record as strings.

    ``value_header_bytes`` drops a fixed-length prefix from the binary value
    first (``REGISTRY_HEADER_BYTES`` for values written by a schema-registry
    serializer), so the rest parses as plain JSON text.
    """
    value = F.col(value_col)
    if value_header_bytes:
        value = F.substring(value.cast("binary"), value_header_bytes + 1, 2**31 - 1)
    return df.select(F.col(key_col).cast("string").alias(key_alias),
                     value.cast("string").alias(value_alias))


def parse_json(df: DataFrame, schema: T.StructType, value_col: str = "value",
               keep: Sequence[str] = (), on_bad: str = "keep"):
    """Parse ``value_col`` with a fixed schema and expand it into columns.

    Parsing is permissive per field: a field of the wrong type becomes NULL,
    text that is not JSON gives a row of NULLs.  ``on_bad``:
    ``keep`` keeps such all-NULL rows, ``drop`` removes them, ``split``
    returns ``(good, bad)`` where ``bad`` holds the raw kept columns and value.
    """
    names = [f.name for f in schema.fields]
    # The parse runs inside a generator (one struct -> one row), so filters
    # on the parsed fields (e.g. the IS NOT NULL that a join on them infers)
    # stay above it: each value is parsed once, not once per referenced field.
    carried = list(dict.fromkeys(list(keep) + ([value_col] if on_bad == "split" else [])))
    parsed = df.select(*[F.col(c) for c in carried],
                       F.inline(F.array(F.from_json(F.col(value_col), schema))))
    bad = F.lit(True)
    for n in names:
        bad = bad & F.col(n).isNull()
    out_cols = [F.col(k) for k in keep] + [F.col(n) for n in names]
    if on_bad == "keep":
        return parsed.select(*out_cols)
    if on_bad == "drop":
        return parsed.where(~bad).select(*out_cols)
    if on_bad == "split":
        good = parsed.where(~bad).select(*out_cols)
        rejected = parsed.where(bad).select(*[F.col(k) for k in keep], F.col(value_col))
        return good, rejected
    raise ValueError(f"on_bad must be keep, drop or split, not {on_bad!r}")


def parse_entries(kv: DataFrame, value_col: str = "value", keep: Sequence[str] = (),
                  on_bad: str = "keep"):
    """Entry payloads -> ``email, name, entry_time, day, participation_number``.

    The payload field ``participationnumber`` is renamed to
    ``participation_number`` and widened to bigint; an ``entry_time`` that is
    no number becomes NULL.
    """
    res = parse_json(kv, ENTRY_SCHEMA, value_col=value_col, keep=keep, on_bad=on_bad)

    def _rename(df: DataFrame) -> DataFrame:
        return df.toDF(*list(keep), *ENTRY_COLUMNS).withColumns({
            "entry_time": F.col("entry_time").try_cast("double"),
            "participation_number": F.col("participation_number").cast("long")})

    if isinstance(res, tuple):
        return _rename(res[0]), res[1]
    return _rename(res)


def to_records(df: DataFrame, key: "str | F.Column", fields: Sequence[str],
               value_alias: str = "value") -> DataFrame:
    """``(key, value)`` records whose value is the JSON of ``fields`` in order."""
    key_col = F.col(key) if isinstance(key, str) else key
    return df.select(key_col.cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(f) for f in fields])).alias(value_alias))


def add_json_field(value: "str | F.Column", name: str, field: F.Column) -> F.Column:
    """A JSON object's text with one field added or replaced, the others kept.

    The object's fields are taken as they are, whatever their names and
    types (numbers come out in plain form, ``5.0`` as ``5``).  Text that is no
    JSON object gives NULL: such records belong to a dead-letter output (see
    ``split_objects``).
    """
    v = F.col(value) if isinstance(value, str) else value
    fields = F.from_json(v, "map<string,variant>")
    others = F.map_filter(fields, lambda k, x: k != F.lit(name))
    added = F.map_from_arrays(F.array(F.lit(name)),
                              F.array(F.parse_json(F.to_json(F.struct(field.alias("f"))))
                                      .try_cast("map<string,variant>")["f"]))
    return F.to_json(F.map_concat(others, added))


def split_objects(records: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: records whose value is the text of a JSON object, and the others."""
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json(value_col)).startswith("OBJECT"),
                           F.lit(False))
    return records.where(is_object), records.where(~is_object)
