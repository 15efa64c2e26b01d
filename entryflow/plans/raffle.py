"""Raffle entries: parsed entries, winners, winner flags, outgoing records.

Each function maps ``key, value`` entry records (batch or streaming) and a
static promotions frame to the frame a job writes; the jobs in
``entryflow.streaming`` add sources, sinks and checkpoints around them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from typing import Sequence

from entryflow.functions.keys import daily_winner_key, entry_key, entry_time_text
from entryflow.operators.matching import flag_winners, match_winners, unique_by
from entryflow.operators.numbering import assign_numbers, next_numbers
from entryflow.operators.payload import (
    add_json_field, parse_entries, parse_json, split_objects, to_records,
)
from entryflow.schemas import FLAGGED_TABLE  # noqa: F401  (re-exported)
from entryflow.sinks.topics import RECORD_ID
from entryflow.sources.tables import read_promotions_for_day

# Payload fields of an entry record, in the order they are written.
PAYLOAD_FIELDS = ("email", "name", "entry_time", "day", "participationnumber")

# Payload as the flagging job decodes it: numbers come back as doubles, and
# ``entry_time`` may be a number or text.
FLAG_PAYLOAD = T.StructType([
    T.StructField("email", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("entry_time", T.StringType(), True),
    T.StructField("day", T.StringType(), True),
    T.StructField("participationnumber", T.DoubleType(), True),
])

# Payload of an outgoing record, for checks: numbers keep their kind.
RECORD_PAYLOAD = T.StructType([
    T.StructField("email", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("entry_time", T.DoubleType(), True),
    T.StructField("day", T.StringType(), True),
    T.StructField("participationnumber", T.LongType(), True),
])


def entries_table(kv: DataFrame, on_bad: str = "keep") -> DataFrame:
    """Rows of the entries table: ``email, name, entry_time (text), day,
    participation_number``.  Records that do not parse are kept as NULL rows
    by default, as a plain parse-and-append consumer writes them."""
    parsed = parse_entries(kv, on_bad=on_bad)
    return parsed.withColumn("entry_time", entry_time_text("entry_time"))


def winners(kv: DataFrame, promotions: DataFrame) -> DataFrame:
    """Rows of the winners table: entries columns + ``promotion``.

    ``promotions`` has ``day, promotion, participation_number``.  The
    unparseable records fall out of the inner join by themselves.
    """
    return match_winners(entries_table(kv), promotions)


def promotion_keys(daily_winners: DataFrame, as_of=None) -> DataFrame:
    """``key`` of each daily-winners row (``day`` date, ``winnernumber``),
    optionally only those of one day."""
    rows = daily_winners if as_of is None else read_promotions_for_day(daily_winners, as_of)
    return rows.select(daily_winner_key("day", "winnernumber").alias("key"),
                       F.col("day"), F.col("winnernumber"))


def check_unique_entries(kv: DataFrame) -> DataFrame:
    """Fail the job when two entry records share a key (batch frames: one
    aggregation over the keys, joined back on the key).  Records without a
    key are kept and are no duplicates of each other."""
    fail = F.raise_error(F.concat(F.lit("duplicate rows for key "), F.col("key")))
    keys = (kv.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
            .select(F.when((F.col("n") > 1) & F.col("key").isNotNull(), fail)
                    .otherwise(F.col("key")).alias("key")))
    return kv.join(keys, kv["key"].eqNullSafe(keys["key"]), "left_semi")


def flag_keys(kv: DataFrame, daily_winners: DataFrame, as_of=None,
              on_duplicate: str = "error", entries_unique: bool = False) -> DataFrame:
    """``key, value, winner`` for every entry record.

    ``winner`` is true when the record key has a daily-winners row.  A key
    with two winners rows fails the job (``on_duplicate="error"``); winners
    rows without an entry produce nothing.  ``entries_unique`` also fails on
    two entry records with one key (batch only; it costs a shuffle of the
    entry keys, and topic keys are unique by construction).
    """
    if entries_unique:
        kv = check_unique_entries(kv)
    keys = promotion_keys(daily_winners, as_of).select("key")
    return flag_winners(kv, keys, entry_key="key", promo_key="key", on_duplicate=on_duplicate)


def flagged_rows(flagged: DataFrame) -> DataFrame:
    """Rows of the flagged-entries table (``FLAGGED_TABLE``) from ``flag_keys``."""
    parsed = parse_json(flagged, FLAG_PAYLOAD, keep=["key", "winner"])
    return parsed.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name)
                           for f in FLAGGED_TABLE.fields])


def flagged_to_records(flagged: DataFrame) -> DataFrame:
    """Outgoing ``key, value`` records from ``flag_keys``: the entry JSON with
    ``winner`` added and every other field kept.  Records whose value is no
    JSON object are left out; ``unflaggable`` has them."""
    good, _ = split_objects(flagged)
    ids = [c for c in (RECORD_ID,) if c in flagged.columns]
    return good.select("key", add_json_field("value", "winner", F.col("winner")).alias("value"), *ids)


def unflaggable(flagged: DataFrame) -> DataFrame:
    """The ``key, value`` records of ``flag_keys`` that are no JSON objects (dead letters)."""
    return split_objects(flagged)[1].select("key", "value")


def flag_entries(kv: DataFrame, daily_winners: DataFrame, as_of=None,
                 on_duplicate: str = "error", entries_unique: bool = False) -> DataFrame:
    """One flagged row per entry record (``FLAGGED_TABLE`` columns); see
    ``flag_keys`` for the rules."""
    return flagged_rows(flag_keys(kv, daily_winners, as_of, on_duplicate, entries_unique))


def flagged_records(kv: DataFrame, daily_winners: DataFrame, as_of=None,
                    on_duplicate: str = "error") -> DataFrame:
    """Outgoing ``key, value`` records: the entry JSON with ``winner`` added."""
    return flagged_to_records(flag_keys(kv, daily_winners, as_of, on_duplicate))


def decode_records(records: DataFrame) -> DataFrame:
    """Fields of outgoing records, for checks: key + payload + winner."""
    schema = T.StructType(list(RECORD_PAYLOAD.fields) +
                          [T.StructField("winner", T.BooleanType(), True)])
    return parse_json(records, schema, keep=["key"])


def unique_promotions(promotions: DataFrame, on_duplicate: str = "first") -> DataFrame:
    """One promotion per (day, participation_number); ``first`` keeps the
    alphabetically first promotion text, ``error`` fails on a duplicate."""
    return unique_by(promotions, ["day", "participation_number"], on_duplicate,
                     order_by=["promotion"])


def number_entries(entries: DataFrame, order_cols: Sequence[str] = ("entry_time",),
                   last_by_day: DataFrame | None = None) -> DataFrame:
    """Give new entries (``email, name, entry_time, day``) their
    ``participationnumber``: dense per day in ``order_cols`` order (add a
    unique id as last tie-breaker), continuing from ``last_by_day``
    (``day, next_number``) when given."""
    return assign_numbers(entries, "day", list(order_cols), out_col="participationnumber",
                          start=last_by_day)


def entry_records(numbered: DataFrame) -> DataFrame:
    """``key, value`` topic records: key ``<day>_<number>``, JSON payload."""
    return to_records(numbered, entry_key("day", "participationnumber"), PAYLOAD_FIELDS)


def produce_entries(entries: DataFrame, order_cols: Sequence[str] = ("entry_time",),
                    last_by_day: DataFrame | None = None):
    """Q11: number new entries and encode them; returns ``(records,
    next_by_day)`` where ``next_by_day`` is what to store for the next run."""
    numbered = number_entries(entries, order_cols, last_by_day)
    return entry_records(numbered), next_numbers(numbered, "day", "participationnumber")
