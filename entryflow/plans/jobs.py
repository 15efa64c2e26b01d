"""The streaming jobs (Q1-Q4): source -> operators -> sink, checkpointed.

``source`` is a dict for ``read_records_stream``: ``{"source": "kafka",
"options": kafka_options(...)}`` or ``{"source": "parquet"|"json", "path":
..., "options": {"maxFilesPerTrigger": "100"}}``; ``"value_header_bytes": 5``
drops a schema-registry frame ahead of each value.

A target is a folder, or with ``as_table`` a catalog table (see
``sinks.tables.create_table``), whose declared columns the rows are conformed
to.  Every mode of a job writes the same columns, in the same way: modes, jobs
and batch appends may share a target, in any order.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from entryflow.operators.payload import parse_entries
from entryflow.plans import raffle
from entryflow.schemas import ENTRIES_TABLE, FLAGGED_TABLE, WINNERS_TABLE
from entryflow.sinks.tables import create_table
from entryflow.sinks.topics import kafka_sink, with_record_ids
from entryflow.sources.topics import declare_stream, read_records_stream
from entryflow.streaming.keyed import count_stream, fail_on_repeats, mark_seen, split_repeats
from entryflow.streaming.metrics import ObservedLog, Taps
from entryflow.streaming.queries import (
    fan_out, query_id, table_batch_sink, topic_batch_sink, transcode_stream, with_taps,
)


def _records(spark: SparkSession, source: Mapping) -> DataFrame:
    return read_records_stream(spark, source.get("source", "kafka"), source.get("path"),
                               source.get("options"),
                               value_header_bytes=source.get("value_header_bytes", 0))


def _static(side) -> DataFrame:
    return side() if callable(side) else side


def _tapped_entries(kv: DataFrame) -> DataFrame:
    return with_taps(kv, "entries", records=F.count(F.lit(1)))


def _tapped_winners(rows: DataFrame) -> DataFrame:
    return with_taps(rows, "winners", matches=F.count(F.lit(1)),
                     promotions=F.approx_count_distinct("promotion"))


def _entries(taps: Taps, batch: DataFrame) -> DataFrame:
    return taps.on(batch, "entries", records=F.count(F.lit(1)))


def run_entries(spark: SparkSession, source: Mapping, target: str, checkpoint: str,
                trigger: str | None = "60 seconds", as_table: bool = False,
                dead_letters: str | None = None, metrics_to: str | None = None) -> StreamingQuery:
    """Q1: entry records -> parsed rows appended to the entries table.

    Records that do not parse are appended as NULL rows (as the plain
    consumer does), or with ``dead_letters`` go to that folder as they came.
    Metrics, in the query's progress and per micro-batch in the table
    ``metrics_to``: ``entries.records``.
    """
    kv, taps = _tapped_entries(_records(spark, source)), Taps("entries", metrics_to)
    on_bad = "keep" if dead_letters is None else "drop"
    sinks = [table_batch_sink(target, lambda b: raffle.entries_table(b, on_bad=on_bad),
                              as_table=as_table, schema=ENTRIES_TABLE)]
    if as_table:
        create_table(spark, target, ENTRIES_TABLE)
    if dead_letters is not None:
        sinks.append(table_batch_sink(
            dead_letters, lambda b: parse_entries(b, keep=["key"], on_bad="split")[1], part="dead"))
    return fan_out(kv, sinks, checkpoint, trigger, prepare=lambda b, _: _entries(taps, b), after=taps.commit)


def run_winners(spark: SparkSession, source: Mapping, promotions, target: str,
                checkpoint: str, trigger: str | None = "60 seconds",
                refresh: str = "none", as_table: bool = False,
                metrics_to: str | None = None) -> StreamingQuery:
    """Q2: entry records matched with the promotions -> winners table.

    ``refresh="none"``: the promotions are the rows the static side listed
    when the query started.  ``refresh="batch"``: ``promotions`` (a frame or a
    function returning one) is re-read for every micro-batch, so promotions
    added while the job runs are seen.  Metrics, per micro-batch in the table
    ``metrics_to``: ``entries.records``, ``promotions.records`` (rows of the static
    side), ``winners.matches`` and ``winners.promotions`` (distinct promotions
    won, estimated); in the query's progress: ``entries.records`` and, without
    refresh, the winners'.
    """
    if refresh not in ("none", "batch"):
        raise ValueError("refresh must be none or batch")
    if as_table:
        create_table(spark, target, WINNERS_TABLE)
    kv, taps, now = _tapped_entries(_records(spark, source)), Taps("winners", metrics_to), {}
    metrics = {"matches": F.count(F.lit(1)), "promotions": F.approx_count_distinct("promotion")}

    def match(batch: DataFrame) -> DataFrame:
        now["promotions"] = _static(promotions)
        return taps.on(raffle.winners(_entries(taps, batch), now["promotions"]), "winners", **metrics)

    def count(batch: DataFrame, batch_id: int, written: bool) -> None:
        known = {} if metrics_to is None else {"promotions.records": now["promotions"].count()}
        taps.commit(batch, batch_id, written, **known)

    if refresh == "batch":
        sink = table_batch_sink(target, match, as_table=as_table, schema=WINNERS_TABLE)
        return fan_out(kv, [sink], checkpoint, trigger, after=count)
    side = _static(promotions)
    rows = _tapped_winners(raffle.winners(kv, side))
    sink = table_batch_sink(target, as_table=as_table, schema=WINNERS_TABLE)
    if metrics_to is None:
        return fan_out(rows, [sink], checkpoint, trigger)
    log = ObservedLog(spark, "winners", metrics_to, **{"promotions.records": side.count()})
    spark.streams.addListener(log)
    return log.follow(fan_out(rows, [sink], checkpoint, trigger))


def run_flagged(spark: SparkSession, source: Mapping, daily_winners, table_target: str,
                topic_sink: Mapping, checkpoint: str, trigger: str | None = "60 seconds",
                as_of="today", as_table: bool = False,
                dead_letters: str | None = None, metrics_to: str | None = None,
                entries_unique: bool = False, unique_delay: str = "3 days",
                record_ids: bool = False) -> StreamingQuery:
    """Q3: every entry with a ``winner`` flag -> flagged-entries table and
    outgoing topic, from one read of each micro-batch.

    The daily winners (``day`` date, ``winnernumber``) are re-read per batch
    and restricted to ``as_of`` (``"today"`` = current date, None = all days),
    so the flag is computed against all winners known for the day.  Records
    that are no JSON objects reach the table as NULL rows but not the topic;
    with ``dead_letters`` they are also written to that folder.

    ``entries_unique`` guards against a second entry record of one key, in the
    same micro-batch or an earlier one (see ``streaming.keyed.mark_seen``): it goes
    to ``dead_letters``, or without that folder fails the job.  ``record_ids``
    gives outgoing records an id that a retried batch repeats, so that consumers
    can read each once; it costs a sort of the batch.  Metrics, in the
    query's progress: ``entries.records``; per micro-batch in the table
    ``metrics_to``: that, ``promotions.records`` (winners rows looked up) and
    ``winners.matches`` (entries flagged).
    """
    day, taps, now = (None if as_of == "today" else as_of), Taps("flagged", metrics_to), {}
    if as_table:
        create_table(spark, table_target, FLAGGED_TABLE)

    def winners_now() -> DataFrame:
        dw = _static(daily_winners)
        if as_of == "today":
            return dw.where(F.col("day") == F.current_date())
        return dw

    def flag(batch: DataFrame, batch_id: int) -> DataFrame:
        batch = _entries(taps, batch)
        now["promotions"] = raffle.promotion_keys(winners_now(), day)
        if entries_unique:
            batch, now["repeats"] = split_repeats(batch)
            if dead_letters is None:
                fail_on_repeats(now["repeats"])
        if record_ids:
            batch = with_record_ids(batch, query_id(batch), batch_id)
        flagged = raffle.flag_keys(batch, winners_now(), day)
        return taps.on(flagged, "winners", matches=F.count(F.when(F.col("winner"), 1)))

    def dead(rows: DataFrame) -> DataFrame:
        bad = raffle.unflaggable(rows)
        return bad.unionByName(now["repeats"].select("key", "value")) if entries_unique else bad

    def count(batch: DataFrame, batch_id: int, written: bool) -> None:
        known = {} if metrics_to is None else {"promotions.records": now["promotions"].count()}
        taps.commit(batch, batch_id, written, **known)

    sinks = [table_batch_sink(table_target, raffle.flagged_rows, as_table=as_table,
                              schema=FLAGGED_TABLE),
             topic_batch_sink(topic_sink, raffle.flagged_to_records)]
    if dead_letters is not None:
        sinks.append(table_batch_sink(dead_letters, dead, part="dead"))
    kv = _tapped_entries(_records(spark, source))
    if entries_unique:
        kv = mark_seen(kv, delay=unique_delay)
    # one flag join per micro-batch, shared by all sinks
    return fan_out(kv, sinks, checkpoint, trigger, prepare=flag, after=count, stateful=entries_unique)


def run_cogroup(spark: SparkSession, source: Mapping, target: str, checkpoint: str,
                trigger: str | None = "60 seconds", as_table: bool = False) -> StreamingQuery:
    """Running count of entry records per key (the entry side of the cogroup), as a
    table of changes; ``streaming.keyed.cogroup_view`` joins it with the promotions."""
    return count_stream(_records(spark, source).select("key"), "key", target, checkpoint,
                        name="entries", trigger=trigger, as_table=as_table)


def run_transcode(spark: SparkSession, source: Mapping, schema, target: str, checkpoint: str,
                  view_name: str, fmt: str = "avro", trigger: str | None = None,
                  topic: str | None = None) -> StreamingQuery:
    """Q4: JSON records with a known schema -> the same rows re-encoded
    (Avro records, or files of ``fmt``), as a persistent query.  A ``topic``
    is written on the brokers that the source reads from."""
    parsed = declare_stream(_records(spark, source), view_name, schema)
    options = kafka_sink(topic, source.get("options"))["options"] if topic else None
    return transcode_stream(parsed, target, checkpoint, fmt=fmt, trigger=trigger, topic=topic,
                            options=options)
