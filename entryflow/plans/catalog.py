"""Named queries over the driver's tables: ``name -> fn(spark, sf_dir)``."""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from entryflow.functions.keys import day_key, iso_day_key, strip_dashes
from entryflow.operators.matching import cogroup_summary
from entryflow.operators.numbering import assign_numbers
from entryflow.operators.payload import add_json_field, split_objects
from entryflow.plans import chartdata, jobs, raffle, reports, sql_reports
from entryflow.schemas import (
    ENTRIES_TABLE, FLAGGED_TABLE, POSTS_TABLE, PROMOTIONS_TABLE, WINNERS_TABLE,
)
from entryflow.session import scratch_path
from entryflow.sinks.bucketed import buckets_for, write_by_question
from entryflow.sinks.commits import compact, read_table
from entryflow.sinks.tables import append_table, create_table, insert_promotions
from entryflow.sinks.topics import with_record_ids, write_topic
from entryflow.sources import driver_tables as dt
from entryflow.sources.topics import read_records_batch, read_records_stream
from entryflow.streaming.keyed import cogroup_view
from entryflow.streaming.queries import append_stream, sync_stream_to_table

AS_OF_DAY = "2024-01-15"
#: A day without entries in the test tables.
INSERT_DAY = "20310102"


def _qa(spark: SparkSession, sf: str):
    return dt.posts(spark, sf), dt.questions(spark, sf), dt.answers(spark, sf), dt.users(spark, sf)


# -- raffle entries --------------------------------------------------------

def entries_parsed(spark, sf):
    return raffle.entries_table(dt.entries_kv(spark, sf))


def winners_inner(spark, sf):
    return raffle.winners(dt.entries_kv(spark, sf), dt.promotions(spark, sf))


def flagged_entries(spark, sf):
    return raffle.flag_entries(dt.entries_kv(spark, sf), dt.daily_winners(spark, sf))


def flagged_records(spark, sf):
    records = raffle.flagged_records(dt.entries_kv(spark, sf), dt.daily_winners(spark, sf))
    return raffle.decode_records(records)


def cogroup_counts(spark, sf):
    kv = dt.entries_kv(spark, sf)
    keys = raffle.promotion_keys(dt.daily_winners(spark, sf))
    return cogroup_summary(kv.select("key"), keys.select("key"), "key",
                           left_name="entries", right_name="promotions")


def unique_promotions(spark, sf):
    return raffle.unique_promotions(dt.promotions(spark, sf), "first")


def promotions_for_day(spark, sf):
    return raffle.promotion_keys(dt.daily_winners(spark, sf), as_of=AS_OF_DAY)


def assign_numbers_q(spark, sf):
    ev = dt.table(spark, sf, "events").select("event_id", "ts", day_key("ts").alias("day"))
    return assign_numbers(ev, "day", ["ts", "event_id"], out_col="participation_number") \
        .select("event_id", "day", "participation_number")


def assign_numbers_split(spark, sf):
    """The same numbering in a given number of slices, more than there are
    days, so that every day is spread over several; checked against the same SQL."""
    ev = dt.table(spark, sf, "events").select("event_id", "ts", day_key("ts").alias("day"))
    return assign_numbers(ev, "day", ["ts", "event_id"], out_col="participation_number",
                          num_partitions=64).select("event_id", "day", "participation_number")


def produce_records(spark, sf):
    """Q11: number the day's new entries, encode them as topic records
    (decoded again here for the check)."""
    records, _ = raffle.produce_entries(dt.new_entries(spark, sf), ["ts", "event_id"])
    return raffle.decode_records(records).drop("winner")


def day_keys(spark, sf):
    ev = dt.table(spark, sf, "events").where(F.col("ts").isNotNull())
    per_day = ev.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("events"))
    return per_day.select("day", day_key("day").alias("calendar_key"),
                          iso_day_key("day").alias("iso_key"),
                          strip_dashes("day").alias("stripped"), "events")


# -- the same jobs as streams (file-fed, run to completion) ----------------

#: Files of a micro-batch: what bounds a batch here, as offsets do on a topic.
FILES_PER_BATCH = 64


def _stream_run(spark, name: str, records: DataFrame) -> tuple[str, dict]:
    """Lay the records out as a topic-like folder, a file per partition of
    the records, read ``FILES_PER_BATCH`` files per micro-batch."""
    run = scratch_path(spark, "runs", name)
    records.write.parquet(f"{run}/input")
    return run, {"source": "parquet", "path": f"{run}/input",
                 "options": {"maxFilesPerTrigger": str(FILES_PER_BATCH)}}


def _created(spark, run: str, schema) -> str:
    """A new catalog table with the declared columns, stored below ``run``."""
    name = f"entryflow_{uuid.uuid4().hex}"
    create_table(spark, name, schema, location=f"{run}/table")
    return name


def entries_stream(spark, sf):
    run, src = _stream_run(spark, "entries", dt.entries_kv(spark, sf))
    jobs.run_entries(spark, src, f"{run}/out", f"{run}/checkpoint",
                     trigger="available_now").awaitTermination()
    return spark.read.parquet(f"{run}/out")


def winners_stream(spark, sf):
    run, src = _stream_run(spark, "winners", dt.entries_kv(spark, sf))
    jobs.run_winners(spark, src, dt.promotions(spark, sf), f"{run}/out", f"{run}/checkpoint",
                     trigger="available_now").awaitTermination()
    return spark.read.parquet(f"{run}/out")


def flagged_stream(spark, sf):
    run, src = _stream_run(spark, "flagged", dt.entries_kv(spark, sf))
    winners = dt.daily_winners(spark, sf)
    jobs.run_flagged(spark, src, winners, f"{run}/table",
                     {"format": "json", "path": f"{run}/topic"}, f"{run}/checkpoint",
                     trigger="available_now", as_of=None).awaitTermination()
    return spark.read.parquet(f"{run}/table")


def flagged_topic_stream(spark, sf):
    """Q3's topic side: the records it sent, read back and decoded."""
    run, src = _stream_run(spark, "flagged_topic", dt.entries_kv(spark, sf))
    jobs.run_flagged(spark, src, dt.daily_winners(spark, sf), f"{run}/table",
                     {"format": "json", "path": f"{run}/topic"}, f"{run}/checkpoint",
                     trigger="available_now", as_of=None).awaitTermination()
    return raffle.decode_records(read_records_batch(spark, "json", f"{run}/topic"))


def entries_into_table(spark, sf):
    """Q1 into a catalog table that was created with declared columns (K1, K2, K7)."""
    run, src = _stream_run(spark, "entries_table", dt.entries_kv(spark, sf))
    name = _created(spark, run, ENTRIES_TABLE)
    jobs.run_entries(spark, src, name, f"{run}/checkpoint", trigger="available_now",
                     as_table=True).awaitTermination()
    return spark.table(name)


def winners_into_table(spark, sf):
    """Q2 with promotions re-read per micro-batch (T9), into a created table."""
    run, src = _stream_run(spark, "winners_table", dt.entries_kv(spark, sf))
    name = _created(spark, run, WINNERS_TABLE)
    jobs.run_winners(spark, src, lambda: dt.promotions(spark, sf), name, f"{run}/checkpoint",
                     trigger="available_now", refresh="batch", as_table=True).awaitTermination()
    return spark.table(name)


def flagged_into_table(spark, sf):
    """Q3's table side into a created table, dead letters apart."""
    run, src = _stream_run(spark, "flagged_table", dt.entries_kv(spark, sf))
    name = _created(spark, run, FLAGGED_TABLE)
    jobs.run_flagged(spark, src, dt.daily_winners(spark, sf), name,
                     {"format": "json", "path": f"{run}/topic"}, f"{run}/checkpoint",
                     trigger="available_now", as_of=None, as_table=True,
                     dead_letters=f"{run}/dead").awaitTermination()
    return spark.table(name)


def synced_table(spark, sf):
    """K5: a catalog table kept in step with a stream, created by it."""
    run, src = _stream_run(spark, "synced", dt.entries_kv(spark, sf))
    name = f"entryflow_{uuid.uuid4().hex}"
    stream = raffle.entries_table(read_records_stream(spark, src["source"], src["path"],
                                                      src["options"]))
    sync_stream_to_table(stream, name, f"{run}/checkpoint", "available_now").awaitTermination()
    return spark.table(name)


def _entries_batch(spark, name, kv):
    append_table(raffle.entries_table(kv), name, ENTRIES_TABLE, by_path=False)


def _mixed(name: str, *writers: str):
    """A table that several writers fill one after the other; each adds every entry."""
    def run(spark, sf):
        kv = dt.entries_kv(spark, sf)
        folder, src = _stream_run(spark, name, kv)
        kv = read_records_batch(spark, src["source"], src["path"])
        table = _created(spark, folder, ENTRIES_TABLE)
        for writer in writers:
            if writer == "batch":
                _entries_batch(spark, table, kv)
            else:
                jobs.run_entries(spark, src, table, f"{folder}/checkpoint_{writer}", "available_now", as_table=True,
                                 dead_letters=f"{folder}/dead" if writer == "dead" else None).awaitTermination()
        return spark.table(table)
    run.__name__, run.__doc__ = name, f"K1, K2, Q1: a table written by {', then '.join(writers)}."
    return run


def mixed_writers_refresh(spark, sf):
    """Q2 on one folder in both of its modes, read by the folder's commit list."""
    run, src = _stream_run(spark, "winners_mixed", dt.entries_kv(spark, sf))
    for refresh in ("none", "batch"):
        jobs.run_winners(spark, src, dt.promotions(spark, sf), f"{run}/out", f"{run}/checkpoint_{refresh}",
                         "available_now", refresh).awaitTermination()
    return read_table(spark, f"{run}/out")


def compacted_entries(spark, sf):
    """Q1 into a folder whose small files are then merged; a reader of the commit list gets the
    merged ones before they replace the small ones."""
    run, src = _stream_run(spark, "compacted", dt.entries_kv(spark, sf))
    for i in range(2):
        jobs.run_entries(spark, src, f"{run}/out", f"{run}/checkpoint_{i}", "available_now").awaitTermination()
    compact(spark, f"{run}/out")
    return read_table(spark, f"{run}/out")


def cogroup_stream(spark, sf):
    """J2 on a stream: running counts of entries per key over micro-batches and a restart, cogrouped
    with the promotions."""
    kv = dt.entries_kv(spark, sf)
    run = scratch_path(spark, "runs", "cogroup")
    src = {"source": "parquet", "path": f"{run}/input", "options": {"maxFilesPerTrigger": "1"}}
    kv = kv.repartition(3, "key")
    for half in (F.crc32("key") % 2 == 0, F.crc32("key") % 2 == 1):
        kv.where(half).write.mode("append").parquet(f"{run}/input")
        jobs.run_cogroup(spark, src, f"{run}/counts", f"{run}/checkpoint", "available_now").awaitTermination()
    keys = raffle.promotion_keys(dt.daily_winners(spark, sf))
    return cogroup_view(read_table(spark, f"{run}/counts"), keys, "key", left_name="entries", right_name="promotions")


def unique_entries_stream(spark, sf):
    """J4 on a stream: Q3 with every entry record sent twice, in different micro-batches; the guard
    lets one of each through and puts the other to the dead letters."""
    kv = dt.entries_kv(spark, sf)
    run = scratch_path(spark, "runs", "unique")
    src = {"source": "parquet", "path": f"{run}/input", "options": {"maxFilesPerTrigger": str(FILES_PER_BATCH)}}
    for _ in range(2):
        kv.write.mode("append").parquet(f"{run}/input")
        jobs.run_flagged(spark, src, dt.daily_winners(spark, sf), f"{run}/table",
                         {"format": "json", "path": f"{run}/topic"}, f"{run}/checkpoint", "available_now",
                         as_of=None, dead_letters=f"{run}/dead", entries_unique=True,
                         unique_delay="36500 days").awaitTermination()
    return read_table(spark, f"{run}/table")


def inserted_promotions(spark, sf):
    """K6, Q10: the offers of a day appended to a created promotions table, beside
    those of the days in the test tables."""
    run = scratch_path(spark, "runs", "promotions")
    name = _created(spark, run, PROMOTIONS_TABLE)
    append_table(dt.promotions(spark, sf), name, PROMOTIONS_TABLE, by_path=False)
    insert_promotions(spark, dt.PROMOTION_OFFERS, name, INSERT_DAY)
    return spark.table(name)


def records_round_trip(spark, sf):
    """K8, S7: numbered entries written as keyed records, read back bounded."""
    run = scratch_path(spark, "runs", "records")
    records, _ = raffle.produce_entries(dt.new_entries(spark, sf), ["ts", "event_id"])
    write_topic(records, {"format": "json", "path": f"{run}/topic"})
    return raffle.decode_records(read_records_batch(spark, "json", f"{run}/topic")).drop("winner")


def json_fields_kept(spark, sf):
    """P10: one field added to JSON documents of any shape, the others kept; some
    values are no objects and go to the dead letters (``kept`` false)."""
    ev = dt.table(spark, sf, "events")
    odd = F.col("event_id") % 10 == 3
    doc = F.to_json(F.struct(
        F.col("event_id").alias("id"), (F.col("event_id") + 0.25).alias("score"),
        F.struct(F.array("event_id", F.lit(None)).alias("list"), F.lit("x").alias("name")).alias("inner"),
        F.lit("old").alias("winner")))
    records = ev.select(F.col("event_id").cast("string").alias("key"),
                        F.when(odd, F.lit("not json")).otherwise(doc).alias("value"))
    good, bad = split_objects(records)
    added = good.select("key", add_json_field("value", "winner", F.lit(True)).alias("value"))
    return added.withColumn("kept", F.lit(True)).union(bad.withColumn("kept", F.lit(False)))


def numbered_stream(spark, sf):
    """T14 on a stream: per-day numbers continued across micro-batches;
    summarised per day (rows, lowest, highest and distinct numbers)."""
    from entryflow.streaming.numbering import number_stream
    base = dt.table(spark, sf, "events").select("event_id", "ts", day_key("ts").alias("day"))
    run, src = _stream_run(spark, "numbered", base)
    stream = spark.readStream.schema(base.schema).options(**src["options"]).parquet(src["path"])
    number_stream(stream, "day", ["ts", "event_id"], "n", f"{run}/out", f"{run}/state",
                  f"{run}/checkpoint", trigger="available_now").awaitTermination()
    out = spark.read.parquet(f"{run}/out")
    return out.groupBy("day").agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("min_n"),
                                  F.max("n").alias("max_n"),
                                  F.countDistinct("n").alias("distinct_n"))


def transcode_posts(spark, sf):
    posts = dt.posts(spark, sf)
    records = posts.select(F.col("url").alias("key"),
                           F.to_json(F.struct(*posts.columns)).alias("value"))
    run, src = _stream_run(spark, "transcode", records)
    jobs.run_transcode(spark, src, POSTS_TABLE, f"{run}/out", f"{run}/checkpoint",
                       f"posts_{uuid.uuid4().hex}", fmt="parquet",
                       trigger="available_now").awaitTermination()
    return spark.read.parquet(f"{run}/out")


# -- reports ---------------------------------------------------------------

def top_viewed(spark, sf):
    return reports.top_viewed(dt.posts(spark, sf))


def posts_by_language(spark, sf):
    return reports.posts_by_language(dt.posts(spark, sf))


def days_to_answer(spark, sf):
    p, q, a, _ = _qa(spark, sf)
    return reports.days_to_answer(p, q, a)


def active_vs_total(spark, sf):
    return reports.active_vs_total(*_qa(spark, sf))


#: Buckets of the tables stored by question at least; more answers get more (``buckets_for``).
QA_BUCKETS = 8


def _by_question(report):
    """A report of questions and answers on tables stored by question."""
    def run(spark, sf):
        p, q, a, u = _qa(spark, sf)
        names = [f"entryflow_{uuid.uuid4().hex}" for _ in range(2)]
        buckets = buckets_for(a, QA_BUCKETS)
        write_by_question(spark, q, a, *names, buckets=buckets)
        return report(p, *map(spark.table, names), u, buckets)
    return run


def records_once(spark, sf):
    """K3, S7: flagged records of which every one was sent twice, by a batch that was run again,
    each read once."""
    run = scratch_path(spark, "runs", "once")
    kv = with_record_ids(dt.entries_kv(spark, sf), "raffle", 0)
    for _ in range(2):
        flagged = raffle.flag_keys(kv, dt.daily_winners(spark, sf))
        write_topic(raffle.flagged_to_records(flagged), {"format": "parquet", "path": f"{run}/topic"})
    return raffle.decode_records(read_records_batch(spark, "parquet", f"{run}/topic", once=True))


def records_once_stream(spark, sf):
    """The same on a stream (S1), the ids remembered for an hour of record time."""
    run = scratch_path(spark, "runs", "once_stream")
    for _ in range(2):
        kv = with_record_ids(dt.entries_kv(spark, sf), "raffle", 0)
        flagged = raffle.flag_keys(kv, dt.daily_winners(spark, sf))
        write_topic(raffle.flagged_to_records(flagged), {"format": "parquet", "path": f"{run}/topic"})
    stream = read_records_stream(spark, "parquet", f"{run}/topic", {"maxFilesPerTrigger": str(FILES_PER_BATCH)},
                                 once="1 hour")
    append_stream(stream, f"{run}/out", f"{run}/checkpoint", "available_now").awaitTermination()
    return raffle.decode_records(read_table(spark, f"{run}/out"))


def _sql_report(name: str):
    def run(spark, sf):
        prefix = f"report_{uuid.uuid4().hex}_"
        sql_reports.register_report_views(spark, *_qa(spark, sf), prefix=prefix)
        return sql_reports.run_report(spark, name, prefix)
    run.__name__ = f"{name}_sql"
    run.__doc__ = f"The {name} report as Spark SQL over temp views."
    return run


def tag_unnest(spark, sf):
    return reports.tag_rows(dt.posts(spark, sf), "url")


def classify_tags(spark, sf):
    return reports.tag_rows(dt.posts(spark, sf), "url").withColumn(
        reports.LANG, reports.classify("tag"))


def union_distinct_users(spark, sf):
    return reports.active_user_years(*_qa(spark, sf))


def running_total_users(spark, sf):
    return reports.users_running_total(dt.users(spark, sf))


def language_rollup(spark, sf):
    return chartdata.language_rollup(days_to_answer(spark, sf))


def yearly_answer_days(spark, sf):
    return chartdata.yearly_answer_days(days_to_answer(spark, sf))


def yearly_active(spark, sf):
    return chartdata.yearly_active(active_vs_total(spark, sf))


def user_share(spark, sf):
    return chartdata.user_share(active_vs_total(spark, sf))


def record_count_by_year(spark, sf):
    """The charts' default metric: rows of the days-to-answer report per year."""
    return chartdata.record_count(days_to_answer(spark, sf), "year")


PREVIEW_ROWS = 100


def preview(spark, sf):
    """A preview of the winners table: its first rows by day, number and promotion."""
    rows = raffle.winners(dt.entries_kv(spark, sf), dt.promotions(spark, sf))
    return rows.orderBy("day", "participation_number", "promotion").limit(PREVIEW_ROWS)


def preview_entries(spark, sf):
    rows = raffle.entries_table(dt.entries_kv(spark, sf))
    return rows.orderBy("day", "participation_number").limit(PREVIEW_ROWS)


def preview_promotions(spark, sf):
    rows = dt.promotions(spark, sf)
    return rows.orderBy("day", "participation_number", "promotion").limit(PREVIEW_ROWS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "entries_parsed": entries_parsed,
    "winners_inner": winners_inner,
    "flagged_entries": flagged_entries,
    "flagged_records": flagged_records,
    "cogroup_counts": cogroup_counts,
    "unique_promotions": unique_promotions,
    "promotions_for_day": promotions_for_day,
    "assign_numbers": assign_numbers_q,
    "assign_numbers_split": assign_numbers_split,
    "produce_records": produce_records,
    "day_keys": day_keys,
    "top_viewed": top_viewed,
    "posts_by_language": posts_by_language,
    "days_to_answer": days_to_answer,
    "active_vs_total": active_vs_total,
    "tag_unnest": tag_unnest,
    "classify_tags": classify_tags,
    "union_distinct_users": union_distinct_users,
    "running_total_users": running_total_users,
    "language_rollup": language_rollup,
    "yearly_answer_days": yearly_answer_days,
    "yearly_active": yearly_active,
    "user_share": user_share,
    "record_count_by_year": record_count_by_year,
    "preview": preview,
    "preview_entries": preview_entries,
    "preview_promotions": preview_promotions,
    "json_fields_kept": json_fields_kept,
    "records_round_trip": records_round_trip,
    "inserted_promotions": inserted_promotions,
    "entries_into_table": entries_into_table,
    "winners_into_table": winners_into_table,
    "flagged_into_table": flagged_into_table,
    "flagged_topic_stream": flagged_topic_stream,
    "synced_table": synced_table,
    "entries_stream": entries_stream,
    "winners_stream": winners_stream,
    "flagged_stream": flagged_stream,
    "transcode_posts": transcode_posts,
    "numbered_stream": numbered_stream,
    "mixed_writers_batch_first": _mixed("mixed_writers_batch_first", "batch", "stream"),
    "mixed_writers_stream_first": _mixed("mixed_writers_stream_first", "stream", "batch"),
    "mixed_writers_dead_letters": _mixed("mixed_writers_dead_letters", "stream", "dead"),
    "mixed_writers_refresh": mixed_writers_refresh,
    "compacted_entries": compacted_entries,
    "cogroup_stream": cogroup_stream,
    "records_once": records_once,
    "records_once_stream": records_once_stream,
    "days_to_answer_bucketed": _by_question(
        lambda p, q, a, _, buckets: reports.days_to_answer(p, q, a, buckets=buckets)),
    "active_vs_total_bucketed": _by_question(lambda p, q, a, u, _: reports.active_vs_total(p, q, a, u)),
    "unique_entries_stream": unique_entries_stream,
    **{f"{name}_sql": _sql_report(name) for name in sql_reports.REPORTS},
}
