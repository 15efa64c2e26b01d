"""Command line for the jobs: ``python -m entryflow <job> ...``, or
``spark-submit --py-files entryflow.zip entryflow/__main__.py <job> ...``.

    entries    topic -> parsed entries table                    (Q1)
    winners    topic x promotions -> winners table              (Q2)
    flagged    topic x daily winners -> flagged table + topic   (Q3)
    transcode  JSON topic -> re-encoded stream                  (Q4)
    promotions insert a day's promotions                        (Q10)
    report     run one of the four reports over stored tables   (Q5-Q8)

Credentials are passed as options only and never printed.
"""

from __future__ import annotations

import argparse
from typing import Sequence

from pyspark.sql import SparkSession

from entryflow.operators.payload import REGISTRY_HEADER_BYTES
from entryflow.schemas import load_table_schema
from entryflow.session import apply_defaults
from entryflow.sources.tables import read_static
from entryflow.sinks.topics import kafka_sink
from entryflow.sources.topics import kafka_options


def _source_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--source", choices=["kafka", "json", "parquet"], default="kafka")
    p.add_argument("--path", help="record folder for json/parquet sources")
    p.add_argument("--bootstrap", help="kafka bootstrap servers")
    p.add_argument("--topic", help="kafka topic to read")
    p.add_argument("--api-key")
    p.add_argument("--api-secret")
    p.add_argument("--min-partitions", type=int)
    p.add_argument("--max-offsets-per-trigger", type=int, default=10_000_000,
                   help="records of a micro-batch at most (topics)")
    p.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                   help="further source option, passed through (such as "
                        "kafka.request.timeout.ms=60000)")
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument("--registry-framed", action="store_true",
                   help="values carry a schema-registry frame (5 bytes) before the JSON")


def _sink_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--target", required=True, help="output folder, or table with --as-table")
    p.add_argument("--as-table", action="store_true", help="the target is a catalog table")
    p.add_argument("--metrics-to", help="folder of the table that counts each micro-batch")
    p.add_argument("--dead-letters", help="folder for records that do not parse")
    p.add_argument("--checkpoint", required=True, help="stable checkpoint folder")
    p.add_argument("--trigger", default="60 seconds",
                   help='"available_now", "once" or an interval such as "60 seconds"')


def _source(a: argparse.Namespace) -> dict:
    header = REGISTRY_HEADER_BYTES if getattr(a, "registry_framed", False) else 0
    extra = dict(o.split("=", 1) for o in a.option)
    if a.source == "kafka":
        return {"source": "kafka", "value_header_bytes": header,
                "options": kafka_options(a.bootstrap, a.topic, a.api_key, a.api_secret,
                                         min_partitions=a.min_partitions,
                                         max_offsets_per_trigger=a.max_offsets_per_trigger,
                                         extra=extra)}
    opts = dict(extra)
    if a.max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(a.max_files_per_trigger)
    return {"source": a.source, "path": a.path, "options": opts, "value_header_bytes": header}


def _table(spark: SparkSession, ref: str):
    """A stored table: a catalog name, or a Parquet folder when it has a slash."""
    return read_static(spark, ref, "parquet" if "/" in ref else "table")


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="entryflow")
    sub = parser.add_subparsers(dest="job", required=True)

    p = sub.add_parser("entries")
    _source_args(p)
    _sink_args(p)

    p = sub.add_parser("winners")
    _source_args(p)
    _sink_args(p)
    p.add_argument("--promotions", required=True, help="promotions table or folder")
    p.add_argument("--refresh", choices=["none", "batch"], default="none")

    p = sub.add_parser("flagged")
    _source_args(p)
    _sink_args(p)
    p.add_argument("--daily-winners", required=True, help="daily winners table or folder")
    p.add_argument("--out-topic", help="kafka topic for flagged records")
    p.add_argument("--out-path", help="record folder for flagged records (instead of a topic)")
    p.add_argument("--as-of", default="today", help='"today", "all" or a yyyy-MM-dd day')
    p.add_argument("--entries-unique", action="store_true",
                   help="a second entry of a key goes to the dead letters, or fails the job")
    p.add_argument("--record-ids", action="store_true",
                   help="outgoing records carry an id that a retried batch repeats")

    p = sub.add_parser("transcode")
    _source_args(p)
    _sink_args(p)
    p.add_argument("--schema-json", required=True, help="JSON field-spec file of the values")
    p.add_argument("--format", default="avro")
    p.add_argument("--out-topic")
    p.add_argument("--view", required=True, help="name of the parsed stream's temp view")

    p = sub.add_parser("promotions")
    p.add_argument("--target", required=True)
    p.add_argument("--day", help="yyyyMMdd (default today)")
    p.add_argument("--iso-week-year", action="store_true")
    p.add_argument("--offer", action="append", required=True, metavar="TEXT=NUMBER")

    p = sub.add_parser("report")
    p.add_argument("name", choices=["top_viewed", "posts_by_language", "days_to_answer",
                                    "active_vs_total"])
    for t in ("posts", "questions", "answers", "users"):
        p.add_argument(f"--{t}", required=t == "posts")
    p.add_argument("--out", help="write the result here (Parquet) instead of showing it")
    return parser


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None):
    a = build_parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"entryflow-{a.job}").getOrCreate()
    apply_defaults(spark)
    from entryflow.plans import jobs, reports
    from entryflow.sinks.tables import insert_promotions

    if a.job == "entries":
        return jobs.run_entries(spark, _source(a), a.target, a.checkpoint, a.trigger,
                                as_table=a.as_table, dead_letters=a.dead_letters,
                                metrics_to=a.metrics_to)
    if a.job == "winners":
        return jobs.run_winners(spark, _source(a), lambda: _table(spark, a.promotions),
                                a.target, a.checkpoint, a.trigger, refresh=a.refresh,
                                as_table=a.as_table, metrics_to=a.metrics_to)
    if a.job == "flagged":
        sink = (kafka_sink(a.out_topic, _source(a).get("options"))
                if a.out_topic else {"format": "json", "path": a.out_path})
        as_of = None if a.as_of == "all" else a.as_of
        return jobs.run_flagged(spark, _source(a), lambda: _table(spark, a.daily_winners),
                                a.target, sink, a.checkpoint, a.trigger, as_of=as_of,
                                as_table=a.as_table, dead_letters=a.dead_letters,
                                metrics_to=a.metrics_to, entries_unique=a.entries_unique,
                                record_ids=a.record_ids)
    if a.job == "transcode":
        return jobs.run_transcode(spark, _source(a), load_table_schema(a.schema_json), a.target,
                                  a.checkpoint, a.view, fmt=a.format, trigger=a.trigger,
                                  topic=a.out_topic)
    if a.job == "promotions":
        offers = []
        for o in a.offer:
            text, _, number = o.rpartition("=")
            offers.append((text, int(number)))
        insert_promotions(spark, offers, a.target, a.day, a.iso_week_year)
        return None
    if a.job == "report":
        needed = {"top_viewed": ["posts"], "posts_by_language": ["posts"],
                  "days_to_answer": ["posts", "questions", "answers"],
                  "active_vs_total": ["posts", "questions", "answers", "users"]}[a.name]
        missing = [t for t in needed if not getattr(a, t)]
        if missing:
            build_parser().error(f"{a.name} needs --" + ", --".join(missing))
        df = getattr(reports, a.name)(*[_table(spark, getattr(a, t)) for t in needed])
        if a.out:
            df.write.mode("overwrite").parquet(a.out)
        return df
    raise SystemExit(f"unknown job {a.job}")


def run(argv: Sequence[str] | None = None) -> None:
    """Script entry: start the job; streaming jobs run until stopped."""
    result = main(argv)
    from pyspark.sql.streaming import StreamingQuery
    if isinstance(result, StreamingQuery):
        result.awaitTermination()
    elif result is not None and not build_parser().parse_args(argv).__dict__.get("out"):
        result.show(50, truncate=False)
