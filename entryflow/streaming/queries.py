"""Structured Streaming building blocks: triggers, appends, fan-out, taps.

Every sink writes with a checkpoint location that must stay the same for a
query across restarts; a restart then resumes after the last committed
micro-batch and writes no duplicates.  Tables are written one way only, by
the table's commit list (``sinks.commits``), where a micro-batch is named by
the query's id and its number.
"""

from __future__ import annotations

import time
from collections import deque
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from entryflow.sinks.commits import commit_rows
from entryflow.sinks.tables import conform, create_table, overwrite_batch
from entryflow.sinks.topics import folder_records, write_topic


def trigger_options(trigger: str | None) -> dict:
    """``available_now`` (drain what is there, then stop), ``once``, or a
    processing-time interval such as ``"60 seconds"``; None = as fast as
    possible."""
    if trigger is None:
        return {}
    if trigger == "available_now":
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


def triggered(writer, trigger: str | None):
    """The writer with its trigger (None: the next micro-batch starts at once)."""
    options = trigger_options(trigger)
    return writer.trigger(**options) if options else writer


def append_stream(df: DataFrame, target: str, checkpoint: str, trigger: str | None = "60 seconds",
                  fmt: str = "parquet", as_table: bool = False,
                  query_name: str | None = None, partition_by: Sequence[str] = (),
                  schema: T.StructType | None = None) -> StreamingQuery:
    """Append each micro-batch to a folder (``fmt``) or a catalog table
    (created from the stream's schema when missing).  With a ``schema`` the
    rows are conformed to it (see ``sinks.tables.conform``).  Other streams
    and batch jobs may write the same target."""
    if as_table:
        create_table(df.sparkSession, target, schema or df.schema, fmt, partition_by=partition_by)
    sink = table_batch_sink(target, fmt=fmt, as_table=as_table, schema=schema,
                            partition_by=partition_by)
    return fan_out(df, [sink], checkpoint, trigger, query_name)


def sync_stream_to_table(df: DataFrame, table: str, checkpoint: str,
                         trigger: str | None = None) -> StreamingQuery:
    """Keep a catalog table in step with a stream; the table takes the
    stream's columns when it has to be created."""
    return append_stream(df, table, checkpoint, trigger, as_table=True)


def run_until_stopped(query: StreamingQuery, timeout_s: float | None = None) -> bool:
    """Block until the query ends (or ``timeout_s`` passes); re-raises the
    query's failure.  Returns whether it has ended."""
    if timeout_s is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(timeout_s))


def stop_gracefully(query: StreamingQuery, timeout_s: float = 120.0, poll_s: float = 0.2) -> None:
    """Stop after the micro-batch in progress has committed (polls the
    query status, not data), or after ``timeout_s`` at the latest."""
    deadline = time.monotonic() + timeout_s
    while query.isActive and query.status.get("isTriggerActive") and time.monotonic() < deadline:
        time.sleep(poll_s)
    query.stop()


def tail_stream(df: DataFrame, name: str, checkpoint: str, rows: int = 1000,
                trigger: str | None = None) -> StreamingQuery:
    """Push query: temp view ``name`` shows the last rows that came, ``rows`` of them at most,
    over as many micro-batches as they span: rows of a quick micro-batch stay in view until
    that many newer ones have come.  (Of a single micro-batch with more rows, some ``rows`` are
    shown.)  The driver holds no more than these."""
    latest: deque = deque(maxlen=rows)

    def show(batch: DataFrame, batch_id: int) -> None:
        new = batch.limit(rows).collect()
        if new:
            latest.extend(new)
            spark = batch.sparkSession
            spark.createDataFrame(list(latest), batch.schema).createOrReplaceGlobalTempView(name)

    return triggered(df.writeStream.option("checkpointLocation", checkpoint).queryName(name),
                     trigger).foreachBatch(show).start()


def with_taps(df: DataFrame, name: str, **metrics: Column) -> DataFrame:
    """Count what passes through without logging payloads: the named
    aggregate metrics appear per micro-batch in
    ``query.lastProgress["observedMetrics"][name]`` (batch: ``Observation``)."""
    if not metrics:
        metrics = {"rows": F.count(F.lit(1))}
    return df.observe(name, *[c.alias(k) for k, c in metrics.items()])


#: Writes a micro-batch; returns False if an earlier attempt had written it (None: it can't tell).
BatchFn = Callable[[DataFrame, int], "bool | None"]


def fan_out(df: DataFrame, sinks: Sequence[BatchFn], checkpoint: str,
            trigger: str | None = "60 seconds", query_name: str | None = None,
            prepare: Callable[[DataFrame, int], DataFrame] | None = None,
            after: Callable[[DataFrame, int, bool], None] | None = None,
            stateful: bool = False) -> StreamingQuery:
    """One source, several sinks: each micro-batch (after ``prepare``) is
    computed once, persisted, and handed to every sink ``fn(batch_df, batch_id)``.

    Sinks should add a batch once (see ``table_batch_sink``), so that a
    retried batch does not duplicate rows.  ``after`` is told whether every
    sink wrote.  The batch of a ``stateful`` stream is persisted before
    ``prepare``, so that its state is updated in one pass.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        held = [batch.persist()] if stateful else []
        rows = prepare(batch, batch_id) if prepare else batch
        if len(sinks) > 1:
            held.append(rows.persist())
        try:
            written = [sink(rows, batch_id) for sink in sinks]
            if after is not None:
                after(batch, batch_id, False not in written)
        finally:
            for frame in held:
                frame.unpersist()

    w = triggered(df.writeStream.option("checkpointLocation", checkpoint), trigger).foreachBatch(run)
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query whose micro-batch this is; it is kept in the query's
    checkpoint, so it outlives restarts and is new for a new checkpoint."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("no micro-batch of a streaming query: name the writer")
    return found


def table_batch_sink(target: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                     fmt: str = "parquet", as_table: bool = False,
                     schema: T.StructType | None = None, partition_by: Sequence[str] = (),
                     part: str = "rows", writer: str | None = None) -> BatchFn:
    """Sink adding ``transform(batch)``, conformed to ``schema`` if given, to a
    folder or catalog table, once per (query, batch).  Several sinks of a query
    on one target need different names of their ``part``."""
    session = SparkSession.getActiveSession()

    def sink(batch: DataFrame, batch_id: int) -> bool:
        out = transform(batch) if transform else batch
        new = commit_rows(conform(out, schema) if schema is not None else out, target,
                          f"{writer or query_id(batch)}.{part}", batch_id, fmt, as_table, partition_by)
        if as_table and session is not None:  # a micro-batch has a session of its own
            session.catalog.refreshTable(target)
        return new
    return sink


def topic_batch_sink(sink: Mapping, transform: Callable[[DataFrame], DataFrame] | None = None
                     ) -> BatchFn:
    """Sink writing ``key, value`` records of ``transform(batch)``.

    Record folders: each batch goes to its own sub-folder, replaced on a
    retry (exactly once).  Kafka topics: a retried batch writes its records
    again (at least once); records with ids (``sinks.topics.with_record_ids``)
    are read once by ``sources.topics`` with ``once``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        if sink.get("format", "kafka") == "kafka":
            write_topic(out, sink)
        else:
            overwrite_batch(folder_records(out), sink["path"], batch_id, sink.get("format", "json"))
    return write


def transcode_stream(df: DataFrame, target: str, checkpoint: str, fmt: str = "avro",
                     trigger: str | None = None, topic: str | None = None,
                     options: Mapping[str, str] | None = None) -> StreamingQuery:
    """Re-encode a parsed stream into another value format, as a persistent
    query.  ``fmt="avro"`` writes ``key, value`` records whose value is Avro
    (needs the spark-avro package; to a topic when ``topic`` is given);
    other formats write the columns to files of that format."""
    if fmt == "avro":
        from pyspark.sql.avro.functions import to_avro  # needs the spark-avro package
        rec = df.select(F.lit(None).cast("string").alias("key"),
                        to_avro(F.struct(*df.columns)).alias("value"))
        w = triggered(rec.writeStream.option("checkpointLocation", checkpoint), trigger)
        if topic:
            w = w.format("kafka").option("topic", topic)
            for k, v in (options or {}).items():
                w = w.option(k, v)
            return w.start()
        return w.format("parquet").start(target)
    return append_stream(df, target, checkpoint, trigger, fmt=fmt)
