"""Counts of what passes a job, as rows of a table: never payloads.

``Taps`` counts inside a micro-batch, with Spark's ``Observation`` on the frames that
the sinks write, so counting costs no pass of its own. The counts of a micro-batch are
one commit (query, batch) of the metrics table: a retried batch counts once.

``ObservedLog`` is a listener that writes the same rows from what a stream observes before
its micro-batch reaches a sink.

``ProgressLog`` is a listener that adds a row per micro-batch from the query's own
progress: input rows, rows that came too late for the state, rows held in state.
"""

from __future__ import annotations

import json
import threading
import time
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from entryflow.sinks.commits import commit_rows
from entryflow.streaming.queries import query_id

METRICS_TABLE = T.StructType([
    T.StructField("job", T.StringType(), False), T.StructField("query", T.StringType(), False),
    T.StructField("batch_id", T.LongType(), False), T.StructField("metric", T.StringType(), False),
    T.StructField("value", T.LongType(), True)])

PROGRESS_TABLE = T.StructType([
    T.StructField("query", T.StringType(), False), T.StructField("name", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), False), T.StructField("at", T.TimestampType(), True),
    T.StructField("input_rows", T.LongType(), True), T.StructField("late_rows", T.LongType(), True),
    T.StructField("state_rows", T.LongType(), True), T.StructField("duration_ms", T.LongType(), True),
    T.StructField("observed", T.StringType(), True)])


class Taps:
    """Counts of one job's micro-batches; without a ``target`` nothing is counted."""

    def __init__(self, job: str, target: str | None):
        self.job, self.target = job, target
        self._open: list[tuple[str, Observation, DataFrame, dict[str, Column]]] = []

    def on(self, df: DataFrame, name: str, **metrics: Column) -> DataFrame:
        """The frame, with its aggregates counted when it is written."""
        if self.target is None:
            return df
        seen = Observation()
        self._open.append((name, seen, df, metrics))
        return df.observe(seen, *[c.alias(k) for k, c in metrics.items()])

    def commit(self, batch: DataFrame, batch_id: int, written: bool, **known: int) -> None:
        """Write the counts of a micro-batch. If its rows were committed by an earlier attempt,
        no frame was evaluated in this one; it is then counted by itself."""
        found, self._open = self._open, []
        if self.target is None:
            return
        values = dict(known)
        for name, seen, df, metrics in found:
            got = _observed(seen) if written else None
            if got is None:
                got = df.agg(*[c.alias(k) for k, c in metrics.items()]).first().asDict()
            values.update({f"{name}.{k}": int(got[k]) for k in metrics})
        _commit(batch.sparkSession, self.target, self.job, query_id(batch), batch_id, values)


def _commit(spark: SparkSession, target: str, job: str, query: str, batch_id: int, values: dict[str, int]) -> None:
    rows = [(job, query, batch_id, k, v) for k, v in sorted(values.items())]
    commit_rows(spark.createDataFrame(rows, METRICS_TABLE).coalesce(1), target, f"{query}.metrics", batch_id)


def _observed(seen: Observation, patience_s: float = 5.0) -> dict | None:
    """What was observed; None if the planner left the frame out (a join with an empty side)."""
    until = time.monotonic() + patience_s
    while not seen._jo.future().isCompleted():  # Spark tells it shortly after the write
        if time.monotonic() > until:
            return None
        time.sleep(0.02)
    return seen.get


class _Listener(StreamingQueryListener):
    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class ObservedLog(_Listener):
    """Adds what one query's stream observes (``queries.with_taps``) to the metrics table, for
    jobs whose micro-batch is computed before it reaches their sink."""

    def __init__(self, spark: SparkSession, job: str, target: str, **known: int):
        super().__init__()
        self.spark, self.job, self.target, self.known = spark, job, target, known
        self._query, self._given = None, threading.Event()

    def follow(self, query: StreamingQuery) -> StreamingQuery:
        self._query = str(query.id)
        self._given.set()
        return query

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._given.wait(30)  # the first micro-batch may end before start() returns
        if str(p.id) != self._query or not p.observedMetrics:
            return
        values = {f"{tap}.{k}": int(v) for tap, row in p.observedMetrics.items() for k, v in row.asDict().items()}
        _commit(self.spark, self.target, self.job, self._query, p.batchId, {**self.known, **values})


class ProgressLog(_Listener):
    """Adds each micro-batch's progress to a table; register with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, target: str):
        super().__init__()
        self.spark, self.target = spark, target

    def onQueryProgress(self, event) -> None:
        p = event.progress
        states = p.stateOperators
        observed = {name: row.asDict() for name, row in p.observedMetrics.items()}
        row = (str(p.id), p.name, p.batchId, datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")),
               p.numInputRows, sum(s.numRowsDroppedByWatermark for s in states),
               sum(s.numRowsTotal for s in states), p.batchDuration, json.dumps(observed, sort_keys=True))
        commit_rows(self.spark.createDataFrame([row], PROGRESS_TABLE).coalesce(1), self.target,
                    f"{p.id}.progress", p.batchId)


def metrics_by_batch(spark: SparkSession, target: str) -> DataFrame:
    """``job, query, batch_id`` with a column per metric."""
    from entryflow.sinks.commits import read_table
    rows = read_table(spark, target, schema=METRICS_TABLE)
    return rows.groupBy("job", "query", "batch_id").pivot("metric").agg(F.first("value"))
