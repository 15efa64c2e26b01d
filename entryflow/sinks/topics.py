"""Topic sinks for ``key, value`` records.

``sink`` is a dict: ``{"format": "kafka", "topic": ..., "options": {...}}``
for a topic (needs the Kafka package), or ``{"format": "json"|"parquet",
"path": ...}`` for a folder of record files laid out like a topic.

A topic keeps what a retried micro-batch writes again.  Records with a
``record_id`` carry it in their headers, and ``sources.topics`` can read each once.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, functions as F

from entryflow.operators.numbering import assign_numbers


def kafka_sink(topic: str, source_options: Mapping[str, str] | None) -> dict:
    """Sink on the brokers, and with the credentials, of a topic source's options."""
    return {"format": "kafka", "topic": topic,
            "options": {k: v for k, v in (source_options or {}).items() if k.startswith("kafka.")}}


#: Column, and header of a written record, that identifies it across retries.
RECORD_ID = "record_id"


def with_record_ids(batch: DataFrame, query: str, batch_id: int) -> DataFrame:
    """The records of a micro-batch with ``record_id``: query, batch and position.

    A position is the record's place by (key, value) in the batch as it was read. A batch
    that is run again holds the same records, so each gets the same id, whatever is made
    of it then; equal records change places unseen. Records are numbered by range slices.
    """
    numbered = assign_numbers(batch.withColumn("_all", F.lit(0)), "_all", ["key", "value"], out_col="_at")
    named = F.concat_ws(":", F.lit(query), F.lit(str(batch_id)), F.col("_at").cast("string"))
    return numbered.withColumn(RECORD_ID, named).drop("_all", "_at")


def _records(df: DataFrame) -> DataFrame:
    """``key, value``, and with record ids ``headers`` (as Kafka takes them)."""
    columns = [F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")]
    if RECORD_ID in df.columns:
        header = F.struct(F.lit(RECORD_ID).alias("key"), F.col(RECORD_ID).cast("binary").alias("value"))
        columns.append(F.array(header).alias("headers"))
    return df.select(*columns)


def folder_records(df: DataFrame) -> DataFrame:
    """Records as a topic-like folder keeps them; records with headers have a time, as on a topic."""
    rec = _records(df)
    return rec.withColumn("timestamp", F.current_timestamp()) if "headers" in rec.columns else rec


def write_topic(df: DataFrame, sink: Mapping, mode: str = "append") -> None:
    """Batch write of records to a topic or record folder."""
    fmt = sink.get("format", "kafka")
    if fmt == "kafka":
        w = _records(df).write.format("kafka").option("topic", sink["topic"])
        for k, v in (sink.get("options") or {}).items():
            w = w.option(k, v)
        w.save()
    else:
        folder_records(df).write.mode(mode).format(fmt).save(sink["path"])
