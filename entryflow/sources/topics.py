"""Keyed records from a topic, or from files laid out like one.

The Kafka source needs the ``spark-sql-kafka`` package on the classpath.
Where it is missing, the same functions read ``key, value`` records from
JSON or Parquet files (batch or as a file stream), which is how the tests
drive them.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from entryflow.operators.payload import kv_strings, parse_json
from entryflow.schemas import HEADED_SCHEMA, KV_SCHEMA
from entryflow.sinks.topics import RECORD_ID


def kafka_options(bootstrap_servers: str, topic: str, api_key: str | None = None,
                  api_secret: str | None = None, starting_offsets: str = "earliest",
                  fail_on_data_loss: bool = True, min_partitions: int | None = None,
                  max_offsets_per_trigger: int | None = None, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Source options for a SASL/PLAIN-over-TLS topic, read from the earliest
    offset and failing when offsets were lost.  ``min_partitions`` splits a
    topic with few partitions into more read tasks; ``max_offsets_per_trigger``
    bounds a micro-batch (without it the first one is the whole topic).  ``extra`` passes further
    options (``kafka.request.timeout.ms`` and the like) through unchanged.
    Secrets are placed in the options only, never printed.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true" if fail_on_data_loss else "false",
    }
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if api_key is not None:
        jaas = ("org.apache.kafka.common.security.plain.PlainLoginModule required "
                f'username="{api_key}" password="{api_secret}";')
        opts.update({
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": jaas,
        })
    for k, v in (extra or {}).items():
        opts[k] = str(v)
    return opts


def _file_reader(reader, fmt: str, schema: T.StructType, options: Mapping[str, str] | None):
    r = reader.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r


def _record_id(headers: str = "headers") -> Column:
    """The id that a record's writer gave it (``sinks.topics``), NULL without one."""
    named = F.filter(headers, lambda h: h["key"] == RECORD_ID)
    return F.try_element_at(named, F.lit(1))["value"].cast("string")


def read_records_stream(spark: SparkSession, source: str = "kafka", path: str | None = None,
                        options: Mapping[str, str] | None = None,
                        schema: T.StructType = KV_SCHEMA,
                        value_header_bytes: int = 0, once: str | None = None) -> DataFrame:
    """Streaming ``key, value`` strings from a topic (``source="kafka"``) or
    from a folder of ``json``/``parquet`` files (new files = new records).
    ``value_header_bytes``: see ``operators.payload.kv_strings``.

    ``once`` (a time such as ``"1 hour"``) drops a record whose id came before,
    written by a batch that was run twice; ids are remembered until the
    record times are that far ahead, and records that come later still are
    dropped as late.  Records without an id all stay.
    """
    if source == "kafka":
        r = spark.readStream.format("kafka")
        for k, v in (options or {}).items():
            r = r.option(k, v)
        df = (r.option("includeHeaders", "true") if once else r).load()
    else:
        df = _file_reader(spark.readStream, source, HEADED_SCHEMA if once else schema, options).load(path)
    if once:
        known = df.withColumn(RECORD_ID, _record_id())
        df = (known.where(F.col(RECORD_ID).isNotNull()).withWatermark("timestamp", once)
              .dropDuplicatesWithinWatermark([RECORD_ID]).select("key", "value")
              .unionByName(known.where(F.col(RECORD_ID).isNull()).select("key", "value")))
    return kv_strings(df, value_header_bytes=value_header_bytes)


def read_records_batch(spark: SparkSession, source: str = "kafka", path: str | None = None,
                       options: Mapping[str, str] | None = None,
                       schema: T.StructType = KV_SCHEMA,
                       value_header_bytes: int = 0, once: bool = False) -> DataFrame:
    """Bounded read of everything in the topic (or files) from the start.
    ``once`` keeps one record of each id; records without an id all stay."""
    if source == "kafka":
        r = spark.read.format("kafka")
        opts = dict(options or {})
        opts.setdefault("startingOffsets", "earliest")
        opts.setdefault("endingOffsets", "latest")
        for k, v in opts.items():
            r = r.option(k, v)
        df = (r.option("includeHeaders", "true") if once else r).load()
    else:
        df = _file_reader(spark.read, source, HEADED_SCHEMA if once else schema, options).load(path)
    if once:
        known = df.select("key", "value", _record_id().alias(RECORD_ID))
        df = (known.where(F.col(RECORD_ID).isNotNull()).dropDuplicates([RECORD_ID])
              .unionByName(known.where(F.col(RECORD_ID).isNull())))
    return kv_strings(df, value_header_bytes=value_header_bytes)


def declare_stream(df: DataFrame, name: str, schema: T.StructType,
                   value_col: str = "value") -> DataFrame:
    """A named stream over a topic whose values are JSON of ``schema``.

    The parsed columns are exposed as temp view ``name`` (for ``spark.sql``).
    """
    parsed = parse_json(df, schema, value_col)
    parsed.createOrReplaceTempView(name)
    return parsed


def schema_from_sample(spark: SparkSession, sample_json: str) -> T.StructType:
    """Schema of one sample document (fields come back sorted by name)."""
    ddl = spark.range(1).select(F.schema_of_json(F.lit(sample_json))).head()[0]
    return T._parse_datatype_string(ddl)
