"""Keyed state on a stream: cogroup counts, and the guard against repeated keys.

``count_stream`` keeps one running count per key in Spark's state store (update mode: a
micro-batch gives the new totals of the keys it touched) and commits the changes to a
table; ``cogroup_view`` joins the latest totals with the other side. No key's rows are
gathered.

``mark_seen`` remembers which keys came in earlier micro-batches, for the days that are
still open: the state of a day's keys ends when the watermark passes the end of the day.
This is the only Python code of the streams; it sees keys in Arrow batches, not rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from entryflow.operators.matching import join_sides, side_counts
from entryflow.sinks.commits import commit_rows
from entryflow.streaming.queries import query_id, triggered

DAY_MS = 24 * 3600 * 1000


# -- cogroup ------------------------------------------------------------------

def count_stream(df: DataFrame, key: str, target: str, checkpoint: str, value: str | None = None,
                 name: str = "left", trigger: str | None = "60 seconds", as_table: bool = False,
                 event_time: str | None = None, delay: str | None = None) -> StreamingQuery:
    """Running count (and least ``value``) per key, as a table of changes ``key, n_<name>,
    only_<name>``: a row per key and micro-batch that touched it.

    Without ``event_time`` a key's total is kept for good. With it, totals are kept per key
    and time (a day, say) and their state is dropped once the watermark, ``delay`` behind
    the latest time, has passed; rows that come later still are dropped by Spark and
    counted in the query's progress (``numRowsDroppedByWatermark``).
    """
    keys = [F.col(key).alias(key)]
    if event_time is not None:
        df = df.withWatermark(event_time, delay or "0 seconds")
        keys.append(F.col(event_time).alias(event_time))
    totals = side_counts(df, keys, value, name)

    def commit(batch: DataFrame, batch_id: int) -> None:
        commit_rows(batch, target, f"{query_id(batch)}.counts", batch_id, as_table=as_table)

    writer = totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).foreachBatch(commit).start()


def latest_counts(changes: DataFrame, key: str, value: str | None = None, name: str = "left",
                  event_time: str | None = None) -> DataFrame:
    """The last total of each key: totals only grow (and least values fall), so the last is
    the greatest, whatever the order of the rows."""
    def last(rows: DataFrame, keys: list[str], count: Callable) -> DataFrame:
        only = [F.min(f"only_{name}").alias(f"only_{name}")] if value else []
        return rows.groupBy(*keys).agg(count(f"n_{name}").alias(f"n_{name}"), *only)

    if event_time is None:
        return last(changes, [key], F.max)
    return last(last(changes, [key, event_time], F.max), [key], F.sum)


def cogroup_view(changes: DataFrame, right: DataFrame, key: str, left_value: str | None = None,
                 right_value: str | None = None, left_name: str = "left", right_name: str = "right",
                 event_time: str | None = None) -> DataFrame:
    """``cogroup_summary`` of everything the stream has counted with the other side as it is now."""
    left = latest_counts(changes, key, left_value, left_name, event_time)
    return join_sides(left, side_counts(right, [F.col(key).alias(key)], right_value, right_name), key,
                      left_value, right_value, left_name, right_name)


# -- repeated keys --------------------------------------------------------------

_SEEN = T.StructType([T.StructField("keys", T.BinaryType())])
#: Bytes of a key's hash, and parts that a day's keys are dealt into: each is one state.
_HASH, BUCKETS = 16, 16


def entry_day(key: str | Column = "key") -> Column:
    """Start of the day that a record key ``yyyyMMdd_<n>`` names; NULL for other keys and
    for days to come (which would close all earlier days)."""
    day = F.try_to_timestamp(F.regexp_extract(key, r"^(\d{8})_", 1), F.lit("yyyyMMdd"))
    return F.when(day <= F.current_timestamp() + F.expr("interval 1 day"), day)


def mark_seen(df: DataFrame, key: str = "key", day: Column | None = None,
              delay: str = "3 days", buckets: int = BUCKETS) -> DataFrame:
    """The rows of a stream with ``seen``: whether their key came in an earlier micro-batch.

    State is the 128-bit hashes of an open day's keys, dealt into ``buckets`` by hash, so a
    day with most of the rows is spread over tasks (a state is read and written whole in each
    micro-batch that touches it: give a day of very many keys more buckets). It ends when
    the watermark (``delay`` behind the latest day) passes the day's end. Rows without a key
    or day are passed on with ``seen`` false. Rows of a closed day can not be checked; Spark
    drops them before the state and counts them (``numRowsDroppedByWatermark``), so choose
    ``delay`` beyond what is late.
    """
    columns = df.columns
    timed = df.withColumn("_day", entry_day(key) if day is None else day)
    checked = (timed.where(F.col(key).isNotNull() & F.col("_day").isNotNull())
               .withColumn("_hash", F.unhex(F.md5(F.col(key).cast("string"))))
               .withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
               .withWatermark("_day", delay))
    others = timed.where(F.col(key).isNull() | F.col("_day").isNull()).select(*columns, F.lit(False).alias("seen"))
    out = T.StructType([*df.schema.fields, T.StructField("seen", T.BooleanType())])

    def look(at: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        old = bytes(state.get[0]) if state.exists else b""
        seen = {old[i:i + _HASH] for i in range(0, len(old), _HASH)}
        new: set[bytes] = set()
        for part in rows:  # a state's rows come in Arrow batches, one at a time
            hashes = [bytes(h) for h in part["_hash"]]
            part["seen"] = [h in seen for h in hashes]
            new.update(hashes)
            yield part[[*columns, "seen"]]
        state.update((b"".join(sorted(seen | new)),))
        until = int(pd.Timestamp(at[0]).timestamp() * 1000) + DAY_MS
        state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))

    marked = checked.groupBy("_day", "_bucket").applyInPandasWithState(
        look, out, _SEEN, "append", GroupStateTimeout.EventTimeTimeout)
    return marked.unionByName(others)


def split_repeats(batch: DataFrame, key: str = "key") -> tuple[DataFrame, DataFrame]:
    """Of a micro-batch of ``mark_seen``: the first row of each new key, and the repeats.

    Within the batch the row that sorts first is the key's first, so a batch that is run
    again is split alike. Equal rows are counted before they meet, then given out again.
    """
    columns = [c for c in batch.columns if c != "seen"]
    rest = [c for c in columns if c != key]
    counted = batch.groupBy(*batch.columns).agg(F.count(F.lit(1)).alias("_n"))
    keyed = counted.where(F.col(key).isNotNull())
    first = (keyed.where("not seen").groupBy(F.col(key).alias("_key"))
             .agg(F.min(F.struct(*rest)).alias("_first")))
    joined = keyed.join(first, F.col(key) == F.col("_key"), "left")
    is_first = ~F.col("seen") & F.struct(*rest).eqNullSafe(F.col("_first"))
    marked = joined.withColumn("_is_first", is_first)
    good = (marked.where("_is_first").select(*columns)
            .unionByName(counted.where(F.col(key).isNull())
                         .select(*columns, F.explode(F.expr("sequence(1L, _n)")).alias("_i")).drop("_i")))
    extra = F.col("_n") - F.col("_is_first").cast("int")
    again = (marked.where(extra > 0).withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), extra)))
             .select(*columns))
    return good, again


def fail_on_repeats(repeats: DataFrame, key: str = "key") -> None:
    found = repeats.select(key).first()
    if found is not None:
        raise ValueError(f"duplicate rows for key {found[0]}")
