"""Per-group numbering on a stream, continued across micro-batches.

Window functions are refused on streaming frames, so each micro-batch is
numbered as a batch (``assign_numbers``) starting from the next free number
per group.  Those numbers live in a small state folder:

    state/epoch=E/batch_id=N   next free number of each group batch N touched
    state_snapshots/epoch=E    next free number of every group before epoch E

An epoch is ``epoch_size`` consecutive batch ids.  Batch N (epoch E) starts
from the snapshot of E plus the deltas of the batches of E before N, so it
reads one snapshot and at most ``epoch_size`` small deltas however long the
stream has run.  The first batch that needs a snapshot writes it (replacing
any half-written attempt).  A retried batch N reads the same start and
rewrites the same rows and delta, since its outputs are replaced by id.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from entryflow.operators.numbering import assign_numbers, next_numbers
from entryflow.sinks.tables import overwrite_batch
from entryflow.streaming.queries import triggered

EPOCH_SIZE = 100


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """The state at ``path``, None before it was written.  State that is there
    but cannot be read is an error: starting again at 0 would repeat numbers."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _merge(parts: list[DataFrame | None], group_col: str, start_col: str) -> DataFrame | None:
    parts = [p.select(group_col, start_col) for p in parts if p is not None]
    if not parts:
        return None
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy(group_col).agg(F.max(start_col).alias(start_col))


def epoch_snapshot(spark: SparkSession, state_path: str, epoch: int, group_col: str,
                   start_col: str = "next_number") -> DataFrame | None:
    """Next free number per group before ``epoch`` (None before any batch)."""
    if epoch <= 0:
        return None
    path = f"{state_path.rstrip('/')}_snapshots/epoch={epoch}"
    snap = _read(spark, path)
    if snap is not None:
        return snap
    prev = epoch_snapshot(spark, state_path, epoch - 1, group_col, start_col)
    deltas = _read(spark, f"{state_path.rstrip('/')}/epoch={epoch - 1}")
    merged = _merge([prev, deltas], group_col, start_col)
    if merged is None:
        return None
    merged.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stored_next(spark: SparkSession, state_path: str, group_col: str, before_batch: int,
                start_col: str = "next_number", epoch_size: int = EPOCH_SIZE
                ) -> DataFrame | None:
    """Next free number per group after all batches < ``before_batch``."""
    epoch = before_batch // epoch_size
    snap = epoch_snapshot(spark, state_path, epoch, group_col, start_col)
    deltas = _read(spark, f"{state_path.rstrip('/')}/epoch={epoch}")
    if deltas is not None:
        deltas = deltas.where(F.col("batch_id") < before_batch)
    return _merge([snap, deltas], group_col, start_col)


def number_batch(batch: DataFrame, batch_id: int, group_col: str, order_cols: Sequence[str],
                 out_col: str, state_path: str, start: DataFrame | None = None,
                 epoch_size: int = EPOCH_SIZE) -> DataFrame:
    """Number one micro-batch and record its delta; returns the numbered rows
    (persisted: the caller writes them and then unpersists)."""
    spark = batch.sparkSession
    if start is None:
        start = stored_next(spark, state_path, group_col, batch_id, epoch_size=epoch_size)
    numbered = assign_numbers(batch, group_col, order_cols, out_col=out_col, start=start)
    numbered.persist()
    epoch = batch_id // epoch_size
    overwrite_batch(next_numbers(numbered, group_col, out_col),
                    f"{state_path.rstrip('/')}/epoch={epoch}", batch_id)
    return numbered


def number_stream(df: DataFrame, group_col: str, order_cols: Sequence[str], out_col: str,
                  target: str, state_path: str, checkpoint: str,
                  trigger: str | None = "60 seconds",
                  epoch_size: int = EPOCH_SIZE) -> StreamingQuery:
    """Number a stream's rows per group in arrival order (within a batch by
    ``order_cols``) and append them to ``target/batch_id=N``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        numbered = number_batch(batch, batch_id, group_col, order_cols, out_col,
                                state_path, epoch_size=epoch_size)
        try:
            overwrite_batch(numbered, target, batch_id)
        finally:
            numbered.unpersist()

    return triggered(df.writeStream.option("checkpointLocation", checkpoint), trigger) \
        .foreachBatch(run).start()
