"""Dense numbering of rows within a group, continued from stored numbers.

A window ``row_number() OVER (PARTITION BY day ORDER BY ...)`` puts a whole
day into one task; when one day holds a third of all rows that task does a
third of the work.  So the rows are range-partitioned on the full sort key (a
hot day spreads over many tasks), each task numbers its slice, and a small
table of per-(task, group) row counts gives every slice its offset.

The sliced, position-tagged rows are written once to the shared scratch
folder (``spark.checkpoint.dir``) and read back.  Range bounds come from a
sample whose seed differs between two exchanges of one plan, so the offsets
and the rows must be derived from one materialised copy; the write also cuts
the lineage, so a lost executor does not re-run the sort.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from entryflow.session import scratch_path

_PID, _POS, _FIRST, _ROWS, _BEFORE, _BASE = (
    "_nb_pid", "_nb_pos", "_nb_first", "_nb_rows", "_nb_before", "_nb_base")


def assign_numbers(df: DataFrame, group_col: str, order_cols: Sequence[str],
                   out_col: str = "number", start: DataFrame | None = None,
                   start_col: str = "next_number", num_partitions: int | None = None
                   ) -> DataFrame:
    """Number rows 0, 1, 2, ... within each ``group_col`` in ``order_cols`` order.

    ``(group_col, *order_cols)`` must be unique (add an id as last tie-breaker).
    ``start`` holds ``(group_col, start_col)``: the first free number per group
    from earlier runs (one row per group); numbering continues from it.

    ``df`` is evaluated once, in ``num_partitions`` slices; without a number
    the job's ``spark.sql.shuffle.partitions`` holds, as for its other
    shuffles, and AQE joins slices that come out small.
    """
    spark = df.sparkSession
    keys = [F.col(group_col)] + [F.col(c) for c in order_cols]
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    # monotonically_increasing_id is (task index << 33) + row index in the task
    tagged = (ranged.sortWithinPartitions(*keys)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_POS, F.monotonically_increasing_id()))
    path = scratch_path(spark, "numbering")
    tagged.write.mode("overwrite").parquet(path)
    tagged = spark.read.schema(tagged.schema).parquet(path)

    spans = (tagged.groupBy(_PID, group_col)
             .agg(F.min(_POS).alias(_FIRST), F.count(F.lit(1)).alias(_ROWS)))
    # a window row per (task, group) run, not per row
    before = Window.partitionBy(group_col).orderBy(_PID)
    spans = spans.withColumn(_BEFORE, F.sum(_ROWS).over(before) - F.col(_ROWS))
    if start is not None:
        base = start.select(F.col(group_col).alias("_nb_g"),
                            F.col(start_col).cast("long").alias(_BASE))
        spans = (spans.join(base, spans[group_col].eqNullSafe(base["_nb_g"]), "left")
                      .drop("_nb_g"))
    else:
        spans = spans.withColumn(_BASE, F.lit(0).cast("long"))
    spans = spans.select(F.col(_PID).alias("_nb_spid"), F.col(group_col).alias("_nb_sgrp"),
                         _FIRST, _BEFORE, F.coalesce(F.col(_BASE), F.lit(0)).alias(_BASE))

    # keyed by slice, so no key is hot; the planner broadcasts the spans when
    # their measured size allows
    cond = (tagged[_PID] == spans["_nb_spid"]) & tagged[group_col].eqNullSafe(spans["_nb_sgrp"])
    out = tagged.join(spans, cond, "inner")
    number = F.col(_POS) - F.col(_FIRST) + F.col(_BEFORE) + F.col(_BASE)
    return (out.withColumn(out_col, number.cast("long"))
               .drop(_PID, _POS, "_nb_spid", "_nb_sgrp", _FIRST, _BEFORE, _BASE))


def next_numbers(numbered: DataFrame, group_col: str, number_col: str,
                 start_col: str = "next_number") -> DataFrame:
    """First free number per group after a numbering run (to store for the next)."""
    return numbered.groupBy(group_col).agg((F.max(number_col) + 1).alias(start_col))
