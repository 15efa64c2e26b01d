"""Static tables: stored promotions, daily winners, report tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_static(spark: SparkSession, ref: str, fmt: str = "parquet", **options) -> DataFrame:
    """A stored table by catalog name (``fmt="table"``) or by path."""
    if fmt == "table":
        return spark.read.table(ref)
    r = spark.read.format(fmt)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(ref)


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        return F.lit(as_of.isoformat()[:10]).cast("date")
    return F.lit(str(as_of)).cast("date")


def read_promotions_for_day(df: DataFrame, as_of=None, day_col: str = "day") -> DataFrame:
    """Rows of one day (default: today).  ``day_col`` is a date column; on a
    table partitioned by it the filter prunes partitions, otherwise it is
    pushed into the Parquet scan."""
    return df.where(F.col(day_col) == _as_of(as_of))


def read_day_keyed(df: DataFrame, as_of=None, day_col: str = "day") -> DataFrame:
    """Same for a table whose day is ``yyyyMMdd`` text."""
    return df.where(F.col(day_col) == F.date_format(_as_of(as_of), "yyyyMMdd"))
