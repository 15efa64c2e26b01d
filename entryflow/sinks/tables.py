"""Table sinks: create with a declared schema, append conformed rows.

``NOT NULL`` in a Parquet table's DDL is not enforced on write, so
``conform`` adds a check that fails the job on a NULL in a required column.
"""

from __future__ import annotations

import datetime as _dt
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from entryflow.functions.keys import day_key, iso_day_key
from entryflow.schemas import PROMOTIONS_TABLE, ddl
from entryflow.sinks.commits import commit_rows


def create_table(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet",
                 location: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with the schema's columns (required
    ones marked NOT NULL)."""
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING {fmt}"
    if partition_by:
        sql += " PARTITIONED BY (" + ", ".join(partition_by) + ")"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order, cast to its types; a NULL in a
    required column fails the job with the column's name."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"NULL in required column {f.name}"))
                       ).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def append_table(df: DataFrame, target: str, schema: T.StructType | None = None,
                 fmt: str = "parquet", by_path: bool | None = None,
                 partition_by: Sequence[str] = (), writer: str | None = None, number: int = 0) -> bool:
    """Append rows to a table (catalog name) or a folder (path).

    With a schema the rows are conformed first (see ``conform``); a missing
    catalog table is created from the rows (create-if-needed, append).  The
    rows are one commit of the table's list (see ``commits``): a job that
    gives its ``writer`` name and run ``number`` can be rerun and adds its
    rows once.  Returns whether rows were added.
    """
    out = conform(df, schema) if schema is not None else df
    path_like = by_path if by_path is not None else ("/" in target or ":" in target)
    if not path_like:
        create_table(df.sparkSession, target, schema or out.schema, fmt, partition_by=partition_by)
    return commit_rows(out, target, writer, number, fmt, not path_like, partition_by)


def overwrite_batch(df: DataFrame, target: str, batch_id: int, fmt: str = "parquet") -> str:
    """Write one micro-batch to ``target/batch_id=N`` replacing any earlier
    attempt of the same batch, so a retried batch does not duplicate rows.
    Readers see the batch id as a column (see ``commits`` for tables without)."""
    path = f"{target.rstrip('/')}/batch_id={int(batch_id)}"
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def promotion_rows(spark: SparkSession, offers: Iterable[tuple[str, int]], day=None,
                   iso_week_year: bool = False) -> DataFrame:
    """Rows for the promotions table: one per (promotion, number) for ``day``
    (a date or ``yyyyMMdd`` text; default today).  The day key uses the
    calendar year; ``iso_week_year`` reproduces a ``%G%m%d`` insert, whose
    year part is the ISO week-numbering year (differs around New Year)."""
    offers = list(offers)
    base = spark.createDataFrame(offers, "promotion string, participation_number bigint")
    key = iso_day_key if iso_week_year else day_key
    if day is None:
        d = key(F.current_date())
    elif isinstance(day, (_dt.date, _dt.datetime)):
        d = key(F.lit(day.isoformat()[:10]).cast("date"))
    else:
        d = F.lit(str(day))
    return base.select(d.alias("day"), "promotion", "participation_number")


def insert_promotions(spark: SparkSession, offers: Iterable[tuple[str, int]], target: str,
                      day=None, iso_week_year: bool = False) -> None:
    """Append a day's promotions, checked against the required schema."""
    append_table(promotion_rows(spark, offers, day, iso_week_year), target, PROMOTIONS_TABLE)
