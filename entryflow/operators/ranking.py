"""Top-k over distinct rows, running totals, shares and one-level rollups."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def top_distinct(df: DataFrame, cols: Sequence[str], by: str, k: int,
                 tie_breakers: Sequence[str] = ()) -> DataFrame:
    """``SELECT DISTINCT cols ORDER BY by DESC, tie_breakers LIMIT k``.

    The smallest of the k largest distinct values of ``by`` is a lower bound
    for the ``by`` of every result row (with fewer than k distinct values it
    is the overall minimum, so nothing is cut).  It is found on the single
    column ``by`` and applied before the distinct as ``by >= t OR by IS
    NULL`` (one scalar subquery; both predicates can reach a Parquet scan's
    row-group statistics), so only rows near the top are deduplicated and
    sorted.  NULL ``by`` rows stay candidates because they sort last.
    """
    rows = df.select(*cols)
    top_values = (rows.where(F.col(by).isNotNull()).select(by).distinct()
                  .orderBy(F.col(by).desc()).limit(k))
    threshold = top_values.agg(F.min(by)).scalar()
    candidates = rows.where((F.col(by) >= threshold) | F.col(by).isNull())
    order = [F.col(by).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie_breakers]
    return candidates.distinct().orderBy(*order).limit(k)


def running_total(df: DataFrame, order_col: str, value_col: str,
                  out_col: str = "running_total", one_row_per_value: bool = False) -> DataFrame:
    """Per distinct ``order_col`` value, the sum of ``value_col`` over all rows
    whose ``order_col`` is at most it (RANGE frame: peers included).

    The input is first reduced to one row per ``order_col`` value, so the
    single ordered window only sees as many rows as there are distinct values
    (years, days), however large the input.  With ``one_row_per_value`` the
    caller states that ``df`` already is such a reduction (e.g. the output of
    a group-by on ``order_col``); its columns are kept and the total added.
    """
    w = Window.orderBy(order_col).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    if one_row_per_value:
        return df.withColumn(out_col, F.sum(value_col).over(w))
    per_value = df.groupBy(order_col).agg(F.sum(value_col).alias("_rt_v"))
    return per_value.select(order_col, F.sum("_rt_v").over(w).alias(out_col))


def row_share(df: DataFrame, cols: Sequence[str], suffix: str = "_share") -> DataFrame:
    """Add ``c + suffix`` = c / (sum of cols) for each c (a 100 % stacked row)."""
    total = None
    for c in cols:
        total = F.col(c) if total is None else total + F.col(c)
    out = df
    for c in cols:
        out = out.withColumn(c + suffix, F.col(c).cast("double") / total)
    return out


def rollup_metric(df: DataFrame, dim: str, metric: str, out_col: str | None = None,
                  how: str = "sum", scale: int | None = None) -> DataFrame:
    """One-level rollup of ``metric`` by ``dim``, largest first.

    A sum of doubles depends on the order of addition (and so on the
    partitioning) in its last bits; ``scale`` returns it as
    ``decimal(38, scale)``, which is the same however the rows were added.
    """
    out_col = out_col or f"{how}_{metric}"
    fn = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}[how]
    value = fn(metric)
    if scale is not None:
        value = value.cast(f"decimal(38,{scale})")
    return (df.groupBy(dim).agg(value.alias(out_col))
              .orderBy(F.col(out_col).desc(), F.col(dim)))
