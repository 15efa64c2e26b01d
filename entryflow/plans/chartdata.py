"""Chart data for the report dashboards (the charts themselves are not drawn)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from entryflow.operators.ranking import rollup_metric, row_share
from entryflow.plans.reports import LANG


# Chart sums of doubles are returned with this many decimals (as a decimal),
# so they do not depend on the order in which the rows were added.
CHART_SCALE = 6


def language_rollup(days: DataFrame) -> DataFrame:
    """Column chart: SUM of the yearly mean days per language, largest first."""
    return rollup_metric(days, LANG, "average_number_of_days_for_answer",
                         "sum_average_days", scale=CHART_SCALE)


def yearly_answer_days(days: DataFrame) -> DataFrame:
    """Time series: SUM of the mean days per year, by year."""
    total = F.sum("average_number_of_days_for_answer").cast(f"decimal(38,{CHART_SCALE})")
    return days.groupBy("year").agg(total.alias("sum_average_days")).orderBy("year")


def yearly_active(active: DataFrame) -> DataFrame:
    """Time series: active users per year."""
    return active.select("year", "active_users").orderBy("year")


def user_share(active: DataFrame) -> DataFrame:
    """100 % stacked bars: each measure's share of active + total per year."""
    return row_share(active.select("year", "active_users", "total_users"),
                     ["active_users", "total_users"]).orderBy("year")


def record_count(df: DataFrame, dim: str) -> DataFrame:
    """The default chart metric: rows per dimension value."""
    return df.groupBy(dim).agg(F.count(F.lit(1)).alias("record_count")).orderBy(dim)
