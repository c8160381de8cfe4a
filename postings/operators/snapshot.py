"""Rows of the latest day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_day(df: DataFrame, day: str) -> DataFrame:
    return df.agg(F.max(day).alias(day))


def latest(df: DataFrame, day: str, days_of: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` on its latest day.

    The day comes from a scalar subquery, so a table partitioned by day reads
    one partition. ``days_of`` may name a cheaper relation with the same days.
    """
    top = latest_day(df if days_of is None else days_of, day)
    return df.where(F.col(day) == top.scalar())
