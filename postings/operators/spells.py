"""Spells of presence per key, with the rule that closes them as a choice.

A key is present on some days; its guard (a country, say) is covered on some. A spell closes on the ``absent_days``-th covered
day after its last presence on which the key is still absent. With ``over_holes`` uncovered days are passed over, so a
closure that falls into a hole is not lost; without it the closing days have to be the very next observed ones, as in
:mod:`postings.operators.presence`, whose gone rows are the spells closed by the default rule. A key that
comes back before it closes stays in its spell; after that it opens a new one.

Input rows are unique per (key, day), so a key has at most one row per observation day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postings.operators.sizing import measured_small


def closing_days(df: DataFrame, day: str, guard: str, absent_days: int = 1, over_holes: bool = False) -> DataFrame:
    """(day, guard, closing_on) for covered days that a spell of the guard can close after; at most one row per day and guard.

    The windows run over distinct (day, guard) pairs and over distinct days, not over rows.
    """
    covered = df.select(day, guard).distinct()
    by_day = Window.partitionBy(guard).orderBy(day)
    found = covered.withColumn("closing_on", F.lead(day, absent_days).over(by_day))
    if not over_holes:
        # The covered day so many observed days later, and all between: positions in both calendars move alike.
        place = df.select(day).distinct().withColumn("_place", F.row_number().over(Window.orderBy(day)))
        found = found.join(F.broadcast(place), day).withColumn("_then", F.lead("_place", absent_days).over(by_day))
        found = found.where(F.col("_then") - F.col("_place") == absent_days)
    return found.where(F.col("closing_on").isNotNull()).select(day, guard, "closing_on")


def spells(df: DataFrame, key: str, day: str, guard: str, absent_days: int = 1, over_holes: bool = False) -> DataFrame:
    """(key, spell, guard, opened_on, last_present_on, closed_on, n_days): the spells of every key, numbered from 1.

    ``guard`` is that of the last presence, ``n_days`` counts days of presence, ``closed_on`` is NULL while a spell is open.
    One window and one aggregate by key share a shuffle; the calendar of closing days is measured and broadcast.
    """
    by_day = Window.partitionBy(key).orderBy(day)
    timeline = df.select(key, day, guard).withColumn("_next", F.lead(day).over(by_day))
    calendar = measured_small(closing_days(df, day, guard, absent_days, over_holes))
    closed = F.when(F.col("_next").isNull() | (F.col("_next") > F.col("closing_on")), F.col("closing_on"))
    ended = timeline.join(calendar, [day, guard], "left").withColumn("_closed", closed)
    opens = F.when(F.lag("_closed").over(by_day).isNotNull() | F.lag(day).over(by_day).isNull(), 1).otherwise(0)
    numbered = ended.withColumn("_opens", opens).withColumn("spell", F.sum("_opens").over(by_day.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(key, "spell").agg(
        F.max_by(guard, day).alias(guard), F.min(day).alias("opened_on"), F.max(day).alias("last_present_on"),
        F.max("_closed").alias("closed_on"), F.count("*").alias("n_days"))
