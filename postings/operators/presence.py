"""Presence between consecutive snapshots: new, open, gone.

Input rows are unique per (key, day). A key therefore has at most one row per
observation day, which bounds every window partition below by the number of
days, however often the key was repeated in the raw data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings.functions import key_text
from postings.operators.sizing import local_copy, measured_small


def day_sequence(df: DataFrame, day: str) -> DataFrame:
    """Distinct days with the previous and the next observed day.

    The unpartitioned window runs over one row per day.
    """
    in_order = Window.orderBy(day)
    return df.select(day).distinct().select(
        day,
        F.lag(day).over(in_order).alias("prev_day"),
        F.lead(day).over(in_order).alias("next_day"),
    )


def covered_next(df: DataFrame, day: str, guard: str) -> DataFrame:
    """(day, guard, next_day) for guards that were also observed on the next day.

    At most one row per day and guard value. The pairs are measured first;
    within the bound everything after them runs on a local relation and the
    result, never larger than the pairs, is broadcast.
    """
    pairs = df.select(day, guard).distinct()
    small = local_copy(pairs)
    seen = pairs if small is None else small
    after = day_sequence(seen, day).where(F.col("next_day").isNotNull()).select(day, "next_day")
    covered = seen.select(F.col(day).alias("next_day"), guard)
    closing = after.join(covered, "next_day").select(day, guard, "next_day")
    return closing if small is None else F.broadcast(closing)


def first_seen(df: DataFrame, key: str, day: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(day).alias("first_seen_on"))


def gone_rows(
    df: DataFrame, key: str, day: str, guard: str, coverage: DataFrame | None = None
) -> DataFrame:
    """Rows of keys missing on the next observed day, dated to that day.

    A row closes when its guard was covered on the next observed day and the
    key was not present then. ``last_present_on`` keeps the day it was seen.
    ``coverage`` may name a cheaper relation with the same day and guard pairs.
    """
    return _with_next(df, key, day, guard, coverage).where(_closes()).select(
        *[F.col("next_day").alias(day) if c == day else F.col(c) for c in df.columns],
        "first_seen_on",
        F.col(day).alias("last_present_on"),
    )


def gone_rows_by_join(df: DataFrame, key: str, day: str, guard: str) -> DataFrame:
    """The same rows as :func:`gone_rows`, from joins: the checked baseline."""
    after = measured_small(
        day_sequence(df, day).where(F.col("next_day").isNotNull()).select(day, "next_day")
    )
    covered = measured_small(df.select(F.col(day).alias("next_day"), guard).distinct())
    present = df.select(key, F.col(day).alias("next_day"))
    return (
        df.join(after, day)
        .join(covered, ["next_day", guard], "left_semi")
        .join(present, [key, "next_day"], "left_anti")
        .join(first_seen(df, key, day), key)
        .select(
            *[F.col("next_day").alias(day) if c == day else F.col(c) for c in df.columns],
            "first_seen_on",
            F.col(day).alias("last_present_on"),
        )
    )


def daily_status(
    df: DataFrame,
    key: str,
    day: str,
    guard: str,
    coverage: DataFrame | None = None,
    versioned_by: list[str] | None = None,
) -> DataFrame:
    """Present rows plus gone rows, with ``is_new``, ``is_gone``, ``first_seen_on``, ``last_present_on``.

    One window over the key yields the first day, the next presence and, with
    ``versioned_by``, the start of the attribute version in force
    (``version_from``): a gone row falls into the version it left, so no
    separate as-of join is needed. A row emits itself and, when it closes, its
    gone row, from the same task.
    """
    timeline = _with_next(df, key, day, guard, coverage, versioned_by)
    here = F.struct(
        F.col(day).alias(day),
        (F.col(day) == F.col("first_seen_on")).alias("is_new"),
        F.lit(False).alias("is_gone"),
    )
    left = F.struct(
        F.col("next_day").alias(day), F.lit(False).alias("is_new"), F.lit(True).alias("is_gone")
    )
    states = F.when(_closes(), F.array(here, left)).otherwise(F.array(here))
    kept = [c for c in df.columns if c != day]
    extra = ["version_from"] if versioned_by else []
    return timeline.select(
        *kept, *extra, "first_seen_on", F.col(day).alias("last_present_on"),
        F.explode(states).alias("state"),
    ).select(
        key, f"state.{day}", *[c for c in kept if c != key], *extra,
        "state.is_new", "state.is_gone", "first_seen_on", "last_present_on",
    )


def _closes() -> Column:
    return F.col("next_day").isNotNull() & (
        F.col("next_seen").isNull() | (F.col("next_seen") > F.col("next_day"))
    )


def _with_next(df, key, day, guard, coverage, versioned_by=None) -> DataFrame:
    by_day = Window.partitionBy(key).orderBy(day)
    steps = [
        F.min(day).over(by_day).alias("first_seen_on"),
        F.lead(day).over(by_day).alias("next_seen"),
    ]
    columns = df.columns
    if versioned_by:
        attributes = key_text(*versioned_by)
        before = F.lag(attributes).over(by_day)
        changed = before.isNull() | (before != attributes)
        steps.append(F.when(changed, F.col(day)).alias("opens"))
    timeline = df.select(*columns, *steps)
    if versioned_by:
        timeline = timeline.withColumn("version_from", F.max("opens").over(by_day)).drop("opens")
    closing = covered_next(df if coverage is None else coverage, day, guard)
    return timeline.join(closing, [day, guard], "left")
