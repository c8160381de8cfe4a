"""State per key that one day's rows advance: first day, open version, and the version that a change closes.

A state row belongs to a (key, day) at which the key was present and says what is known after that day:

* ``first_seen_on``: the key's first day
* ``version_from`` and the attributes: the version in force, each attribute with its first known value in that version
* ``closes``: the version that ended on this day (its start and attributes), NULL when none did

The state before a day is the latest row per key among a snapshot (one row per key, as of some day) and the days
after it, so it is read from at most that many days. A day needs nothing else: its states come from its own
rows and the state before it, in one join by key.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings.functions import key_text, surrogate_key


def known_columns(key: str, attributes: list[str]) -> list[str]:
    """What is carried from day to day."""
    return [key, "first_seen_on", "version_from", *attributes]


def states(df: DataFrame, key: str, day: str, attributes: list[str]) -> DataFrame:
    """State rows of every (key, day) of ``df`` at once; rows are unique per (key, day), which bounds the windows."""
    by_day = Window.partitionBy(key).orderBy(day)
    in_version = Window.partitionBy(key, "version_from").orderBy(day)
    text = key_text(*attributes)
    marked = df.select(key, day, *attributes, text.alias("_text"), F.min(day).over(by_day).alias("first_seen_on"), F.lag(text).over(by_day).alias("_before"))
    opens = F.col("_before").isNull() | (F.col("_before") != F.col("_text"))
    marked = marked.withColumn("_opens", opens).withColumn("version_from", F.max(F.when(F.col("_opens"), F.col(day))).over(by_day))
    filled = marked.select(key, day, "first_seen_on", "version_from", "_opens", *[F.first(a, ignorenulls=True).over(in_version).alias(a) for a in attributes])
    previous = F.lag(F.struct(*_version(attributes))).over(by_day)
    return filled.select(*known_columns(key, attributes), F.when(F.col("_opens"), previous).alias("closes"), day)


def before(days: DataFrame, key: str, day: str, attributes: list[str], value: date | None = None, snapshot: DataFrame | None = None, since: date | None = None) -> DataFrame:
    """The state of every key before the day ``value`` (or after all days): ``snapshot``, taken after ``since``, advanced by the days that follow it.

    Both bounds are literals, so only the partitions between them are read. The latest row per key is a maximum, merged before the shuffle.
    """
    columns = known_columns(key, attributes)
    rows = days if value is None else days.where(F.col(day) < F.lit(value))
    rows = rows if since is None else rows.where(F.col(day) > F.lit(since))
    rows = rows.select(day, *columns)
    if snapshot is not None:
        rows = rows.unionByName(snapshot.select(F.lit(since).alias(day), *columns))
    # one row per key and day, so no two rows tie
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns[1:]), day).alias("s")).select(key, "s.*")


def advanced(today: DataFrame, known: DataFrame, key: str, day: str, attributes: list[str]) -> DataFrame:
    """State rows of one day from its own rows and the state before it; the other way to :func:`states`."""
    old = known.select(F.col(key).alias("_key"), F.struct(*known_columns(key, attributes)[1:]).alias("_old"))
    joined = today.select(key, day, *attributes).join(old, F.col(key) == F.col("_key"), "left")
    met = F.col("_old").isNotNull()
    same = met & (key_text(*[f"_old.{a}" for a in attributes]) == key_text(*attributes))

    def carried(attribute: str) -> Column:
        return F.when(same, F.coalesce(f"_old.{attribute}", attribute)).otherwise(F.col(attribute)).alias(attribute)

    return joined.select(
        key,
        F.coalesce("_old.first_seen_on", day).alias("first_seen_on"),
        F.when(same, F.col("_old.version_from")).otherwise(F.col(day)).alias("version_from"),
        *[carried(a) for a in attributes],
        F.when(met & ~same, F.struct(*_version(attributes, "_old."))).alias("closes"),
        day,
    )


def _version(attributes: list[str], of: str = "") -> list[Column]:
    return [F.col(f"{of}version_from").alias("valid_from"), *[F.col(f"{of}{a}").alias(a) for a in attributes]]


def closed_versions(days: DataFrame, key: str, day: str, attributes: list[str], sk: str) -> DataFrame:
    """The versions that end on the days of the state rows, in the layout of :func:`postings.operators.history.scd2`."""
    ended = days.where(F.col("closes").isNotNull()).select(key, "closes.*", F.col(day).alias("valid_to"))
    return _versions(ended, key, attributes, sk)


def open_versions(known: DataFrame, key: str, attributes: list[str], sk: str) -> DataFrame:
    """The version in force of every key of a state."""
    now = known.select(key, F.col("version_from").alias("valid_from"), *attributes, F.lit(None).cast("date").alias("valid_to"))
    return _versions(now, key, attributes, sk)


def _versions(rows: DataFrame, key: str, attributes: list[str], sk: str) -> DataFrame:
    return rows.select(
        surrogate_key(key, "valid_from").alias(sk), key, *attributes, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))
