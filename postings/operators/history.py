"""Attribute history (SCD Type 2) and as-of lookup into it.

Input rows are unique per (key, day), so a key has at most one row and one
version per observation day; that bounds the windows and the as-of join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postings.functions import first_known, key_text, surrogate_key


def scd2(df: DataFrame, key: str, day: str, attributes: list[str], sk: str) -> DataFrame:
    """Versions of ``attributes`` per key with half-open validity ``[valid_from, valid_to)``.

    A version opens when the attributes differ from the previous observation;
    a gap without a change opens none. The lag, the running version number, the
    collapse and the lead all work on rows clustered by ``key``: one shuffle.
    """
    by_day = Window.partitionBy(key).orderBy(day)
    by_start = Window.partitionBy(key).orderBy("valid_from")
    marked = df.select(key, day, *attributes, key_text(*attributes).alias("text"))
    before = F.lag("text").over(by_day)
    opens = F.when(before.isNull() | (before != F.col("text")), 1).otherwise(0)
    versions = (
        marked.withColumn("opens", opens)
        .withColumn("version", F.sum("opens").over(by_day.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(key, "version")
        .agg(
            *[first_known(a, [day]).alias(a) for a in attributes],
            F.min(day).alias("valid_from"),
        )
    )
    return versions.withColumn("valid_to", F.lead("valid_from").over(by_start)).select(
        surrogate_key(key, "valid_from").alias(sk),
        key,
        *attributes,
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def as_of(fact: DataFrame, versions: DataFrame, key: str, day: str, take: list[str]) -> DataFrame:
    """Left join of each fact row to the version in force on its day.

    Equality on ``key`` plus a range residual. Both sides are clustered by key;
    should facts of one key dominate, adaptive execution splits that side.
    """
    v = versions.select(
        F.col(key).alias("_key"), "valid_from", "valid_to", *[F.col(c).alias(f"_{c}") for c in take]
    )
    in_force = (
        (F.col(key) == F.col("_key"))
        & (F.col(day) >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to")))
    )
    return fact.join(v, in_force, "left").select(
        *[fact[c] for c in fact.columns], *[F.col(f"_{c}").alias(c) for c in take]
    )


def as_of_merge(fact: DataFrame, versions: DataFrame, key: str, day: str, take: list[str], slice_days: int = 365) -> DataFrame:
    """The same rows as :func:`as_of` by one sort of both sides: the last version is carried forward to the facts after it.

    Both sides are merged by (key, day), so there is no range condition and a fact meets one version, however many its
    key has. A key's rows are cut into slices of ``slice_days`` days, so a key with a long history or many facts is
    no single group; the version in force at the start of a slice is handed on from the slices before it, which are
    one row each. Facts with a NULL key or day meet no version.
    """
    slot = F.floor(F.datediff(F.col("_at"), F.lit("1970-01-01").cast("date")) / slice_days)
    taken = F.struct("valid_from", "valid_to", *[F.col(c) for c in take])
    sides = fact.select(F.col(key).alias("_key"), F.col(day).alias("_at"), F.lit(1).alias("_side"), F.struct(*fact.columns).alias("_fact"), F.lit(None).cast(versions.select(taken).schema[0].dataType).alias("_version"))
    starts = versions.select(F.col(key).alias("_key"), F.col("valid_from").alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(sides.schema["_fact"].dataType).alias("_fact"), taken.alias("_version"))
    both = sides.union(starts).withColumn("_slot", slot)
    # The last version of each slice, then of all slices before a slice.
    in_slot = starts.withColumn("_slot", slot).groupBy("_key", "_slot").agg(F.max_by("_version", "_at").alias("_version"))
    handed = both.select("_key", "_slot").distinct().join(in_slot, ["_key", "_slot"], "left")
    before = Window.partitionBy("_key").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    handed = handed.select("_key", "_slot", F.last("_version", ignorenulls=True).over(before).alias("_version"))
    handed = handed.where(F.col("_version").isNotNull()).select("_key", F.lit(None).cast("date").alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(sides.schema["_fact"].dataType).alias("_fact"), "_version", "_slot")
    in_order = Window.partitionBy("_key", "_slot").orderBy(F.col("_at").asc_nulls_first(), "_side").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.unionByName(handed).withColumn("_version", F.last("_version", ignorenulls=True).over(in_order)).where("_side = 1")
    met = F.col("_key").isNotNull() & F.col("_at").isNotNull() & (F.col("_version.valid_to").isNull() | (F.col("_at") < F.col("_version.valid_to")))
    return carried.select("_fact.*", *[F.when(met, F.col(f"_version.{c}")).alias(c) for c in take])
