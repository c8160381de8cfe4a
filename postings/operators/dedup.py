"""One row per key, whatever number of repeats the input holds."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.functions import listed
from postings.operators.sizing import measured_small, null_safe
from postings.sources.warehouse import stored


def _first_row(order: list[str], columns: list[str]) -> Column:
    """Aggregate: the first row by ``order``, ties by the values of ``columns``.

    A minimum over a struct: it combines before any shuffle, keeps one row per
    group, and gives the same answer on every run.
    """
    ranks = F.struct(*order).alias("ranks")
    return F.min(F.struct(ranks, F.struct(*columns).alias("row"))).getField("row")


def dedup(
    df: DataFrame,
    keys: list[str],
    attributes: list[str],
    order: list[str],
    list_of: str | None = None,
    list_as: str | None = None,
) -> DataFrame:
    """Collapse repeats of ``keys``.

    The attributes come from the first row by ``order``; one that is NULL there
    takes the smallest value among the repeats. ``list_of`` becomes the ordered
    list of its distinct values. A group keeps two rows' worth of values and a
    set bounded by the distinct list values, so repeats are merged before the
    shuffle and a key that repeats in a third of the rows costs one row per map
    task.
    """
    merged = [_first_row(order, attributes).alias("row")]
    merged += [F.min(a).alias(a) for a in attributes]
    if list_of:
        merged.append(listed(list_of).alias(list_as or list_of))
    return (
        df.groupBy(*keys)
        .agg(*merged)
        .select(
            *keys,
            *([list_as or list_of] if list_of else []),
            *[F.coalesce(f"row.{a}", a).alias(a) for a in attributes],
        )
    )


def dedup_in_two(
    df: DataFrame,
    keys: list[str],
    attributes: list[str],
    order: list[str],
    list_of: str | None = None,
    list_as: str | None = None,
) -> DataFrame:
    """The same rows as :func:`dedup`, with each attribute sent over the shuffle once.

    The first pass keeps the first row by ``order``, and in one number which attributes any of the repeats knows. Keys
    whose first row lacks one of those are measured; only their rows are read again, for the smallest
    known values. The first pass is written once, since both parts of the result read it. At most 63 attributes.
    """
    if len(attributes) > 63:
        raise ValueError("one bit per attribute: at most 63")
    merged = [_first_row(order, attributes).alias("row"), F.bit_or(_known(attributes)).alias("known")]
    if list_of:
        merged.append(listed(list_of).alias(list_as or list_of))
    kept = [*keys, *([list_as or list_of] if list_of else [])]
    lacks = F.col("known").bitwiseAND(F.bitwise_not(_known(attributes, "row."))) != 0
    winners = stored(df.groupBy(*keys).agg(*merged).withColumn("lacks", lacks))
    gaps = winners.where("lacks")
    wanted = measured_small(gaps.select(*keys)).alias("w")
    rows = df.alias("d").join(wanted, null_safe("d", "w", keys), "left_semi")
    filled = rows.groupBy(*keys).agg(*[F.min(a).alias(a) for a in attributes])
    whole = winners.where("NOT lacks").select(*kept, *[F.col(f"row.{a}").alias(a) for a in attributes])
    mended = gaps.alias("g").join(filled.alias("f"), null_safe("g", "f", keys))
    return whole.union(mended.select(*[F.col(f"g.{c}") for c in kept], *[F.coalesce(f"g.row.{a}", f"f.{a}").alias(a) for a in attributes]))


def _known(columns: list[str], of: str = "") -> Column:
    """A number with a bit for each column that is not NULL."""
    return reduce(add, [F.when(F.col(f"{of}{c}").isNotNull(), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, c in enumerate(columns)])


def first_rows(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """The whole first row of every non-NULL key."""
    found = _first_row(order, columns).alias("row")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(found).select(key, "row.*")
