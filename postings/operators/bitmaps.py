"""Exact distinct counts that merge: a bit per key, kept by day and group, for any range of days and any filter on the groups.

Keys get dense numbers once, which stay theirs. A bitmap holds a block of 32768 numbers, so a group has as many rows
per measure as blocks that its keys fall into, whatever the number of its rows; a count over many days and
groups merges their bitmaps by ``or`` and counts bits. No fact row is read again, and nothing but bitmaps is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings.sources.warehouse import stored


def dense_numbers(df: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """(key, number) of the distinct non-NULL keys, numbered from 1; ``known`` numbers stay and new keys follow them.

    Keys are sorted by ranges; each range counts on from the sizes of the ranges before it, so no task holds all keys. The
    ranges are written, since numbers must not change when a task runs again.
    """
    keys = df.where(F.col(key).isNotNull()).select(key).distinct()
    start = F.lit(0).cast("long")
    if known is not None:
        keys = keys.join(known.select(key), key, "left_anti")
        start = F.lit(known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]).cast("long")
    ranged = stored(keys.repartitionByRange(key).withColumn("range", F.spark_partition_id()))
    # one row per range
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("range").agg(F.count("*").alias("n"))
    offsets = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(key))
    new = ranged.join(F.broadcast(offsets), "range").select(key, (start + F.col("offset") + inside).alias("number"))
    return new if known is None else known.select(key, "number").unionByName(new)


def bitmaps(df: DataFrame, by: list[str], measures: dict[str, tuple[Column, str]]) -> DataFrame:
    """(by, measure, block, bits) of every measure, given as (rule, number column); a number that is NULL counts for nothing.

    A measure without keys has no row in its group. Bitmaps are built before the shuffle and merged after it.
    """
    met = F.array_compact(F.array(*[
        F.when(rule & F.col(number).isNotNull(), F.struct(F.lit(name).alias("measure"), F.col(number).alias("number"))) for name, (rule, number) in measures.items()
    ]))
    rows = df.select(*by, F.explode(met).alias("m")).select(*by, "m.measure", "m.number")
    block = F.bitmap_bucket_number("number").alias("block")
    return rows.groupBy(*by, "measure", block).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merged(maps: DataFrame, by: list[str]) -> DataFrame:
    """Bitmaps of coarser groups: weeks from days, countries from roles."""
    return maps.groupBy(*by, "measure", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(maps: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """Distinct counts per group, one column per measure; a measure without keys is 0."""
    ones = merged(maps, by).groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(F.col("measure") == m, F.bitmap_count("bits"))), F.lit(0)).alias(m) for m in measures])
    return ones
