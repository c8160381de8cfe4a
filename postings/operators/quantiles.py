"""Exact quantiles of groups of any size, and the approximate option."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings.operators.sizing import null_safe

CONTINUOUS, DISCRETE = "continuous", "discrete"
# buckets per e-fold of the value: a bucket spans about 1.6 % of its values
BUCKETS_PER_E_FOLD = 64


def quantiles(
    df: DataFrame,
    by: list[str],
    wanted: dict[str, tuple[str, float, str]],
    rows_as: str | None = None,
    approx: bool = False,
) -> DataFrame:
    """``wanted[name] = (column, p, kind)`` per group, NULL values ignored.

    ``continuous`` interpolates between the two neighbouring values,
    ``discrete`` is the smallest value whose cumulative share reaches ``p``.
    A group without values gets NULL. ``rows_as`` names the row count.

    Spark's own exact percentile keeps all distinct values of a group in one
    buffer. Here equal values are first counted (combined before the shuffle),
    then counted per coarse value bucket; the ranks pick the one or two buckets
    that hold the answer, and only the values of those buckets are ordered.
    Hot groups are thus spread over tasks by value and by bucket; what one task
    orders is the distinct amounts inside one bucket, by a spilling sort.
    """
    if approx:
        size = [F.count("*").alias(rows_as)] if rows_as else []
        return df.groupBy(*by).agg(
            *size, *[F.percentile_approx(c, p).alias(n) for n, (c, p, _) in wanted.items()]
        )

    columns = list(dict.fromkeys(c for c, _, _ in wanted.values()))
    if len(columns) == 1:
        values = df.select(*by, F.lit(0).alias("m"), F.col(columns[0]).cast("double").alias("value"))
    else:
        pairs = F.array(*[
            F.struct(F.lit(i).alias("m"), F.col(c).cast("double").alias("value"))
            for i, c in enumerate(columns)
        ])
        values = df.select(*by, F.explode(pairs).alias("p")).select(*by, "p.m", "p.value")
    counted = (
        values.groupBy(*by, "m", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("bucket", _bucket(F.col("value")))
    )

    # NULL values form a bucket of their own: it keeps the group and takes no rank
    group = [*by, "m"]
    whole = Window.partitionBy(*group)
    known = F.when(F.col("bucket").isNotNull(), F.col("held")).otherwise(F.lit(0))
    totals = (
        counted.groupBy(*group, "bucket")
        .agg(F.sum("n").alias("held"))
        .withColumn("known", known)
        .withColumn("size", F.sum("held").over(whole))
        .withColumn("total", F.sum("known").over(whole))
        .withColumn("start", F.sum("known").over(whole.orderBy("bucket")) - F.col("known"))
    )
    holds = F.col("bucket").isNull()
    for column, p, kind in wanted.values():
        for rank in _ranks(p, kind):
            inside = (rank > F.col("start")) & (rank <= F.col("start") + F.col("known"))
            holds = holds | ((F.col("m") == columns.index(column)) & inside)
    target = totals.where(holds)

    c, t = counted.alias("c"), target.alias("t")
    by_value = Window.partitionBy(*group, "bucket").orderBy("value")
    ranked = (
        c.join(t, null_safe("c", "t", [*group, "bucket"]))
        .select(
            *[F.col(f"c.{k}").alias(k) for k in [*group, "bucket"]],
            "c.value", "c.n", "t.start", "t.total", "t.size",
        )
        .withColumn("upto", F.col("start") + F.sum("n").over(by_value))
    )

    def value_at(rank: Column, column: str) -> Column:
        mine = F.col("m") == columns.index(column)
        hit = (rank > F.col("upto") - F.col("n")) & (rank <= F.col("upto"))
        return F.max(F.when(mine & hit, F.col("value")))

    picked = [F.max("size").alias(rows_as)] if rows_as else []
    for name, (column, p, kind) in wanted.items():
        low, high = _ranks(p, kind)
        if kind == DISCRETE:
            picked.append(value_at(low, column).alias(name))
        else:
            lo, hi = value_at(low, column), value_at(high, column)
            mine = F.col("m") == columns.index(column)
            place = (F.max(F.when(mine, F.col("total"))) - 1) * F.lit(p)
            picked.append((lo + (hi - lo) * (place - F.floor(place))).alias(name))
    return ranked.groupBy(*by).agg(*picked)


def with_quantiles(groups: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """Quantiles joined onto groups that were counted separately."""
    names = [c for c in found.columns if c not in by]
    g, f = groups.alias("g"), found.alias("f")
    return g.join(f, null_safe("g", "f", by), "left").select("g.*", *[F.col(f"f.{n}").alias(n) for n in names])


def _ranks(p: float, kind: str) -> tuple[Column, Column]:
    """1-based ranks below and above quantile ``p`` of ``total`` values."""
    if kind == DISCRETE:
        rank = F.greatest(F.ceil(F.col("total") * F.lit(p)), F.lit(1))
        return rank, rank
    place = (F.col("total") - 1) * F.lit(p)
    return F.floor(place) + 1, F.ceil(place) + 1


def _bucket(value: Column) -> Column:
    """A coarse code that never decreases as the value grows; NaN sorts last, NULL stays NULL."""
    size = F.least(F.floor(F.log1p(F.abs(value)) * BUCKETS_PER_E_FOLD), F.lit(1 << 40))
    signed = F.when(F.isnan(value), F.lit(1 << 41)).when(value < 0, -size).otherwise(size)
    return F.when(value.isNotNull(), signed)
