"""Conditional counts and conditional distinct counts in two map-side-combined steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def measures(
    df: DataFrame,
    by: list[str],
    counts: dict[str, Column] | None = None,
    distinct: dict[str, tuple[Column, str]] | None = None,
) -> DataFrame:
    """Counts per group: ``counts[name] = predicate``, ``distinct[name] = (predicate, key)``.

    ``counts`` counts rows and equals a distinct count of the grain key wherever
    the grouping holds the whole rest of the grain. ``distinct`` counts distinct
    non-NULL keys among the rows of the predicate.

    Instead of one expansion of the input per distinct expression, rows are
    grouped by (group, key) with one flag per measure and then by group. The
    key is part of the first shuffle, so a group with a third of all rows is
    spread; both steps combine before they shuffle. Rows are doubled only when
    two different keys are counted. Groups without a qualifying row stay, with 0.
    """
    counts, distinct = counts or {}, distinct or {}
    if not distinct:
        return df.groupBy(*by).agg(*[F.count_if(p).alias(n) for n, p in counts.items()])

    keys = list(dict.fromkeys(key for _, key in distinct.values()))
    flagged = df.select(
        *by,
        *[F.coalesce(p, F.lit(False)).alias(f"c_{n}") for n, p in counts.items()],
        *[
            (F.coalesce(p, F.lit(False)) & F.col(k).isNotNull()).alias(f"d_{n}")
            for n, (p, k) in distinct.items()
        ],
        *[F.col(k).cast("string").alias(f"k_{i}") for i, k in enumerate(keys)],
    )
    if len(keys) == 1:
        members = flagged.withColumn("kind", F.lit(0)).withColumnRenamed("k_0", "member")
    else:
        per_key = F.array(*[
            F.struct(F.lit(i).alias("kind"), F.col(f"k_{i}").alias("member")) for i in range(len(keys))
        ])
        members = flagged.withColumn("m", F.explode(per_key)).select(
            *by, *[c for c in flagged.columns if c[:2] in ("c_", "d_")], "m.kind", "m.member"
        )
    first = members.groupBy(*by, "kind", "member").agg(
        *[F.count_if(F.col(f"c_{n}") & (F.col("kind") == 0)).alias(n) for n in counts],
        *[
            F.bool_or(F.col(f"d_{n}") & (F.col("kind") == keys.index(k))).alias(n)
            for n, (_, k) in distinct.items()
        ],
    )
    return first.groupBy(*by).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts],
        *[F.count_if(n).alias(n) for n in distinct],
    )
