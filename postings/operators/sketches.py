"""Quantiles that merge: one sketch per day and group, merged for weeks or coarser groups without the rows.

A sketch of size ``k`` holds every value of up to about ``k`` of them, so quantiles of small groups are exact, the least value
whose rank reaches the share asked for; beyond that the rank of an answer is off by less than about ``3 / k`` of the rows
(:func:`rank_error`) with 99 % certainty, whatever the number of rows and of merged sketches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 2048


def rank_error(k: int = K) -> float:
    """The share of rows by which an answer's rank may be off, an upper bound of what is published for these sketches."""
    return 2.446 / k**0.9433 + 0.001


def sketches(df: DataFrame, by: list[str], columns: list[str], k: int = K) -> DataFrame:
    """One sketch per group and column of its non-NULL values, NULL where there is none; built before the shuffle, merged after it."""
    return df.groupBy(*by).agg(*[F.kll_sketch_agg_double(c, k).alias(c) for c in columns])


def merged(found: DataFrame, by: list[str], columns: list[str], k: int = K) -> DataFrame:
    """Sketches of coarser groups."""
    return found.groupBy(*by).agg(*[F.kll_merge_agg_double(c, k).alias(c) for c in columns])


def sketched_quantiles(found: DataFrame, by: list[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """(by, n, quantiles): ``wanted`` names a column's sketch and a share; ``n`` is the number of values of the first column."""
    first = next(iter(wanted.values()))[0]

    def of(column: str, value):
        # the sketch of a group without values answers nothing
        return F.when(F.kll_sketch_get_n_double(column) > 0, value)

    quantile = {n: of(c, F.kll_sketch_get_quantile_double(c, F.lit(p))).alias(n) for n, (c, p) in wanted.items()}
    return found.select(*by, F.kll_sketch_get_n_double(first).alias("n"), *quantile.values())
