"""Data tests: every test is a row ``(test, n_bad)``; zero means it passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataTestFailure(Exception):
    """At least one data test found bad rows."""


def row_tests(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Tests that look at one row at a time, all in one pass. A NULL condition passes."""
    counted = df.agg(*[F.count_if(bad).alias(f"t{i}") for i, bad in enumerate(tests.values())])
    rows = F.array(*[
        F.struct(F.lit(name).alias("test"), F.col(f"t{i}").alias("n_bad"))
        for i, name in enumerate(tests)
    ])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def not_null(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: list[str]) -> Column:
    return ~F.col(column).isin(values)


def unique_test(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """Keys that occur more than once; a lone NULL key is not counted."""
    rows = df.where(F.col(keys[0]).isNotNull()) if len(keys) == 1 else df
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return _one(repeated, name)


def dependency_test(df: DataFrame, name: str, key: str, dependents: dict[str, Column]) -> DataFrame:
    """Keys with more than one value of any dependent expression.

    More than one distinct value is the same as a minimum below the maximum,
    which needs no distinct aggregation.
    """
    ends = [f(e).alias(f"{n}_{f.__name__}") for n, e in dependents.items() for f in (F.min, F.max)]
    differ = reduce(
        lambda a, b: a | b, [F.col(f"{n}_min") != F.col(f"{n}_max") for n in dependents]
    )
    return _one(df.groupBy(key).agg(*ends).where(differ), name)


def relationship_test(child: DataFrame, name: str, column: str, parent: DataFrame) -> DataFrame:
    """Child rows whose non-NULL key is missing in the parent.

    Child keys are counted first, so the anti-join sees one row per key.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    orphans = keys.join(parent.select(column), column, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_bad")).select(
        F.lit(name).alias("test"), "n_bad"
    )


def same_days_test(name: str, *days: DataFrame) -> DataFrame:
    """Days that not every one of the one-column relations holds."""
    marked = reduce(DataFrame.union, [d.toDF("day").distinct().withColumn("layer", F.lit(i)) for i, d in enumerate(days)])
    return _one(marked.groupBy("day").agg(F.count("*").alias("n")).where(F.col("n") < len(days)), name)


def all_tests(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def enforce(results: DataFrame) -> None:
    """Raise when any test failed. The result has one row per test."""
    failed = results.where("n_bad > 0").orderBy("test").collect()
    if failed:
        raise DataTestFailure(", ".join(f"{r.test}: {r.n_bad}" for r in failed))


def _one(bad: DataFrame, name: str) -> DataFrame:
    return bad.agg(F.count("*").alias("n_bad")).select(F.lit(name).alias("test"), "n_bad")
