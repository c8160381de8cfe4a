"""Dedup, measures, quantiles and the latest snapshot against brute force and built-ins."""

import random
import statistics
from datetime import date

import pytest
from pyspark.sql import functions as F

from postings.operators.dedup import dedup, first_rows
from postings.operators.measures import measures
from postings.operators.quantiles import CONTINUOUS, DISCRETE, quantiles
from postings.operators.snapshot import latest


def test_dedup_takes_the_first_row_and_fills_its_gaps(table, rows):
    df = table(
        "id string, day int, q string, page int, a string, b int",
        ("1", 1, "y", 1, "from y", 7), ("1", 1, "x", 2, None, None), ("1", 1, "x", 9, "late", 5),
        ("1", 2, "x", 1, "next day", 1), ("2", 1, "z", 1, None, None),
    )
    found = dedup(df, ["id", "day"], ["a", "b"], ["q", "page"], "q", "queries")
    assert rows(found, "id", "day", "queries", "a", "b") == [
        ("1", 1, "x, y", "from y", 5), ("1", 2, "x", "next day", 1), ("2", 1, "z", None, None)]


def test_dedup_keeps_the_first_row_together(table, rows):
    df = table("id string, q string, flag boolean, amount int", ("1", "b", False, 1), ("1", "a", True, 2))
    assert rows(dedup(df, ["id"], ["flag", "amount"], ["q"])) == [("1", True, 2)]


def test_dedup_is_the_same_however_rows_are_spread(spark, rows):
    df = spark.range(3000).selectExpr("id % 40 AS k", "id % 7 AS o", "hash(id) % 5 AS a", "if(id % 3 = 0, NULL, id) AS b")
    once = rows(dedup(df.repartition(7, "b"), ["k"], ["a", "b"], ["o"]))
    assert once == rows(dedup(df.orderBy(F.desc("b")).coalesce(2), ["k"], ["a", "b"], ["o"]))


def test_first_rows(table, rows):
    df = table("id string, f int, v string", ("1", 2, "b"), ("1", 1, None), (None, 0, "x"), ("2", 1, "z"))
    assert rows(first_rows(df, "id", ["f"], ["v"])) == [("1", None), ("2", "z")]


@pytest.fixture(scope="module")
def facts(spark):
    """Rows of which a third sit in one group."""
    rng = random.Random(5)
    data = []
    for n in range(3000):
        group = "hot" if n % 3 == 0 else f"g{n % 50}"
        value = None if rng.random() < 0.1 else rng.choice([rng.uniform(-1e6, 1e6), float(rng.randint(1, 9)), 0.0])
        data.append((group, str(rng.randint(0, 80)), rng.choice([None, "p1", "p2", "p3"]), rng.random() < 0.5, value))
    data += [("none", "1", "p1", True, None), (None, "1", "p1", True, 4.0)]
    df = spark.createDataFrame(data, "g string, ad string, position string, flag boolean, value double").cache()
    df.count()
    return df


@pytest.mark.parametrize("by", [["g"], []])
def test_measures_equal_conditional_distinct_counts(facts, rows, by):
    flag, any_row = F.col("flag"), F.lit(True)
    found = measures(
        facts, by, counts={"n": any_row, "n_flag": flag},
        distinct={"ads": (any_row, "ad"), "flag_ads": (flag, "ad"), "positions": (flag, "position")},
    )
    expected = facts.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if("flag").alias("n_flag"), F.count_distinct("ad").alias("ads"),
        F.count_distinct(F.when(flag, F.col("ad"))).alias("flag_ads"),
        F.count_distinct(F.when(flag, F.col("position"))).alias("positions"),
    )
    assert rows(found, *expected.columns) == rows(expected)


def test_measures_keep_groups_without_a_hit(facts, rows):
    found = measures(facts.where("g = 'none'"), ["g"], distinct={"n": (~F.col("flag"), "ad")})
    assert rows(found) == [("none", 0)]


WANTED = {
    "p50": ("value", 0.5, CONTINUOUS), "p10": ("value", 0.1, CONTINUOUS), "d25": ("value", 0.25, DISCRETE),
    "d75": ("value", 0.75, DISCRETE), "low": ("value", 0.0, DISCRETE), "high": ("value", 1.0, DISCRETE),
}


@pytest.mark.parametrize("by", [["g"], []])
def test_quantiles_equal_the_built_in_ones(facts, rows, by):
    found = quantiles(facts, by, WANTED, rows_as="n")
    expected = facts.groupBy(*by).agg(F.count("*").alias("n"), *[
        F.expr(f"percentile{'_disc' if kind == DISCRETE else '_cont'}({p}) WITHIN GROUP (ORDER BY value)").alias(name)
        for name, (_, p, kind) in WANTED.items()
    ])
    mine, theirs = rows(found, *expected.columns), rows(expected)
    assert len(mine) == len(theirs)
    for a, b in zip(mine, theirs):
        assert a[: len(by) + 1] == b[: len(by) + 1]
        for x, y in zip(a[len(by) + 1:], b[len(by) + 1:]):
            assert (x is None and y is None) or x == pytest.approx(y, rel=1e-12)


def test_quantiles_of_two_columns(spark):
    df = spark.range(101).selectExpr("id * 1.0 AS a", "if(id < 50, NULL, -id * 2.0) AS b")
    row = quantiles(df, [], {"a": ("a", 0.5, CONTINUOUS), "b": ("b", 0.5, CONTINUOUS)}).first()
    assert (row.a, row.b) == (50.0, statistics.median(-2.0 * n for n in range(50, 101)))


def test_approximate_quantiles_are_close(facts):
    exact = quantiles(facts.where("g = 'hot'"), ["g"], {"v": ("value", 0.5, DISCRETE)}).first().v
    approx = quantiles(facts.where("g = 'hot'"), ["g"], {"v": ("value", 0.5, DISCRETE)}, approx=True).first().v
    assert approx == pytest.approx(exact, abs=2.0)


def test_latest(table, rows):
    df = table("day date, x int", (date(2026, 9, 1), 1), (date(2026, 9, 2), 2))
    assert rows(latest(df, "day")) == [(date(2026, 9, 2), 2)]
    other = table("day date", (date(2026, 9, 1),))
    assert rows(latest(df, "day", other)) == [(date(2026, 9, 1), 1)]
