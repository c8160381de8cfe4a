"""Forms that send less or merge: two-phase dedup, bitmaps, the merge as-of."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from postings.operators import bitmaps, sketches
from postings.operators.dedup import dedup, dedup_in_two
from postings.operators.history import as_of, as_of_merge, scd2

START = date(2026, 1, 1)


@pytest.fixture(scope="module")
def repeats(spark):
    draw = random.Random(4)
    rows = [(draw.choice([None, "a", "b"]), draw.randrange(60), draw.choice("pqr"), draw.randrange(3), draw.choice([None, 1, 2]), draw.choice([None, "x", ""]), None)
            for _ in range(600)] + [("hot", 1, "p", k, None, None, None) for k in range(500)] + [("hot", 1, "q", 0, 5, None, None)]
    return spark.createDataFrame(rows, "k string, d int, q string, page int, n int, t string, never string").repartition(5)


@pytest.mark.parametrize("order", [["q", "page"], ["page"], ["page", "n"]])
def test_two_phase_dedup_equals_one_phase(repeats, rows, order):
    of = (["k", "d"], ["n", "t", "never"], order, "q", "qs")
    assert rows(dedup_in_two(repeats, *of)) == rows(dedup(repeats, *of))


def test_two_phase_dedup_beyond_the_broadcast_bound(repeats, rows, monkeypatch):
    from postings.operators import dedup as module
    monkeypatch.setattr(module, "measured_small", lambda df: df)
    assert rows(dedup_in_two(repeats, ["k", "d"], ["n", "t"], ["page"])) == rows(dedup(repeats, ["k", "d"], ["n", "t"], ["page"]))


def test_two_phase_dedup_of_nothing_and_of_rows_without_gaps(repeats, rows):
    assert rows(dedup_in_two(repeats.where("false"), ["k"], ["n"], ["page"])) == []
    full = repeats.where("n IS NOT NULL")
    assert rows(dedup_in_two(full, ["k"], ["n"], ["page"])) == rows(dedup(full, ["k"], ["n"], ["page"]))


# --- bitmaps -----------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def facts(spark):
    draw = random.Random(6)
    rows = [(START + timedelta(days=draw.randrange(30)), draw.choice(["gb", "us", None]), draw.choice("xyz"), draw.choice([None, *(f"p{k}" for k in range(400))]), draw.random() < 0.7)
            for _ in range(3000)]
    return spark.createDataFrame(rows, "day date, country string, role string, position string, is_open boolean").repartition(6)


def test_numbers_are_dense_and_stay(facts, rows):
    some = bitmaps.dense_numbers(facts.where("day < '2026-01-05'"), "position")
    n = some.count()
    assert sorted(r.number for r in some.collect()) == list(range(1, n + 1))
    more = bitmaps.dense_numbers(facts, "position", some)
    assert rows(more.join(some, ["position", "number"])) == rows(some)
    assert sorted(r.number for r in more.collect()) == list(range(1, more.count() + 1))
    assert more.count() == facts.select("position").where("position IS NOT NULL").distinct().count()
    assert bitmaps.dense_numbers(facts.where("false"), "position").collect() == []


@pytest.mark.parametrize("shift", [0, 32_760, 10_000_000])
def test_merged_bitmaps_count_as_distinct_counts(facts, rows, shift):
    """Numbers on both sides of a block's end, for random ranges and filters."""
    numbers = bitmaps.dense_numbers(facts, "position").withColumn("number", F.col("number") + shift)
    maps = bitmaps.bitmaps(facts.join(numbers, "position", "left"), ["day", "country", "role"], {"n_open": (F.col("is_open"), "number"), "n_all": (F.lit(True), "number")})
    draw = random.Random(shift)
    for by in ([], ["country"], ["country", "role"]):
        first = draw.randrange(20)
        chosen = f"day BETWEEN DATE'{START + timedelta(days=first)}' AND DATE'{START + timedelta(days=first + 9)}' AND role <> '{draw.choice('xyz')}'"
        expected = facts.where(chosen).groupBy(*by).agg(
            F.countDistinct(F.when(F.col("is_open"), F.col("position"))).alias("n_open"), F.countDistinct("position").alias("n_all"))
        assert rows(bitmaps.counts(maps.where(chosen), by, ["n_open", "n_all"])) == rows(expected)
    weeks = bitmaps.merged(maps.withColumn("week", F.weekofyear("day")), ["week"])
    again = bitmaps.counts(weeks, [], ["n_all"])
    assert rows(again) == [(facts.select("position").distinct().where("position IS NOT NULL").count(),)]


# --- as-of by merging -----------------------------------------------------------------------------------

@pytest.mark.parametrize("slice_days", [1, 7, 365, 100_000])
def test_merge_as_of_equals_the_range_join(table, spark, rows, slice_days):
    draw = random.Random(slice_days)
    seen = {(draw.choice(["a", "b", "c", None]), START + timedelta(days=draw.randrange(200))) for _ in range(300)}
    seen |= {("hot", START + timedelta(days=k)) for k in range(400)}
    versions = scd2(spark.createDataFrame([(k, d, draw.choice("xy")) for k, d in seen if k], "k string, day date, v string"), "k", "day", ["v"], "sk")
    # validity may end without a successor, and start later than some facts
    versions = versions.withColumn("valid_to", F.when(F.col("k") == "c", F.col("valid_from")).otherwise(F.col("valid_to")))
    facts = spark.createDataFrame(
        [(k, START + timedelta(days=draw.randrange(-5, 420)), i) for i, k in enumerate(["a", "b", "c", "d", None, "hot"] * 40)] + [("a", None, 999)], "k string, day date, i int")
    assert rows(as_of_merge(facts, versions, "k", "day", ["sk", "v"], slice_days)) == rows(as_of(facts, versions, "k", "day", ["sk", "v"]))


def test_merge_as_of_has_no_range_condition(spark, facts):
    versions = spark.createDataFrame([("gb", START, None, "s")], "country string, valid_from date, valid_to date, sk string")
    plan = as_of_merge(facts, versions, "country", "day", ["sk"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# --- sketches -----------------------------------------------------------------------------------------------

def test_small_groups_have_exact_quantiles(table, rows):
    df = table("g string, x double", ("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("a", None), ("b", 7.0), ("c", None))
    found = sketches.sketched_quantiles(sketches.sketches(df, ["g"], ["x"]), ["g"], {"p25": ("x", 0.25), "p50": ("x", 0.5), "p75": ("x", 0.75)})
    assert rows(found) == [("a", 4, 1.0, 2.0, 3.0), ("b", 1, 7.0, 7.0, 7.0), ("c", 0, None, None, None)]


@pytest.mark.parametrize("k", [200, 2048])
def test_merged_days_stay_within_the_rank_error(spark, k):
    """30 days of very different sizes and values, merged; ranks against all rows, ties counted in the answer's favour."""
    df = spark.range(200_000).selectExpr("id % 30 AS day", "CAST((id * 7919) % 100003 + (id % 30) * 1000 * (id % 2) AS DOUBLE) AS x").where("day > 2 OR x > 90000")
    days = sketches.sketches(df, ["day"], ["x"], k)
    shares = {f"p{i}": ("x", i / 100) for i in (1, 10, 25, 50, 75, 90, 99)}
    found = sketches.sketched_quantiles(sketches.merged(days, [], ["x"], k), [], shares).first()
    n = df.count()
    assert found.n == n
    for name, (_, share) in shares.items():
        below, upto = df.where(F.col("x") < found[name]).count(), df.where(F.col("x") <= found[name]).count()
        error = sketches.rank_error(k) * n
        assert below - error <= share * n <= upto + error, name
