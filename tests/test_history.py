from datetime import date

from postings.operators.history import as_of, scd2

SCHEMA = "source_id string, observed_on date, grade string, title string"


def d(n):
    return date(2026, 9, n)


def x_rows(table):
    return table(SCHEMA, *[("X", d(n), g, "t") for n, g in
                           [(1, "mid"), (2, "mid"), (3, "senior"), (5, "senior"), (6, "mid")]],
                 ("Y", d(2), None, "t"))


def versions_of(df):
    return scd2(df, "source_id", "observed_on", ["grade", "title"], "sk")


def test_versions(table, rows):
    found = versions_of(x_rows(table))
    assert rows(found, "source_id", "grade", "valid_from", "valid_to", "is_current") == sorted([
        ("X", "mid", d(1), d(3), False), ("X", "senior", d(3), d(6), False), ("X", "mid", d(6), None, True),
        ("Y", None, d(2), None, True),
    ], key=repr)


def test_missing_and_empty_are_one_version_with_the_known_value(table, rows):
    df = table(SCHEMA, ("Z", d(1), "mid", None), ("Z", d(2), "mid", ""))
    assert rows(versions_of(df), "title", "valid_from", "valid_to") == [("", d(1), None)]


def test_as_of(table, rows):
    versions = versions_of(x_rows(table))
    facts = table("source_id string, observed_on date", *[("X", d(n)) for n in (1, 4, 6, 9)], ("Y", d(1)), ("N", d(1)))
    found = as_of(facts, versions, "source_id", "observed_on", ["sk", "grade"])
    assert rows(found, "source_id", "observed_on", "grade") == sorted([
        ("X", d(1), "mid"), ("X", d(4), "senior"), ("X", d(6), "mid"), ("X", d(9), "mid"),
        ("Y", d(1), None), ("N", d(1), None),
    ], key=repr)
    assert found.where("sk IS NULL").count() == 2


def test_one_shuffle_builds_the_history(spark, tmp_path, table):
    x_rows(table).write.parquet(str(tmp_path / "x"))
    found = versions_of(spark.read.parquet(str(tmp_path / "x")))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
