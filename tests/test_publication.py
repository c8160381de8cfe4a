"""Publication: one swap for all tables, changed days only, versions that stay readable."""

import datetime as dt
import os

import pytest
from test_daily import ad, clean, folder  # noqa: F401
from test_landing import put

from postings.operators.quality import DataTestFailure
from postings.plans import daily
from postings.sources import publication, warehouse

DAYS = [dt.date(2026, 9, k) for k in (1, 2, 3)]


@pytest.fixture
def base(spark):
    return warehouse.scratch_database(spark)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "published")


def save(spark, table, *rows):
    warehouse.save_table(spark.createDataFrame(list(rows), "source_id string, n long, day date"), table, "day")


def builds(root, name):
    return sorted(os.listdir(f"{root}/{name}"))


def test_only_changed_days_are_written(spark, base, root, rows):
    save(spark, f"{base}.a", ("x", 1, DAYS[0]), ("y", 2, DAYS[1]))
    assert publication.publish(spark, root, f"{base}.a") == 1
    first = builds(root, "a")
    warehouse.replace_days(spark.createDataFrame([("z", 9, DAYS[1]), ("w", None, DAYS[2])], "source_id string, n long, day date"), f"{base}.a", "day")
    assert publication.publish(spark, root, f"{base}.a") == 2
    (second,) = set(builds(root, "a")) - set(first)
    assert sorted(d for d in os.listdir(f"{root}/a/{second}") if "=" in d) == ["day=2026-09-02", "day=2026-09-03"]
    assert rows(publication.read(spark, root, "a")) == rows(spark.table(f"{base}.a"))
    assert rows(publication.read(spark, root, "a", 1)) == [("x", 1, DAYS[0]), ("y", 2, DAYS[1])]
    # nothing changed: nothing written, the same rows
    assert publication.publish(spark, root, f"{base}.a") == 3 and len(builds(root, "a")) == 2
    warehouse.drop_days(spark, f"{base}.a", DAYS[:1])
    publication.publish(spark, root, f"{base}.a")
    assert rows(publication.read(spark, root, "a")) == rows(spark.table(f"{base}.a")) and len(builds(root, "a")) == 2


def test_a_filter_on_the_day_prunes_folders(spark, base, root):
    save(spark, f"{base}.a", *[("x", k, d) for k, d in enumerate(DAYS)])
    publication.publish(spark, root, f"{base}.a")
    plan = publication.read(spark, root, "a").where("day = DATE'2026-09-02'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "build" not in publication.read(spark, root, "a").columns


def test_a_build_that_dies_leaves_every_table_at_the_old_version(spark, base, root, rows, monkeypatch):
    save(spark, f"{base}.a", ("x", 1, DAYS[0]))
    save(spark, f"{base}.b", ("x", 1, DAYS[0]))
    publication.publish(spark, root, f"{base}.a", f"{base}.b")
    for t in "ab":
        save(spark, f"{base}.{t}", ("new", 2, DAYS[0]))
    sent = publication._sent

    def dies(spark, folder, table, before):
        if table.endswith(".b"):
            raise KeyboardInterrupt
        return sent(spark, folder, table, before)

    monkeypatch.setattr(publication, "_sent", dies)
    with pytest.raises(KeyboardInterrupt):
        publication.publish(spark, root, f"{base}.a", f"{base}.b")
    monkeypatch.undo()
    assert publication.versions(spark, root) == [1]
    assert [rows(publication.read(spark, root, t), "source_id") for t in "ab"] == [[("x",)]] * 2
    # what the dead build wrote goes, and the next build publishes both
    assert len(builds(root, "a")) == 2 and len(publication.vacuum(spark, root)) == 1 and len(builds(root, "a")) == 1
    assert publication.publish(spark, root, f"{base}.a", f"{base}.b") == 2
    assert [rows(publication.read(spark, root, t), "source_id") for t in "ab"] == [[("new",)]] * 2


def test_a_version_is_named_once(spark, base, root):
    save(spark, f"{base}.a", ("x", 1, DAYS[0]))
    publication.publish(spark, root, f"{base}.a")
    with pytest.raises(RuntimeError):
        publication._swap(spark, root, 1, {})
    assert publication.read(spark, root, "a").count() == 1 and publication.versions(spark, root) == [1]


def test_vacuum_keeps_what_kept_versions_name(spark, base, root, rows):
    for k in range(4):  # the first day never changes, so its first folder stays in use
        save(spark, f"{base}.a", ("x", 1, DAYS[0])) if k == 0 else warehouse.replace_days(
            spark.createDataFrame([("y", k, DAYS[1])], "source_id string, n long, day date"), f"{base}.a", "day")
        publication.publish(spark, root, f"{base}.a")
    gone = publication.vacuum(spark, root, keep=2)
    assert len(gone) == 1 and publication.versions(spark, root) == [3, 4]
    assert [rows(publication.read(spark, root, "a", v), "n") for v in (3, 4)] == [[(1,), (2,)], [(1,), (3,)]]
    with pytest.raises(publication.NotPublished):
        publication.read(spark, root, "a", 2)
    with pytest.raises(ValueError):
        publication.vacuum(spark, root, keep=0)


def test_tables_without_days_without_rows_and_of_other_columns(spark, base, root, rows):
    whole = spark.createDataFrame([("gb", None)], "country_code string, label string")
    warehouse.save_table(whole, f"{base}.dim")
    save(spark, f"{base}.none")
    publication.publish(spark, root, f"{base}.dim", f"{base}.none")
    assert rows(publication.read(spark, root, "dim")) == [("gb", None)]
    empty = publication.read(spark, root, "none")
    assert empty.count() == 0 and empty.columns == ["source_id", "n", "day"]
    # another set of columns: all days again, and tables not named stay
    spark.sql(f"DROP TABLE {base}.none")
    warehouse.save_table(spark.createDataFrame([("x", DAYS[0])], "source_id string, day date"), f"{base}.none", "day")
    publication.publish(spark, root, f"{base}.none")
    assert rows(publication.read(spark, root, "none")) == [("x", DAYS[0])]
    assert publication.views(spark, root) == 2 and rows(spark.table("dim")) == [("gb", None)]
    assert publication.views(spark, root, 1) == 1 and spark.table("none").columns == ["source_id", "n", "day"]
    for missing in (lambda: publication.read(spark, root, "other"), lambda: publication.read(spark, root, "dim", 7), lambda: publication.views(spark, root + "x")):
        with pytest.raises(publication.NotPublished):
            missing()


def test_the_daily_job_publishes_what_passed(spark, folder, clean, root, rows, monkeypatch):  # noqa: F811
    daily.run_day(spark, str(folder), publish_to=root)
    names = {t.split(".")[-1]: t for t in daily.PUBLISHED}
    for name, table in names.items():
        assert rows(publication.read(spark, root, name)) == rows(spark.table(table)), name
    before = rows(publication.read(spark, root, "fct_vacancy_daily"))
    put(folder, "2026-09-02", "gb", "data analyst", 1, [ad("D", "Data Analyst")], count=1)

    def fails(results):
        raise DataTestFailure("ads grain: 1")

    monkeypatch.setattr(daily, "enforce", fails)
    with pytest.raises(DataTestFailure):
        daily.run_day(spark, str(folder), publish_to=root)
    monkeypatch.undo()
    assert rows(spark.table("marts.fct_vacancy_daily")) != before == rows(publication.read(spark, root, "fct_vacancy_daily"))
    daily.run_day(spark, str(folder), publish_to=root)
    assert publication.versions(spark, root) == [1, 2]
    for name, table in names.items():
        assert rows(publication.read(spark, root, name)) == rows(spark.table(table)), name
