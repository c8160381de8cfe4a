"""The whole job on landed files: gate, replacement, layers, data tests, arrivals."""

import pytest
from test_landing import put, put_ledger

from postings.operators.quality import DataTestFailure
from postings.plans import bronze, daily
from postings.sources import warehouse
from postings.streaming.arrivals import load_arrivals


def ad(key, title="Data Engineer", **more):
    return {"id": key, "title": title, "description": "spark", "created": "2026-09-01T08:00:00Z",
            "company": {"display_name": "Co"}, "location": {"area": ["UK", "London", "Soho"]},
            "salary_min": 10.0, "salary_max": 20.0, "salary_is_predicted": "0",
            "contract_type": "permanent", "contract_time": "full_time", **more}


@pytest.fixture
def folder(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    put(folder, "2026-09-01", "gb", "data engineer", 1, [ad("A"), ad("B"), ad("C", "Gardener")], count=3)
    put(folder, "2026-09-01", "gb", "data analyst", 1, [ad("A")], count=1)
    put(folder, "2026-09-02", "gb", "data engineer", 1, [ad("A", "Senior Data Engineer")], count=1)
    put(folder, "2026-09-03", "gb", "data engineer", 1, [ad("A")], count=1)
    put_ledger(folder, "2026-09-01", ["gb/data engineer", "gb/data analyst"],
               {"gb/data engineer": "complete", "gb/data analyst": "complete"})
    put_ledger(folder, "2026-09-03", ["gb/data engineer", "gb/data analyst"], {"gb/data engineer": "complete"})
    return folder


@pytest.fixture
def clean(spark):
    warehouse.ensure_layers(spark)
    spark.sql(f"DROP TABLE IF EXISTS {warehouse.RAW_TABLE}")
    spark.sql(f"DROP TABLE IF EXISTS {daily.ADS}")
    spark.sql(f"DROP TABLE IF EXISTS {daily.BUILT}")


def days(spark):
    return {r.run_date.day: r["count"] for r in spark.table(warehouse.RAW_TABLE).groupBy("run_date").count().collect()}


def test_load_build_and_test(spark, folder, clean, rows):
    loaded = daily.run_day(spark, str(folder))
    assert days(spark) == {1: 4, 2: 1}
    assert rows(loaded.problems, "pair", "problem") == [("gb/data analyst", "not collected")]
    facts = spark.table("marts.fct_vacancy_daily")
    assert [(a, b.day, c, e) for a, b, c, e in rows(facts, "source_id", "observed_on", "is_new", "is_gone")] == [
        ("A", 1, True, False), ("A", 2, False, False), ("B", 1, True, False), ("B", 2, False, True),
        ("C", 1, True, False), ("C", 2, False, True)]
    assert rows(facts.where("source_id = 'A' AND is_new"), "role_queries") == [("data analyst, data engineer",)]
    market = spark.table("marts.mart_market_daily")
    assert [(d.day, *r) for d, *r in rows(market, "observed_on", "n_ads", "n_positions", "n_new", "n_gone")] == [
        (1, 2, 1, 2, 0), (2, 1, 1, 0, 1)]
    assert rows(spark.table("marts.mart_qa_unmatched_titles"), "title", "n") == [("Gardener", 1)]
    assert rows(spark.table("marts.dim_vacancy").where("source_id = 'A'"), "title", "is_current") == [
        ("Data Engineer", False), ("Senior Data Engineer", True)]
    assert spark.table("marts.bi_vacancies").where("city_group = 'London'").count() == 4
    for name in ("mart_salary_daily", "mart_salary_disclosure", "mart_city_daily", "mart_company_role",
                 "dim_company", "dim_location", "dim_date", "dim_country", "dim_role"):
        assert spark.table(f"marts.{name}").count() > 0, name


def test_refreshing_changed_days_equals_a_full_rebuild(spark, folder, clean, rows):
    daily.run_day(spark, str(folder))
    put(folder, "2026-09-02", "gb", "data engineer", 1, [ad("A"), ad("N", "ML Engineer")], count=2)
    put(folder, "2026-09-04", "gb", "data engineer", 1, [ad("N")], count=1)
    loaded = daily.run_day(spark, str(folder), "2026-09-02", "2026-09-04")
    assert [d.day for d in loaded.days] == [2, 4]
    assert loaded.summary.first().rows == 3
    refreshed = rows(spark.table(daily.ADS)), rows(spark.table("marts.fct_vacancy_daily"))
    daily.build(spark, full=True)
    assert refreshed == (rows(spark.table(daily.ADS)), rows(spark.table("marts.fct_vacancy_daily")))


def test_loading_twice_is_loading_once(spark, folder, clean):
    bronze.load_days(spark, str(folder))
    once = days(spark)
    bronze.load_days(spark, str(folder), "2026-09-01")
    assert days(spark) == once


def test_incomplete_days_on_request(spark, folder, clean):
    loaded = bronze.load_days(spark, str(folder), "2026-09-03", allow_incomplete=True)
    assert days(spark) == {3: 1}
    assert loaded.summary.first().rows == 1


def test_a_failing_data_test_stops_the_job(spark, tmp_path, clean):
    put(tmp_path, "2026-09-01", "gb", "data engineer", 1, [ad("A", salary_is_predicted=None)], count=1)
    with pytest.raises(DataTestFailure, match="is_salary_disclosed not null: 1"):
        daily.run_day(spark, str(tmp_path))


def test_arrivals(spark, folder, clean, tmp_path):
    progress = str(tmp_path / "progress")
    load_arrivals(spark, str(folder), progress).awaitTermination(120)
    assert days(spark) == {1: 4, 2: 1}
    put(folder, "2026-09-02", "gb", "data analyst", 1, [ad("D")], count=1)
    put(folder, "2026-09-04", "gb", "data analyst", 1, [ad("D"), ad("E")], count=2)
    load_arrivals(spark, str(folder), progress).awaitTermination(120)
    assert days(spark) == {1: 4, 2: 2, 4: 2}


def layer_days(spark):
    def of(table, column, where="true"):
        return sorted(r[0].day for r in spark.table(table).where(where).select(column).distinct().collect())

    return of(daily.ADS, "observed_on"), of("marts.fct_vacancy_daily", "observed_on", "NOT is_gone")


def same_as_full(spark, rows):
    kept = rows(spark.table(daily.ADS)), rows(spark.table("marts.fct_vacancy_daily"))
    daily.build(spark, full=True)
    assert kept == (rows(spark.table(daily.ADS)), rows(spark.table("marts.fct_vacancy_daily")))


@pytest.fixture
def three_days(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for day, n in ((1, 3), (2, 4), (3, 5)):
        put(folder, f"2026-09-0{day}", "gb", "data engineer", 1, [ad(f"{chr(64 + k)}") for k in range(1, n + 1)], count=n)
    return folder


def test_days_loaded_without_a_build_reach_the_marts(spark, three_days, clean, rows):
    daily.run_day(spark, str(three_days), "2026-09-01")
    bronze.load_days(spark, str(three_days), "2026-09-02")  # a stream, or a run whose build died
    daily.run_day(spark, str(three_days), "2026-09-03")
    assert layer_days(spark) == ([1, 2, 3], [1, 2, 3])
    same_as_full(spark, rows)


def test_a_day_reloaded_without_ids_loses_its_ads(spark, three_days, clean, rows):
    daily.run_day(spark, str(three_days))
    put(three_days, "2026-09-03", "gb", "data engineer", 1, [{"title": "no id"}, {"title": "none"}], count=2)
    daily.run_day(spark, str(three_days), "2026-09-03")
    assert days(spark) == {1: 3, 2: 4, 3: 2}
    assert layer_days(spark) == ([1, 2], [1, 2])
    same_as_full(spark, rows)


def test_changed_rules_reach_all_days(spark, three_days, clean, monkeypatch):
    daily.run_day(spark, str(three_days))
    before = daily.rules_in_force()
    spark.sql(f"ALTER TABLE {daily.ADS} DROP PARTITION (observed_on = DATE'2026-09-01')")
    daily.build(spark)  # nothing is seen to have changed
    assert layer_days(spark)[0] == [2, 3]
    monkeypatch.setattr(daily, "rules_in_force", lambda: before + "x")
    daily.build(spark)
    assert layer_days(spark)[0] == [1, 2, 3]


@pytest.mark.parametrize("page", [1, 2, 3])
@pytest.mark.parametrize("ledger", [True, False])
def test_a_cut_page_keeps_its_day_out(spark, tmp_path, clean, rows, page, ledger):
    for p, n in ((1, 50), (2, 50), (3, 30)):
        put(tmp_path, "2026-09-01", "gb", "data engineer", p, [ad(f"{p}-{k}") for k in range(n)], count=130)
    if ledger:
        put_ledger(tmp_path, "2026-09-01", ["gb/data engineer"], {"gb/data engineer": "complete"})
    file = tmp_path / f"raw_2026-09-01_gb_data-engineer_p{page}.json"
    file.write_text(file.read_text()[: len(file.read_text()) // 2])
    for allow in (False, True):
        loaded = bronze.load_days(spark, str(tmp_path), allow_incomplete=allow)
        assert loaded.days == [] and days(spark) == {}
        assert (file.name, "unreadable") in rows(loaded.problems, "pair", "problem")


def test_a_cut_ledger_keeps_its_day_out(spark, tmp_path, clean, rows):
    put(tmp_path, "2026-09-01", "gb", "data engineer", 1, [ad("A")], count=1)
    put_ledger(tmp_path, "2026-09-01", ["gb/data engineer", "us/data engineer"], {"gb/data engineer": "complete"})
    file = tmp_path / "status_2026-09-01.json"
    file.write_text(file.read_text()[:-20])
    loaded = bronze.load_days(spark, str(tmp_path))
    assert loaded.days == [] and rows(loaded.problems, "problem", "evidence") == [("unreadable", "status file")]
