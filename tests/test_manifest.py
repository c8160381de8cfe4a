"""The landing manifest decides what is read; the stream sees ledgers and unreadable pages."""

import os

import pytest
from test_daily import ad, clean, days, folder  # noqa: F401
from test_landing import put, put_ledger

from postings.plans import bronze
from postings.sources import landing, manifest, warehouse
from postings.streaming.arrivals import load_arrivals

FILES = manifest.files_table(warehouse.RAW_TABLE)


@pytest.fixture
def parsed(monkeypatch):
    """The days that are parsed, call by call."""
    calls, read = [], landing.read_pages
    monkeypatch.setattr(landing, "read_pages", lambda spark, folder, *dates: calls.append([d[-1] for d in dates]) or read(spark, folder, *dates))
    return calls


def test_an_unchanged_folder_is_not_parsed(spark, folder, clean, parsed, rows):  # noqa: F811
    first = bronze.load_days(spark, str(folder))
    assert [d.day for d in first.days] == [1, 2] and parsed == [["1", "2", "3"]]
    again = bronze.load_days(spark, str(folder))
    assert again.days == [] and len(parsed) == 1
    assert rows(again.problems) == rows(first.problems) != []
    noted = spark.table(FILES).where("folder = '%s'" % folder)
    assert rows(noted, "file_name", "readable", "n_ads", "loaded") == sorted([
        ("raw_2026-09-01_gb_data-analyst_p1.json", True, 1, True), ("raw_2026-09-01_gb_data-engineer_p1.json", True, 3, True),
        ("status_2026-09-01.json", True, None, True), ("raw_2026-09-02_gb_data-engineer_p1.json", True, 1, True),
        ("raw_2026-09-03_gb_data-engineer_p1.json", True, 1, False), ("status_2026-09-03.json", True, None, False)], key=repr)
    assert {r.length for r in noted.collect()} == {f.stat().st_size for f in folder.iterdir()}


def test_only_changed_days_are_parsed(spark, folder, clean, parsed):  # noqa: F811
    bronze.load_days(spark, str(folder))
    put(folder, "2026-09-02", "gb", "data analyst", 1, [ad("D")], count=1)
    assert [d.day for d in bronze.load_days(spark, str(folder)).days] == [2]
    put_ledger(folder, "2026-09-03", ["gb/data engineer"], {"gb/data engineer": "complete"})
    assert [d.day for d in bronze.load_days(spark, str(folder)).days] == [3]
    assert parsed == [["1", "2", "3"], ["2"], ["3"]] and days(spark) == {1: 4, 2: 2, 3: 1}


def test_days_written_by_someone_else_are_read_again(spark, folder, clean, parsed):  # noqa: F811
    bronze.load_days(spark, str(folder))
    spark.sql(f"ALTER TABLE {warehouse.RAW_TABLE} DROP PARTITION (run_date = DATE'2026-09-01')")
    warehouse.replace_days(warehouse.stored(spark.table(warehouse.RAW_TABLE).where("run_date = DATE'2026-09-02'").limit(0).union(
        spark.table(warehouse.RAW_TABLE).where("run_date = DATE'2026-09-02'"))))
    assert [d.day for d in bronze.load_days(spark, str(folder)).days] == [1, 2]
    assert days(spark) == {1: 4, 2: 1}


def test_rejected_days_wait_for_their_files_or_for_leave(spark, folder, clean, parsed):  # noqa: F811
    bronze.load_days(spark, str(folder))
    assert bronze.load_days(spark, str(folder), "2026-09-03").days == []
    assert [d.day for d in bronze.load_days(spark, str(folder), "2026-09-03", allow_incomplete=True).days] == [3]
    assert parsed == [["1", "2", "3"], ["3"]]


def test_a_load_that_dies_is_done_again(spark, folder, clean, monkeypatch):  # noqa: F811
    note = manifest.note
    monkeypatch.setattr(manifest, "note", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        bronze.load_days(spark, str(folder))
    monkeypatch.setattr(manifest, "note", note)
    assert [d.day for d in bronze.load_days(spark, str(folder)).days] == [1, 2]


def test_a_ledger_completed_later_loads_its_day(spark, folder, clean, tmp_path):  # noqa: F811
    progress = str(tmp_path / "progress")
    load_arrivals(spark, str(folder), progress).awaitTermination(120)
    assert days(spark) == {1: 4, 2: 1}
    put_ledger(folder, "2026-09-03", ["gb/data engineer"], {"gb/data engineer": "complete"})
    load_arrivals(spark, str(folder), progress).awaitTermination(120)
    assert days(spark) == {1: 4, 2: 1, 3: 1}


def test_an_unreadable_page_that_arrives_later_is_judged(spark, folder, clean, tmp_path, rows):  # noqa: F811
    progress = str(tmp_path / "progress")
    load_arrivals(spark, str(folder), progress).awaitTermination(120)
    (folder / "raw_2026-09-02_gb_data-engineer_p2.json").write_text('{"_meta": {')
    load_arrivals(spark, str(folder), progress).awaitTermination(120)
    found = manifest.noted_problems(spark, str(folder), warehouse.RAW_TABLE, "2026-09-02")
    assert rows(found, "pair", "problem") == [("raw_2026-09-02_gb_data-engineer_p2.json", "unreadable")]
    assert not any(r.loaded for r in spark.table(FILES).where("run_date = DATE'2026-09-02'").collect())
    os.remove(folder / "raw_2026-09-02_gb_data-engineer_p2.json")
    load_arrivals(spark, str(folder), progress).awaitTermination(120)
    assert all(r.loaded for r in spark.table(FILES).where("run_date = DATE'2026-09-02'").collect())
