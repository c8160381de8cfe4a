import json
from datetime import date, datetime

import pytest

from postings import fixed
from postings.sources import landing


def envelope(day, country, query, page, results, count=None, headers=None):
    document = {
        "_meta": {
            "source": "s", "run_date": day, "extracted_at": f"{day}T06:00:00.5+00:00", "country": country,
            "role_query": query, "page": page, "results_per_page": 50, "max_days_old": 2,
            "count_reported": count, "request_url": "u", "response_headers": headers or {},
        },
        "payload": {"count": count},
    }
    if results is not ...:
        document["payload"]["results"] = results
    return document


def put(folder, day, country, query, page, results, **more):
    name = f"raw_{day}_{country}_{query.replace(' ', '-')}_p{page}.json"
    text = json.dumps(envelope(day, country, query, page, results, **more), ensure_ascii=False, indent=2)
    (folder / name).write_text(text, encoding="utf-8")
    return name


def put_ledger(folder, day, expected, pairs):
    ledger = {
        "run_date": day, "updated_at": "t", "expected_pairs": expected,
        "pairs": {k: {"status": s, "pages": 1, "collected": 1, "count_reported": 1, "finished_at": "t"}
                  for k, s in pairs.items()},
    }
    (folder / f"status_{day}.json").write_text(json.dumps(ledger), encoding="utf-8")


FULL = {
    "id": "A1", "title": " Data Engineer ", "description": "d", "created": "2026-08-31T10:00:00Z",
    "company": {"display_name": " Ä Co \n"}, "category": {"tag": "it", "label": "IT Jobs"},
    "location": {"display_name": "Soho, London", "area": ["UK", "London", "Soho"]},
    "latitude": 51.5, "longitude": -0.1, "salary_min": 50000, "salary_max": 60000.5,
    "salary_is_predicted": "0", "contract_type": "permanent", "contract_time": "full_time",
    "redirect_url": "https://x", "unknown_key": {"deep": [1]},
}


@pytest.fixture
def folder(tmp_path):
    put(tmp_path, "2026-09-01", "gb", "data engineer", 1, [FULL, {"id": 17, "title": "t", "created": "soon"}], count=2)
    put(tmp_path, "2026-09-01", "gb", "data engineer", 2, None)
    put(tmp_path, "2026-09-01", "gb", "data engineer", 3, ...)
    put(tmp_path, "2026-09-02", "de", "ml engineer", 1, [
        {"title": "no id", "company": {"display_name": "  "}, "location": {"area": ["DE"]}},
        {"id": "B", "company": None, "location": None, "salary_min": None},
    ], count=2, headers={"X-Quota": "9", "Date": "d"})
    return tmp_path


def test_flatten(spark, folder):
    flat = {r.source_id: r for r in landing.flatten_pages(landing.read_pages(spark, str(folder))).collect()}
    assert len(flat) == 4
    full = flat["A1"]
    assert full.source_file == "raw_2026-09-01_gb_data-engineer_p1.json"
    assert (full.run_date, full.extracted_at) == (date(2026, 9, 1), datetime(2026, 9, 1, 6, 0, 0, 500000))
    assert (full.country, full.role_query, full.page, full.count_reported) == ("gb", "data engineer", 1, 2)
    assert full.posted_at == datetime(2026, 8, 31, 10)
    assert (full.title, full.company_name) == (" Data Engineer ", "Ä Co")
    assert (full.salary_min, full.salary_max, full.salary_is_predicted) == (50000.0, 60000.5, "0")
    assert (full.location_region, full.location_city) == ("London", "Soho")
    assert json.loads(full.location_area_json) == ["UK", "London", "Soho"]
    assert (full.category_tag, full.category_label) == ("it", "IT Jobs")
    assert json.loads(full.vacancy_json) == FULL
    sparse = flat["17"]
    assert sparse.posted_at is None and sparse.salary_min is None and sparse.location_city is None
    assert sparse.location_area_json == "[]"
    assert flat[None].company_name is None and flat[None].location_region is None
    assert flat["B"].company_name is None


def test_layout_is_the_raw_table(spark, folder):
    flat = landing.flatten_pages(landing.read_pages(spark, str(folder)))
    assert [(f.name, f.dataType) for f in flat.schema] == fixed.RAW_COLUMNS


def test_one_day_or_some_days(spark, folder):
    def days(*wanted):
        pages = landing.read_pages(spark, str(folder), *wanted)
        return {r[0] for r in pages.select("_meta.run_date").distinct().collect()}

    assert days("2026-09-02") == {"2026-09-02"}
    assert days("2026-09-01", "2026-09-02") == days() == {"2026-09-01", "2026-09-02"}


def test_page_counts(spark, folder, rows):
    counts = landing.page_counts(landing.read_pages(spark, str(folder)))
    assert rows(counts, "country", "page", "n") == [("de", 1, 2), ("gb", 1, 2), ("gb", 2, 0), ("gb", 3, 0)]


def test_ledger(spark, tmp_path, rows):
    put_ledger(tmp_path, "2026-09-01", ["gb/a", "de/a"], {"gb/a": "complete"})
    ledger = landing.read_ledger(spark, str(tmp_path), "2026-09-01")
    day = date(2026, 9, 1)
    assert rows(landing.expected_pairs(ledger)) == [(day, "de/a"), (day, "gb/a")]
    assert rows(landing.pair_states(ledger), "run_date", "pair", "status") == [(day, "gb/a", "complete")]


def test_rows_round_trip(spark, folder, tmp_path, rows):
    flat = landing.flatten_pages(landing.read_pages(spark, str(folder)))
    landing.write_rows(flat, str(tmp_path / "export"))
    assert rows(landing.read_rows(spark, str(tmp_path / "export"))) == rows(flat)


def test_quota_headers_of_the_first_page(spark, tmp_path, rows):
    from postings.plans.reports import quota_headers

    put(tmp_path, "2026-09-01", "de", "b", 1, [], headers={"X-Quota-Left": "9", "Date": "d"})
    put(tmp_path, "2026-09-01", "gb", "b", 1, [], headers={"X-Quota-Left": "8"})
    assert rows(quota_headers(landing.read_pages(spark, str(tmp_path)))) == [("X-Quota-Left", "9")]
