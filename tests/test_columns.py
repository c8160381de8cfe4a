import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from postings import fixed
from postings import functions as fn


def one(df, column):
    return df.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("title, role, grade", [
    ("Analytics Engineer / Data Engineer", "analytics_engineer", "mid"),
    ("Senior Machine Learning Engineer", "ml_engineer", "senior"),
    ("International Data Analyst", "data_analyst", "intern"),
    ("Jr Dateningenieur", "data_engineer", "junior"),
    ("Sr Data Scientist", "data_scientist", "mid"),
    ("Sr. Datenwissenschaftler", "data_scientist", "senior"),
    ("Lead Data Engineer", "data_engineer", "lead"),
    ("Data Governance Manager", "data_analyst", "lead"),
    ("Leading Data Analyst", "data_analyst", "mid"),
    ("A leading Data Analyst", "data_analyst", "lead"),
    ("Angular/NodeJS Developer", "other", "mid"),
    (None, "other", "mid"),
])
def test_title_rules(table, title, role, grade):
    df = table("title string", (title,))
    assert one(df, fn.role_of()) == role
    assert one(df, fn.grade_of()) == grade


@pytest.mark.parametrize("title, description, mode", [
    ("Engineer", "hybrid or remote", "hybrid"),
    ("Engineer", "Work From Home", "remote"),
    ("Engineer (WFH)", None, "remote"),
    (None, "home office", "remote"),
    ("Engineer", None, "unknown"),
    ("work from", "home", "remote"),
])
def test_work_mode(table, title, description, mode):
    df = table("title string, description string", (title, description))
    assert one(df, fn.work_mode_of()) == mode


def test_rule_order_is_the_priority_of_the_role_dimension():
    ranked = [key for key, _, _ in sorted(fixed.ROLE_ROWS, key=lambda r: r[2])]
    assert [label for label, _ in fixed.ROLE_RULES] + [fixed.NO_ROLE] == ranked


def test_keys(table):
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    df = table(
        "company_name string, title string, country_code string, d date, flag boolean",
        ("IMR Soft LLC", "Data Engineer", "us", date(2026, 9, 1), True),
    )
    assert one(df, fn.position_key()) == md5("imr soft llc|data engineer|us")
    assert one(df, fn.surrogate_key("d", "flag", F.lit(None))) == md5("2026-09-01|true|")
    empty = table("company_name string", (None,))
    assert one(empty, fn.company_key()) == md5("")


def test_trims(table):
    df = table("x string", (" \t Acme  ",))
    assert one(df, fn.trimmed("x")) == "\t Acme"
    assert one(df, fn.stripped_or_null("x")) == "Acme"
    blank = table("x string", (" \n　",))
    assert one(blank, fn.stripped_or_null("x")) is None


@pytest.mark.parametrize("area, region, city", [
    ([], None, None), (["UK"], None, None), (["UK", "London"], "London", "London"),
    (["UK", "South East", "x", "Reading"], "South East", "Reading"), (None, None, None),
])
def test_area(table, area, region, city):
    df = table("area array<string>", (area,))
    assert one(df, fn.region_of("area")) == region
    assert one(df, fn.city_of("area")) == city


@pytest.mark.parametrize("country, region, city, group", [
    ("gb", "London", "Soho", "London"), ("gb", "South East", "Reading", "Rest of GB"),
    ("gb", None, None, "Rest of GB"), ("ca", "Ontario", "Downtown Toronto", "Toronto"),
    ("ca", "BC", "North Vancouver", "Vancouver"), ("ca", "Quebec", "Montreal", "Montreal"),
    ("ca", None, None, None), ("de", "Berlin", "Toronto", "Toronto"),
])
def test_city_group(table, country, region, city, group):
    df = table("country_code string, location_region string, location_city string", (country, region, city))
    assert one(df, fn.city_group()) == group


def test_disclosure_is_three_valued(table):
    schema = "salary_is_predicted string, salary_min double"
    values = {("0", 1.0): True, ("1", 1.0): False, ("0", None): False, (None, 1.0): None, (None, None): False}
    for row, expected in values.items():
        assert one(table(schema, row), fn.salary_disclosed()) is expected


def test_mid_salary(table):
    schema = "salary_min double, salary_max double"
    assert one(table(schema, (10.0, 20.0)), fn.salary_mid()) == 15.0
    assert one(table(schema, (10.0, None)), fn.salary_mid()) == 10.0
    assert one(table(schema, (None, 20.0)), fn.salary_mid()) is None


def test_days(table):
    schema = "posted timestamp, day date"
    late = (datetime(2026, 9, 1, 23, 59), date(2026, 9, 3))
    assert one(table(schema, late), fn.days_since("posted", "day")) == 2
    future = (datetime(2026, 9, 4), date(2026, 9, 3))
    assert one(table(schema, future), fn.days_since("posted", "day")) == 0
    unknown = (None, date(2026, 9, 3))
    assert one(table(schema, unknown), fn.days_since("posted", "day")) is None
    assert one(table(schema, late), fn.hours_between("posted", F.lit("2026-09-02 11:59:00").cast("timestamp"))) == 12.0


def test_terms_headers_names_and_shares(table):
    df = table("text string", ("Python and PySpark, power BI",))
    assert one(df, fn.terms_in("text")) == ["python", "spark", "power bi"]
    headers = table("h map<string,string>", ({"X-RateLimit-Limit": "5", "Server": "x"},))
    assert one(headers, fn.headers_with("h")) == {"X-RateLimit-Limit": "5"}
    page = table("d date, c string, q string, p int", (date(2026, 9, 1), "gb", "data engineer", 10))
    assert one(page, fn.page_file_name("d", "c", "q", "p")) == "raw_2026-09-01_gb_data-engineer_p10.json"
    assert one(page, fn.pair_key("c", "q")) == "gb/data engineer"
    assert one(page, fn.share(F.lit(1), F.lit(0))) == 0.0
