"""The digest of the rules: same in every process, and raised when the rows of an ad change."""

import datetime as dt
import subprocess
import sys

from pyspark.sql import functions as F

from postings import fixed
from postings.plans import daily, silver

#: The number of the rules and what they make of the ads below. Change both together.
PINNED = (1, "a6b08b8648fe24ae7fe746dbba04eca3")

TITLES = [
    "Data Engineer", "Senior  Analytics Engineer (Remote)", "Junior Data Analyst - hybrid", "ML Engineer Intern", "Gardener", "", None,
    " Lead Data Scientist ", "Werkstudent BI Developer",
]
VARIANTS = [
    {}, {"salary_min": 10.0, "salary_max": 20.5, "salary_is_predicted": "0"}, {"salary_min": 10.0, "salary_is_predicted": "1"},
    {"company_name": " Co  ", "description": "work from home", "page": 2}, {"company_name": "", "role_query": "data analyst"},
]


def ads(spark):
    names = [n for n, _ in fixed.RAW_COLUMNS]
    rows = []
    for k, title in enumerate(TITLES):
        for j, more in enumerate(VARIANTS):
            about = {"source_file": f"f{j}", "run_date": dt.date(2026, 9, 1 + j % 2), "country": "gb", "role_query": "data engineer", "page": 1,
                     "source_id": f"ad{k}", "title": title, "location_city": "Camden", **more}
            rows.append(tuple(about.get(n) for n in names))
    return silver.present(silver.stage(spark.createDataFrame(rows, fixed.RAW_SCHEMA)))


def test_rows_of_an_ad_are_pinned_to_the_number_of_the_rules(spark):
    df = ads(spark)
    lines = df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("line"))
    digest = lines.agg(F.md5(F.array_join(F.array_sort(F.collect_list("line")), "\n"))).first()[0]
    assert (daily.RULES, digest) == PINNED


def test_digest_is_the_same_in_every_process_and_follows_the_values(monkeypatch):
    before = daily.rules_in_force()
    code = "from postings.plans import daily; print(daily.rules_in_force())"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.strip() == before
    monkeypatch.setattr(fixed, "NO_GRADE", "none")
    changed = daily.rules_in_force()
    monkeypatch.setattr(daily, "RULES", daily.RULES + 1)
    assert len({before, changed, daily.rules_in_force()}) == 3
