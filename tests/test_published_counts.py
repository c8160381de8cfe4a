"""The counts published in FIXTURES.md for its own observation view, at the smallest scale."""

import os
import re

import pytest
from pyspark.sql import functions as F

from postings.plans import gold, silver
from verification.observations import table as given

SF = "/root/testdata/sf0.001"
FIXTURES = os.path.join(os.path.dirname(os.path.dirname(__file__)), "FIXTURES.md")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def staged(spark):
    text = open(FIXTURES, encoding="utf-8").read()
    view = re.search(r"```sql\n(with c as .*?)```", text, re.S).group(1)
    given(spark, SF, "events").createOrReplaceTempView("events")
    obs = spark.sql(view + " select * from obs")
    absent = {"location_display_name": "string", "redirect_url": "string", "source_file": "string",
              "latitude": "double", "longitude": "double"}
    return obs.select(
        "*",
        *[F.lit(None).cast(t).alias(c) for c, t in absent.items()],
        ((F.col("salary_is_predicted") == "0") & F.col("salary_min").isNotNull()).alias("is_salary_disclosed"),
    )


def test_published_counts(spark, staged):
    ads = silver.present(staged).cache()
    facts = gold.fact(ads).cache()
    assert (staged.count(), staged.select("source_id").distinct().count()) == (895, 15)
    assert ads.count() == 359
    assert ads.where("role_queries LIKE '%,%'").count() == 238
    assert facts.where("is_gone").count() == 30
    assert (facts.count(), facts.where("vacancy_sk IS NULL").count()) == (389, 0)
    assert gold.dim_vacancy(ads).count() == 60
    assert ads.select("position_id").distinct().count() == 45
    assert gold.salary_daily(facts, gold.dim_country(spark)).count() == 42
