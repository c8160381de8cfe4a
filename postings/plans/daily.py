"""The daily job: load whole days, rebuild the layers, test them."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings import fixed
from postings.operators.quality import enforce
from postings.operators.sizing import fetched
from postings.plans import bronze, checks, days, gold, silver
from postings.sources import publication, warehouse
from postings.sources.warehouse import file_states, replace_days, save_table, save_view, stored

ADS = "intermediate.vacancies_enriched"


#: Per day the state of the raw partition that the ads were built from, and the rules they were built with.
BUILT = "intermediate.ads_built_from"


#: What a build publishes as one. The history is a view over tables that its days advance, and is read there.
PUBLISHED = (
    days.FACTS, "marts.mart_market_daily", "marts.mart_salary_daily", "marts.mart_salary_disclosure", "marts.mart_city_daily", "marts.bi_vacancies",
    "marts.mart_company_role", "marts.mart_qa_unmatched_titles", "marts.dim_company", "marts.dim_location", "marts.dim_date", "marts.dim_country", "marts.dim_role",
)


#: Raise when code of staging, dedup or classification changes what an ad row holds; a test pins the rows of a few ads to it.
RULES = 1


def rules_in_force() -> str:
    """A digest of what decides an ad row: the number of the rules and every fixed value. Comments and layout of code do not count."""
    values = {name: repr(value) for name, value in vars(fixed).items() if name.isupper() and name != "T"}
    return hashlib.md5(repr((RULES, sorted(values.items()))).encode()).hexdigest()


def refreshed_ads(staged: DataFrame, raw_table: str, full: bool = False) -> DataFrame:
    """The classified ads as a table by day, rebuilt for the days that differ from what they were built from.

    An ad row depends on the raw rows of its own day alone, so replacing the
    days that changed gives the same table as a full rebuild. The day list
    prunes the raw partitions at planning time. Days without a usable row leave
    the table. What was built is noted last: a build that dies is done again.
    """
    spark = staged.sparkSession
    now = [(r.run_date, r.state, rules_in_force()) for r in fetched(file_states(spark, raw_table, "run_date"), "days of the raw table")]
    known = set()
    if not full and spark.catalog.tableExists(ADS) and spark.catalog.tableExists(BUILT):
        known = {tuple(r) for r in fetched(spark.table(BUILT).select("run_date", "state", "rules"), "days of the ads table")}
    if not known:
        spark.sql(f"DROP TABLE IF EXISTS {BUILT}")
        ads = save_table(silver.present(staged), ADS, "observed_on")
    elif changed := sorted({d for d, *_ in known.symmetric_difference(now)}):
        some = stored(silver.present(staged.where(F.col("observed_on").isin(changed))))
        replace_days(some, ADS, "observed_on")
        left = {r.observed_on for r in fetched(some.select("observed_on").distinct(), "days rebuilt")}
        for day in changed:
            if day not in left:
                spark.sql(f"ALTER TABLE {ADS} DROP IF EXISTS PARTITION (observed_on = DATE'{day}')")
        ads = spark.table(ADS)
    else:
        return spark.table(ADS)
    save_table(spark.createDataFrame(now, "run_date date, state string, rules string").coalesce(1), BUILT)
    return ads


def build(
    spark: SparkSession, raw_table: str = warehouse.RAW_TABLE, full: bool = False
) -> DataFrame:
    """Rebuild everything above the raw table and return the test results.

    Every day whose raw rows or rules changed since its ads were built is
    rebuilt, whoever loaded it; ``full`` rebuilds all days.

    The classified ads are read by the fact, the dimensions and the QA mart, so
    they are written once, by day; staging stays a view. Fact, history and the marts by
    day are advanced by the days that changed (:mod:`postings.plans.days`), and so are
    the tests of rows and grains. Every table is a recovery point: work lost with
    an executor restarts from the last one.
    """
    warehouse.ensure_layers(spark)
    staged = save_view(silver.stage(spark.table(raw_table)), "stg_vacancies")
    ads = refreshed_ads(staged, raw_table, full)

    countries = save_table(gold.dim_country(spark), "marts.dim_country")
    roles = save_table(gold.dim_role(spark), "marts.dim_role")
    companies = save_table(gold.dim_company(ads), "marts.dim_company")
    save_table(gold.dim_location(ads), "marts.dim_location")
    save_table(gold.dim_date(staged), "marts.dim_date")
    save_table(gold.unmatched_titles(ads), "marts.mart_qa_unmatched_titles")

    changed = days.refresh(spark, ADS, spark.table(BUILT), full)
    facts, versions = spark.table(days.FACTS), spark.table(days.HISTORY)
    of_changed = (lambda df: df) if changed is None else (lambda df: df.where(F.col("observed_on").isin(changed)))
    some = of_changed(facts)
    days.save_days(gold.market_daily(some), "marts.mart_market_daily", changed)
    days.save_days(gold.salary_daily(some, countries), "marts.mart_salary_daily", changed)
    days.save_days(gold.salary_disclosure(some), "marts.mart_salary_disclosure", changed)
    days.save_days(gold.city_daily(some), "marts.mart_city_daily", changed)
    days.save_days(gold.bi_table(some, countries, roles), "marts.bi_vacancies", changed)
    save_table(gold.company_role(facts), "marts.mart_company_role")
    if not changed:  # nothing new to test by itself: all of it
        return checks.run(staged, ads, facts, versions, companies, countries, roles)
    return checks.run(of_changed(staged), of_changed(ads), some, versions, companies, countries, roles)


def run_day(
    spark: SparkSession, folder: str, *dates: str, allow_incomplete: bool = False, publish_to: str | None = None
) -> bronze.Load:
    """Load, rebuild and test; raises when a data test fails.

    With ``publish_to`` the marts that passed are published there as one version (:mod:`postings.sources.publication`);
    readers of it never see a build at work or one that failed.
    """
    loaded = bronze.load_days(spark, folder, *dates, allow_incomplete=allow_incomplete)
    enforce(build(spark))
    if publish_to:
        publication.publish(spark, publish_to, *PUBLISHED)
    return loaded
