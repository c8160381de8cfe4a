"""Dimensions, the fact table and the marts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postings import fixed
from postings.functions import (
    city_group,
    company_key,
    folded,
    location_key,
    surrogate_key,
)
from postings.operators.history import as_of, as_of_merge, scd2
from postings.operators.measures import measures
from postings.operators.quantiles import CONTINUOUS, DISCRETE, quantiles, with_quantiles
from postings.operators.sizing import measured_small
from postings.operators.sketches import merged as merged_sketches
from postings.operators.sketches import sketched_quantiles, sketches
from postings.operators.snapshot import latest
from postings.plans import silver

FACT_COLUMNS = [
    "vacancy_daily_sk", "source_id", "observed_on", "vacancy_sk", "company_sk", "location_sk",
    "country_code", "role_key", "position_id", "title", "company_name",
    "location_region", "location_city", "salary_min", "salary_max", "salary_mid",
    "is_salary_disclosed", "contract_type", "contract_time", "grade", "remote_type",
    "is_remote", "is_relevant", "is_new", "is_gone", "days_open", "days_since_posted",
    "first_seen_on", "posted_at", "redirect_url", "role_queries",
]


def is_open() -> Column:
    return ~F.col("is_gone")


def open_disclosed() -> Column:
    return is_open() & F.col("is_salary_disclosed")


# --- dimensions -----------------------------------------------------------------

def _fixed_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    columns = {n: pa.array(values) for n, values in zip(names, zip(*rows))}
    return spark.createDataFrame(pa.table(columns))


def dim_country(spark: SparkSession) -> DataFrame:
    names = ["country_code", "country_name", "currency", "salary_charts"]
    return _fixed_rows(spark, fixed.COUNTRY_ROWS, names).select(
        "country_code", "country_name", "currency", (F.col("salary_charts") == 1).alias("show_salary")
    )


def dim_role(spark: SparkSession) -> DataFrame:
    rows = _fixed_rows(spark, fixed.ROLE_ROWS, ["role_key", "role_name", "priority"])
    return rows.withColumn("priority", F.col("priority").cast("int"))


def dim_company(ads: DataFrame) -> DataFrame:
    """One row per company, whatever the case of its name; the key is hashed once per company."""
    return (
        ads.where(F.col("company_name").isNotNull())
        .groupBy(folded("company_name").alias("name"))
        .agg(F.min("company_name").alias("company_name"))
        .select(surrogate_key("name").alias("company_sk"), "company_name")
    )


def dim_location(ads: DataFrame) -> DataFrame:
    places = ads.select("country_code", "location_region", "location_city").distinct()
    return places.select(location_key().alias("location_sk"), *places.columns)


def dim_date(staged: DataFrame) -> DataFrame:
    return staged.select(F.col("observed_on").alias("date_day")).distinct().select(
        "date_day",
        F.year("date_day").cast("bigint").alias("year"),
        F.month("date_day").cast("bigint").alias("month"),
        F.dayofmonth("date_day").cast("bigint").alias("day"),
    )


def dim_vacancy(ads: DataFrame) -> DataFrame:
    return scd2(ads, silver.KEY, silver.DAY, silver.VERSIONED, "vacancy_sk")


# --- fact -----------------------------------------------------------------------

def _with_keys(daily: DataFrame) -> DataFrame:
    return daily.select(
        *daily.columns,
        surrogate_key("source_id", "observed_on").alias("vacancy_daily_sk"),
        company_key().alias("company_sk"),
        location_key().alias("location_sk"),
    )


def fact(ads: DataFrame, covered: DataFrame | None = None) -> DataFrame:
    """The daily fact; the version key comes from the same window as the status."""
    keyed = _with_keys(silver.daily(ads, covered, with_versions=True))
    return keyed.withColumn("vacancy_sk", surrogate_key("source_id", "version_from")).select(
        *FACT_COLUMNS
    )


def fact_by_join(daily: DataFrame, versions: DataFrame, merge: bool = False) -> DataFrame:
    """The same fact from separately kept daily rows and versions, by an as-of join, or by ``merge``."""
    attach = as_of_merge if merge else as_of
    return attach(_with_keys(daily), versions, silver.KEY, silver.DAY, ["vacancy_sk"]).select(
        *FACT_COLUMNS
    )


def fact_of_day(ads: DataFrame, states: DataFrame, yesterday: DataFrame | None) -> DataFrame:
    """The fact rows of one day, from its ads, their state rows and the fact of the observed day before.

    An ad that was present the day before, is absent now and whose country was
    collected now leaves its gone row: its last row under the new date. Both
    joins are by ad; the countries of a day are few and measured.
    """
    after = states.select(silver.KEY, "first_seen_on", "version_from")
    status = ads.join(after, silver.KEY).select(
        *ads.columns, "version_from", "first_seen_on", F.col(silver.DAY).alias("last_present_on"),
        (F.col(silver.DAY) == F.col("first_seen_on")).alias("is_new"), F.lit(False).alias("is_gone"))
    keyed = _with_keys(silver.aged(status))
    present = keyed.withColumn("vacancy_sk", surrogate_key("source_id", "version_from")).select(*FACT_COLUMNS)
    if yesterday is None:
        return present
    covered = measured_small(ads.select(silver.GUARD, F.col(silver.DAY).alias("_today")).distinct())
    left = yesterday.where(is_open()).join(ads.select(silver.KEY), silver.KEY, "left_anti").join(covered, silver.GUARD)
    changed = {
        "vacancy_daily_sk": surrogate_key("source_id", "_today"), "observed_on": F.col("_today"),
        "is_new": F.lit(False), "is_gone": F.lit(True),
    }
    return present.union(left.select(*[changed.get(c, F.col(c)).alias(c) for c in FACT_COLUMNS]))


# --- marts ----------------------------------------------------------------------
# The fact is unique per ad and day. Where the grouping holds the day, counting
# rows is counting distinct ads; positions stay a real distinct count.

def market_daily(facts: DataFrame) -> DataFrame:
    one_of = {
        "n_salary_disclosed": F.col("is_salary_disclosed"),
        "n_remote_or_hybrid": F.col("is_remote"),
        "n_permanent": F.col("contract_type") == "permanent",
        "n_contract": F.col("contract_type") == "contract",
        "n_full_time": F.col("contract_time") == "full_time",
        "n_part_time": F.col("contract_time") == "part_time",
        **{f"n_{g}": F.col("grade") == g for g in fixed.GRADES},
    }
    return measures(
        facts.where("is_relevant"),
        ["observed_on", "country_code", "role_key"],
        counts={
            "n_ads": is_open(),
            "n_new": F.col("is_new") & is_open(),
            "n_gone": F.col("is_gone"),
            **{name: is_open() & rule for name, rule in one_of.items()},
        },
        distinct={"n_positions": (is_open(), "position_id")},
    )


def salary_disclosure(facts: DataFrame) -> DataFrame:
    return measures(
        facts.where("is_relevant"),
        ["observed_on", "country_code"],
        counts={"n_ads": is_open(), "n_salary_disclosed": open_disclosed()},
    )


def city_daily(facts: DataFrame) -> DataFrame:
    return measures(
        facts.where(F.col("is_relevant") & F.col("location_city").isNotNull()),
        ["observed_on", "country_code", "location_city", "location_region", "role_key"],
        counts={"n_ads": is_open()},
        distinct={"n_positions": (is_open(), "position_id")},
    )


SALARY_GROUP = ["observed_on", "country_code", "role_key", "currency"]


def charted_salaries(facts: DataFrame, countries: DataFrame) -> DataFrame:
    """Open relevant ads with a disclosed salary in the countries whose salaries are shown."""
    charted = measured_small(countries.where("show_salary").select("country_code", "currency"))
    return facts.where(F.col("is_relevant") & open_disclosed()).join(charted, "country_code")


def salary_daily(facts: DataFrame, countries: DataFrame, approx: bool = False) -> DataFrame:
    """Counts, medians and quartiles of disclosed salaries, one currency per row."""
    return quantiles(
        charted_salaries(facts, countries),
        SALARY_GROUP,
        {
            "salary_mid_p50": ("salary_mid", 0.5, CONTINUOUS),
            "salary_mid_p25": ("salary_mid", 0.25, DISCRETE),
            "salary_mid_p75": ("salary_mid", 0.75, DISCRETE),
            "salary_min_p50": ("salary_min", 0.5, CONTINUOUS),
            "salary_max_p50": ("salary_max", 0.5, CONTINUOUS),
        },
        rows_as="n_disclosed",
        approx=approx,
    )


def salary_sketches(facts: DataFrame, countries: DataFrame) -> DataFrame:
    """Sketches of disclosed salaries per day, country, role and currency, to be merged by :func:`salary_of_sketches`."""
    return sketches(charted_salaries(facts, countries), SALARY_GROUP, ["salary_mid", "salary_min", "salary_max"])


def salary_of_sketches(found: DataFrame, by: list[str]) -> DataFrame:
    """Counts, medians and quartiles of coarser groups, weeks or countries say, from the sketches of their days."""
    whole = merged_sketches(found, by, ["salary_mid", "salary_min", "salary_max"])
    return sketched_quantiles(whole, by, {
        "salary_mid_p50": ("salary_mid", 0.5), "salary_mid_p25": ("salary_mid", 0.25), "salary_mid_p75": ("salary_mid", 0.75),
        "salary_min_p50": ("salary_min", 0.5), "salary_max_p50": ("salary_max", 0.5),
    })


def company_role(facts: DataFrame, days_of: DataFrame | None = None) -> DataFrame:
    """Who hires now: the latest day by company and role. All its days are one global latest day."""
    by = ["observed_on", "country_code", "role_key", "company_name"]
    now = latest(facts, "observed_on", days_of).where(
        F.col("is_relevant") & F.col("company_name").isNotNull()
    ).select(
        *by,
        "position_id",
        "is_gone",
        "is_new",
        F.when(is_open(), F.col("days_open")).alias("open_for"),
        F.when(open_disclosed(), F.col("salary_mid")).alias("disclosed_mid"),
    )
    counted = measures(
        now,
        by,
        distinct={
            "n_positions_open": (is_open(), "position_id"),
            "n_positions_new": (F.col("is_new") & is_open(), "position_id"),
        },
    )
    # days open are at most as many values as there are days: one aggregate, combined before the shuffle
    open_for = now.groupBy(*by).agg(F.percentile("open_for", 0.5).alias("days_open_p50"))
    salaries = quantiles(now, by, {"salary_mid_p50": ("disclosed_mid", 0.5, CONTINUOUS)})
    return with_quantiles(with_quantiles(counted, open_for, by), salaries, by)


def unmatched_titles(ads: DataFrame) -> DataFrame:
    return (
        ads.where(F.col("role_key") == fixed.NO_ROLE)
        .groupBy("title", "country_code", "role_queries")
        .agg(F.count("*").alias("n"))
    )


def bi_table(facts: DataFrame, countries: DataFrame, roles: DataFrame) -> DataFrame:
    """Flat table for dashboards: relevant rows with labels and the city group."""
    labelled = (
        facts.where("is_relevant")
        .join(measured_small(countries), "country_code", "left")
        .join(measured_small(roles), "role_key", "left")
    )
    return labelled.select(
        "observed_on", "source_id", "position_id", "country_code", "country_name",
        "role_key", "role_name", "title", "company_name", "location_region", "location_city",
        city_group().alias("city_group"),
        "salary_min", "salary_max", "salary_mid", "is_salary_disclosed",
        "contract_type", "contract_time", "grade", "remote_type", "is_remote",
        "is_new", "is_gone", is_open().alias("is_open"),
        "days_open", "days_since_posted", "currency", "show_salary",
    )
