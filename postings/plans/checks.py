"""The data tests of the warehouse: 22 declared on columns, 4 on grain, key and rule, and one on the days of the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings import fixed
from postings.functions import folded, salary_disclosed
from postings.operators.quality import (
    all_tests,
    dependency_test,
    not_accepted,
    not_null,
    relationship_test,
    row_tests,
    same_days_test,
    unique_test,
)


def run(
    staged: DataFrame,
    ads: DataFrame,
    facts: DataFrame,
    versions: DataFrame,
    companies: DataFrame,
    countries: DataFrame,
    roles: DataFrame,
) -> DataFrame:
    def not_nulls(table: str, *columns: str) -> dict:
        return {f"{table}.{c} not null": not_null(c) for c in columns}

    return all_tests(
        row_tests(staged, {
            **not_nulls("staging", "source_id", "observed_on", "country_code", "is_salary_disclosed"),
            "staging.country_code accepted": not_accepted("country_code", fixed.COUNTRIES),
            "staging disclosure rule": F.col("is_salary_disclosed") != salary_disclosed(),
        }),
        unique_test(ads, "ads grain", "source_id", "observed_on"),
        dependency_test(ads, "ads position key", "position_id", {
            "company": folded("company_name"), "title": folded("title"),
        }),
        row_tests(facts, not_nulls(
            "fact", "vacancy_daily_sk", "source_id", "observed_on", "country_code", "role_key"
        )),
        unique_test(facts, "fact.vacancy_daily_sk unique", "vacancy_daily_sk"),
        unique_test(facts, "fact grain", "source_id", "observed_on"),
        relationship_test(facts, "fact.country_code in dim_country", "country_code", countries),
        relationship_test(facts, "fact.role_key in dim_role", "role_key", roles),
        same_days_test(
            "days of staging, ads and fact", staged.select("observed_on"), ads.select("observed_on"), facts.where("NOT is_gone").select("observed_on")
        ),
        row_tests(versions, not_nulls("dim_vacancy", "vacancy_sk", "source_id")),
        unique_test(versions, "dim_vacancy.vacancy_sk unique", "vacancy_sk"),
        row_tests(companies, not_nulls("dim_company", "company_sk")),
        unique_test(companies, "dim_company.company_sk unique", "company_sk"),
        row_tests(countries, not_nulls("dim_country", "country_code")),
        unique_test(countries, "dim_country.country_code unique", "country_code"),
        row_tests(roles, not_nulls("dim_role", "role_key")),
        unique_test(roles, "dim_role.role_key unique", "role_key"),
    )
