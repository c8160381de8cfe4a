"""Raw rows to classified, deduplicated ads and their daily status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings import fixed
from postings.functions import (
    days_between,
    days_since,
    grade_of,
    position_key,
    role_of,
    salary_disclosed,
    salary_mid,
    trimmed,
    work_mode_of,
)
from postings.operators.dedup import dedup, dedup_in_two
from postings.operators.presence import daily_status

KEY, DAY, GUARD = "source_id", "observed_on", "country_code"

ATTRIBUTES = [
    "country_code", "title", "description", "posted_at", "company_name",
    "salary_min", "salary_max", "is_salary_disclosed", "contract_type", "contract_time",
    "location_display_name", "location_region", "location_city",
    "latitude", "longitude", "redirect_url",
]
# where repeats disagree, the first result by country, query, page and file counts
REPEAT_ORDER = ["country_code", "role_query", "page", "source_file"]
VERSIONED = ["title", "grade", "contract_type", "contract_time", "is_remote"]


def stage(raw: DataFrame) -> DataFrame:
    """Internal names, trimmed text, the disclosure rule; rows without an id are dropped."""
    return raw.where(F.col("source_id").isNotNull()).select(
        F.col("run_date").alias("observed_on"),
        "extracted_at",
        F.col("country").alias("country_code"),
        "role_query",
        "page",
        "count_reported",
        "source_id",
        trimmed("title").alias("title"),
        "description",
        "posted_at",
        F.nullif(trimmed("company_name"), F.lit("")).alias("company_name"),
        "salary_min",
        "salary_max",
        "salary_is_predicted",
        salary_disclosed().alias("is_salary_disclosed"),
        "contract_type",
        "contract_time",
        "location_display_name",
        "location_region",
        "location_city",
        "latitude",
        "longitude",
        "redirect_url",
        "source_file",
    )


def deduped(staged: DataFrame, in_two: bool = False) -> DataFrame:
    """One row per ad and day, with the ordered list of queries that found it; ``in_two`` passes where the rows are many."""
    collapse = dedup_in_two if in_two else dedup
    return collapse(staged, [KEY, DAY], ATTRIBUTES, REPEAT_ORDER, "role_query", "role_queries")


def coverage(staged: DataFrame) -> DataFrame:
    """Day and country pairs of the ads, without reading the wide columns.

    An ad seen in several countries on one day counts for the first of them,
    as in :func:`deduped`, whose order starts with the country.
    """
    return staged.groupBy(KEY, DAY).agg(F.min(GUARD).alias(GUARD)).select(DAY, GUARD)


def enriched(ads: DataFrame) -> DataFrame:
    """Role, grade, work mode, relevance and the position key."""
    return ads.select(
        *ads.columns,
        role_of().alias("role_key"),
        grade_of().alias("grade"),
        work_mode_of().alias("remote_type"),
    ).select(
        "*",
        (F.col("role_key") != fixed.NO_ROLE).alias("is_relevant"),
        F.col("remote_type").isin(fixed.REMOTE_MODES).alias("is_remote"),
        position_key().alias("position_id"),
    )


def present(staged: DataFrame, in_two: bool = False) -> DataFrame:
    return enriched(deduped(staged, in_two))


def daily(
    ads: DataFrame, covered: DataFrame | None = None, with_versions: bool = False
) -> DataFrame:
    """Present and gone rows per ad and day, with age and mid salary.

    ``covered`` spares a second pass over ads that are not stored (see :func:`coverage`).
    """
    return aged(daily_status(ads, KEY, DAY, GUARD, covered, VERSIONED if with_versions else None))


def aged(status: DataFrame) -> DataFrame:
    """Status rows with age and mid salary, without their last day of presence."""
    return status.select(
        *[c for c in status.columns if c != "last_present_on"],
        salary_mid().alias("salary_mid"),
        (days_between("first_seen_on", "last_present_on") + 1).alias("days_open"),
        days_since("posted_at", "last_present_on").alias("days_since_posted"),
    )
